"""The Metaphone code of a name (Philips, 1990), for small lists on the driver.

Letters become the sounds 0BFHJKLMNPRSTWXY (0 is "th", X is "sh"); vowels stay at the beginning only;
words keep their spaces. The rules look at a letter's neighbours in the name without its doubled
letters (cc stays).
"""

from __future__ import annotations

VOWELS = frozenset("AEIOU")
FRONT = frozenset("EIY")
SAME = frozenset("FJLMNR")
SILENT_STARTS = ("KN", "GN", "PN", "AE", "WR")


def metaphone(name: str | None) -> str | None:
    """The code of a name, words joined by a space; null or without letters: null."""
    codes = [_word(w) for w in (name or "").upper().split()]
    return " ".join(c for c in codes if c) or None


def _word(word: str) -> str:
    letters = [c for c in word if "A" <= c <= "Z"]
    s = "".join(c for i, c in enumerate(letters) if not i or c != letters[i - 1] or c == "C")
    if s.startswith(SILENT_STARTS):
        s = s[1:]
    return "".join(_sound(s, i) for i in range(len(s)))


def _sound(s: str, i: int) -> str:
    """What the letter at place ``i`` adds to the code."""
    c, before, rest = s[i], s[i - 1 : i], s[i + 1 :]
    after, vowel_next = rest[:1], rest[:1] in VOWELS and bool(rest)
    if c in VOWELS:
        return c if i == 0 else ""
    if c in SAME:
        return c
    if c == "B":
        return "" if before == "M" and not rest else "B"
    if c == "C":
        if rest.startswith("IA") or after == "H":
            return "K" if after == "H" and before == "S" else "X"
        if after and after in FRONT:
            return "" if before == "S" else "S"
        return "K"
    if c == "D":
        return "J" if rest[:2] in ("GE", "GI", "GY") else "T"
    if c == "G":
        if after == "H" and rest[1:2] and rest[1:2] not in VOWELS or rest in ("N", "NED") or before == "D" and after and after in FRONT:
            return ""
        return "J" if after and after in FRONT and before != "G" else "K"
    if c == "H":
        if before and before in "CGPST" or i == 1 and before == "W":
            return ""
        return "" if before in VOWELS and before and not vowel_next else "H"
    if c == "K":
        return "" if before == "C" else "K"
    if c == "P":
        return "F" if after == "H" else "P"
    if c == "S":
        return "X" if after == "H" or rest[:2] in ("IO", "IA") else "S"
    if c == "T":
        if after == "H":
            return "0"
        return "X" if rest[:2] in ("IA", "IO") else "" if rest.startswith("CH") else "T"
    if c == "W" or c == "Y":
        return c if vowel_next or c == "W" and i == 0 and after == "H" else ""
    if c == "X":
        return "S" if i == 0 else "KS"
    return {"Q": "K", "V": "F", "Z": "S"}[c]

"""Token ids of whole texts through the tokenizers library, one call per distinct word.

A text is cut where the tokenizer's own rules cut anyway: at spaces and line ends, then between
a word's letters and one closing mark. The library encodes each distinct part once per Python
worker, in bounded tables, since most parts of a corpus are repeats. The ids equal those of the
library for the whole text; ``tests/llm`` compares them on random texts.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import cache
from itertools import compress

from .memo import Memo, byte_letters, lowered

#: Marks that both splitting patterns cut off a run of letters, as a part of their own.
CLOSING = ".,;:!?"
#: Words that the model takes at once.
TOGETHER = 32


class ChunkEncoder:
    """``path``: a tokenizer file of the tokenizers library. ``spaced``: True for byte-level
    vocabularies whose words carry their leading space; False for lower-case ones that drop white
    space. ``dtype``: little-endian unsigned ids of 2 bytes ("<u2") or 4 ("<u4"). ``words``: kept words."""

    def __init__(self, path: str, spaced: bool, dtype: str = "<u4", words: int = 120_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import numpy as np
        from tokenizers import Tokenizer

        self.np = np
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.get_vocab_size() > 1 << 8 * np.dtype(dtype).itemsize:
            raise ValueError(f"{dtype} is too small for the ids of {path}")
        self.dtype, self.spaced = np.dtype(dtype), spaced
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]  # array codes of that width; little-endian machines
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(byte_letters()))  # for str.translate of the bytes as Latin-1
        self.word = Memo(self.word_ids, words)
        self.raw = Memo(self.library_ids)
        self.after = Memo(self.after_space)
        self.first = Memo(self.line_start)
        if spaced:
            vocabulary, space = self.tokenizer.get_vocab(), self.letters[32]
            self.opening = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that begin with a space or are a line end
            for token, i in vocabulary.items():
                self.opening[i] = token[0] == space or token == self.letters[10]
            byte = {letter: b for b, letter in self.letters.items()}
            led = (t[:i] for t in vocabulary if space in t[1:] for i in range(1, len(t)) if t[i] == space)  # before a space inside a token
            last = [bytes(byte.get(c, 255) for c in t).decode(errors="replace")[-1] for t in led]
            self.by_letters = not any(c.isalpha() or c == "\ufffd" for c in last)
            self.codes = np.array([ord(self.letters[b]) for b in range(256)], "<u4")
        self.cut = re.compile(r"(?<=\S) (?=\S)")

    def packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def library_ids(self, text: str) -> bytes:
        """The library's ids of ``text`` as it stands."""
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word_ids(self, word: str) -> bytes:
        """The library's ids of one part that its splitting leaves whole."""
        return self.packed([t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))])

    def piece(self, piece: str, space: str) -> bytes:
        """The ids of a piece without white space at its ends."""
        body = piece.rstrip(CLOSING)
        mark = piece[len(body) :]
        body = body if self.spaced else lowered(body)
        if body.isalpha():
            ids = self.word[space + body if space else body]
            return ids + self.word[mark] if mark else ids
        return self.library_ids(space + piece)

    def after_space(self, piece: str) -> bytes | bool:
        """The ids of a piece that follows one space; False where the space isn't the piece's own."""
        if not piece:
            return False if self.spaced else b""
        if self.spaced and (piece[0].isspace() or piece[-1].isspace()):
            return False
        return self.piece(piece, " " if self.spaced else "")

    def line_start(self, piece: str) -> bytes | bool:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return False
        return self.piece(piece, "")

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, as bytes."""
        if not self.spaced:
            return b"".join(map(self.after.__getitem__, text.replace("\n", " ").split(" ")))
        if not text:
            return b""
        out = []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            out.append(self.first[head])
            out += map(self.after.__getitem__, rest)
            out.append(self.raw["\n"])
        if False in out:
            return self.by_runs(text)
        return b"".join(out[:-1])

    def by_runs(self, text: str) -> bytes:
        """The ids of ``text``, cut only at single spaces between other characters."""
        cuts = [0, *(m.start() for m in self.cut.finditer(text)), len(text)]
        return b"".join([self.raw[text[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)])

    def cut_ids(self, ids, pieces: list[str]) -> list[bytes]:
        """``ids`` of all ``pieces`` cut where a piece begins; each alone by the library if that doesn't tell them apart."""
        begins = (self.np.flatnonzero(self.opening[ids]) * self.dtype.itemsize).tolist()
        if len(begins) != len(pieces):
            return [self.library_ids(p if p[0] == "\n" else " " + p) for p in pieces]
        flat = ids.tobytes()
        return [flat[a:b] for a, b in zip(begins, [*begins[1:], len(flat)], strict=True)] if pieces else []

    def letter_ids(self, words: list[str]):
        """The ids of distinct ``words`` of letters, each behind a space. No merge leads over a space that follows
        a letter, so the model takes some words at once, whose ids are those of each."""
        np, out = self.np, []
        for i in range(0, len(words), TOGETHER):
            data = np.frombuffer((" " + " ".join(words[i : i + TOGETHER])).encode(), np.uint8)
            out += [t.id for t in self.model.tokenize(self.codes[data].tobytes().decode("utf-32-le"))]
        return np.array(out, self.dtype)

    def spaced_pieces(self, pieces: list[str]) -> list[bytes | bool]:
        """The ids of distinct pieces, each behind a space or, if it begins with one, a line end.
        False where other white space stands at a piece's ends."""
        bodies, marks, made = [], [], {}
        for piece in pieces:
            body = piece.rstrip(CLOSING)
            if len(body) < len(piece) and body.isalpha():  # the library cuts the marks off, too
                bodies.append(body)
                marks.append(piece[len(body) :])
                if body not in made:
                    made[body] = self.word.get(body) or self.word.old.get(body)
            else:
                bodies.append(piece)
                marks.append("")
                made[piece] = None
        new = [b for b, ids in made.items() if ids is None]
        words = [b for b in new if b.isalpha()] if self.by_letters else []
        made.update(zip(words, self.cut_ids(self.letter_ids(words), words), strict=True))
        rest = [b for b in new if made[b] is None]
        own = [p.strip() == p != "" if p[:1] != "\n" else p[1:].strip() == p[1:] != "" for p in rest]
        made.update((p, False) for p, o in zip(rest, own, strict=True) if not o)
        rest = list(compress(rest, own))
        whole = (" " + " ".join(rest)).replace(" \n", "\n") if rest else ""
        ids = self.np.array(self.tokenizer.encode_batch_fast([whole], add_special_tokens=False)[0].ids, self.dtype)
        made.update(zip(rest, self.cut_ids(ids, rest), strict=True))
        return [made[b] + self.raw[m] if m else made[b] for b, m in zip(bodies, marks, strict=True)]

    def told_apart_spaced(self, texts: list[str]):
        """``encode_many`` of spaced vocabularies. A piece that begins a line has its line end before it."""
        import pyarrow as pa
        import pyarrow.compute as pc

        np, width = self.np, self.dtype.itemsize
        lined = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n")
        lists = pc.split_pattern(pc.binary_join_element_wise(pa.scalar("\n", pa.large_string()), lined, pa.scalar("", pa.large_string())), " ")
        words = lists.flatten().dictionary_encode()
        made = self.word.many(words.dictionary.to_numpy(zero_copy_only=False).tolist(), self.spaced_pieces)
        which, offsets = words.indices.to_numpy(), lists.offsets.to_numpy()
        if False not in made:
            flat, ends = self.gathered(made, which, offsets)  # the line end before a text isn't its own
            return np.delete(flat, ends[:-1]), ends - np.arange(len(ends))
        other = np.array([ids is False for ids in made], bool)
        flat, ends = self.gathered([ids or b"" for ids in made], which, offsets)
        spoiled = np.diff(np.append(0, np.cumsum(other[which]))[offsets]) > 0
        parts = [self.by_runs(text) if bad else flat[a + 1 : b].tobytes() for text, bad, a, b in zip(texts, spoiled.tolist(), ends, ends[1:], strict=False)]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // width
        return np.frombuffer(b"".join(parts), self.dtype), np.append(0, np.cumsum(lengths))

    def gathered(self, made: list[bytes], which, offsets):
        """The ids of the words ``which`` of ``made`` one behind the other, and the places of the words at ``offsets``."""
        np = self.np
        lengths = np.fromiter(map(len, made), np.int64, len(made)) // self.dtype.itemsize
        begins = np.cumsum(lengths) - lengths
        n = lengths[which]
        ends = np.append(0, np.cumsum(n))
        at = np.repeat(begins[which] - ends[:-1], n)
        at += np.arange(len(at))
        return np.frombuffer(b"".join(made), self.dtype)[at], ends[offsets]

    def told_apart(self, piece: str) -> bytes:
        """``after_space`` without a table of its own for letters (words are distinct already), so ``word`` has the room."""
        body = piece.rstrip(CLOSING)
        low = lowered(body)
        if low.isalpha():
            return self.word[low] if len(body) == len(piece) else self.word[low] + self.word[piece[len(body) :]]
        return self.after[piece]

    def encode_many(self, texts: list[str]):
        """The ids of all ``texts`` one behind the other, and the place where each text's begin (and the last
        one's end). The words of all texts are told apart first, each is looked up once."""
        if self.spaced:
            return self.told_apart_spaced(texts)
        import pyarrow as pa
        import pyarrow.compute as pc

        lists = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        made = list(map(self.told_apart, words.dictionary.to_pylist()))
        return self.gathered(made, words.indices.to_numpy(), lists.offsets.to_numpy())


@cache
def encoder(path: str, spaced: bool, dtype: str = "<u4", words: int = 120_000) -> ChunkEncoder:
    """The encoder of this Python process; its tables serve all tasks that the process runs."""
    return ChunkEncoder(path, spaced, dtype, words)

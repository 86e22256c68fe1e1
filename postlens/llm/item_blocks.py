"""Words of texts as bytes, and a query set (benchmark items) in blocks of bounded size.

A query set is held whole by every task, so it goes in blocks: ``item_blocks`` deals its distinct
rows by hash to groups of ``max_chars`` characters on average, cuts a larger one, and hands blocks of at
most ``max_chars`` out one at a time (an item that alone is longer is a block of its own). The number of
passes over the documents is the number of blocks: it grows with the query set, never with the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written

#: Bytes of a text as word bytes: digits, lower-cased A-Z, and all bytes of code points from U+0080
#: on; every other byte separates words.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: The same words in a text, for their places in code points.
WORD_PATTERN = "[0-9A-Za-z\x80-\U0010ffff]+"

Item = tuple[str | None, tuple[bytes, ...]]


def text_words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased; null has none."""
    return text.encode().translate(WORD_BYTES).split() if text else []


def item_blocks(items: DataFrame, id_col: str, text_col: str, max_chars: int) -> Iterator[list[Item]]:
    """The distinct (id as string, words) of ``items`` in blocks; items without words are left out."""
    rows = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).filter("text is not null").distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    number = F.pmod(F.xxhash64("id", "text"), F.lit(max(1, -(-total // max_chars))))
    dealt = written(rows.groupBy(number.alias("block")).agg(F.collect_list(F.struct("id", "text")).alias("items")), "item-blocks")
    for row in dealt.toLocalIterator():
        held, n = [], 0
        for x in row["items"]:
            if held and n + len(x["text"]) > max_chars:
                yield held
                held, n = [], 0
            words = tuple(text_words(x["text"]))
            if words:
                held.append((x["id"], words))
                n += len(x["text"])
        if held:
            yield held

"""Linking inside groups of any size, in blocks.

Members of a group that may be linked are compared in a task that reads its group as one sorted run.
A group of more than ``BLOCK`` members is cut into blocks, and each pair of blocks is a group of
its own, so that no task holds more than two blocks, and no pair is left out. What a group emits
is a spanning forest of its links: fewer rows than members, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 2048


def in_blocks(rows: DataFrame, size: str, place: Column) -> DataFrame:
    """``rows`` with a column ``pair``: -1 for groups of at most ``BLOCK`` members by the column
    ``size``, else one copy of the row for each pair of blocks that holds its block. ``place`` is a
    long hash that deals members to blocks."""
    blocks = F.when(F.col(size) > BLOCK, F.ceil(F.col(size) / BLOCK)).otherwise(1).cast("int")
    dealt = rows.withColumn("__own", F.pmod(place, blocks).cast("int"))
    copies = dealt.withColumn("__other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    pair = F.least("__own", "__other").cast("long") * (1 << 31) + F.greatest("__own", "__other")
    return copies.withColumn("pair", F.when(F.col(size) > BLOCK, pair).otherwise(F.lit(-1).cast("long"))).drop("__own", "__other")


def forest(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Spanning-forest edges (member, root) of ``n`` members, by a search that compares each reached
    member with those not yet reached. ``near(i, rest)`` says which of ``rest`` are linked to i."""
    rest, out = np.arange(n), []
    while len(rest) > 1:
        root, rest = int(rest[0]), rest[1:]
        wave = [root]
        while wave and len(rest):
            hit = near(wave.pop(), rest)
            if hit.any():
                found = rest[hit].tolist()
                out += [(x, root) for x in found]
                wave += found
                rest = rest[~hit]
    return out


def runs(batches: Iterator[dict[str, list]], key: list[str]) -> Iterator[dict[str, list]]:
    """Cuts sorted batches into their runs of equal ``key``, which may cross batches."""
    held: dict[str, list] | None = None
    for batch in batches:
        keys = list(zip(*(batch[k] for k in key), strict=True))
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            part = {k: v[start:i] for k, v in batch.items()}
            if held is not None and all(held[k][0] == x for k, x in zip(key, keys[start], strict=True)):
                held = {k: v + part[k] for k, v in held.items()}
            else:
                if held is not None:
                    yield held
                held = part
            start = i
    if held is not None:
        yield held

"""Blocks of neighbouring points, so that a k-means pass compares few points with few centres.

``pack`` splits points by halves at the widest column (a k-d tree's leaves) into blocks of about 6 KB. A block
holds its points and, in ``held``, their number, scatter about the mean, sums and bounding box. ``add_up`` is one pass of
Lloyd's algorithm over blocks (Kanungo et al., 2002, the filtering step): a centre that is farther than another one from
every place of the box can't own a point of the block. A block with one centre left goes to it as a whole; the points
of the others are compared with the centres left. The result is that of comparing all points with all centres.
"""

from __future__ import annotations

import numpy as np

BLOCK_BYTES = 6144
CHUNK_BYTES = 1 << 25
SLICE_POINTS = 1 << 14
#: Rounding of a comparison by a box, as a share of the squared coordinates (a bound on it, for each column).
ROUNDING = 1e-13


def block_size(dims: int) -> int:
    return max(16, BLOCK_BYTES // (8 * dims))


def split(x, size: int) -> list:
    """Indices of the rows of ``x`` in blocks of ``size`` (one may be smaller) by halves at the widest column."""
    parts, found = [np.arange(len(x))], []
    while parts:
        own = parts.pop()
        if len(own) <= size:
            found.append(own)
            continue
        some = x[own]
        half = -(-len(own) // size) // 2 * size
        order = np.argpartition(some[:, np.argmax(some.max(0) - some.min(0))], half)
        parts += [own[order[:half]], own[order[half:]]]
    return found


def pack(x) -> tuple[list, list]:
    """``held`` and ``points`` as bytes for each block of the rows of ``x``; a short block repeats its last point."""
    size = block_size(x.shape[1])
    held, points = [], []
    for own in split(x, size):
        p = x[own]
        sums = p.sum(0)
        scatter = ((p - sums / len(p)) ** 2).sum()
        held.append(np.concatenate([[len(p), scatter], sums, p.min(0), p.max(0)]).tobytes())
        points.append(np.concatenate([p, np.repeat(p[-1:], size - len(p), 0)]).T.tobytes())
    return held, points


def left_over(lo, hi, c):
    """For each box and centre, whether the centre may be the nearest one of a point in the box."""
    dims = c.shape[1]
    mid = (lo + hi) / 2
    far = sum((mid[:, i, None] - c[:, i]) ** 2 for i in range(dims))
    best = c[far.argmin(1)]
    # the difference of the squared distances is linear, least at the corner towards the other centre
    least = 0.0
    for i in range(dims):
        b = best[:, i, None]
        step = c[:, i] - b
        least = least + step * (c[:, i] + b - 2 * np.where(step > 0, hi[:, i, None], lo[:, i, None]))
    reach = np.maximum(np.abs(lo), np.abs(hi)).max(1) + np.abs(c).max()
    return ~(least > (ROUNDING * dims * reach ** 2)[:, None])


def add_up(held, points, c):
    """Per centre of ``c`` the number of points nearest to it (lowest index on ties) and their sums, and the cost."""
    k, dims = c.shape
    n, scatter, sums, lo, hi = held[:, 0], held[:, 1], held[:, 2:2 + dims], held[:, 2 + dims:2 + 2 * dims], held[:, 2 + 2 * dims:]
    may = left_over(lo, hi, c)
    whole = may.sum(1) == 1
    own, w = may[whole].argmax(1), n[whole]
    count = np.bincount(own, w, k)
    total = np.stack([np.bincount(own, sums[whole, i], k) for i in range(dims)], 1).astype(float)  # of no block: integers
    # about a block's mean, so that no digits are lost
    cost = (scatter[whole] + w * ((sums[whole] / w[:, None] - c[own]) ** 2).sum(1)).sum()
    rest = np.flatnonzero(~whole)
    size = points.shape[2]
    step = max(1, SLICE_POINTS // size)
    for at in range(0, len(rest), step):
        blocks = rest[at:at + step]
        x, open_ = points[blocks], may[blocks]
        nearest, least = np.zeros((len(blocks), size), np.int64), np.full((len(blocks), size), np.inf)
        for j in range(k):
            some = np.flatnonzero(open_[:, j])
            if not len(some):
                continue
            p, before = x[some], least[some]
            d = (p[:, 0] - c[j, 0]) ** 2
            for i in range(1, dims):
                d += (p[:, i] - c[j, i]) ** 2
            nearest[some] = np.where(d < before, j, nearest[some])
            least[some] = np.minimum(d, before)
        short = np.flatnonzero(n[blocks] < size)
        for b in short:
            filled = int(n[blocks[b]])
            nearest[b, filled:], least[b, filled:] = k, 0.0
        flat = nearest.ravel()
        count = count + np.bincount(flat, minlength=k + 1)[:k]
        for i in range(dims):
            total[:, i] += np.bincount(flat, x[:, i].ravel(), k + 1)[:k]
        cost += least.sum()
    return count, total, cost

"""Bit-parallel alignment of word sequences with unbounded Python integers as bit vectors."""

from __future__ import annotations

from collections.abc import Sequence


def _where(a: Sequence) -> dict:
    """Bit mask of the positions of each symbol."""
    out: dict = {}
    for i, x in enumerate(a):
        out[x] = out.get(x, 0) | (1 << i)
    return out


def distances_by_end(a: Sequence, b: Sequence) -> list[int]:
    """Edit distance of ``a`` to every prefix of ``b``: entry j is that of ``b[:j]``."""
    n = len(a)
    if not n:
        return list(range(len(b) + 1))
    where, full, top = _where(a), (1 << n) - 1, 1 << (n - 1)
    up, down, score, out = full, 0, n, [n]
    for x in b:
        eq = where.get(x, 0)
        diagonal = ((((eq & up) + up) ^ up) | eq | down) & full
        right = down | (full & ~(diagonal | up))
        left = diagonal & up
        score += bool(right & top) - bool(left & top)
        right, left = ((right << 1) | 1) & full, (left << 1) & full
        up, down = left | (full & ~(diagonal | right)), right & diagonal
        out.append(score)
    return out


def banded(a: Sequence, b: Sequence, k: int) -> int | None:
    """Edit distance of ``a`` and ``b`` if it is at most ``k``, else None.

    Only the diagonals within ``k`` of the main one are computed: the bit vectors hold the 2k+1 rows
    around the current column and move down one row a column.
    """
    n, m = len(a), len(b)
    if abs(n - m) > k:
        return None
    if n <= 2 * k + 1:
        d = distances_by_end(a, b)[-1]
        return d if d <= k else None
    where, width = _where(a), 2 * k + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    up, down, score = (full >> k) << k & full, 0, k
    for j, x in enumerate(b, 1):
        eq, shift = where.get(x, 0), j - k - 1
        eq = (eq >> shift if shift >= 0 else eq << -shift) & full
        diagonal = (((((eq & up) + up) ^ up)) | eq | down) & full
        right = down | (full & ~(diagonal | up))
        left = diagonal & up
        if j <= n - k:
            score += not diagonal & top
        else:
            row = 1 << (n - j + k)
            score += bool(right & row) - bool(left & row)
        if score - (m - max(j, n - k)) > k:  # from here on only steps along the last row lower it, by one each
            return None
        half = diagonal >> 1
        up, down = left | (full & ~(half | right)), half & right
    return score if score <= k else None


def distance_within(a: Sequence, b: Sequence, k: int) -> int | None:
    """Like :func:`banded`, after equal ends are cut and with a narrow band tried first."""
    if abs(len(a) - len(b)) > k:
        return None
    low = min(len(a), len(b))
    i = 0
    while i < low and a[i] == b[i]:
        i += 1
    e = 0
    while e < low - i and a[len(a) - 1 - e] == b[len(b) - 1 - e]:
        e += 1
    a, b = a[i: len(a) - e], b[i: len(b) - e]
    if not len(a) or not len(b):
        return max(len(a), len(b)) if max(len(a), len(b)) <= k else None
    if k > 24:
        d = banded(a, b, 12)
        if d is not None:
            return d
    return banded(a, b, k)

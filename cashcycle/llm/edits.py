"""Bounded edit distances of many pairs of texts at once.

The table of distances is walked by antidiagonals, within the band that the bound leaves, for
all pairs of a batch together. A pair whose two last antidiagonals are beyond its bound goes:
each way to the end passes one of them. So texts that differ are done after few characters.
What both texts begin and end with is left out before: a changed word leaves a few characters.
"""

from __future__ import annotations

import numpy as np

_CELLS = 1 << 16  # of an antidiagonal, all pairs of a batch
_LOOK = 16  # antidiagonals between two looks at what is beyond its bound


def _codes(texts: list[str]) -> list[np.ndarray]:
    """Characters as small numbers from 2, the same in all texts."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    there = np.zeros(int(points.max(initial=0)) + 1, bool)
    there[points] = True
    kind = np.uint8 if np.count_nonzero(there) < 250 else np.uint32
    codes = (np.cumsum(there) + 1).astype(kind)[points]
    return np.split(codes, np.cumsum([len(t) for t in texts])[:-1])


def _middles(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two texts without what they have in common at their begin and end, which leaves their distance."""
    n = min(len(left), len(right))
    differ = left[:n] != right[:n]
    first = int(differ.argmax()) if n else 0
    if not n or not differ[first]:
        return left[n:], right[n:]
    left, right, n = left[first:], right[first:], n - first
    differ = left[len(left) - n :] != right[len(right) - n :]  # the first characters differ
    same = int(differ[::-1].argmax()) if differ.any() else n
    return left[: len(left) - same], right[: len(right) - same]


def _within(left: list[np.ndarray], right: list[np.ndarray], most: np.ndarray) -> np.ndarray:
    """Whether each pair's distance is at most ``most``; lengths differ by no more than that."""
    n, m = (np.array([len(t) for t in side]) for side in (left, right))
    ends, k = n + m, max(1, int(most.max()))
    steps = int(ends.max())
    ahead, height = k // 2 + 2, (steps + k) // 2 + 2
    # positions by pairs, padded by what is equal to nothing; the left texts backwards
    rows = np.zeros((len(n), ahead + height), left[0].dtype)
    columns = np.ones_like(rows)
    for at, (x, y) in enumerate(zip(left, right, strict=True)):
        rows[at, height - len(x) : height] = x[::-1]
        columns[at, ahead : ahead + len(y)] = y
    rows, columns = np.ascontiguousarray(rows.T), np.ascontiguousarray(columns.T)
    kind, far = (np.int16, 12_000) if steps < 12_000 else (np.int32, 1 << 29)
    # the last two antidiagonals: diagonals -k, -k + 2, ... and those between them
    sides = [np.full((k + 1 - odd, len(n)), far, kind) for odd in (0, 1)]
    sides[k % 2][k // 2] = 0
    found, alive, lengths = ends == 0, np.arange(len(n)), set(ends.tolist())
    for s in range(1, steps + 1):
        odd = (s + k) % 2
        now, step = sides[odd], sides[1 - odd] + 1
        i, j = height - (s - odd + k) // 2, ahead + (s + odd - k) // 2 - 1
        now += rows[i : i + len(now)] != columns[j : j + len(now)]
        if odd:
            np.minimum(now, step[:-1], out=now)
            np.minimum(now, step[1:], out=now)
        else:
            np.minimum(now[:-1], step, out=now[:-1])
            np.minimum(now[1:], step, out=now[1:])
        if s in lengths:
            done = np.flatnonzero(ends[alive] == s)
            own = alive[done]
            found[own] = now[((m - n)[own] + k - odd) // 2, done] <= most[own]
        if s % _LOOK == 0:
            stay = (np.minimum(sides[0].min(0), sides[1].min(0)) <= most[alive]) & (ends[alive] > s)
            if not stay.any():
                break
            if 10 * np.count_nonzero(stay) < 7 * len(stay):
                alive, rows, columns = alive[stay], rows[:, stay], columns[:, stay]
                sides = [side[:, stay] for side in sides]
    return found


def close_pairs(texts: list[str], left: np.ndarray, right: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether the Levenshtein distance of ``texts[left]`` and ``texts[right]`` is at most ``most``,
    pair by pair, in characters."""
    codes = _codes(texts)
    sizes = np.array([len(c) for c in codes], np.int64)
    found = np.zeros(len(left), bool)
    asked = np.flatnonzero(np.abs(sizes[left] - sizes[right]) <= most)
    middles = [_middles(codes[a], codes[b]) for a, b in zip(left[asked], right[asked], strict=True)]
    longer = np.array([max(len(a), len(b)) for a, b in middles], np.int64)
    found[asked] = longer <= most[asked]  # no distance is beyond the longer one's length
    rest = np.flatnonzero(~found[asked])
    rest = rest[np.argsort(longer[rest], kind="stable")[::-1]]
    lo = 0
    while lo < len(rest):
        part = rest[lo : lo + 1024]
        part = part[: max(1, _CELLS // (int(most[asked[part]].max()) + 1))]
        pairs = [middles[k] for k in part]
        found[asked[part]] = _within([a for a, _ in pairs], [b for _, b in pairs], most[asked[part]])
        lo += len(part)
    return found

"""Edit distance of word sequences within a limit."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np


def bag_bound(a: np.ndarray, b: np.ndarray) -> int:
    """Words of the one that the other lacks, counted with repeats: the edit distance is no less."""
    both = np.concatenate([a, b])
    order = np.argsort(both, kind="stable")
    s = both[order]
    new = np.r_[True, s[1:] != s[:-1]]
    sign = np.where(order < len(a), 1, -1)
    net = np.add.reduceat(sign, np.flatnonzero(new)) if len(s) else np.zeros(1, int)
    return int(max(net[net > 0].sum(), -net[net < 0].sum()))


def bag_bounds(a: np.ndarray, b: np.ndarray, pad: np.uint64) -> np.ndarray:
    """:func:`bag_bound` of each row of ``a`` and the row of ``b`` beside it; ``pad`` is no word."""
    both = np.concatenate([a, b], axis=1)
    order = np.argsort(both, axis=1)
    s = np.take_along_axis(both, order, 1)
    sign = np.where(s == pad, 0, np.where(order < a.shape[1], 1, -1))
    new = np.ones(s.shape, bool)
    new[:, 1:] = s[:, 1:] != s[:, :-1]
    first = np.flatnonzero(new)
    net, row = np.add.reduceat(sign.ravel(), first), first // s.shape[1]
    return np.maximum(*(np.bincount(row, np.maximum(x, 0), len(a)) for x in (net, -net))).astype(np.int64)


def _slider(a: np.ndarray, b: np.ndarray):
    """slide(i, k): the first place from ``i`` on where a[place] and b[place + k] differ, or the diagonal's end."""
    n, m, places = len(a), len(b), {}

    def slide(i: int, k: int) -> int:
        if k not in places:
            lo, hi = max(0, -k), min(n, m - k)
            places[k] = (np.flatnonzero(a[lo:hi] != b[lo + k : hi + k]) + lo).tolist() + [hi] if hi > lo else [lo]
        x = places[k]
        j = bisect_left(x, i)
        return x[j] if j < len(x) else i

    return slide


def _greedy(a: np.ndarray, b: np.ndarray, limit: int, band: int = 6, turns: int = 64) -> int | None:
    """Cost of one alignment within ``band`` of the current diagonal, if it is at most ``limit``: after each mismatch
    it goes on along the diagonal that then matches furthest for its cost. It gives up after ``turns`` mismatches."""
    n, m, slide = len(a), len(b), _slider(a, b)
    i, k, cost = slide(0, 0), 0, 0
    while i < n and i + k < m:
        turns -= 1
        if cost > limit or turns < 0:
            return None
        best = None
        for to in range(k - band, k + band + 1):
            step = abs(to - k) or 1
            at = i + 1 if to == k else i + k - to if to < k else i
            if at > n or at + to > m or at + to < 0:
                continue
            end = slide(at, to)
            if best is None or end - at - 2 * step > best[0]:
                best = (end - at - 2 * step, end, to, step)
        _, i, k, step = best
        cost += step
    cost += (n - i) + (m - i - k)
    return cost if cost <= limit else None


class _Matches:
    """Where a word of ``b`` occurs in the band: a bit for each place of ``a``. Frequent words have their bits at hand,
    those of rare ones are set when asked for, so that these take at most 64 MB whatever the length."""

    def __init__(self, a: list[int], b: list[int], limit: int):
        wanted, places = set(b), {}
        for p, w in enumerate(a):
            if w in wanted:
                places.setdefault(w, []).append(p + limit)
        frequent = max(4, len(a) ** 2 >> 30)
        self.mask, self.places, self.bits = (1 << 2 * limit + 1) - 1, {}, {}
        for w, own in places.items():
            if len(own) < frequent:
                self.places[w] = own
            else:
                row = np.zeros(own[-1] + 1, np.uint8)
                row[own] = 1
                self.bits[w] = int.from_bytes(np.packbits(row, bitorder="little").tobytes(), "little")

    def at(self, i: int, word: int) -> int:
        if word in self.bits:
            return self.bits[word] >> i & self.mask
        out = 0
        for p in self.places.get(word, ()):
            if 0 <= p - i and p - i < self.mask.bit_length():
                out |= 1 << p - i
        return out


def _band(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """Banded alignment, a row of the band at a time as bits of whole numbers (Hyyro 2003): bit t of row i stands for
    place i - limit + t of ``a``. The cost is followed down the band's outer diagonal, then along the last column."""
    if len(a) < len(b):
        a, b = b, a
    n, m, limit = len(a), len(b), min(limit, len(a))
    if n - m > limit:
        return None
    a, b = a.tolist(), b.tolist()
    matches, mask, outer = _Matches(a, b, limit), (1 << 2 * limit + 1) - 1, 1 << 2 * limit
    plus, minus, cost, down = mask ^ ((1 << limit) - 1), 0, limit, n - limit
    hopeless = limit + m - down  # each step along the last column saves one at most
    for i, word in enumerate(b):
        same = matches.at(i, word)
        zero = (((same & plus) + plus) ^ plus | same | minus) & mask
        right, left = minus | (zero | plus) ^ mask, zero & plus
        if i < down:
            cost += not zero & outer
            if cost > hopeless:
                return None
        else:
            t = n - 1 - i + limit
            cost += (right >> t & 1) - (left >> t & 1)
        zero >>= 1
        plus, minus = left | (zero | right) ^ mask, zero & right
    return cost if cost <= limit else None


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the common head and tail, which some best alignment matches."""
    m = min(len(a), len(b))
    differ = np.flatnonzero(a[:m] != b[:m])
    head = int(differ[0]) if len(differ) else m
    a, b, m = a[head:], b[head:], m - head
    differ = np.flatnonzero(a[len(a) - m :][::-1] != b[len(b) - m :][::-1]) if m else ()
    tail = int(differ[0]) if len(differ) else m
    return a[: len(a) - tail], b[: len(b) - tail]


def edit_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """The edit distance if it is at most ``limit``, else None."""
    if abs(len(a) - len(b)) > limit:
        return None
    a, b = _trimmed(a, b)
    if not len(a) or not len(b):
        return d if (d := max(len(a), len(b))) <= limit else None
    if bag_bound(a, b) > limit:
        return None
    d = _band(a, b, near) if (near := 64) < limit else None
    return d if d is not None else _band(a, b, limit)


def within(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """Cost of some alignment of at most ``limit`` edits; None only if there is none."""
    if abs(len(a) - len(b)) > limit:
        return None
    a, b = _trimmed(a, b)
    if not len(a) or not len(b):
        return d if (d := max(len(a), len(b))) <= limit else None
    if bag_bound(a, b) > limit:
        return None
    d = _greedy(a, b, limit)
    return d if d is not None else edit_distance(a, b, limit)

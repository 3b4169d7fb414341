"""Suffix sorting of a block of texts, one suffix bucket at a time, with the ranks of a difference-cover sample.

The sample holds the positions whose remainder by 7 is 1, 2 or 4: for any two positions there is a shift below 7 that takes both
into the sample. Sample suffixes are ranked first, by doubling. All other suffixes are then sorted bucket by bucket (a bucket is a range of
first bytes): by their next seven bytes, and where those are equal, however long the tie goes on, by the ranks at the common shift. Beside the text and
the sample's ranks, memory is needed for one bucket only.

A text that ends sorts before one that goes on; suffixes equal to their end stand in any order among each other.
"""

from __future__ import annotations

import numpy as np

from platewise.llm.arrays import ranges

PERIOD = 7
COVER = (1, 2, 4)
BUCKET = 1 << 17  # suffixes sorted at once, unless more share their first two bytes

_SHIFT = [
    [next(d for d in range(PERIOD) if (r + d) % PERIOD in COVER and (s + d) % PERIOD in COVER) for s in range(PERIOD)] for r in range(PERIOD)
]


def by_key(keys: np.ndarray) -> np.ndarray:
    """Stable ascending order of unsigned keys. Each key is sorted with its place in one number, which numpy does much faster than ``argsort``."""
    n = len(keys)
    if not n:
        return np.zeros(0, np.int64)
    bits = np.uint64(max(1, (n - 1).bit_length()))
    place = np.arange(n, dtype=np.uint64)
    if int(keys.max()) >> (64 - int(bits)) == 0:
        return (np.sort(keys << bits | place) & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    half = np.uint64(32)
    low = np.uint64((1 << 32) - 1)
    lower = (np.sort(keys << half | place) & low).view(np.int64)
    return lower[(np.sort((keys[lower] >> half) << half | place) & low).view(np.int64)]


class Block:
    """Texts of a block, each followed by seven zero bytes, with the leading bytes of every suffix and the sample's ranks."""

    def __init__(self, texts: list[bytes]) -> None:
        self._lay(np.frombuffer(b"".join(texts), np.uint8), np.fromiter(map(len, texts), np.int64, len(texts)))

    @classmethod
    def of(cls, data: np.ndarray, lengths: np.ndarray) -> Block:
        """Texts given as bytes back to back."""
        block = cls.__new__(cls)
        block._lay(data, lengths)
        return block

    def _lay(self, data: np.ndarray, lengths: np.ndarray) -> None:
        self.begins = np.cumsum(lengths + PERIOD) - (lengths + PERIOD)
        self.lengths = lengths
        n = int((lengths + PERIOD).sum())
        inside = ranges(self.begins, lengths)
        padded = np.zeros(n + PERIOD + 1, np.uint8)
        padded[inside] = data
        self.rest = np.zeros(n, np.int64)
        self.rest[inside] = np.repeat(self.begins + lengths, lengths) - inside
        self.leading = np.ndarray((n,), ">u8", padded, strides=(1,)).astype(np.uint64)
        self.leading &= ~np.uint64(255)
        self.leading |= np.minimum(self.rest, PERIOD).astype(np.uint64)
        self.rank = self._ranks(inside[np.isin(np.arange(PERIOD), COVER)[inside % PERIOD]])

    def _ranks(self, sample: np.ndarray) -> np.ndarray:
        """Rank of every sample suffix, from 1, by doubling the bytes that are compared; equal suffixes have equal ranks.

        A rank is the place of the first suffix of its group, so those told apart keep theirs and only the others are sorted again.
        """
        rank = np.zeros(len(self.rest), np.int64)
        by = by_key(self.leading[sample])
        at, old = sample[by], np.ones(len(by), np.int64)
        new = _starts(self.leading[at])
        step, top = PERIOD, np.uint64(len(by) + 2)
        while len(at):
            index = np.arange(len(at))
            run = np.maximum.accumulate(np.where(_starts(old), index, 0))
            head = np.maximum.accumulate(np.where(new, index, 0))
            rank[at] = old + head - run
            tied = ~new
            tied[:-1] |= ~new[1:]
            at = at[tied & (self.rest[at] >= step)]  # shorter ones are equal to their end
            if not len(at):
                break
            goes_on = self.rest[at] > step
            following = np.where(goes_on, rank[np.where(goes_on, at + step, 0)], 0)
            code = rank[at].astype(np.uint64) * top + following.astype(np.uint64)
            by = by_key(code)
            at, new = at[by], _starts(code[by])
            old = rank[at]
            step *= 2
        return rank

    def order(self, suffixes: np.ndarray) -> np.ndarray:
        """The given suffixes (positions) in ascending order."""
        if not len(suffixes):
            return suffixes
        first = (self.leading[suffixes] >> np.uint64(48)).astype(np.int64)
        counts = np.bincount(first, minlength=1 << 16)
        bucket_of = (np.cumsum(counts) - counts) // BUCKET
        bucket = bucket_of[first]
        parts = [self._sorted(suffixes[bucket == b]) for b in np.unique(bucket).tolist()]
        return np.concatenate(parts)

    def _sorted(self, suffixes: np.ndarray) -> np.ndarray:
        leading = self.leading[suffixes]
        by = by_key(leading)
        suffixes, leading = suffixes[by], leading[by]
        new = _starts(leading)
        group = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        tied = (np.diff(np.append(heads, len(leading))) > 1)[group] & (self.rest[suffixes] >= PERIOD)
        if not tied.any():
            return suffixes
        at, group = suffixes[tied], group[tied]
        out = suffixes.copy()
        out[heads[group] + self._places(at, group)] = at
        return out

    def _places(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Place of each suffix among those of its group, all of which agree in seven bytes or more."""
        base = int(self.rank.max()) + 1
        groups = int(group[-1]) + 1
        remainder = at % PERIOD
        classes = [np.flatnonzero(remainder == r) for r in range(PERIOD)]
        before = []  # of each class, how many are in earlier groups
        for own in classes:
            count = np.bincount(group[own], minlength=groups)
            before.append(np.cumsum(count) - count)
        held = {}  # (class, shift): its suffixes by group and rank at the shift, and these as one number
        for r, own in enumerate(classes):
            for shift in sorted(set(_SHIFT[r])) if len(own) else ():
                key = (group[own] * base + self.rank[at[own] + shift]).astype(np.uint64)
                by = by_key(key)
                held[r, shift] = own[by], key[by]
        places = np.zeros(len(at), np.int64)
        for (r, shift), (own, key) in held.items():
            place = np.zeros(len(own), np.int64)
            for s in range(PERIOD):
                if _SHIFT[r][s] != shift or not len(classes[s]):
                    continue
                if r == s:
                    place += np.arange(len(own))
                else:
                    place += np.searchsorted(held[s, shift][1], key, side="right" if s < r else "left")
                place -= before[s][group[own]]
            places[own] += place
        return places

    def same(self, in_order: np.ndarray, length: int) -> np.ndarray:
        """Whether the ``length`` bytes that begin at a position and at the one before it are equal; all of them must lie inside their texts."""
        equal = np.ones(max(0, len(in_order) - 1), bool)
        if length < PERIOD:
            some = self.leading[in_order] >> np.uint64(8 * (PERIOD + 1 - length))
            return some[1:] == some[:-1]
        for offset in [*range(0, length - PERIOD + 1, PERIOD), length - PERIOD]:
            # the low byte is the same, as all seven bytes lie inside
            some = self.leading[in_order + offset]
            equal &= some[1:] == some[:-1]
        return equal


def _starts(keys: np.ndarray) -> np.ndarray:
    """Whether a key differs from the one before."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return new


def repeated(data: np.ndarray, lengths: np.ndarray, docs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings of ``length`` bytes that also begin in a text of a smaller document number: their texts, in order, and where in them they begin.

    The texts are given as bytes back to back.
    """
    block = Block.of(data, lengths)
    windows = np.maximum(lengths - length + 1, 0)
    starts = ranges(block.begins, windows)
    if not len(starts):
        return starts, starts
    number = np.zeros(len(block.rest), np.int32)
    number[starts] = np.arange(len(starts))
    in_order = block.order(starts)
    by = number[in_order]
    owner = np.repeat(np.arange(len(lengths)), windows)
    doc = docs[owner[by]]
    new = np.append(True, ~block.same(in_order, length))
    least = np.minimum.reduceat(doc, np.flatnonzero(new))
    hit = np.zeros(len(by), bool)
    hit[by] = doc > least[np.cumsum(new) - 1]
    hit = np.flatnonzero(hit)
    return owner[hit], starts[hit] - block.begins[owner[hit]]

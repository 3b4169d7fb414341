"""Canonical length-limited Huffman codes as numpy arrays: lengths, codes, packing and table-driven unpacking."""

from __future__ import annotations

import numpy as np

LIMIT = 20  # bits of the longest code, and of the decoding table's index
CHECKPOINT = 256  # ids between two noted bit offsets
_LENGTH_BITS = 5  # room for a length beside its id
_LENGTH = np.uint32((1 << _LENGTH_BITS) - 1)


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for ids that do not occur.

    Ties are settled by id, so equal counts give equal codes.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need codes of more than {limit} bits")
    order = used[np.lexsort((used, counts[used]))]
    weights = counts[order].astype(np.int64)
    n = len(order)
    # A coin per id and level; each level pairs up what the level below made and adds its own coins.
    rounds = []
    merged = weights
    is_coin = np.ones(n, bool)
    for _ in range(limit - 1):
        rounds.append(is_coin)
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, packages])
        place = np.argsort(both, kind="stable")
        merged, is_coin = both[place], place < n
    rounds.append(is_coin)
    take = 2 * n - 2
    depth = np.zeros(n, np.int64)
    for coins in reversed(rounds):
        chosen = int(coins[:take].sum())
        depth[:chosen] += 1
        take = 2 * (take - chosen)
    lengths[order] = depth
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint32)
    code, previous = 0, 0
    for length in range(1, int(lengths.max(initial=0)) + 1):
        code <<= length - previous
        previous = length
        ids = np.flatnonzero(lengths == length)
        codes[ids] = code + np.arange(len(ids), dtype=np.uint32)
        code += len(ids)
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of all ids, and the bit offset of every ``CHECKPOINT``-th id."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    at = end - size
    bits = codes[ids].astype(np.uint64) << (64 - size - (at & 31)).astype(np.uint64)
    word = at >> 5
    head = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    out = np.zeros(int(end[-1] + 31) // 32 + 1, np.uint64)
    both = np.bitwise_or.reduceat(bits, head)
    out[word[head]] |= both >> np.uint64(32)
    out[word[head] + 1] |= both & np.uint64(0xFFFFFFFF)
    return out.astype(">u4").tobytes()[: int(end[-1] + 7) // 8], at[::CHECKPOINT]


class Table:
    """Id and length of the code that any ``LIMIT`` bits begin with, as one number: a step looks up once."""

    def __init__(self, lengths: np.ndarray) -> None:
        if len(lengths) > 1 << 32 - _LENGTH_BITS:
            raise ValueError(f"{len(lengths)} ids do not fit beside their lengths")
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        self.width = max(1, int(lengths.max(initial=1)))
        span = np.left_shift(1, self.width - lengths[order].astype(np.int64))
        self.codes = np.zeros(1 << self.width, np.uint32)
        self.codes[: int(span.sum())] = np.repeat((order << _LENGTH_BITS | lengths[order]).astype(np.uint32), span)

    def unpack(self, payloads: list[bytes], checkpoints: list[np.ndarray], counts: list[int]) -> np.ndarray:
        """Ids of several blocks back to back. All checkpoint segments advance together, one id a step.

        A shorter segment reads on behind its end; what it finds there is dropped.
        """
        if not sum(counts):
            return np.zeros(0, np.int32)
        data = b"".join(payloads) + bytes(CHECKPOINT * LIMIT // 8 + 8)
        n = len(data) // 4 - 1
        windows = np.empty((n, 4), np.uint32)  # the 32 bits from each byte on
        for k in range(4):
            windows[:, k] = np.frombuffer(data, ">u4", n, k)
        windows = windows.ravel()
        base = np.cumsum([0, *map(len, payloads)])[:-1] * 8
        at = np.concatenate([b + np.asarray(c, np.int64) for b, c in zip(base, checkpoints)])
        left = np.concatenate(
            [np.minimum(CHECKPOINT, n - CHECKPOINT * np.arange(len(c), dtype=np.int64)) for n, c in zip(counts, checkpoints)]
        )
        steps = int(left.max())
        out = np.empty((steps, len(at)), np.uint32)
        shift = np.uint32(32 - self.width)
        for step in range(steps):
            found = self.codes[(windows[at >> 3] << (at & 7).astype(np.uint32)) >> shift]
            out[step] = found
            at += found & _LENGTH
        return (out.T[np.arange(steps) < left[:, None]] >> _LENGTH_BITS).astype(np.int32)

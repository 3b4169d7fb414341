"""Whole-batch work on Arrow text: slices of bounded size, word boundaries and word hashes as numpy arrays.

Everything here runs inside Spark tasks on the batches of ``mapInArrow``; Spark partitions and shuffles the work.
A null text is an empty text.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 19  # text bytes handled at once; one longer text is handled alone

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)

LETTERS_AND_DIGITS = "letters"  # runs of ASCII letters, digits and anything beyond ASCII
UNSPACED = "unspaced"  # runs of anything but space and \t \n \v \f \r


def let_workers_import(df: DataFrame) -> DataFrame:
    """Python workers find this package also where the driver was started in another folder."""
    environment = df.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))
    return df


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of at most ``limit`` text bytes (list elements, for a list column) or one row."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sized = batch.column(column)
        count = pc.list_value_length if pa.types.is_list(sized.type) else pc.binary_length
        lengths = pc.fill_null(count(sized), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        at = 0
        while at < n:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to
    pa.default_memory_pool().release_unused()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts back to back, and the n + 1 positions where each begins."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    ends = ends.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), ends - ends[0]
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


@functools.cache
def _byte_class(kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Normalised form of each byte, and whether it belongs to words."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    keep = np.ones(256, bool)
    if kind == LETTERS_AND_DIGITS:
        keep[:128] = False
        for low, high in (("0", "9"), ("A", "Z"), ("a", "z")):
            keep[ord(low) : ord(high) + 1] = True
    else:
        keep[[0x20, *range(0x09, 0x0E)]] = False
    return table, keep


@functools.cache
def byte_values() -> np.ndarray:
    """A fixed pseudo-random 64-bit number for each byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """The first n powers of ``base``; tables of ordinary size are kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


class RunHash:
    """64-bit hashes of any runs of a sequence, from one pass over it."""

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _power(_MULTIPLIER, n), out=self.sums[1:])
        self.inverse = _power(_INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words of a slice of texts, in order."""

    lower: np.ndarray  # bytes with ASCII capitals lower-cased
    begins: np.ndarray  # where each text begins in ``lower``, n + 1
    start: np.ndarray  # of each word in ``lower``
    end: np.ndarray
    first: np.ndarray  # index of the first word of each text, n + 1
    runs: RunHash

    @functools.cached_property
    def hashes(self) -> np.ndarray:
        return self.runs.of(self.start, self.end)

    @functools.cached_property
    def text_of(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.lower[self.start[i] : self.end[i]].tobytes()


def split_words(data: np.ndarray, begins: np.ndarray, kind: str) -> Words:
    """Words of texts given as bytes back to back; a word never spans two texts."""
    table, keep = _byte_class(kind)
    lower = table[data]
    inside = keep[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = True
    edge[1:] = True
    cut = np.zeros(len(data) + 1, bool)
    cut[begins] = True
    if len(data):
        edge[1:-1] = inside[1:] != inside[:-1]
    edge |= cut
    at = np.flatnonzero(edge)
    runs = inside[at[:-1]] if len(data) else np.zeros(0, bool)
    start, end = at[:-1][runs], at[1:][runs]
    first = np.searchsorted(start, begins)
    first[-1] = len(start)
    return Words(lower, begins, start, end, first, RunHash(byte_values()[lower]))


def words_of(column: pa.Array, kind: str) -> Words:
    return split_words(*text_bytes(column), kind)


def code_points_before(data: np.ndarray, at: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Code point offset, within its text, of each byte position; ``begins`` is where the position's text begins."""
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    return points[at] - points[begins]


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, .. for each length, back to back."""
    total = int(length.sum())
    out = np.ones(total, np.int64)
    full = length > 0
    start, length = start[full], length[full]
    if not len(start):
        return out[:0]
    heads = np.cumsum(length) - length
    out[heads[0]] = start[0]
    out[heads[1:]] = start[1:] - (start[:-1] + length[:-1] - 1)
    return np.cumsum(out)

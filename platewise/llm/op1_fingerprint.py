"""Document fingerprints by content-defined chunking.

A gear hash rolls over the last 32 bytes; a chunk ends where its top bits are zero. Chunk sizes are normalised: between 16 and 64
bytes nine bits must be zero, from there to 255 bytes five, and 255 bytes end a chunk in any case. Boundaries depend on what stands around
them alone, so text that is shifted keeps its chunks. A fingerprint is the set of chunk digests with their lengths; the likeness of
two fingerprints is the length of the chunks they share over that of the smaller one (weighted containment).

``with_neighbours`` lays the documents out in ranges of doc_id and hands each the one before it. The first document of a
range gets its neighbour from a second, small step over two rows of each range, so no text is moved twice and no
window spans the corpus.

Edge cases: a null or empty text has an empty fingerprint; two empty ones are alike (1), an empty and another are not (0). A single
document is its own neighbour. Documents without a doc_id come last in descending order; of repeated doc_ids any may come
first. Equal texts have equal fingerprints. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.arrays import RunHash, byte_values, let_workers_import, slices, text_bytes
from platewise.workspace import materialise

SMALLEST, NORMAL, LARGEST = 16, 64, 255
STRICT_BITS, LOOSE_BITS = 9, 5  # zero bits asked for below and above the normal size
_WINDOW = 32
_ENTRY = 5  # bytes: four of digest, one of length


def gear(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Rolling hash at every byte over the last 32 of its text, by doubling the window."""
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    place = np.arange(len(data)) + _WINDOW * (owner + 1)  # room before each text, so that none looks into another
    h = np.zeros(len(data) + _WINDOW * len(begins), np.uint32)
    h[place] = (byte_values() >> np.uint64(32)).astype(np.uint32)[data]
    width = 1
    while width < _WINDOW:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h[place]


def cuts(hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """End of every chunk of all texts, and the number of chunks of each text."""
    loose = np.flatnonzero(hashes >> np.uint32(32 - LOOSE_BITS) == 0) + 1
    strict = loose[hashes[loose - 1] >> np.uint32(32 - STRICT_BITS) == 0].tolist()
    loose = loose.tolist()
    ends, counts = [], []
    for begin, end in zip(begins[:-1].tolist(), begins[1:].tolist()):
        before, at = len(ends), begin
        while end - at > SMALLEST:
            cut = min(at + LARGEST, end)
            i = bisect_left(strict, at + SMALLEST)
            if i < len(strict) and strict[i] < at + NORMAL and strict[i] <= end:
                cut = strict[i]
            else:
                i = bisect_left(loose, at + NORMAL)
                if i < len(loose) and loose[i] < cut:
                    cut = loose[i]
            ends.append(cut)
            at = cut
        if at < end:
            ends.append(end)
        counts.append(len(ends) - before)
    return np.array(ends, np.int64), np.array(counts, np.int64)


class Prints:
    """Fingerprints of a slice of texts: sorted digests, lengths, and where those of each text begin."""

    def __init__(self, column: pa.Array) -> None:
        data, begins = text_bytes(column)
        ends, counts = cuts(gear(data, begins), begins)
        text = np.repeat(np.arange(len(counts)), counts)
        starts = np.empty_like(ends)
        starts[1:] = ends[:-1]
        first = np.cumsum(counts) - counts
        starts[first[counts > 0]] = begins[:-1][counts > 0]
        digests = (RunHash(byte_values()[data]).of(starts, ends) >> np.uint64(32)).astype(np.int64)
        entries = np.unique(text << 40 | digests << 8 | (ends - starts))
        self.first = np.searchsorted(entries >> 40, np.arange(len(counts) + 1))
        self.entries = entries & ((1 << 40) - 1)

    def one(self, k: int) -> np.ndarray:
        return self.entries[self.first[k] : self.first[k + 1]]


def packed(entries: np.ndarray) -> bytes:
    """Sorted entries as bytes: digest, then length, of each chunk."""
    return entries.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - _ENTRY :].tobytes()


def unpacked(fingerprint: bytes) -> np.ndarray:
    wide = np.zeros((len(fingerprint) // _ENTRY, 8), np.uint8)
    wide[:, 8 - _ENTRY :] = np.frombuffer(fingerprint, np.uint8).reshape(-1, _ENTRY)
    return wide.view(">u8").ravel().astype(np.int64)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Length of the shared chunks over that of the smaller fingerprint."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shared = np.intersect1d(a, b, assume_unique=True)
    return float((shared & 0xFF).sum() / min((a & 0xFF).sum(), (b & 0xFF).sum()))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = Prints(batch.column("text"))
            own = [packed(prints.one(k)) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own, pa.binary())], names=["doc_id", "fingerprint"])

    docs = let_workers_import(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return docs.mapInArrow(run, "doc_id long, fingerprint binary")


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as much of the beginning of the next one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
        ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)
_RANGED = pa.schema([("part", pa.int32()), ("place", pa.string()), *_RESULT, ("text", pa.string())])
_RESULT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
)


def _compare(doc_ids: list, texts: list[str], following: list[str]) -> list[dict]:
    """Results of documents whose next document is known."""
    n = len(texts)
    changed = [edited(t, f) for t, f in zip(texts, following)]
    prints = Prints(pa.array([*texts, *changed, *following], pa.string()))
    out = []
    for k in range(n):
        own, other, next_ = prints.one(k), prints.one(n + k), prints.one(2 * n + k)
        out.append(
            {
                "doc_id": doc_ids[k],
                "n_chars": len(texts[k]),
                "edited_sha256": hashlib.sha256(changed[k].encode()).hexdigest(),
                "fingerprint": packed(own),
                "edited_fingerprint": packed(other),
                "near_edited": containment(own, other),
                "near_next": containment(own, next_),
            }
        )
    return out


def _ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in ascending order of doc_id, so the next document in descending order is the row before."""
    part, before, last = TaskContext.get().partitionId(), None, None
    for batch in slices(batches, limit=1 << 18):
        doc_ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
        rows = []
        if before is None:
            rows.append({"part": part, "place": "first", "doc_id": doc_ids[0], "text": texts[0]})
            known = slice(1, None)
        else:
            known = slice(0, None)
        following = ([before] if before is not None else []) + texts[:-1]
        results = _compare(doc_ids[known], texts[known], following)
        rows += [{"part": part, "place": "inner", **r} for r in results]
        before, last = texts[-1], doc_ids[-1]
        yield pa.RecordBatch.from_pylist(rows, schema=_RANGED)
    if before is not None:
        yield pa.RecordBatch.from_pylist([{"part": part, "place": "last", "doc_id": last, "text": before}], schema=_RANGED)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "following")]
        yield pa.RecordBatch.from_pylist(_compare(*columns), schema=_RESULT)


def with_neighbours(docs: DataFrame) -> DataFrame:
    """Every document compared with its edited text and with the next document in descending order of doc_id."""
    spark = let_workers_import(docs).sparkSession
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ranged = ordered.mapInArrow(_ranged, f"part int, place string, {_RESULT_DDL}, text string")
    ranged = materialise(ranged, "fingerprints")
    result = ranged.where("place = 'inner'").select(*_RESULT.names)
    parts = sorted(r["part"] for r in ranged.where("place = 'first'").select("part").collect())  # one row for each range
    if not parts:
        return result
    previous = F.broadcast(spark.createDataFrame(list(zip(parts, [parts[-1], *parts[:-1]])), "part int, previous int"))
    lasts = ranged.where("place = 'last'").select(F.col("part").alias("previous"), F.col("text").alias("following"))
    firsts = ranged.where("place = 'first'").select("part", "doc_id", "text").join(previous, "part").join(lasts, "previous")
    return result.unionByName(firsts.select("doc_id", "text", "following").mapInArrow(_edges, _RESULT_DDL))


def report(docs: DataFrame) -> DataFrame:
    """``with_neighbours`` with the fingerprints as lowercase hex."""
    found = with_neighbours(docs)
    hexed = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(hexed)

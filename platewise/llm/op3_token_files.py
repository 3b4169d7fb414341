"""Token-id files: ids of all documents in ascending doc_id order, in blocks of canonical length-limited Huffman codes.

The code comes from the counts of every id in the whole corpus. A folder holds two Parquet data sets:

* ``codes``: one row per id that occurs, with the length of its code; lengths alone define a canonical code;
* ``blocks``: whole documents of about ``BLOCK_IDS`` ids in all, with their ids and id counts, the packed bits, the bit offset of
  every 256th id, and the position of the block in its shard. A block is read on its own, and its segments between
  checkpoints are decoded side by side by table look-up.

A shard is what one task wrote: one range of doc_id. Shards hold ascending ranges, and blocks are numbered within them.

Edge cases: a null or empty text is its end id alone. An added token of the definition that stands in a text has its own id, as in the
library's default. Documents without a doc_id come first. Repeated documents are written as
often as they come, in order of their ids. An empty table gives files without rows. Other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.llm import huffman, pieces
from platewise.llm.arrays import let_workers_import, slices
from platewise.workspace import new_path

BLOCK_IDS = 1 << 16

_BLOCKS = (
    "shard int, block int, start long, n_ids long, doc_ids array<bigint>, n_tokens array<int>, checkpoints array<bigint>, bits binary"
)
_DOCUMENTS = "doc_id long, shard int, start long, n_tokens long, ids binary"


def _binary(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Values as one binary for each span of bytes."""
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(first.astype(np.int32)), pa.py_buffer(values)])


def _kind(wide: bool) -> np.dtype:
    """Two bytes an id on the way, where the vocabulary allows it."""
    return np.dtype("<u4" if wide else "<u2")


def _encode(shared, end_id: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pieces.encoder(shared)
        for batch in slices(batches, limit=pieces.ENCODED_BYTES):
            got = encoder.encode_marked(batch.column("text"))
            ids = np.insert(got.ids.astype(_kind(wide)), got.first[1:], end_id)
            first = got.first + np.arange(batch.num_rows + 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _binary(ids, first * ids.itemsize)], names=["doc_id", "ids"])

    return run


def _values(column: pa.Array, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    width = _kind(wide).itemsize
    ids = np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(_kind(wide)) if data is not None else np.zeros(0, np.int64)
    return ids.astype(np.int64), (at - at[0]) // width


def _count(size: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            counts += np.bincount(_values(batch.column("ids"), wide)[0], minlength=size)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["id", "n"])

    return run


def _pack(shared, wide: bool, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = shared.value
        codes = huffman.canonical(lengths)
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        names, parts, held = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal block, start, names, parts, held
            ids = np.concatenate(parts)
            bits, checkpoints = huffman.pack(ids, lengths, codes)
            row = {
                "shard": shard, "block": block, "start": start, "n_ids": len(ids), "doc_ids": names,
                "n_tokens": [len(p) for p in parts], "checkpoints": checkpoints.tolist(), "bits": bits,
            }
            block, start, names, parts, held = block + 1, start + len(ids), [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in slices(batches, "ids"):
            ids, first = _values(batch.column("ids"), wide)
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                names.append(doc_id)
                parts.append(ids[first[k] : first[k + 1]])
                held += len(parts[-1])
                if held >= block_ids:
                    yield close()
        if names:
            yield close()

    return run


_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int32())), ("checkpoints", pa.list_(pa.int64())), ("bits", pa.binary()),
    ]
)


def write(docs: DataFrame, folder: str, path: str, pattern: str, end_id: int, block_ids: int = BLOCK_IDS) -> None:
    """Encode ``text``, append ``end_id`` to each document and write the files to ``folder``."""
    spark = let_workers_import(docs).sparkSession
    definition = pieces.definition(path, pattern)
    size = max(pieces.vocabulary_size(definition), end_id + 1)
    wide = size > 1 << 16
    shared = spark.sparkContext.broadcast(definition)
    encoded = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_encode(shared, end_id, wide), "doc_id long, ids binary")
    unsorted = new_path(spark, "token-ids")
    encoded.write.option("compression", "zstd").parquet(unsorted)
    encoded = spark.read.schema("doc_id long, ids binary").parquet(unsorted)

    counted = encoded.select("ids").mapInArrow(_count(size, wide), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(size, np.int64)
    for row in counted.collect():  # at most one row for each id of the vocabulary
        counts[row["id"]] = row["n"]
    lengths = huffman.code_lengths(counts)
    used = np.flatnonzero(lengths)
    codes = spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, length int")
    codes.coalesce(1).write.parquet(f"{folder}/codes")

    ordered = encoded.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    blocks = ordered.mapInArrow(_pack(spark.sparkContext.broadcast(lengths), wide, block_ids), _BLOCKS)
    blocks.write.option("compression", "none").parquet(f"{folder}/blocks")


@functools.lru_cache(maxsize=1)
def _table(shared) -> huffman.Table:
    return huffman.Table(shared.value)


def _unpack(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(shared)
        for batch in slices(batches, "bits"):
            rows = batch.to_pylist()
            ids = table.unpack(
                [r["bits"] for r in rows], [np.array(r["checkpoints"], np.int64) for r in rows], [r["n_ids"] for r in rows]
            )
            n_tokens = np.array([n for r in rows for n in r["n_tokens"]], np.int64)
            first = np.zeros(len(n_tokens) + 1, np.int64)
            np.cumsum(n_tokens, out=first[1:])
            starts, at = [], 0
            for r in rows:
                starts.append(r["start"] + first[at : at + len(r["n_tokens"])] - first[at])
                at += len(r["n_tokens"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([d for r in rows for d in r["doc_ids"]], pa.int64()),
                    pa.array(np.repeat([r["shard"] for r in rows], [len(r["n_tokens"]) for r in rows]).astype(np.int32)),
                    pa.array(np.concatenate(starts)),
                    pa.array(n_tokens),
                    _binary(ids.astype("<u4"), first * 4),
                ],
                names=["doc_id", "shard", "start", "n_tokens", "ids"],
            )

    return run


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every document from the files alone: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers.
    """
    codes = spark.read.parquet(f"{folder}/codes").collect()  # at most one row for each id of the vocabulary
    lengths = np.zeros(max([r["id"] for r in codes], default=0) + 1, np.uint8)
    for row in codes:
        lengths[row["id"]] = row["length"]
    blocks = let_workers_import(spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks"))
    before, total = [], 0
    for row in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect():  # a row for each writing task
        before.append((row["shard"], total))
        total += row["n"]
    shards = F.broadcast(spark.createDataFrame(before, "shard int, ids_before long"))
    documents = blocks.mapInArrow(_unpack(spark.sparkContext.broadcast(lengths)), _DOCUMENTS)
    return documents.join(shards, "shard").select("doc_id", (F.col("start") + F.col("ids_before")).alias("start"), "n_tokens", "ids")


def written_and_read(docs: DataFrame, path: str, pattern: str, end_id: int) -> DataFrame:
    """One row per document from the files: its place, its number of ids and their checksum."""
    spark = docs.sparkSession
    folder = new_path(spark, "token-files")
    write(docs, folder, path, pattern, end_id)
    return read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

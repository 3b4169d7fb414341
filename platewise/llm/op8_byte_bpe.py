"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The ranks are turned into a vocabulary and merges over byte characters (one printable character for each byte), so the
library merges the adjacent pair whose joint token ranks lowest, piece by piece of the split pattern, as the owner of the
rank file does. Decoding reverses the byte table: the bytes of all ids are put together before they are read as UTF-8, so
a character that is split over several ids comes back whole.

Edge cases: a null or empty text has no ids and decodes to no bytes. Strings of special tokens in a text are ordinary text.
Rows, their order within a partition and other columns are kept; a column of the same name as an output is replaced. A null
list of ids decodes as an empty one; ids that end within a character give U+FFFD in ``text`` and the exact bytes in
``decoded``. An id outside the vocabulary is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.llm import pieces
from platewise.llm.arrays import let_workers_import, slices, text_bytes

_INTS = T.ArrayType(T.IntegerType())


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.astype(np.int32)))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column back to back, and where each list begins; a null list is empty."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=first[1:])
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), first


def _with(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *columns.values()], names=[*names, *columns])


def _schema(df: DataFrame, **types: T.DataType) -> T.StructType:
    return T.StructType([*[f for f in df.schema if f.name not in types], *[T.StructField(n, t) for n, t in types.items()]])


def encode(docs: DataFrame, path: str, pattern: str, offsets: bool = False) -> DataFrame:
    """``docs`` with ``ids`` of its ``text``; with ``offsets`` also the code points that each id covers, ``starts``, ``ends``."""
    shared = pieces.share(let_workers_import(docs).sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pieces.encoder(shared)
        for batch in slices(batches, limit=pieces.ENCODED_BYTES):
            got = encoder.encode(batch.column("text"))
            columns = {"ids": _lists(got.ids, got.first)}
            if offsets:
                starts, ends = pieces.byte_table(shared).offsets(got.ids, got.first)
                columns |= {"starts": _lists(starts, got.first), "ends": _lists(ends, got.first)}
            yield _with(batch, **columns)

    types = {"ids": _INTS} | ({"starts": _INTS, "ends": _INTS} if offsets else {})
    return docs.mapInArrow(run, _schema(docs, **types))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with the bytes of its ``ids`` as ``decoded``."""
    shared = pieces.share(let_workers_import(encoded).sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces.byte_table(shared)
        for batch in slices(batches, "ids"):
            data, begins = table.decode(*_flat(batch.column("ids")))
            binary = pa.Array.from_buffers(
                pa.binary(), batch.num_rows, [None, pa.py_buffer(begins.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
            )
            yield _with(batch, decoded=binary)

    return encoded.mapInArrow(run, _schema(encoded, decoded=T.BinaryType()))


def decode_text(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with ``text`` read from its ``ids``; an incomplete character at an end is U+FFFD."""
    return decode(encoded, path, pattern).withColumn("text", F.make_valid_utf8(F.col("decoded").cast("string"))).drop("decoded")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: number of ids, digest of the ids, digest of the bytes that they decode to.

    Encodes and decodes slice by slice in one worker, so that ids and decoded bytes need not travel between workers.
    """
    shared = pieces.share(let_workers_import(docs).sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = pieces.encoder(shared), pieces.byte_table(shared)
        names = [str(i) for i in range(len(table.length))]
        for batch in slices(batches, limit=pieces.ENCODED_BYTES):
            got = encoder.encode(batch.column("text"))
            data, begins = table.decode(got.ids, got.first)
            decoded, ids = data.tobytes(), got.ids.tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(got.first)),
                    pa.array([_sha256(",".join([names[i] for i in ids[a:b]]).encode()) for a, b in _spans(got.first)]),
                    pa.array([_sha256(decoded[a:b]) for a, b in _spans(begins)]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def encode_checked(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids`` in place of ``text``, and ``round_trip``: whether the ids decode to the bytes of the text."""
    shared = pieces.share(let_workers_import(docs).sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = pieces.encoder(shared), pieces.byte_table(shared)
        for batch in slices(batches, limit=pieces.ENCODED_BYTES):
            got = encoder.encode(batch.column("text"))
            decoded, begins = table.decode(got.ids, got.first)
            data, places = text_bytes(batch.column("text"))
            same = [np.array_equal(decoded[a:b], data[c:d]) for (a, b), (c, d) in zip(_spans(begins), _spans(places))]
            out = _with(batch, ids=_lists(got.ids, got.first), round_trip=pa.array(same))
            yield out.select([n for n in out.schema.names if n != "text"])
        del encoder
        pieces.release()

    types = _schema(docs, ids=_INTS, round_trip=T.BooleanType())
    return docs.mapInArrow(run, T.StructType([f for f in types if f.name != "text"]))


def _spans(first: np.ndarray) -> list[tuple[int, int]]:
    places = first.tolist()
    return list(zip(places, places[1:]))


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()

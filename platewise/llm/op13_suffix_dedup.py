"""Suffix-array dedup: every byte covered by a string of 50 bytes that also begins in a document of a smaller doc_id goes.

The suffixes are sorted one bucket at a time by the difference-cover method of ``cover_sort``. Sorting is the last of three steps, since most
suffixes of a corpus have no partner:

1. *Contexts.* Every window of 50 bytes has an anchor, the least hash among its 27 strings of 24 bytes. Windows that follow each other
   and have one anchor make a context (14 windows on average). Equal windows have equal anchors, wherever they stand. Contexts
   meet by anchor: all windows of a context that also stands in a smaller document are repeated, and a context whose anchor has no
   other context has no further repeats. Only the first occurrence of a context whose anchor has several is left open.
2. *Suffix buckets.* The texts of open contexts, again brought together by anchor, are laid out in blocks of some megabytes; the suffixes that begin a
   window are sorted, neighbours that agree in 50 bytes compared, and windows that a smaller document has are marked.
3. The marked windows come back to their documents, where the covered bytes are cut out. Documents without any are not searched again.

Hot groups: contexts that repeat within a slice of some thousand documents are settled there, and one of them is sent on. An anchor with
very many different contexts (a common short phrase) is found in a sample of ``SAMPLED`` documents; its contexts are dealt out one by one, and its windows
as texts of their own, so that no task gets all of it. The sample decides on the balance only, never on the result.

Contexts are compared by 96 bits of hash, not by their bytes; windows of open contexts are compared byte by byte.

Edge cases: a null or empty text has no bytes. Texts of fewer than 50 bytes lose nothing. Rows of one doc_id count as one document: they remove
nothing from each other. A row without a doc_id neither loses nor removes anything. Ties, repeated rows: each row gets its result. An empty table gives
an empty result. Other columns are ignored by ``judge`` and kept by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.arrays import RunHash, byte_values, let_workers_import, mix, ranges, slices, text_bytes
from platewise.llm.cover_sort import by_key, repeated
from platewise.llm.steps import settled

LENGTH = 50
SLICE = 1 << 21  # text bytes looked at together
BUCKET_BYTES = 1 << 20  # text bytes for each bucket of contexts
BLOCK = 1 << 21  # text bytes whose suffixes are sorted together
SAMPLED = 20_000  # documents in which hot anchors are looked for
HOT = 1 << 14  # contexts of an anchor, as estimated from the sample, from which it is dealt out
PLACE_BITS = 14
CHUNK = (1 << PLACE_BITS) - 128  # bytes whose anchors are looked for together, so that all arrays stay in the processor's cache

_NONE = np.zeros(0, np.int64)


@dataclass
class Contexts:
    """Contexts of a slice of texts, in order."""

    text: np.ndarray  # text number
    anchor: np.ndarray  # hash of the anchor
    digest: np.ndarray  # hash of the context
    first: np.ndarray  # where its first window begins
    windows: np.ndarray  # how many windows it has


def contexts(data: np.ndarray, begins: np.ndarray, length: int) -> Contexts:
    """``begins`` has n + 1 entries; a context never spans two texts."""
    gram = max(1, length // 2 - 1, length - 61)
    span = length - gram + 1
    lengths = np.diff(begins)
    size = np.maximum(lengths - length + 1, 0)
    last = len(data) - length + 1  # windows, those that cross a border between texts included
    inside = np.ones(max(len(data), 1), bool)
    inside[ranges(begins[:-1] + size, lengths - size)] = False
    edge = ~inside
    edge[begins[:-1][size > 0]] = True
    parts = [
        _chunk_contexts(data, start, min(start + CHUNK, last), min(start + CHUNK + span, last), gram, length, inside, edge)
        for start in range(0, last, CHUNK)
    ]
    parts = [p for p in parts if len(p[0])]
    if not parts:
        return Contexts(_NONE, _NONE.astype(np.uint64), _NONE, _NONE, _NONE)
    first, windows, anchor, digest = (np.concatenate(x) for x in zip(*parts))
    text = np.repeat(np.arange(len(size)), np.diff(np.searchsorted(first, begins)))
    return Contexts(text, anchor, digest.view(np.int64), first, windows)


def _chunk_contexts(
    data: np.ndarray, start: int, stop: int, to: int, gram: int, length: int, inside: np.ndarray, edge: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Contexts that begin in ``start`` to ``stop`` (all of them end by ``to``): first windows, numbers of windows, anchors, digests."""
    span = length - gram + 1
    low = max(start - 1, 0)
    runs = RunHash(byte_values()[data[low : to - 1 + length]])
    n = len(runs.sums) - gram
    bits = np.uint32(PLACE_BITS)
    # As many bits of the hash in every chunk, then the place: equal hashes leave the first, so the anchor depends on the window's bytes only.
    least = (((runs.sums[gram:] - runs.sums[:-gram]) * runs.inverse[:n]) >> np.uint64(32)).astype(np.uint32)
    least >>= bits
    least <<= bits
    least |= np.arange(n, dtype=np.uint32)
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: width - span], least[span - width :])
    place = least & ((np.uint32(1) << bits) - np.uint32(1))
    ends = edge[low:to].copy()
    ends[1:] |= place[1:] != place[:-1]
    if low < start:
        ends[0] = False
    ends = np.flatnonzero(ends)
    heads = ends[: np.searchsorted(ends, stop - low)]
    following = np.append(ends, to - low)[1 : len(heads) + 1]
    mine = inside[low + heads]
    heads, following = heads[mine], following[mine]
    at = place[heads].astype(np.int64)
    return low + heads, following - heads, mix(runs.of(at, at + gram)), runs.of(heads, following - 1 + length)


def _packs(length: int, buckets: int, hot: np.ndarray):
    """Contexts of each slice by bucket, one of those that are equal; what is repeated within the slice is told at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            found = contexts(*text_bytes(batch.column("text")), length)
            doc = batch.column("doc_id").to_numpy(zero_copy_only=False)[found.text]
            by = by_key(found.digest.view(np.uint64))
            anchor, digest, doc = found.anchor[by], found.digest[by], doc[by]
            new, same = _changes(anchor, digest), _changes(anchor, digest, doc)
            heads = np.flatnonzero(new)
            least = np.minimum.reduceat(doc, heads) if len(doc) else doc
            late = same & (doc > least[np.cumsum(new) - 1])
            is_hot = np.isin(anchor[heads], hot) if len(hot) else np.zeros(len(heads), bool)
            for rows, docs, kind in ((late, doc[late], 2), (heads[is_hot], least[is_hot], 1), (heads[~is_hot], least[~is_hot], 0)):
                if not len(docs):
                    continue
                a, c = anchor[rows], digest[rows]
                bucket = (mix(a ^ c.view(np.uint64)) if kind else a) % np.uint64(buckets)
                order = by_key(bucket)
                bucket = bucket[order].astype(np.int64)
                cut = np.append(np.flatnonzero(_changes(bucket)), len(bucket))
                a = (a[order] >> np.uint64(32)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[cut[:-1]]),
                        pa.array(np.full(len(cut) - 1, kind, np.int32)),
                        *(_binary(x.view(np.uint8), cut * x.itemsize) for x in (a, c[order], docs[order])),
                    ],
                    names=["bucket", "kind", "a", "c", "d"],
                )

    return run


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _binary(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Binary values that lie back to back."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data)])


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all binary values back to back, and the n + 1 positions where each begins."""
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data if data is not None else b"", np.uint8)[edges[0] : edges[-1]], edges - edges[0]


def _elements(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row and value of every list element."""
    return np.repeat(np.arange(len(column)), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)), column.flatten()


def _grouped(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The rows, which come by their first column, in batches that end between two of its values, once their last column has ``limit`` bytes."""
    held, size, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        before = _unpacked(batch.column(batch.num_columns - 1))[1]
        new = _changes(key)
        new[0] = key[0] != last
        cuts = np.flatnonzero(new)
        sizes = before[cuts]
        at, last = 0, key[-1]
        while True:
            i = max(np.searchsorted(sizes, limit - size + before[at]), np.searchsorted(cuts, at if held else at + 1))
            if i >= len(cuts):
                break
            yield pa.concat_batches([*held, batch.slice(at, cuts[i] - at)])
            held, size, at = [], 0, int(cuts[i])
        held.append(batch.slice(at))
        size += int(before[-1] - before[at])
    if held:
        yield pa.concat_batches(held)


def _told(doc: np.ndarray, digest: np.ndarray, is_open: np.ndarray) -> pa.RecordBatch:
    """One row for each document: its repeated contexts and its open ones."""
    by = by_key(doc.view(np.uint64))
    doc, digest, is_open = doc[by], digest[by], is_open[by]
    heads = np.flatnonzero(_changes(doc))
    columns = [pa.array(doc[heads])]
    for chosen in (~is_open, is_open):
        edges = np.append(0, np.cumsum(chosen))[np.append(heads, len(doc))]
        columns.append(pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(digest[chosen])))
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "repeats", "open"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket."""
    for batch in _grouped(batches, 0):
        (a, edges), (c, _), (d, _) = (_unpacked(batch.column(i)) for i in (2, 3, 4))
        kind = np.repeat(batch.column("kind").to_numpy(), np.diff(edges) // 4)
        a, c, d = (np.frombuffer(x.tobytes(), t) for x, t in ((a, np.uint32), (c, np.int64), (d, np.int64)))
        local = kind == 2
        doc, digest = [d[local]], [c[local]]
        hot, a, c, d = kind[~local] == 1, a[~local], c[~local], d[~local]
        by = by_key(c.view(np.uint64))
        by = by[by_key(a[by].astype(np.uint64))]
        hot, a, c, d = hot[by], a[by], c[by], d[by]
        context, anchor = _changes(a, c), _changes(a)
        least = np.minimum.reduceat(d, np.flatnonzero(context)) if len(d) else d
        late = d > least[np.cumsum(context) - 1]
        several = np.add.reduceat(context, np.flatnonzero(anchor), dtype=np.int64) > 1 if len(a) else np.zeros(0, bool)
        left = ~late & (hot | several[np.cumsum(anchor) - 1])
        doc += [d[late], d[left]]
        digest += [c[late], c[left]]
        is_open = np.repeat([False, True], [local.sum() + late.sum(), left.sum()])
        yield _told(np.concatenate(doc), np.concatenate(digest), is_open)


def _places(digests: pa.Array, rows: np.ndarray, of: np.ndarray, digest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers of the different pairs of a row and a digest: of the given ``rows`` and ``digests``, and of ``of`` and ``digest``, or -1 if not given."""
    known = pc.unique(digests)
    pairs = pa.array(rows * len(known) + pc.index_in(digests, known).to_numpy())
    named = pc.fill_null(pc.index_in(pa.array(digest), known), -1).to_numpy()
    mine = np.flatnonzero(named >= 0)
    different = pc.unique(pairs)
    out = np.full(len(digest), -1, np.int64)
    out[mine] = pc.fill_null(pc.index_in(pa.array(of[mine] * len(known) + named[mine]), different), -1).to_numpy()
    return pc.index_in(pairs, different).to_numpy(), out, len(different)


def _members(values: pa.Array, of: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Whether each digest is among the values of its row; ``of`` is its row."""
    rows, values = _elements(values)
    return _places(values, rows, of, digest)[1] >= 0


_OPEN = "route long, doc_id long, digest long, offset int, repeats boolean, bytes binary"


def _opened(length: int, hot: np.ndarray):
    """Texts of open contexts; of a hot anchor's contexts the windows, one of those that are equal in a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            data, begins = text_bytes(batch.column("text"))
            found = contexts(data, begins, length)
            chosen = np.flatnonzero(_members(batch.column("open"), found.text, found.digest))
            doc = batch.column("doc_id").to_numpy(zero_copy_only=False)[found.text[chosen]]
            by = by_key(found.digest[chosen].view(np.uint64))
            by = by[by_key(doc[by].view(np.uint64))]
            chosen, doc = chosen[by], doc[by]
            once = _changes(doc, found.digest[chosen])
            chosen, doc = chosen[once], doc[once]
            is_hot = np.isin(found.anchor[chosen], hot) if len(hot) else np.zeros(len(chosen), bool)
            whole = ~is_hot
            route, digest = [found.anchor[chosen[whole]].view(np.int64)], [found.digest[chosen[whole]]]
            docs, offset = [doc[whole]], [np.zeros(whole.sum(), np.int32)]
            start, size = [found.first[chosen[whole]]], [found.windows[chosen[whole]] - 1 + length]
            late = [np.zeros(whole.sum(), bool)]
            if is_hot.any():
                windows = found.windows[chosen[is_hot]]
                at = ranges(found.first[chosen[is_hot]], windows)
                of = np.repeat(np.flatnonzero(is_hot), windows)
                name = RunHash(byte_values()[data]).of(at, at + length).view(np.int64)
                by = np.lexsort((doc[of], name))
                at, of, name = at[by], of[by], name[by]
                new = _changes(name)
                behind = doc[of] > doc[of][new][np.cumsum(new) - 1]
                route.append(name), digest.append(found.digest[chosen[of]]), docs.append(doc[of])
                offset.append((at - found.first[chosen[of]]).astype(np.int32))
                start.append(at), size.append(np.where(behind, 0, length)), late.append(behind)
            start, size = np.concatenate(start), np.concatenate(size)
            columns = [np.concatenate(x) for x in (route, docs, digest, offset, late)]
            for i in range(0, len(start), 1 << 20):
                some = slice(i, i + (1 << 20))
                texts = _binary(data[ranges(start[some], size[some])], np.append(0, np.cumsum(size[some])))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c[some]) for c in columns), texts], names=["route", "doc_id", "digest", "offset", "repeats", "bytes"]
                )

    return run


def _sorted_blocks(length: int):
    """Rows come by route. A block ends between two routes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _grouped(batches, BLOCK):
            doc, digest, offset, late = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "digest", "offset", "repeats"))
            data, edges = _unpacked(batch.column("bytes"))
            text, at = repeated(data, np.diff(edges), doc, length)
            text, at = np.append(text, np.flatnonzero(late)), np.append(at, np.zeros(late.sum(), np.int64))
            by = by_key(text.astype(np.uint64))
            text, bit = text[by], np.left_shift(np.int64(1), at[by] + offset[text[by]])
            heads = np.flatnonzero(_changes(text))
            masks = np.bitwise_or.reduceat(bit, heads) if len(heads) else bit
            row = text[heads]
            yield pa.RecordBatch.from_arrays([pa.array(doc[row]), pa.array(digest[row]), pa.array(masks)], names=["doc_id", "digest", "windows"])

    return run


def removed(
    data: np.ndarray, begins: np.ndarray, length: int, repeats: pa.Array, digests: pa.Array, masks: pa.Array
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of bytes of a slice that repeated windows cover: text, begin and end of each, in order."""
    found = contexts(data, begins, length)
    whole = _members(repeats, found.text, found.digest)
    rows, own = _elements(digests)
    number, place, n = _places(own, rows, found.text, found.digest)
    marked = np.zeros(n, np.int64)
    np.bitwise_or.at(marked, number, masks.flatten().to_numpy())
    partly = np.flatnonzero(~whole & (place >= 0))
    windows = found.windows[partly]
    offset = ranges(np.zeros(len(partly), np.int64), windows)
    on = np.repeat(marked[place[partly]], windows) >> offset & 1 == 1
    start = np.append(found.first[whole], (np.repeat(found.first[partly], windows) + offset)[on])
    end = np.append((found.first + found.windows)[whole], (np.repeat(found.first[partly], windows) + offset + 1)[on]) - 1 + length
    text = np.append(found.text[whole], np.repeat(found.text[partly], windows)[on])
    by = by_key(start.astype(np.uint64))
    start, end, text = start[by], end[by], text[by]
    new = np.ones(len(start), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] > end[:-1])  # windows are in order, so the last one ends last
    heads = np.flatnonzero(new)
    return text[heads], start[heads], end[np.append(heads[1:], len(start)) - 1] if len(heads) else end


def _kept(raw: memoryview, begin: int, end: int, runs: list[tuple[int, int]]) -> list[memoryview]:
    """The pieces of a text between its runs."""
    out = []
    for start, stop in runs:
        out.append(raw[begin:start])
        begin = stop
    return [*out, raw[begin:end]]


def _sha256(pieces: list[memoryview]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece)
    return digest.hexdigest()


def _cut(length: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            data, begins = text_bytes(batch.column("text"))
            # Texts that lose something are looked at again; the others keep all bytes.
            touched = pc.or_(pc.is_valid(batch.column("repeats")), pc.is_valid(batch.column("digests")))
            rows = np.flatnonzero(touched.to_numpy(zero_copy_only=False))
            some = batch.filter(touched)
            at, (found, own) = begins[rows], text_bytes(some.column("text"))
            text, start, end = removed(found, own, length, *(some.column(c) for c in ("repeats", "digests", "masks")))
            shift = (at - own[:-1])[text]
            text, start, end = rows[text], start + shift, end + shift
            n = batch.num_rows
            edges = np.searchsorted(text, np.arange(n + 1)).tolist()
            runs = list(zip(start.tolist(), end.tolist()))
            raw, ends = memoryview(data), begins.tolist()
            digests = [_sha256(_kept(raw, ends[k], ends[k + 1], runs[edges[k] : edges[k + 1]])) for k in range(n)]
            columns = {
                "row": batch.column("row"),
                "n_bytes": pa.array(np.diff(begins)),
                "n_removed": pa.array(np.bincount(text, end - start, n).astype(np.int64)),
                "n_spans": pa.array(np.bincount(text, minlength=n)),
                "kept_sha256": pa.array(digests, pa.string()),
            }
            if with_text:
                gone = np.zeros(len(data), bool)
                gone[ranges(start, end - start)] = True
                heads = np.flatnonzero((data & 0xC0) != 0x80)  # a character goes as a whole
                if len(heads):
                    gone = np.repeat(np.logical_or.reduceat(gone, heads), np.diff(np.append(heads, len(data))))
                kept, left = data[~gone].tobytes(), begins - np.append(0, np.cumsum(gone))[begins]
                texts = [kept[i:j].decode() for i, j in zip(left[:-1].tolist(), left[1:].tolist())]
                columns["text"] = pc.if_else(pc.is_valid(batch.column("text")), pa.array(texts, pa.string()), pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _hot_anchors(docs: DataFrame, n_docs: int, length: int) -> np.ndarray:
    """Anchors with very many different contexts, as a sample of documents shows them."""
    step = max(1, n_docs // SAMPLED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            found = contexts(*text_bytes(batch.column("text")), length)
            yield pa.RecordBatch.from_arrays([pa.array(found.anchor.view(np.int64)), pa.array(found.digest)], names=["anchor", "digest"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).select("text").mapInArrow(run, "anchor long, digest long")
    seen = sample.distinct().groupBy("anchor").count().where((F.col("count") * step >= HOT) & (F.col("count") >= 8))
    return np.array(sorted(r["anchor"] for r in seen.select("anchor").collect()), np.int64).view(np.uint64)


def _marked(docs: DataFrame, length: int) -> DataFrame:
    """All columns of ``docs`` as ``row``, ``text``, and the repeated contexts and windows of its doc_id."""
    let_workers_import(docs)
    known = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = known.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    hot = _hot_anchors(known, size["n"], length)
    buckets = max(64, size["bytes"] // BUCKET_BYTES)
    packs = known.mapInArrow(_packs(length, buckets, hot), "bucket long, kind int, a binary, c binary, d binary")
    packs = packs.repartition("bucket").sortWithinPartitions("bucket")
    told = settled(packs.mapInArrow(_compared, "doc_id long, repeats array<long>, open array<long>"), "contexts")
    open_ = told.where(F.size("open") > 0).groupBy("doc_id").agg(F.flatten(F.collect_list("open")).alias("open"))
    opened = known.join(open_, "doc_id").mapInArrow(_opened(length, hot), _OPEN)
    opened = settled(opened, "open-contexts").repartition("route").sortWithinPartitions("route")
    marks = settled(opened.mapInArrow(_sorted_blocks(length), "doc_id long, digest long, windows long"), "windows")
    whole = told.where(F.size("repeats") > 0).groupBy("doc_id").agg(F.flatten(F.collect_list("repeats")).alias("repeats"))
    partly = marks.groupBy("doc_id").agg(F.collect_list(F.struct("digest", "windows")).alias("marks"))
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*others).alias("row"), "text")
    return rows.join(whole, "doc_id", "left").join(partly, "doc_id", "left").select(
        "row", "text", "repeats", F.col("marks.digest").alias("digests"), F.col("marks.windows").alias("masks")
    )


_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def judge(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id``, its bytes, removed bytes, removed runs and the digest of what is left, for every row."""
    marked = _marked(docs.select("doc_id", "text"), length)
    out = marked.mapInArrow(_cut(length, False), f"row struct<doc_id:{docs.schema['doc_id'].dataType.simpleString()}>, {_RESULT}")
    return out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` without the repeated bytes; all columns as they were. A character that is cut in two by a border goes as a whole."""
    marked = _marked(docs, length)
    row = marked.schema["row"].dataType.simpleString()
    out = marked.mapInArrow(_cut(length, True), f"row {row}, {_RESULT}, text string")
    return out.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])

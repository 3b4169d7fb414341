"""MinHash near-duplicates by fast similarity sketching, banding and exact verification.

A document's set holds its distinct word shingles. A sketch of T coordinates is filled in rounds: in rounds 0 .. T-1 every
element falls into one random bin with a random value, in rounds T .. 2T-1 all elements fall into bin r - T; a bin keeps the smallest value
of the first round that reaches it, and a document stops when its bins are full. Every bin is thus filled for any set, two
sets agree in a bin with probability equal to their similarity, and the number of agreements is concentrated as for
independent samples, at about (set size + T log T) hash values instead of T times the set size.

Bands of four coordinates make the buckets; at the similarity limit of 0.8 a pair misses all 32 bands with a probability of
4.7e-8. Links are confirmed on the full sets. Documents of one normalised word sequence are one node, so copies are never
paired with each other.

Edge cases: a null or empty text, or one of white space alone, has an empty set, is linked with nothing and kept. Fewer words
than a shingle make one shingle of all of them. Each input row gives one row. Rows of one doc_id and different texts are judged apart; where several of these texts
are the first of their kind, one of them takes part in links and the others stay. A row
without a doc_id is returned with a null component and kept. Other columns are ignored. Shingles are compared by 64 bits of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.arrays import UNSPACED, RunHash, Words, let_workers_import, mix, ranges, slices, words_of
from platewise.llm.linking import link_groups
from platewise.llm.steps import settled

WORDS = 5
PERCENT = 80
COORDINATES = 128
ROWS = 4  # coordinates of a band
DIFFERENT_BITS = 34  # of 128; at similarity 0.8 more differ with a probability below 1e-7
CHUNK = 64  # documents checked against one other in one group

_ROUND = 0xD6E8FEB86659FD93
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, in order, and where those of each text begin (n + 1)."""
    counts = np.diff(words.first)
    runs = RunHash(words.hashes)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), made)
    at = words.first[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(made) - made, made)
    length = np.minimum(counts, size)[text]
    hashes = runs.of(at, at + length)
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(text[order].astype(np.int32), kind="stable")]
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(counts) + 1))


def sketches(hashes: np.ndarray, first: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """Sketches (texts x t) of the sets; rows of empty sets hold no value."""
    n = len(first) - 1
    values = np.full(n * t, _EMPTY)
    filled = np.zeros(n * t, bool)
    size = np.diff(first)
    owner = np.repeat(np.arange(n), size)
    for r in range(2 * t):
        if not len(hashes):
            break
        x = mix(hashes + np.uint64(_ROUND * (r + 1) % (1 << 64)))
        place = owner * t + ((x % np.uint64(t)).astype(np.int64) if r < t else r - t)
        open_ = ~filled[place]
        place = place[open_]
        np.minimum.at(values, place, x[open_] >> np.uint64(8))
        filled[place] = True
        done = filled.reshape(n, t).all(axis=1)
        keep = ~done[owner]
        if not keep.all():
            hashes, owner = hashes[keep], owner[keep]
    return values.reshape(n, t)


def band_keys(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    n, t = values.shape
    keys = np.zeros((n, t // rows), np.uint64)
    for k in range(rows):
        keys = mix(keys * np.uint64(3) + values[:, k::rows])
    return mix(keys + np.arange(t // rows, dtype=np.uint64)).view(np.int64)


def bits(values: np.ndarray) -> np.ndarray:
    """One bit of each coordinate, as two longs."""
    flags = (mix(values) & np.uint64(1)).astype(np.uint8)
    return np.packbits(flags, axis=1).view(np.int64)


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = words_of(batch.column("text"), UNSPACED)
            hashes, first = shingles(words, size)
            values = sketches(hashes, first)
            keys, low = band_keys(values), bits(values)
            h = words.hashes
            classes = [
                hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() if b > a else None
                for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())
            ]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("tag"),
                    pa.array(classes, pa.binary()),
                    pa.array(np.diff(first)),
                    pa.array(np.ascontiguousarray(low[:, 0])),
                    pa.array(np.ascontiguousarray(low[:, 1])),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel())),
                ],
                names=["doc_id", "tag", "class", "n", "s0", "s1", "keys"],
            )

    return run


def _may_link(percent: int):
    def test(a: Column, b: Column) -> Column:
        low, high = F.least(a["n"], b["n"]), F.greatest(a["n"], b["n"])
        differ = F.bit_count(a["s0"].bitwiseXOR(b["s0"])) + F.bit_count(a["s1"].bitwiseXOR(b["s1"]))
        return (low * 100 >= high * percent) & (differ <= DIFFERENT_BITS)

    return test


def _confirm(size: int, percent: int):
    """Rows of a group (a, chunk) come together, the one without b first; the set of a is compared with those that follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        against, own = None, None
        for batch in slices(batches):
            hashes, first = shingles(words_of(batch.column("text"), UNSPACED), size)
            out_a, out_b = [], []
            for k, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
                mine = hashes[first[k] : first[k + 1]]
                if b is None:
                    against, own = a, mine
                elif a == against:
                    both = len(np.intersect1d(own, mine, assume_unique=True))
                    if 100 * both >= percent * (len(own) + len(mine) - both):
                        out_a.append(a)
                        out_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return run


def _check(texts: DataFrame, size: int, percent: int):
    def check(pairs: DataFrame) -> DataFrame:
        pairs = settled(pairs, "pairs")
        many = settled(pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")), "pair-counts")
        pairs = settled(pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), "chunks").alias("chunk")), "chunks")
        heads = pairs.select("a", "chunk").distinct().join(texts, F.col("a") == F.col("doc_id"))
        others = pairs.join(texts, F.col("b") == F.col("doc_id"))
        rows = heads.select("a", "chunk", F.lit(None).cast("long").alias("b"), "text").unionByName(others.select("a", "chunk", "b", "text"))
        rows = rows.repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
        return rows.select("a", "b", "text").mapInArrow(_confirm(size, percent), "a long, b long").distinct()

    return check


class Held:
    """Sets of a block's held documents, indexed by shingle: one look-up gives the intersections with all of them."""

    def __init__(self) -> None:
        self.nodes: list[int] = []
        self.sets: list[np.ndarray] = []
        self.group: dict[int, int] = {}  # links found within the block, as a forest over components
        self.index: tuple | None = None

    def add(self, node: int, component: int, shingles: np.ndarray) -> None:
        self.nodes.append(node)
        self.sets.append(shingles)
        self.group.setdefault(node, component)

    def root(self, x: int) -> int:
        while self.group.get(x, x) != x:
            x = self.group[x]
        return x

    def links(self, node: int, component: int, shingles: np.ndarray, percent: int) -> list[int]:
        """Held nodes that the given one is linked with and that were not connected with it yet."""
        if self.index is None:
            flat = np.concatenate(self.sets)
            order = np.argsort(flat, kind="stable")
            sizes = np.array([len(s) for s in self.sets])
            self.index = (flat[order], np.repeat(np.arange(len(sizes)), sizes)[order], sizes)
        flat, owner, sizes = self.index
        low, high = np.searchsorted(flat, shingles), np.searchsorted(flat, shingles, side="right")
        both = np.bincount(owner[ranges(low, high - low)], minlength=len(sizes))
        self.group.setdefault(node, component)
        out = []
        for k in np.flatnonzero(100 * both >= percent * (sizes + len(shingles) - both)).tolist():
            a, b = self.root(self.nodes[k]), self.root(node)
            if a != b:
                self.group[max(a, b)] = min(a, b)
                out.append(self.nodes[k])
        return out


def _confirm_block(size: int, percent: int):
    """Rows of a block come together, the held ones first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, Held()
        for batch in slices(batches):
            hashes, first = shingles(words_of(batch.column("text"), UNSPACED), size)
            columns = [batch.column(c).to_pylist() for c in ("key", "chunk", "part", "held", "node", "component")]
            out_a, out_b = [], []
            for k, (key, chunk, part, is_held, node, component) in enumerate(zip(*columns)):
                if (key, chunk, part) != block:
                    block, held = (key, chunk, part), Held()
                mine = hashes[first[k] : first[k + 1]]
                if is_held:
                    held.add(node, component, mine)
                elif held.nodes:
                    found = held.links(node, component, mine, percent)
                    out_a += found
                    out_b += [node] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return run


def _check_blocks(texts: DataFrame, size: int, percent: int):
    def check(rows: DataFrame) -> DataFrame:
        rows = settled(rows, "blocks").join(texts, F.col("node") == F.col("doc_id"))
        rows = rows.repartition("key", "chunk", "part").sortWithinPartitions("key", "chunk", "part", F.col("held").desc())
        rows = rows.select("key", "chunk", "part", "held", "node", "component", "text")
        return rows.mapInArrow(_confirm_block(size, percent), "a long, b long").distinct()

    return check


def _prepare(docs: DataFrame, nodes: DataFrame, size: int, percent: int):
    """The texts in question are moved once, for all checks."""

    def prepare(wanted: DataFrame):
        own = nodes.join(wanted, "node").select(F.col("node").alias("doc_id"), "tag")
        texts = settled(docs.join(own, ["doc_id", "tag"]).dropDuplicates(["doc_id", "tag"]).select("doc_id", "text"), "texts")
        return _check(texts, size, percent), _check_blocks(texts, size, percent)

    return prepare


def _judged(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id``, ``tag`` (which tells texts of one id apart), ``n_shingles``, ``component_id`` and ``kept`` of every row."""
    docs = let_workers_import(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tag")))
    described = docs.mapInArrow(_describe(words), "doc_id long, tag long, class binary, n long, s0 long, s1 long, keys array<bigint>")
    described = settled(described, "sketches")
    named = described.where(F.col("doc_id").isNotNull() & F.col("class").isNotNull())
    classes = settled(named.groupBy("class").agg(F.min("doc_id").alias("node")), "classes")
    nodes = named.join(classes, "class").where("doc_id = node").select("node", "class", "tag", "n", "s0", "s1", "keys").dropDuplicates(["node"])
    nodes = settled(nodes, "nodes")
    buckets = nodes.select(F.explode("keys").alias("key"), "node")
    signatures = nodes.select("node", F.struct("n", "s0", "s1").alias("sig"))
    groups = link_groups(buckets, signatures, _may_link(percent), _prepare(docs, nodes, words, percent))
    linked = settled(nodes.select("node", "class").join(groups, "node").select("class", "component"), "linked-classes")
    placed = described.select("doc_id", "tag", "class", "n").join(classes, "class", "left").withColumn("node", F.coalesce("node", "doc_id"))
    placed = placed.join(linked, "class", "left").withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node"))
    )
    return placed.select(
        "doc_id",
        "tag",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest doc_id reachable) and ``kept`` of every document."""
    return _judged(docs, words, percent).drop("tag")


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that are near-duplicates of one with a smaller doc_id; all columns as they were."""
    dropped = _judged(docs, words, percent).where("NOT kept").select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).distinct()
    dropped = settled(dropped, "near-duplicates")
    same = (F.col("doc_id").cast("long") == F.col("_id")) & (F.xxhash64("text") == F.col("_tag"))
    return docs.join(dropped, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])

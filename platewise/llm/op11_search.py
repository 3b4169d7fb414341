"""Ranked lexical search over bit-sliced Bloom signatures.

*Index.* Documents of like size stand together in blocks of at most 1,024. A document's signature holds its terms, and for each term
that occurs 2, 4 or 8 times one more entry each; five bits an entry, 8 to 16 bits of signature for each entry. Signatures are stored bit by bit: the
slice of a bit is a bitmap over the documents of the block. Beside them a block keeps the document frequencies of its terms.

*Search.* The AND of a term's slices overestimates the documents that hold it, and its further entries overestimate how often; with the document's length that
bounds the term's share of the score from above. Weighted sums over an item's terms bound the score of every document at once.
The documents with the highest bounds are scored exactly, which gives each item a score that its last rank reaches at least; every document whose
bound reaches that score is then scored exactly from its text. Nothing else can be among the best, so the result is exact.

Items are taken in blocks of about ``BLOCK_BYTES`` of text and ``BLOCK_ITEMS`` items, which bounds what tasks are given; each block of items is a search of its own. The best of an
item are found in every task first, so no task sees all candidates of an item. Terms are compared by 64 bits of hash.

Edge cases: a null or empty text has no terms, is no document of N and is never found. Ties go to the smaller doc_id; repeated rows are found as often as they are there.
Rows without a doc_id count in the statistics but are not ranked. Repeated items count once; an item_id with several texts is searched for
each of them. Items without terms find nothing. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.llm.arrays import LETTERS_AND_DIGITS, let_workers_import, mix, slices, words_of
from platewise.llm.steps import settled

BEST = 20
LEVELS = (1, 2, 4, 8)  # occurrences that have an entry
BITS = 5  # of an entry
ROOM = 8  # bits of signature for each entry of the largest document of a block
DOCUMENTS = 1024  # of a block
BLOCK_BITS = 1 << 25  # bits of a block's signatures
BLOCK_BYTES = 1 << 18  # text of items searched at once
BLOCK_ITEMS = 1 << 11  # their number
SHARES = 1 << 23  # term shares held at once
SLICE = 1 << 20

_LEVEL_SALT = 0xA24BAED4963EE407


def entries(hashes: np.ndarray, level: int) -> np.ndarray:
    return mix(hashes + np.uint64(_LEVEL_SALT * (level + 1) % (1 << 64)))


def positions(entry: np.ndarray, bits: int) -> np.ndarray:
    """Bits of each entry, of a power of two."""
    step = (entry >> np.uint64(32)) | np.uint64(1)
    return ((entry[:, None] + step[:, None] * np.arange(BITS, dtype=np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def counted(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and occurrences of every different term of every text, by text."""
    by = np.lexsort((hashes, text))
    text, hashes = text[by], hashes[by]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(text)))


def _block(docs: list[tuple[int, int, np.ndarray, np.ndarray]], bits: int) -> dict:
    """Index row of documents given as doc_id, number of terms, terms and occurrences."""
    width = -(-len(docs) // 8) * 8
    signature = np.zeros((bits, width), bool)
    for k, (_, _, terms, times) in enumerate(docs):
        for level, least in enumerate(LEVELS):
            signature[positions(entries(terms[times >= least], level), bits), k] = True
    terms, df = np.unique(np.concatenate([d[2] for d in docs]), return_counts=True)
    return {
        "doc_ids": [d[0] for d in docs],
        "lengths": [d[1] for d in docs],
        "slices": np.packbits(signature, axis=1).tobytes(),
        "terms": terms.tobytes(),
        "df": df.astype(np.int32).tobytes(),
    }


_INDEX = "doc_ids array<long>, lengths array<long>, slices binary, terms binary, df binary"
_INDEX_ARROW = pa.schema(
    [("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("slices", pa.binary()), ("terms", pa.binary()), ("df", pa.binary())]
)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: dict[int, list] = {}
    for batch in slices(batches, limit=SLICE):
        words = words_of(batch.column("text"), LETTERS_AND_DIGITS)
        text, terms, times = counted(words.text_of, words.hashes)
        first = np.searchsorted(text, np.arange(batch.num_rows + 1)).tolist()
        lengths = np.diff(words.first).tolist()
        for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            own = slice(first[k], first[k + 1])
            if not lengths[k]:
                continue
            t = times[own]
            size = sum(int((t >= least).sum()) for least in LEVELS)
            bits = max(64, ROOM << (size - 1).bit_length())
            docs = waiting.setdefault(bits, [])
            docs.append((doc_id, lengths[k], terms[own], t))
            if len(docs) >= min(DOCUMENTS, max(8, BLOCK_BITS // bits)):
                yield pa.RecordBatch.from_pylist([_block(waiting.pop(bits), bits)], schema=_INDEX_ARROW)
    for bits, docs in waiting.items():
        yield pa.RecordBatch.from_pylist([_block(docs, bits)], schema=_INDEX_ARROW)


def index(docs: DataFrame) -> DataFrame:
    """Signature blocks of all documents that have terms, written once."""
    docs = let_workers_import(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return settled(docs.mapInArrow(_indexed, _INDEX), "signatures")


@dataclass
class Items:
    """Terms of a block of items, as numbers in the sorted vocabulary, with their occurrences in the item."""

    vocabulary: np.ndarray
    terms: list[np.ndarray]
    times: list[np.ndarray]

    @staticmethod
    def of(texts: list[str]) -> Items:
        words = words_of(pa.array(texts, pa.string()), LETTERS_AND_DIGITS)
        text, terms, times = counted(words.text_of, words.hashes)
        vocabulary = np.unique(terms)
        first = np.searchsorted(text, np.arange(len(texts) + 1))
        numbers = np.searchsorted(vocabulary, terms)
        own = [slice(a, b) for a, b in zip(first[:-1], first[1:])]
        return Items(vocabulary, [numbers[s] for s in own], [times[s] for s in own])


@dataclass
class Scoring:
    """Corpus statistics, and the weight of each term of the vocabulary."""

    documents: int
    total: int
    weights: np.ndarray

    def penalty(self, lengths: np.ndarray) -> np.ndarray:
        return 75 + 25 * lengths * self.documents // max(self.total, 1)

    @staticmethod
    def share(times: np.ndarray, penalty: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * times // (1000 * times + 12 * penalty)


def _frequencies(vocabulary: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for terms, df in zip(batch.column("terms").to_pylist(), batch.column("df").to_pylist()):
                at, known = _looked_up(vocabulary, np.frombuffer(terms, np.uint64))
                total[at[known]] += np.frombuffer(df, np.int32)[known]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["term", "df"])

    return run


def _looked_up(vocabulary: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number in the vocabulary of each hash, and whether it is there at all."""
    at = np.searchsorted(vocabulary, hashes)
    at[at == len(vocabulary)] = 0
    return at, (vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(hashes), bool))


def _scoring(signatures: DataFrame, items: Items) -> Scoring:
    one = signatures.select(F.size("lengths").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("l"))
    sums = one.agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    n = sums["n"] or 0
    counts = signatures.select("terms", "df").mapInArrow(_frequencies(items.vocabulary), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(len(items.vocabulary), np.int64)
    for r in counts.collect():  # one row for each term of the items
        df[r["term"]] = r["df"]
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for f in df.tolist()]
    return Scoring(n, sums["l"] or 0, np.array(weights, np.int64))


class Bounds:
    """Upper bounds of the scores of all documents of a block, for all items."""

    def __init__(self, items: Items, scoring: Scoring) -> None:
        self.items, self.scoring = items, scoring
        self.entries = [entries(items.vocabulary, level) for level in range(len(LEVELS))]
        self.times = [t.astype(float) for t in items.times]

    def of(self, lengths: np.ndarray, raw: bytes) -> np.ndarray:
        """Items x documents, as whole numbers in doubles (below 2 ** 53, so sums are exact)."""
        n = len(lengths)
        step = max(8, SHARES // (len(self.items.vocabulary) + 1) // 8 * 8)
        whole = np.frombuffer(raw, np.uint8).reshape(-1, -(-n // 8))
        return np.concatenate([self._part(lengths[a : a + step], whole[:, a // 8 : (a + step) // 8]) for a in range(0, n, step)], axis=1)

    def _part(self, lengths: np.ndarray, slices_: np.ndarray) -> np.ndarray:
        n = len(lengths)
        bits = len(slices_)
        maybe = np.bitwise_and.reduce(slices_[positions(self.entries[0], bits)], axis=1)
        term, doc = np.nonzero(np.unpackbits(maybe, axis=1, count=n))
        penalty = self.scoring.penalty(lengths)
        most = np.full(len(term), LEVELS[1] - 1, np.int64)
        left = np.arange(len(term))
        for level in range(1, len(LEVELS)):
            t, d = term[left], doc[left]
            held = slices_[positions(self.entries[level][t], bits), (d >> 3)[:, None]] >> (7 - (d & 7)).astype(np.uint8)[:, None] & 1
            left = left[held.all(axis=1)]
            most[left] = lengths[doc[left]] if level == len(LEVELS) - 1 else LEVELS[level + 1] - 1
        most = np.minimum(most, lengths[doc])
        shares = np.zeros((len(self.items.vocabulary), n))
        shares[term, doc] = self.scoring.weights[term] * Scoring.share(most, penalty[doc])
        return np.stack([q @ shares[t] for t, q in zip(self.items.terms, self.times)])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """doc_ids, whether they are there, lengths and slices of each block."""
    for k in range(batch.num_rows):
        one = batch.slice(k, 1)
        ids = one.column("doc_ids").flatten()
        lengths = one.column("lengths").flatten().to_numpy(zero_copy_only=False)
        named = np.asarray(ids.is_valid())
        yield np.where(named, ids.fill_null(0).to_numpy(zero_copy_only=False), -1), named, lengths, one.column("slices")[0].as_py()


def _highest(items: Items, scoring: Scoring, best: int):
    """Of each item the documents with the highest bounds in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(items, scoring)
        kept = [(np.zeros(0), np.zeros(0, np.int64)) for _ in items.terms]
        for batch in batches:
            for ids, named, lengths, raw in _rows(batch):
                upper = bounds.of(lengths, raw)
                for i, row in enumerate(upper):
                    fit = np.flatnonzero((row > 0) & named)
                    value, doc = np.append(kept[i][0], row[fit]), np.append(kept[i][1], ids[fit])
                    top = np.argsort(-value, kind="stable")[:best]
                    kept[i] = value[top], doc[top]
        sizes = [len(v) for v, _ in kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(kept)), sizes)), *(pa.array(np.concatenate(x) if x else np.zeros(0)) for x in zip(*kept))],
            names=["item", "bound", "doc_id"],
        )

    return run


def _not_excluded(items: Items, scoring: Scoring, floors: np.ndarray):
    """The documents whose bound reaches an item's floor, with these items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(items, scoring)
        for batch in batches:
            for ids, named, lengths, raw in _rows(batch):
                doc, item = np.nonzero(((bounds.of(lengths, raw) >= floors[:, None]) & named).T)
                edges = np.flatnonzero(np.diff(doc, prepend=-1))
                lists = pa.ListArray.from_arrays(pa.array(np.append(edges, len(doc)), pa.int32()), pa.array(item, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(ids[doc[edges]]), lists], names=["doc_id", "items"])

    return run


def _scored(items: Items, scoring: Scoring):
    """Exact scores above 0 of documents for the items that they come with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            words = words_of(batch.column("text"), LETTERS_AND_DIGITS)
            at, known = _looked_up(items.vocabulary, words.hashes)
            text, term, times = counted(words.text_of[known], at[known])
            lengths = np.diff(words.first)
            shares = scoring.weights[term] * Scoring.share(times, scoring.penalty(lengths)[text])
            first = np.searchsorted(text, np.arange(batch.num_rows + 1))
            out: list[tuple] = []
            whole = np.zeros(len(items.vocabulary), np.int64)
            for k, (doc_id, asked) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("items").to_pylist())):
                own = slice(first[k], first[k + 1])
                whole[term[own]] = shares[own]
                scores = [int(items.times[i] @ whole[items.terms[i]]) for i in asked]
                whole[term[own]] = 0
                out += [(i, doc_id, s) for i, s in zip(asked, scores) if s > 0]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(3)], names=["item", "doc_id", "score"])

    return run


def _search(known: DataFrame, signatures: DataFrame, texts: list[str], best: int) -> DataFrame:
    """``item`` (number in the block), ``doc_id`` and ``score`` of every document that can be among the best."""
    items = Items.of(texts)
    scoring = _scoring(signatures, items)
    blocks = signatures.select("doc_ids", "lengths", "slices")
    highest = blocks.mapInArrow(_highest(items, scoring, best), "item long, bound double, doc_id long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "doc_id"))
    few = highest.withColumn("place", place).where(F.col("place") <= best).groupBy("doc_id").agg(F.collect_set("item").alias("items"))
    few = settled(few, "highest-bounds")  # at most ``best`` rows for each item
    score = _scored(items, scoring)
    columns = "item long, doc_id long, score long"
    first = known.join(F.broadcast(few), "doc_id").mapInArrow(score, columns)
    reached = first.withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))).where(F.col("place") == best)
    floors = np.ones(len(texts))
    for r in reached.collect():  # one row for each item
        floors[r["item"]] = r["score"]
    candidates = blocks.mapInArrow(_not_excluded(items, scoring, floors), "doc_id long, items array<long>")
    candidates = settled(candidates.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")), "candidates")
    return known.join(candidates, "doc_id").mapInArrow(score, columns)


def _item_blocks(items: DataFrame) -> Iterator[list]:
    """The different items in blocks of about ``BLOCK_BYTES`` of text."""
    items = items.select("item_id", "text").where(F.length("text") > 0).distinct()
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    blocks = max(-(-(size["size"] or 0) // BLOCK_BYTES), -(-size["n"] // BLOCK_ITEMS))
    for block in range(blocks):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the best documents of every item."""
    spark = let_workers_import(docs).sparkSession
    kind = items.schema["item_id"].dataType
    known = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signatures = index(docs)
    found = spark.createDataFrame([], T.StructType([T.StructField("item_id", kind)])).selectExpr(
        "item_id", "0 AS rank", "cast(0 AS long) AS doc_id", "cast(0 AS long) AS score"
    )
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    for rows in _item_blocks(items):
        schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", kind)])
        names = F.broadcast(spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(rows)], schema))
        scores = _search(known, signatures, [r["text"] for r in rows], best)
        top = scores.withColumn("rank", rank).where(F.col("rank") <= best)
        found = found.unionByName(top.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return found

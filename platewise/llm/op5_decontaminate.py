"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training token windows.

Words are the contract's: A-Z lower-cased, runs of ASCII letters, digits and anything beyond ASCII. A window is 13
consecutive words of an item; an item of fewer words, but not none, is one window. Every word window of a document is
hashed, looked up in the set of window hashes, and each hit is verified on the words themselves, so a result never depends
on a hash. Documents are scanned where they lie: no text is shuffled.

The set is broadcast in blocks of at most ``block_bytes`` of item text. A benchmark beyond one block makes further scans
over the same rows, in the same tasks; nothing is left out.

Edge cases: a null or empty text, and a text of separators alone, has no words and no hits. Items without text or without
words have no window; items without an id are left out. Repeated items count once; repeated documents give repeated rows.
An empty benchmark hits nothing. Other columns of the documents are ignored by ``scan`` and kept by the removals.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.llm.arrays import LETTERS_AND_DIGITS, RunHash, code_points_before, let_workers_import, slices, split_words, text_bytes

WINDOW = 13
BLOCK_BYTES = 8 << 20

_HIT = ("first", "last", "start", "end")
_FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in _HIT]))),
    T.StructField("items", T.ArrayType(T.StringType())),
]


class WindowSet:
    """Windows of benchmark items by length, as sorted hashes with the words behind each."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        texts = pa.array([text for _, text in items], pa.string())
        words = split_words(*text_bytes(texts), LETTERS_AND_DIGITS)
        runs = RunHash(words.hashes)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.known: dict[int, dict[bytes, set[str]]] = {}
        found: dict[int, list[int]] = {}
        for i, (item_id, _) in enumerate(items):
            low, high = int(words.first[i]), int(words.first[i + 1])
            length = min(window, high - low)
            for at in range(low, high - length + 1) if length else ():
                key = b" ".join(words.word(j) for j in range(at, at + length))
                h = int(runs.of(np.array([at]), np.array([at + length]))[0])
                self.known.setdefault(h, {}).setdefault(key, set()).add(item_id)
                found.setdefault(length, []).append(h)
        for length, hashes in found.items():
            ordered = np.unique(np.array(hashes, dtype=np.uint64))
            seen = np.zeros(1 << 20, bool)
            seen[ordered >> np.uint64(44)] = True
            self.by_length[length] = (ordered, seen)

    def find(self, words, runs: RunHash) -> Iterator[tuple[int, int, set[str]]]:
        """First word, length and items of every verified window, over a slice of texts."""
        n = len(words.start)
        ends = words.first[1:][words.text_of] if n else np.zeros(0, np.int64)
        for length, (ordered, seen) in self.by_length.items():
            if n < length:
                continue
            at = np.arange(n - length + 1)
            at = at[at + length <= ends[: len(at)]]
            hashes = runs.of(at, at + length)
            maybe = seen[hashes >> np.uint64(44)]
            at, hashes = at[maybe], hashes[maybe]
            place = np.searchsorted(ordered, hashes)
            place[place == len(ordered)] = 0
            same = ordered[place] == hashes
            for first, h in zip(at[same].tolist(), hashes[same].tolist()):
                key = b" ".join(words.word(j) for j in range(first, first + length))
                items = self.known[h].get(key)
                if items:
                    yield first, length, items


@functools.lru_cache(maxsize=1)
def _window_set(shared: Broadcast, window: int) -> WindowSet:
    """Built once in each Python worker."""
    return WindowSet(shared.value, window)


def _scan(shared: Broadcast, window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _window_set(shared, window)
        for batch in slices(batches):
            data, begins = text_bytes(batch.column("text"))
            words = split_words(data, begins, LETTERS_AND_DIGITS)
            hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            items: list[set[str]] = [set() for _ in range(batch.num_rows)]
            found = list(windows.find(words, RunHash(words.hashes)))
            if found:
                first = np.array([f for f, _, _ in found])
                last = first + np.array([n for _, n, _ in found])
                text = words.text_of[first]
                home = begins[text]
                start = code_points_before(data, words.start[first], home)
                end = code_points_before(data, words.end[last - 1], home)
                base = words.first[text]
                for k, (_, _, names) in enumerate(found):
                    t = int(text[k])
                    hits[t].append({"first": int(first[k] - base[k]), "last": int(last[k] - base[k]), "start": int(start[k]), "end": int(end[k])})
                    items[t] |= names
            rows = batch.to_pydict()
            if "hits" in rows:
                hits = [[*a, *b] for a, b in zip(rows["hits"], hits)]
                items = [{*a, *b} for a, b in zip(rows["items"], items)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("text"),
                    pa.array(np.diff(words.first), pa.int64()),
                    pa.array(hits, pa.list_(pa.struct([(c, pa.int32()) for c in _HIT]))),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ],
                names=["row", "text", "n_words", "hits", "items"],
            )

    return scan


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of about ``block_bytes`` text; at least one block."""
    items = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct().collect()
        yield [(r["item_id"], r["text"] or "") for r in rows]


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row`` (a struct of all columns but ``text``), ``text``, ``n_words``, ``hits`` and ``items`` of every document.

    A hit has its first and last word (exclusive) and its code points in the text; ``items`` are the ids as text, sorted.
    """
    spark: SparkSession = let_workers_import(docs).sparkSession
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    out = docs.select(F.struct(*others).alias("row"), "text")
    for items in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(items)
        out = out.mapInArrow(_scan(shared, window), T.StructType([out.schema["row"], out.schema["text"], *_FOUND]))
    return out


def hit_words(hits: str = "hits") -> Column:
    """Number of different words inside any hit. The hits of a document come in word order."""
    ordered = F.array_sort(F.transform(hits, lambda h: F.struct(h["first"].alias("first"), h["last"].alias("last"))))
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        ordered,
        start,
        lambda acc, h: F.struct(
            F.greatest(acc["upto"], h["last"]).alias("upto"),
            (acc["n"] + F.greatest(F.lit(0), h["last"] - F.greatest(acc["upto"], h["first"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def contaminated(n_words: Column, n_hit: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def remove_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents of which less than a twentieth of the words lies inside benchmark windows; all columns as they were."""
    found = scan(docs, benchmark)
    kept = found.where(~contaminated(F.col("n_words"), hit_words()))
    return kept.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All documents without the passages that lie inside benchmark windows; a space stands for each passage."""
    found = scan(docs, benchmark)
    pieces = F.aggregate(
        F.array_sort(F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end")))),
        F.struct(F.lit(0).alias("upto"), F.lit("").alias("text")),
        lambda acc, h: F.struct(
            F.greatest(acc["upto"], h["end"]).alias("upto"),
            F.when(h["start"] <= acc["upto"], F.when((h["start"] == 0) & (acc["upto"] == 0), F.lit(" ")).otherwise(acc["text"]))
            .otherwise(F.concat(acc["text"], F.substring(F.col("text"), acc["upto"] + 1, h["start"] - acc["upto"]), F.lit(" ")))
            .alias("text"),
        ),
    )
    cut = F.when(F.size("hits") == 0, F.col("text")).otherwise(
        F.concat(pieces["text"], F.substring(F.col("text"), pieces["upto"] + 1, F.length("text")))
    )
    return found.select(*[cut.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: its words, hit words, the items found and whether it counts as contaminated."""
    found = scan(docs.select("doc_id", "text"), benchmark).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", hit_words().alias("n_hit"), "items"
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


"""Toxicity by a linear-chain conditional random field over words.

Labels mark documents, so the words are labelled first: in toxic training documents the words whose evidence (smoothed log-odds of
document counts, of the word itself and of its prefixes of 3 to 6 bytes) is high, or the strongest word where none is; in
clean ones no word. A linear-chain CRF with two states is trained on sentences with these labels. It reads more than the evidence that
labelled the words: the evidence of the neighbours, the word's shape, and the identities of the word, its ending and both neighbours, hashed into
2 ** 16 weights. So a word that clean documents use as well offends only in the company that toxic ones give it. The chain's forward-backward
marginals tag the offending words; their maximum and sum, calibrated on training documents kept aside, give the score.

Training reads a bounded sample: the ``SAMPLE`` labelled documents with the smallest hashes of their ids, at most ``SENTENCES``
sentences for the CRF. Evidence is hashed into 2 ** 20 buckets, so the broadcast model has 4.3 MB whatever the corpus. Scoring reads every
word of every text. Only the text enters a score.

Edge cases: a null or empty text has no offending word and the lowest score. Labels that are null, or without a doc_id, are ignored;
of several labels for one document the highest counts. Without any toxic or any clean training document the score is the
share of toxic ones (0 without labels). Repeated documents give repeated rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.llm.arrays import LETTERS_AND_DIGITS, Words, code_points_before, let_workers_import, mix, slices, split_words, text_bytes
from platewise.workspace import materialise

SAMPLE = 20_000  # labelled documents that training reads
SENTENCES = 8_000  # of each kind, with and without an offending word
CLEAN_PART = 8  # one in so many sentences without a toxic word is offered to training; bounds the labelled rows with SAMPLE and SENTENCES
CHAIN = 64  # words; longer sentences are several chains
BUCKETS = 1 << 20
PREFIXES = (3, 4, 5, 6)
LEAST_EVIDENCE = 2.0
LEAST_DOCUMENTS = 3
TASKS = 8

IDENTITIES = 1 << 16  # weights of hashed identities
LEAST_SEEN = 5  # training words that an identity must be seen with to have a weight
SUFFIX = 3  # bytes

_FEATURES = 8 + len(PREFIXES)
_KINDS = 4  # of identities
_BREAKS = np.isin(np.arange(256), [ord(c) for c in ".!?\n"])


def read_words(column: pa.Array) -> Words:
    """Words with ASCII and Latin-1 capitals lower-cased."""
    data, begins = text_bytes(column)
    data = data.copy()
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    data[second] += 0x20
    return split_words(data, begins, LETTERS_AND_DIGITS)


def buckets(words: Words) -> np.ndarray:
    """Bucket of the word and of each prefix, words x kinds."""
    ends = [words.end, *[np.minimum(words.start + k, words.end) for k in PREFIXES]]
    out = np.empty((len(words.start), len(ends)), np.int64)
    for kind, end in enumerate(ends):
        out[:, kind] = (mix(words.runs.of(words.start, end) + np.uint64(kind)) % np.uint64(BUCKETS)).astype(np.int64)
    return out


def features(words: Words, found: np.ndarray, evidence: np.ndarray) -> np.ndarray:
    """Constant, evidence of the word and of its prefixes, the strongest of them, that of both neighbours in the chain, and the word's shape."""
    values = evidence[found]
    best = values.max(axis=1, initial=0)
    before, after = _neighbours(words)
    around = np.append(best, np.float32(0))  # the last one stands for no neighbour
    length = words.end - words.start
    counts = np.zeros((2, len(words.lower) + 1), np.int64)
    np.cumsum((words.lower >= ord("0")) & (words.lower <= ord("9")), out=counts[0, 1:])
    np.cumsum(words.lower >= 0x80, out=counts[1, 1:])
    digits, beyond = (counts[:, words.end] > counts[:, words.start]).astype(np.float32)
    return np.column_stack([np.ones(len(found), np.float32), values, best, around[before], around[after], digits, beyond, np.log(length)]).astype(np.float32)


def _neighbours(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Number of the word before and of the word behind each one in its chain; -1 where there is none."""
    n = len(words.start)
    first, length = chains(words)
    before, after = np.arange(-1, n - 1), np.arange(1, n + 1)
    before[first] = -1
    after[first + length - 1] = -1
    return before, after


def identities(words: Words) -> np.ndarray:
    """Hashed identity of the word, its last bytes, and the words before and behind it in the chain, words x kinds."""
    known = np.append(words.hashes, np.uint64(0))
    ending = words.runs.of(np.maximum(words.start, words.end - SUFFIX), words.end)
    before, after = _neighbours(words)
    kinds = (words.hashes, ending, known[before], known[after])
    return np.stack([(mix(h + np.uint64(len(PREFIXES) + 1 + k)) % np.uint64(IDENTITIES)).astype(np.uint16) for k, h in enumerate(kinds)], axis=1)


def chains(words: Words, longest: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of each chain: sentences and lines, cut where they are too long."""
    n = len(words.start)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    breaks = np.zeros(len(words.lower) + 1, np.int64)
    np.cumsum(_BREAKS[words.lower], out=breaks[1:])
    at = breaks[words.start]
    head = np.ones(n, bool)
    head[1:] = (at[1:] != at[:-1]) | (words.text_of[1:] != words.text_of[:-1])
    begin = np.flatnonzero(head)
    within = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
    first = np.flatnonzero(within % longest == 0)
    return first, np.diff(np.append(first, n))


class Chain:
    """Forward-backward over many chains at once; all chains take a step together."""

    def __init__(self, first: np.ndarray, length: np.ndarray) -> None:
        order = np.argsort(-length, kind="stable")
        self.first, self.length = first[order], length[order]
        steps = int(length.max(initial=0))
        self.active = np.searchsorted(-self.length, -np.arange(steps), side="left")

    def odds(self, unary: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Odds of state 1 given what stands before (and at) each word, and given what stands behind it."""
        e = np.exp(np.clip(unary, -30, 30))
        (t00, t01), (t10, t11) = np.exp(transition)
        before, behind = np.empty_like(e), np.ones_like(e)
        for step, k in enumerate(self.active):
            at = self.first[:k] + step
            if step:
                r = before[at - 1]
                before[at] = e[at] * (t01 + r * t11) / (t00 + r * t10)
            else:
                before[at] = e[at] * t01 / t00
        for step in range(len(self.active) - 2, -1, -1):
            at = self.first[: self.active[step + 1]] + step
            b = e[at + 1] * behind[at + 1]
            behind[at] = (t10 + t11 * b) / (t00 + t01 * b)
        return before, behind

    def marginals(self, unary: np.ndarray, transition: np.ndarray) -> np.ndarray:
        before, behind = self.odds(unary, transition)
        odds = before * behind
        return odds / (1 + odds)


def train_crf(
    x: np.ndarray, y: np.ndarray, first: np.ndarray, length: np.ndarray, ids: np.ndarray | None = None, rounds: int = 200
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature weights, transition scores and weights of identities (``ids``, words x kinds) of the largest penalised likelihood, by gradient steps."""
    ids = np.zeros((len(x), 0), np.uint16) if ids is None else ids
    used = np.flatnonzero(np.bincount(ids.ravel(), minlength=IDENTITIES) >= LEAST_SEEN)
    number = np.full(IDENTITIES, len(used))  # rare ones share a weight that stays 0
    number[used] = np.arange(len(used))
    ids = number[ids]
    chain = Chain(first, length)
    last = np.zeros(len(y), bool)
    last[first + length - 1] = True
    left = np.flatnonzero(~last)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[left], y[left + 1]), 1)
    np.add.at(seen, (np.zeros(len(first), int), y[first]), 1)
    dense = x.shape[1]
    theta = np.zeros(dense + 4 + len(used))
    theta[0] = -2.0
    penalty = np.where(np.arange(len(theta)) < dense + 4, 1e-5, 1e-4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        unary, transition = x @ theta[:dense], theta[dense : dense + 4].reshape(2, 2)
        unary = unary + np.append(theta[dense + 4 :], 0)[ids].sum(axis=1)
        before, behind = chain.odds(unary, transition)
        odds = before * behind
        p = odds / (1 + odds)
        e = np.exp(np.clip(unary, -30, 30))
        joint = np.empty((len(left), 2, 2))
        for a in (0, 1):
            for b in (0, 1):
                weight = np.exp(transition[a, b]) * (before[left] if a else 1.0)
                joint[:, a, b] = weight * (e[left + 1] * behind[left + 1] if b else 1.0)
        expected = (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        expected[0] += [(1 - p[first]).sum(), p[first].sum()]
        of_ids = np.bincount(ids.ravel(), weights=np.repeat(y - p, ids.shape[1]), minlength=len(used) + 1)[:-1]
        gradient = np.concatenate([x.T @ (y - p), (seen - expected).ravel(), of_ids]) / len(y) - penalty * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    context = np.zeros(IDENTITIES, np.float32)
    context[used] = theta[dense + 4 :]
    return theta[:dense], theta[dense : dense + 4].reshape(2, 2), context


@dataclass
class Model:
    evidence: np.ndarray
    weights: np.ndarray
    transition: np.ndarray
    context: np.ndarray  # weights of identities
    calibration: np.ndarray  # of 1, logit of the highest marginal, log of 1 + their sum
    constant: float | None = None

    def marginals(self, words: Words) -> np.ndarray:
        if not len(words.start):
            return np.zeros(0)
        unary = features(words, buckets(words), self.evidence) @ self.weights + self.context[identities(words)].sum(axis=1)
        return Chain(*chains(words)).marginals(unary, self.transition)

    def summary(self, words: Words) -> np.ndarray:
        """What the calibration reads, texts x 3."""
        p = self.marginals(words)
        return summarise(p, words.first)

    def score(self, summary: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(summary), self.constant)
        return 1 / (1 + np.exp(-np.clip(summary @ self.calibration, -30, 30)))


def summarise(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    n = len(first) - 1
    top, total = np.zeros(n), np.zeros(n)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        top[full] = np.maximum.reduceat(p, first[:-1][full])
        total[full] = np.add.reduceat(p, first[:-1][full])
    top = np.clip(top, 1e-4, 1 - 1e-4)
    return np.column_stack([np.ones(n), np.log(top / (1 - top)), np.log1p(total)])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Clean and toxic documents of each bucket that occurs in the task's texts."""
    counts = np.zeros((2, BUCKETS), np.int32)
    for batch in slices(batches):
        words = read_words(batch.column("text"))
        found = buckets(words)
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        pairs = np.unique((words.text_of[:, None] * BUCKETS + found).ravel())
        np.add.at(counts, (toxic[pairs // BUCKETS], pairs % BUCKETS), 1)
    used = np.flatnonzero(counts.any(axis=0))
    for low in range(0, len(used), 1 << 16):
        some = used[low : low + (1 << 16)]
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some.astype(np.int32)), "clean": pa.array(counts[0, some]), "toxic": pa.array(counts[1, some])})


def evidence_of(clean: np.ndarray, toxic: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Log-odds of a document being toxic given a bucket, over those without it."""
    share = documents[1] / documents.sum()
    odds = (toxic + 2 * share) / (clean + 2 * (1 - share))
    return (np.log(odds) - math.log(share / (1 - share))).astype(np.float32)


def label_words(found: np.ndarray, strong: np.ndarray, evidence: np.ndarray, text_of: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """1 for the offending words of toxic texts; ``strong`` marks the buckets that hardly any clean document has."""
    label = strong[found].any(axis=1) & (toxic[text_of] == 1)
    best = evidence[found].max(axis=1, initial=0)
    without = np.flatnonzero((toxic == 1) & (np.bincount(text_of, weights=label, minlength=len(toxic)) == 0))
    for t in without:
        mine = np.flatnonzero(text_of == t)
        if len(mine):
            label[mine[np.argmax(best[mine])]] = True
    return label.astype(np.int64)


def _sentences(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strong, evidence = shared.value
        for batch in slices(batches):
            words = read_words(batch.column("text"))
            found = buckets(words)
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            label = label_words(found, strong, evidence, words.text_of, toxic)
            first, length = chains(words)
            if not len(first):
                continue
            x, ids = features(words, found, evidence), identities(words)
            marked = np.add.reduceat(label, first) > 0
            order = mix(words.hashes[first] + words.hashes[first + length - 1] + length.astype(np.uint64)).view(np.int64)
            take = np.flatnonzero(marked | (order % CLEAN_PART == 0))
            yield pa.RecordBatch.from_pydict(
                {
                    "marked": pa.array(marked[take]),
                    "place": pa.array(order[take]),
                    "x": pa.array([x[a : a + n].astype("<f4").tobytes() for a, n in zip(first[take], length[take])], pa.binary()),
                    "ids": pa.array([ids[a : a + n].tobytes() for a, n in zip(first[take], length[take])], pa.binary()),
                    "y": pa.array([label[a : a + n].astype("u1").tobytes() for a, n in zip(first[take], length[take])], pa.binary()),
                }
            )

    return run


def _summaries(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            z = model.summary(read_words(batch.column("text")))
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic").cast(pa.int32()), "top": pa.array(z[:, 1]), "total": pa.array(z[:, 2])})

    return run


def logistic(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Penalised logistic regression by Newton steps."""
    beta = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        hessian = z.T @ (z * (p * (1 - p))[:, None]) + 0.1 * np.eye(z.shape[1])
        beta = beta + np.clip(np.linalg.solve(hessian, z.T @ (y - p) - 0.1 * beta), -2, 2)
    return beta


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from the labelled documents (``doc_id``, ``toxic`` 0 or 1)."""
    spark = let_workers_import(docs).sparkSession
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    place = F.xxhash64("doc_id")
    chosen = known.orderBy(place, "doc_id").limit(sample).select("doc_id", "toxic", (F.pmod(place, F.lit(4)) == 0).alias("aside")).collect()
    documents = np.bincount([min(1, max(0, r["toxic"])) for r in chosen], minlength=2)
    if not documents.all():
        return Model(np.zeros(1), np.zeros(1), np.zeros((2, 2)), np.zeros(1), np.zeros(3), constant=float(documents[1] > 0))
    rows = [(int(r["doc_id"]), min(1, max(0, r["toxic"])), r["aside"]) for r in chosen]
    picked = F.broadcast(spark.createDataFrame(rows, "doc_id long, toxic int, aside boolean"))  # at most ``sample`` rows
    texts = docs.select("doc_id", "text").join(picked, "doc_id").select("text", "toxic", "aside").repartition(TASKS)
    texts = materialise(texts, "labelled-texts")

    learn = texts.where("NOT aside").select("text", "toxic").coalesce(TASKS)
    documents = np.zeros(2, np.int64)
    for row in learn.groupBy("toxic").count().collect():
        documents[row["toxic"]] = row["count"]
    if not documents.all():
        return Model(np.zeros(1), np.zeros(1), np.zeros((2, 2)), np.zeros(1), np.zeros(3), constant=float(documents[1] / max(1, documents.sum())))
    counts = learn.mapInArrow(_document_counts, "bucket int, clean int, toxic int").groupBy("bucket")
    # At most one row for each bucket; what a single toxic document has says nothing yet and counts as unseen.
    table = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic > 1").toArrow()
    bucket, clean, toxic = (table.column(c).to_numpy() for c in ("bucket", "clean", "toxic"))
    evidence, strong = np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, bool)
    evidence[bucket] = evidence_of(clean, toxic, documents)
    strong[bucket] = (evidence[bucket] >= LEAST_EVIDENCE) & (toxic >= LEAST_DOCUMENTS) & (clean * 9 <= toxic)

    shared = spark.sparkContext.broadcast((strong, evidence))
    sentences = materialise(learn.mapInArrow(_sentences(shared), "marked boolean, place long, x binary, ids binary, y binary"), "sentences")
    train = []
    for marked in (True, False):
        train += sentences.where(F.col("marked") == marked).orderBy("place", "x", "ids", "y").limit(SENTENCES).collect()
    length = np.array([len(r["y"]) for r in train])
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in train), "<f4").reshape(-1, _FEATURES).astype(np.float64)
    y = np.frombuffer(b"".join(bytes(r["y"]) for r in train), "u1").astype(np.int64)
    ids = np.frombuffer(b"".join(bytes(r["ids"]) for r in train), np.uint16).reshape(-1, _KINDS)
    del train
    weights, transition, context = train_crf(x, y, np.cumsum(length) - length, length, ids)
    model = Model(evidence, weights.astype(np.float32), transition, context, np.zeros(3))

    for aside in (True, False):  # the documents kept aside, unless they are of one kind only
        part = texts.where("aside") if aside else texts
        found = part.select("text", "toxic").mapInArrow(_summaries(spark.sparkContext.broadcast(model)), "toxic int, top double, total double")
        rows = np.array([tuple(r) for r in found.collect()], float).reshape(-1, 3)  # at most ``sample`` rows
        if 0 < rows[:, 0].sum() < len(rows):
            break
    order = np.lexsort(rows.T)
    model.calibration = logistic(np.column_stack([np.ones(len(rows)), rows[order, 1:]]), rows[order, 0])
    return model


def _tag(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            words = read_words(batch.column("text"))
            p = model.marginals(words) if model.constant is None else np.zeros(len(words.start))
            scores = model.score(summarise(p, words.first))
            bad = np.flatnonzero(p >= 0.5)
            home = words.begins[words.text_of[bad]]
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            starts = code_points_before(words.lower, words.start[bad], home).tolist()
            ends = code_points_before(words.lower, words.end[bad], home).tolist()
            for t, a, b in zip(words.text_of[bad].tolist(), starts, ends):
                spans[t].append({"start": a, "end": b})
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text"), pa.array(scores), pa.array(spans, kind)], names=["row", "text", "score", "spans"]
            )

    return run


def tag(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (a struct of all columns but ``text``), ``text``, ``score`` and the offending ``spans`` of every document."""
    spark = let_workers_import(docs).sparkSession
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    packed = docs.select(F.struct(*others).alias("row"), "text")
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([*packed.schema, T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    return packed.mapInArrow(_tag(spark.sparkContext.broadcast(model)), schema)


def training_rows(labels: DataFrame) -> DataFrame:
    """The labels to learn from: all but those held out."""
    return labels.where(~held_out("doc_id"))


def held_out(doc_id: str):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: score, prediction and the offending spans, from a model of the labels that are not held out."""
    model = fit(docs, training_rows(labels))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return tag(docs.select("doc_id", "text"), model).select(
        F.col("row.doc_id").alias("doc_id"),
        held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        spans.alias("spans"),
    )


def remove_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those scored 0.5 or more; all columns as they were."""
    kept = tag(docs, fit(docs, training_rows(labels))).where("score < 0.5")
    return kept.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])

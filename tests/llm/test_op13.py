import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from platewise.llm import cover_sort
from platewise.llm import op13_suffix_dedup as op
from tests.llm.conftest import FOLDER


def brute(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, digest) by looking up every string in all documents."""
    least = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for d, t in texts:
        for i in range(len(t) - length + 1) if d is not None else ():
            s = t[i : i + length]
            least[s] = min(d, least.get(s, d))
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1) if d is not None else ():
            if least[t[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def spliced(seed, n, parts=12):
    """Documents that share pieces with each other, in other surroundings."""
    rng = random.Random(seed)
    alphabet = "abcdeé \n漢"
    pool = ["".join(rng.choice(alphabet) for _ in range(rng.choice([20, 45, 49, 50, 51, 60, 130, 400]))) for _ in range(parts)]
    rows = []
    for i in range(n):
        own = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(4)]
        rows.append((i, "".join(x for o in own for x in (o, rng.choice(pool)[rng.choice([0, 0, 1, 5]) :]))))
    return rows


def test_block_order_equals_sorted_suffixes(monkeypatch):
    rng = random.Random(5)
    for trial in range(60):
        texts = [bytes(rng.choice(b"ab\0") for _ in range(rng.choice([0, 1, 3, 7, 8, 30, 200]))) for _ in range(rng.randint(1, 8))]
        texts += texts[:2]
        monkeypatch.setattr(cover_sort, "BUCKET", rng.choice([1, 5, 1 << 17]))
        block = cover_sort.Block(texts)
        suffix = {int(b) + i: t[i:] for b, t in zip(block.begins, texts) for i in range(len(t))}
        order = block.order(np.array(rng.sample(sorted(suffix), len(suffix)), np.int64)).tolist()
        assert sorted(order) == sorted(suffix)
        assert [suffix[p] for p in order] == sorted(suffix.values())


@pytest.mark.parametrize("length", [3, 20, 50])
def test_equals_brute_force(spark, length):
    rows = spliced(length, 40)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(op.judge(docs, length)) == brute(rows, length)


def test_hot_anchors_give_the_same_rows(spark, monkeypatch):
    rows = spliced(7, 60, parts=3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(op, "HOT", 1)
    monkeypatch.setattr(op, "BLOCK", 100)
    assert op._hot_anchors(docs, 60, 50).size
    assert got(op.judge(docs)) == brute(rows, 50)


def test_query_equals_brute_force(spark, texts):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert got(op.judge(docs)) == brute(list(texts.items()), 50)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    assert got(op.judge(odd_docs)) == brute(rows, 50)
    assert op.judge(no_docs).collect() == []


def test_rows_of_one_doc_id_do_not_remove_from_each_other(spark):
    a, b = "first text " * 9, "another one " * 9
    rows = [(0, a), (1, b), (1, a), (1, a + b), (2, "x" + b)]
    assert got(op.judge(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows, 50)


def test_removal_keeps_columns_and_whole_characters(spark, odd_docs):
    cleaned = op.remove_repeats(odd_docs)
    assert cleaned.columns == odd_docs.columns and cleaned.count() == odd_docs.count()
    rows = [(1, "漢" * 30, "x"), (2, "aa" + "漢" * 30 + "bb", "y"), (3, None, "z")]
    out = op.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, row string"))
    assert got(out.select("doc_id", "text", "row")) == [(1, "漢" * 30, "x"), (2, "aabb", "y"), (3, None, "z")]


def test_order_by_keys_equals_a_stable_sort():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 1000):
        for top in (2, 1 << 40, 1 << 64):
            keys = rng.integers(0, top, n, np.uint64) if top < 1 << 64 else rng.integers(0, 1 << 64, n, np.uint64) | np.uint64(1 << 63)
            assert cover_sort.by_key(keys).tolist() == np.argsort(keys, kind="stable").tolist()


@pytest.mark.parametrize("length", [1, 3, 50, 90])
def test_contexts_do_not_depend_on_chunks(monkeypatch, length):
    rng = random.Random(length)
    texts = [bytes(rng.choice(b"ab c") for _ in range(rng.choice([0, 1, length - 1, length, 200, 40_000]))) for _ in range(12)]
    texts += texts[:6]
    data = np.frombuffer(b"".join(texts), np.uint8)
    begins = np.cumsum([0, *map(len, texts)])
    whole = op.contexts(data, begins, length)
    starts = [int(f) + i for f, n in zip(whole.first, whole.windows) for i in range(n)]
    assert starts == [int(b) + i for b, t in zip(begins, texts) for i in range(len(t) - length + 1)]
    anchors = {}
    for text, anchor, first, n in zip(whole.text, whole.anchor, whole.first, whole.windows):
        assert begins[text] <= first and first + n - 1 + length <= begins[text + 1]
        for i in range(first, first + n):
            assert anchors.setdefault(data[i : i + length].tobytes(), anchor) == anchor
    monkeypatch.setattr(op, "CHUNK", 100)
    parts = op.contexts(data, begins, length)
    for name in ("text", "anchor", "digest", "first", "windows"):
        assert getattr(whole, name).tolist() == getattr(parts, name).tolist()


def test_texts_that_lose_nothing_are_not_looked_at_again(monkeypatch):
    looked = []
    plain = op.contexts
    monkeypatch.setattr(op, "contexts", lambda data, *more: looked.append(len(data)) or plain(data, *more))
    texts = ["first " * 30, "", None, "other" * 50, "é" * 60]
    found = plain(np.frombuffer(texts[3].encode(), np.uint8), np.array([0, 250]), 50)
    batch = pa.RecordBatch.from_pydict(
        {
            "row": pa.array(range(5)),
            "text": pa.array(texts),
            "repeats": pa.array([None, None, None, found.digest[:1].tolist(), None], pa.list_(pa.int64())),
            "digests": pa.array([None] * 5, pa.list_(pa.int64())),
            "masks": pa.array([None] * 5, pa.list_(pa.int64())),
        }
    )
    (out,) = op._cut(50, False)(iter([batch]))
    assert looked == [250]
    assert out.column("n_bytes").to_pylist() == [180, 0, 0, 250, 120]
    lost = out.column("n_removed").to_pylist()
    assert lost[3] >= 50 and lost[:3] + lost[4:] == [0, 0, 0, 0]
    kept = [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]
    assert [a == b for a, b in zip(out.column("kept_sha256").to_pylist(), kept)] == [True, True, True, False, True]


def test_ranked_suffixes_are_not_sorted_again(monkeypatch):
    sizes = []
    plain = cover_sort.by_key
    monkeypatch.setattr(cover_sort, "by_key", lambda keys: sizes.append(len(keys)) or plain(keys))
    rng = random.Random(1)
    cover_sort.Block([rng.randbytes(7000), b"twice the same", b"twice the same"])
    assert 2990 < sizes[0] < 3020 and all(n <= 12 for n in sizes[1:])


def test_groups_end_between_keys():
    rng = random.Random(2)
    for limit in (0, 5, 40):
        rows = sorted((rng.randrange(30), rng.randbytes(rng.randrange(9))) for _ in range(200))
        batches = [
            pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows[i:j]], pa.int64()), pa.array([x for _, x in rows[i:j]], pa.binary())], ["key", "bytes"])
            for i, j in ((0, 0), (0, 1), (1, 60), (60, 60), (60, 199), (199, 200))
        ]
        groups = [list(zip(*(c.to_pylist() for c in b.columns))) for b in op._grouped(iter(batches), limit)]
        assert [r for g in groups for r in g] == rows
        for group, following in zip(groups, groups[1:]):
            assert group[-1][0] != following[0][0] and sum(len(x) for _, x in group) >= limit
            last = [x for k, x in group if k != group[-1][0]]
            assert not last or sum(map(len, last)) < max(limit, 1) or limit == 0
        if not limit:
            assert all(len({k for k, _ in g}) == 1 for g in groups)

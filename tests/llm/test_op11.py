import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from platewise.llm import op11_search as op
from platewise.llm import queries
from tests.llm.conftest import FOLDER

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, best=20):
    counts = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    counts = [c for c in counts if c[2]]
    n, total = len(counts), sum(c[2] for c in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item_id, text in dict.fromkeys(items):
        asked = Counter(terms(text))
        scores = []
        for doc_id, c, length in counts:
            m = 100 - 25 + (25 * length * n) // total
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in asked.items() if c[t])
            if score > 0 and doc_id is not None:
                scores.append((-score, doc_id))
        out += [(item_id, k, d, -s) for k, (s, d) in enumerate(sorted(scores)[:best], 1)]
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(op, "DOCUMENTS", 24)
    monkeypatch.setattr(op, "SHARES", 4000)
    monkeypatch.setattr(op, "BLOCK_ITEMS", 7)


def test_query_equals_brute_force_and_sql(spark, texts):
    found = queries.queries()["op11_search"](spark, FOLDER)
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    rows = got(found)
    assert rows == brute(list(texts.items()), items)
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    assert rows == sorted(con.execute(queries.oracle_sql()["op11_search"]).fetchall(), key=repr)


def test_ties_repeats_nulls_and_odd_texts(spark, odd_docs, small_blocks):
    more = [(100 + i, f"tie word{i % 3} common " * (i % 4 + 1), None, None, None) for i in range(80)]
    docs = odd_docs.unionByName(spark.createDataFrame(more, odd_docs.schema)).repartition(3)
    items = [(1, "Common TIE word1"), (1, "Common TIE word1"), (2, None), (3, ""), (4, "-- ,"), (5, "w1 w2 漢字 it"), (6, "no such thing"), (None, "common common")]
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    frame = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string")
    assert got(op.search(docs, frame)) == brute(rows, [i for i in items if i[1]])


def test_empty_tables(spark, no_docs):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert op.search(no_docs, items).collect() == []
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert op.search(docs, items.limit(0)).collect() == []
    assert op.search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_are_never_below_scores():
    rng = np.random.default_rng(4)
    vocabulary = [f"v{i}" for i in range(60)]
    docs = [" ".join(rng.choice(vocabulary, rng.integers(20, 40))) for _ in range(40)]
    items = op.Items.of([" ".join(rng.choice(vocabulary, 10)) for _ in range(5)])
    scoring = op.Scoring(40, sum(len(d.split()) for d in docs), rng.integers(1, 5000, len(items.vocabulary)))
    words = op.words_of(op.pa.array(docs), op.LETTERS_AND_DIGITS)
    text, hashed, times = op.counted(words.text_of, words.hashes)
    rows = [(k, int(np.diff(words.first)[k]), hashed[text == k], times[text == k]) for k in range(40)]
    block = op._block(rows, 512)
    upper = op.Bounds(items, scoring).of(np.array(block["lengths"]), block["slices"])
    for k, (_, n, t, tf) in enumerate(rows):
        share = dict(zip(t.tolist(), op.Scoring.share(tf, scoring.penalty(np.array([n]))).tolist()))
        for i in range(5):
            exact = sum(int(q) * int(scoring.weights[v]) * share.get(int(items.vocabulary[v]), 0) for v, q in zip(items.terms[i], items.times[i]))
            assert exact <= upper[i, k]

import random
import re
import string
from collections import Counter, defaultdict

import numpy as np

from platewise.llm import linking
from platewise.llm import op6_near_duplicates as op
from platewise.llm.queries import queries
from tests.llm.conftest import FOLDER

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(texts, size=4, percent=80):
    sets = {}
    for i, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    inverted = defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            inverted[s].append(i)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        shared = Counter(j for s in sets[i] for j in inverted[s] if j < i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (i, len(sets[i]), find(i), find(i) == i) for i in sets}


def test_query_equals_brute_force(spark, texts):
    found = {r["doc_id"]: tuple(r) for r in queries()["op6_near_duplicates"](spark, FOLDER).collect()}
    assert found == brute(texts) and any(not r[3] for r in found.values())


def edits(n):
    rng = random.Random(1)
    base = [f"w{rng.randint(0, 3000)}" for _ in range(150)]
    out = {}
    for k in range(n):
        w = base[:]
        for _ in range(rng.choice([0, 1, 2, 4, 6, 8, 10])):
            w[rng.randrange(150)] = f"x{rng.randint(0, 40)}"
        out[k] = " ".join(w)
    return out


def test_a_large_group_of_edited_copies_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(linking, "SMALL", 3)
    monkeypatch.setattr(linking, "HELD", 8)
    monkeypatch.setattr(linking, "STREAMED", 16)
    texts = edits(150)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: tuple(r) for r in op.near_duplicates(docs, 4).collect()} == brute(texts)


def test_sketches_are_full_and_estimate_similarity():
    rng = np.random.default_rng(0)
    a, b = rng.integers(1, 1 << 62, (2, 300)).astype(np.uint64)
    sets = [a, np.r_[a[:240], b[:60]], a[:1], a[:3]]
    values = op.sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    assert (values != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    agree = np.mean([(op.sketches(mixed, np.array([0, 300, 600]))[0] == op.sketches(mixed, np.array([0, 300, 600]))[1]).mean()
                     for mixed in (np.concatenate([s ^ np.uint64(k) for s in sets[:2]]) for k in range(20))])
    assert abs(agree - 240 / 360) < 0.05


def test_components_of_chains_and_stars(spark):
    chain = [(k + 1, k) for k in range(40)] + [(100, 50), (100, 60), (70, 60), (5, 5)]
    out = dict(map(tuple, linking.connected(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert out == {k: 0 for k in range(1, 41)} | {60: 50, 70: 50, 100: 50}
    assert linking.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(odd_docs, no_docs):
    out = sorted(map(tuple, op.near_duplicates(odd_docs).collect()), key=str)
    assert sorted(r for r in out if r[0] in (1, 2, 3, 4)) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), *[(4, 6, 4, True)] * 2]
    assert [r[2:] for r in out if r[0] in (5, 6)] == [(5, True), (5, False)]
    assert [r[2:] for r in out if r[0] is None] == [(None, True)]
    kept = op.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == 7
    assert op.near_duplicates(no_docs).count() == 0 and op.keep_one(no_docs).count() == 0


def test_rows_of_one_doc_id_and_different_texts_are_judged_apart(spark):
    a, b = "the first text says this and that today", "another one is unlike all of the others here"
    docs = spark.createDataFrame([(0, a, 1), (1, b, 2), (1, a, 3)], "doc_id long, text string, class int")
    assert sorted(map(tuple, op.keep_one(docs).collect())) == [(0, a, 1), (1, b, 2)]
    both = spark.createDataFrame([(1, a), (1, b), (2, b), (3, a), (3, None)], "doc_id long, text string")
    assert sorted(map(str, op.keep_one(both).collect())) == sorted(map(str, spark.createDataFrame([(1, a), (1, b), (3, None)], "doc_id long, text string").collect()))

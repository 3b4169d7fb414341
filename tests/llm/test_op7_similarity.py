"""Links of op7: those of the rule, and how many of those that edit similarity alone would make."""

import random

import numpy as np
import pyarrow as pa

from platewise.llm import op7_line_dedup as op
from tests.llm.test_op7 import candidates, distance, normal


def groups(texts, alone=False):
    """The smallest place of every line's group; ``alone``: from edit similarity, whatever the SimHashes."""
    places = {(i, n): normal(line) for i, t in texts.items() for n, line in enumerate(t.split("\n"))}
    names = sorted({w for w in places.values() if len(w) >= op.WORDS})
    split, _ = op.split_lines(pa.array([b" ".join(n).decode() for n in names], pa.string()))
    hashes = dict(zip(names, op.simhash(split).view(np.uint64).tolist()))
    parent = {w: w for w in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(names):
        for b in names[k + 1 :]:
            longer = max(len(a), len(b))
            if (alone or candidates(hashes[a], hashes[b])) and len(set(a) & set(b)) and abs(len(a) - len(b)) * 5 <= longer and distance(a, b) * 5 <= longer:
                parent[find(a)] = find(b)
    stands = {}
    for place, w in sorted(places.items()):
        if len(w) >= op.WORDS:
            stands.setdefault(find(w), place)
    return {p: stands[find(w)] if len(w) >= op.WORDS else p for p, w in places.items()}


def edited(rng, line, edits):
    """The line with words at different places replaced, left out or put in."""
    out = list(line)
    for at in sorted(rng.sample(range(len(line)), edits), reverse=True):
        kind = rng.randrange(3)
        out[at : at + (kind != 2)] = [] if kind == 1 else [f"new{rng.randrange(10**6)}"]
    return out


def decided(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {(r["doc_id"], r["line"]): (r["group_doc_id"], r["group_line"]) for r in op.decide(docs).collect()}


def test_links_are_those_of_the_rule(spark):
    rng = random.Random(7)
    common = [f"of{k}" for k in range(30)]
    texts = {}
    for k in range(150):
        n = rng.choice([5, 6, 9, 10, 11, 14, 15, 20, 25, 50, 100])
        line = [rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(10**6)}" for _ in range(n)]
        texts[2 * k] = " ".join(line)
        texts[2 * k + 1] = "short\n" + " ".join(edited(rng, line, rng.choice([1, 1, n // 10, n // 5, n // 5 + 1])))
    want = groups(texts)
    assert sum(p != w for p, w in want.items()) > 60
    assert decided(spark, texts) == want


def test_share_of_changed_lines_that_meet():
    """One changed word in twenty is nearly always found, one in ten in more than half of the cases."""
    rng = random.Random(1)
    for every, least in ((20, 0.85), (10, 0.5)):
        lines = [[f"w{rng.randrange(10**6)}" for _ in range(n)] for n in (20, 40, 80) for _ in range(200)]
        others = [edited(rng, line, len(line) // every) for line in lines]
        words, _ = op.split_lines(pa.array([" ".join(x) for x in lines + others], pa.string()))
        hashes = op.simhash(words).view(np.uint64).tolist()
        found = sum(candidates(hashes[k], hashes[len(lines) + k]) for k in range(len(lines)))
        print(every, found / len(lines))
        assert found >= least * len(lines)


def test_chains():
    close = np.eye(6, dtype=bool)
    for a, b in ((4, 1), (1, 5), (2, 3)):
        close[a, b] = close[b, a] = True
    assert op._chains(close).tolist() == [0, 1, 2, 2, 1, 1]


def test_all_pairs_of_six_different_bits_meet():
    rng = random.Random(2)
    a = np.array([rng.getrandbits(63) for _ in range(500)], np.int64)
    b = np.array([int(x) ^ sum(1 << k for k in rng.sample(range(63), 6)) for x in a], np.int64)
    x, y = op.block_keys(a), op.block_keys(b)
    assert x.shape == (500, 28) and (x == y).any(axis=1).all()


def test_bounded_distance():
    rng = random.Random(3)
    for _ in range(3000):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(1, 14))) for _ in range(2))
        most = rng.randint(0, 8)
        assert op.within(a, b, most) == (distance(a, b) <= most), (a, b, most)


def test_large_buckets_list_no_pairs(spark, monkeypatch):
    """Lines of one template that are not alike: checked in blocks, with the links of brute force."""
    rng = random.Random(5)
    template = [f"same{k}" for k in range(14)]
    texts = {}
    for k in range(140):
        line = template + [f"own{rng.randrange(10**6)}" for _ in range(6)]
        texts[2 * k] = " ".join(line)
        if k % 4 == 0:
            texts[2 * k + 1] = " ".join(edited(rng, line, 3))
    listed, pairs = [], op.link_groups.__globals__["_pairs"]
    monkeypatch.setitem(op.link_groups.__globals__, "_pairs", lambda rows, test: listed.append(rows) or pairs(rows, test))
    assert decided(spark, texts) == groups(texts)
    largest = listed[0].groupBy("key").count().agg({"count": "max"}).first()[0]
    assert largest is None or largest <= 48

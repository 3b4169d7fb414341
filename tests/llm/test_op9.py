import zlib

import numpy as np
import pyarrow as pa

from platewise.llm import op9_toxicity as op
from platewise.llm.queries import queries
from tests.llm.conftest import FOLDER


def test_query_shape_and_held_out_rows(spark, texts):
    rows = queries()["op9_toxicity"](spark, FOLDER).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    found = {r["doc_id"]: r for r in queries()["op9_toxicity"](spark, folder).collect()}
    labels = [(r["doc_id"], r["toxic"]) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    held = [(y, found[i]["predicted"]) for i, y in labels if found[i]["held_out"]]
    hit = sum(y == p == 1 for y, p in held)
    assert hit >= 0.85 * sum(y for y, _ in held) and hit >= 0.9 * sum(p for _, p in held)


def corpus(spark):
    rng = np.random.default_rng(1)
    common = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    docs, labels = [], []
    for i in range(400):
        words = rng.choice(common, 40).tolist()
        toxic = i % 4 == 0
        if toxic:
            words[int(rng.integers(40))] = "Vileness" if i % 8 else "grimly"
        docs.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_spans_point_at_the_offending_words(spark):
    docs, labels = corpus(spark)
    model = op.fit(docs, labels)
    new = spark.createDataFrame([(1, "naïve worda: VILENESS here", 9), (2, "wordaa wordba here", 9), (3, None, 9), (4, "", 9)], "doc_id long, text string, score int")
    rows = {r["row"]["doc_id"]: r for r in op.tag(new, model).collect()}
    assert rows[1]["score"] >= 0.5 and [("naïve worda: VILENESS here"[s["start"] : s["end"]]) for s in rows[1]["spans"]] == ["VILENESS"]
    assert all(rows[k]["score"] < 0.5 and not rows[k]["spans"] for k in (2, 3, 4)) and rows[3]["score"] == rows[4]["score"]
    kept = op.remove_toxic(new, labels.where("doc_id < 0"))
    assert kept.columns == new.columns and kept.count() == 4  # nothing learnt, nothing removed


def ambiguous(seed, n):
    """In toxic documents "utter" stands before "waste"; clean ones use either word in other company."""
    rng = np.random.default_rng(seed)
    common = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}word" for i in range(400)]
    docs = []
    for i in range(n):
        words = rng.choice(common, 40).tolist()
        if i % 4 == 0:
            at = int(rng.integers(38))
            words[at : at + 2] = ["utter", "waste"]
        else:
            for word, place in (("utter", int(rng.integers(19))), ("waste", int(rng.integers(21, 40)))):
                if rng.random() < 0.25:
                    words[place] = word
        docs.append((i, " ".join(words) + "."))
    return docs


def test_the_chain_beats_the_evidence_that_labelled_its_words(spark):
    train, new = ambiguous(3, 1600), ambiguous(4, 400)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in train], "doc_id long, toxic int")
    model = op.fit(spark.createDataFrame(train, "doc_id long, text string"), labels)
    toxic = np.array([i % 4 == 0 for i, _ in new])
    rows = {r["row"]["doc_id"]: r["score"] for r in op.tag(spark.createDataFrame(new, "doc_id long, text string"), model).collect()}
    chain = (np.array([rows[i] >= 0.5 for i, _ in new]) == toxic).mean()
    words = op.read_words(pa.array([t for _, t in new]))
    strongest = np.maximum.reduceat(model.evidence[op.buckets(words)].max(axis=1), words.first[:-1])
    threshold = max(((strongest >= t) == toxic).mean() for t in np.unique(strongest))
    assert chain >= 0.97 and chain >= threshold + 0.05


def test_weights_of_identities_tell_words_with_the_same_features_apart():
    x, ids = np.ones((40, 1)), np.tile(np.array([[7], [9]], np.uint16), (20, 1))
    first, length = np.arange(0, 40, 2), np.full(20, 2)
    weights, transition, context = op.train_crf(x, np.tile([0, 1], 20), first, length, ids)
    assert context[9] > 0 > context[7] and not context[8]
    p = op.Chain(first, length).marginals(x @ weights + context[ids].sum(axis=1), transition)
    assert (p.round().astype(int) == np.tile([0, 1], 20)).all()


def test_neighbours_end_with_the_sentence():
    words = op.read_words(pa.array(["One two. Three", None, "four 5"]))
    before, after = op._neighbours(words)
    assert before.tolist() == [-1, 0, -1, -1, 3] and after.tolist() == [1, -1, -1, 4, -1]
    x = op.features(words, op.buckets(words), np.zeros(op.BUCKETS, np.float32))
    assert x.shape == (5, op._FEATURES) and x[:, -3].tolist() == [0, 0, 0, 0, 1]
    assert op.features(op.read_words(pa.array([""])), np.zeros((0, 5), np.int64), np.zeros(op.BUCKETS, np.float32)).shape == (0, op._FEATURES)


def test_gradient_steps_reach_the_labels():
    x = np.array([[1.0, v] for v in [0, 5, 0, 0, 0, 5, 0, 0]])
    y = np.array([0, 1, 0, 0, 0, 1, 0, 0])
    weights, transition, _ = op.train_crf(x, y, np.array([0, 4]), np.array([4, 4]))
    p = op.Chain(np.array([0, 4]), np.array([4, 4])).marginals(x @ weights, transition)
    assert (p.round() == y).all()


def test_marginals_equal_enumeration():
    import itertools

    rng = np.random.default_rng(2)
    unary, transition = rng.normal(size=7), rng.normal(size=(2, 2))
    first, length = np.array([0, 4]), np.array([4, 3])
    got = op.Chain(first, length).marginals(unary, transition)
    for a, n in zip(first, length):
        total, one = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=int(n)):
            weight = np.exp(sum(unary[a + k] * s for k, s in enumerate(path)) + sum(transition[p, s] for p, s in zip((0, *path), path)))
            total += weight
            one += weight * np.array(path)
        assert np.allclose(got[a : a + n], one / total)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (6, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    assert op.score(odd_docs, labels).count() == 8
    assert op.score(no_docs, labels).count() == 0
    assert {r["score"] for r in op.score(odd_docs, labels.where("doc_id < 0")).collect()} == {0.0}
    assert op.remove_toxic(odd_docs, labels.where("toxic = 0")).count() == 8

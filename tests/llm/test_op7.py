import re

import numpy as np
import pyarrow as pa

from platewise.llm import op7_line_dedup as op
from platewise.llm.queries import queries
from tests.llm.conftest import FOLDER


def normal(line):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in line.encode())
    return tuple(re.findall(rb"[0-9a-z\x80-\xff]+", data))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def candidates(a, b):
    """Two of eight blocks agree, and no more than ten bits differ."""
    return sum(x == y for x, y in zip(a.to_bytes(8), b.to_bytes(8))) >= 2 and (a ^ b).bit_count() <= 10


def brute(texts):
    words = {(i, n): normal(line) for i, t in texts.items() if t is not None for n, line in enumerate(t.split("\n"))}
    first = {}
    for place in sorted(words):
        if len(words[place]) >= op.WORDS:
            first.setdefault(words[place], place)
    names = list(first)
    split, _ = op.split_lines(pa.array([b" ".join(n).decode() for n in names], pa.string()))
    hashes = op.simhash(split).view(np.uint64)
    parent = list(range(len(names)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(names)):
        for b in np.flatnonzero(np.bitwise_count(hashes[a + 1 :] ^ hashes[a]) <= 10) + a + 1:
            if candidates(int(hashes[a]), int(hashes[b])) and distance(names[a], names[b]) * 100 <= 20 * max(len(names[a]), len(names[b])):
                parent[find(b)] = find(a)
    stands = {}
    for k, name in enumerate(names):
        stands[find(k)] = min(stands.get(find(k), (1 << 60, 0)), first[name])
    at = {name: k for k, name in enumerate(names)}
    return {p: (stands[find(at[w])] if len(w) >= op.WORDS else p) for p, w in words.items()}


def test_query_equals_brute_force(spark, texts):
    rows = queries()["op7_line_dedup"](spark, FOLDER).collect()
    want = brute(texts)
    assert len(rows) == len(want)
    for r in rows:
        place = (r["doc_id"], r["line"])
        assert (r["kept"], (r["group_doc_id"], r["group_line"])) == (want[place] == place, want[place])


LINE = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))


def test_fuzzy_lines_are_linked_and_rewritten(spark):
    near = LINE.replace("wordaa", "other", 1).upper()
    rows = [(1, f"top line one two three\n{LINE}\nshort"), (2, f"{near}!\nsomething of its own here now"), (3, LINE), (4, "short\nshort"),
            (5, "call 12 34 56 now or later"), (6, "Call 12 34 56 now, or later"), (7, "call 12 34 56 never and nowhere")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r["doc_id"], r["line"]) for r in op.decide(docs).where("NOT kept").collect()} == {(2, 0), (3, 0), (6, 0)}
    out = dict(map(tuple, op.deduplicate(docs).collect()))
    assert out == {1: rows[0][1], 2: "something of its own here now", 4: "short\nshort", 5: rows[4][1], 7: rows[6][1]}


def test_rows_of_one_doc_id_and_different_texts_are_different_documents(spark):
    a, b = "the first text says this and that today", "another one is unlike all of the others here"
    docs = spark.createDataFrame([(0, a), (1, b), (1, a), (1, f"{b}\n{a}"), (1, b)], "doc_id long, text string")
    assert sorted(map(tuple, op.deduplicate(docs).collect())) == [(0, a), (1, b), (1, b)]


def test_simhash_is_the_majority_of_word_hashes():
    words, _ = op.split_lines(pa.array(["a b c b", "x"], pa.string()))
    hashes = [int(h) >> 24 << 24 for h in words.hashes]
    bits = lambda values: sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in values) > len(values))
    mixed = [[int(op.mix(np.array([i << 40 | h >> 24], np.uint64) << np.uint64(24))[0]) for h in set(own)] for i, own in enumerate((hashes[:4], hashes[4:]))]
    got = op.simhash(words).view(np.uint64)
    assert [int(g).bit_count() for g in got] == [bits(m).bit_count() for m in mixed]


def test_simhash_does_not_depend_on_the_batch():
    texts = [LINE, "a b c d e f g", LINE + " end", ""]
    together = op.simhash(op.split_lines(pa.array(texts))[0])
    alone = [op.simhash(op.split_lines(pa.array([t]))[0])[0] for t in texts]
    assert together.tolist() == alone


def test_odd_rows(odd_docs, no_docs):
    out = op.decide(odd_docs).collect()
    assert sum(r["doc_id"] == 2 for r in out) == 1 and not any(r["doc_id"] in (None, 1) for r in out)
    kept = op.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "4", "5", "None"]  # 6 is 5 but for a word
    assert op.decide(no_docs).count() == 0 and op.deduplicate(no_docs).count() == 0

import random
import re

import pytest

from platewise.workspace import materialise
from tests.llm.conftest import FOLDER

pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_keep_the_columns(spark, texts):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns, name
        docs = materialise(docs, name)
        assert docs.count() <= left
        left = docs.count()
    out = pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert out.count() == left and out.where("NOT round_trip").count() == 0


def test_run_and_entry(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is pipeline.run and "pipeline" not in entry.oracle_sql()
    assert sorted(n for n in entry.queries() if re.match(r"op\d+_", n)) == sorted(
        ["op1_fingerprint", "op2_secrets", "op3_token_files", "op4_licenses", "op5_decontaminate", "op6_near_duplicates", "op7_line_dedup",
         "op8_byte_bpe", "op9_toxicity", "op10_pii", "op11_search", "op12_whitening", "op13_suffix_dedup"])


def test_exact_copies_and_toxic_documents_go(spark, tmp_path):
    folder = str(tmp_path)
    passage = " ".join(f"term{k}" for k in range(60))
    docs = [(k, f"document {k} speaks about topic{k} and subject{k}\nwith reasons{k} of its own kind{k}", "en", "s", 0) for k in range(40)]
    docs += [(100, passage, "en", "s", 0), (101, passage, "en", "s", 0), (102, "exam " + " ".join(f"q{k}" for k in range(20)), "en", "s", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, " ".join(f"q{k}" for k in range(20)))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert sorted(r["doc_id"] for r in pipeline.run(spark, folder).collect()) == [*range(40), 100]


def test_no_text_is_lost_where_a_doc_id_repeats(spark, tmp_path):
    a, b = "the first text says this and that today", "another one is unlike all of the others here"
    spark.createDataFrame([(0, a), (1, b), (1, a)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "nothing of it")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert sorted(r["doc_id"] for r in pipeline.run(spark, str(tmp_path)).collect()) == [0, 1]


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _root(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def _groups(items, like):
    """The first of each connected group, by all pairs."""
    parent = {x: x for x in items}
    for x in items:
        for y in items:
            if x < y and like(x, y):
                a, b = _root(parent, x), _root(parent, y)
                parent[max(a, b)] = min(a, b)
    return {x: _root(parent, x) for x in items}


def brute(docs, offending, items):
    """Ids and texts that stay: offending words, like lines, like documents, benchmark windows, each over what the former left."""
    docs = {i: t for i, t in docs.items() if not any(w in offending for w in _words(t))}
    lines = {(i, k): _words(x) for i, t in docs.items() for k, x in enumerate(t.split("\n"))}

    def like_lines(x, y):
        a, b = lines[x], lines[y]
        return min(len(a), len(b)) >= 5 and _distance(a, b) * 5 <= max(len(a), len(b))

    first = _groups(sorted(lines), like_lines)
    left = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if first[i, k] == (i, k)) for i, t in docs.items()}
    docs = {i: t for i, t in left.items() if t == docs[i] or _words(t)}

    def shingles(i):
        words = re.findall(r"[^\x20\x09-\x0D]+", docs[i].lower())
        return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    sets = {i: shingles(i) for i in docs}
    first = _groups(sorted(docs), lambda x, y: bool(sets[x] and sets[y]) and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]))
    docs = {i: t for i, t in docs.items() if first[i] == i}

    def contaminated(text):
        words, hit = _words(text), set()
        for item in map(_words, items):
            size = min(13, len(item))
            windows = {tuple(item[k : k + size]) for k in range(len(item) - size + 1)} if item else set()
            hit |= {k + j for k in range(len(words) - size + 1) for j in range(size) if item and tuple(words[k : k + size]) in windows}
        return bool(hit) and 20 * len(hit) >= len(words)

    return {i: t for i, t in docs.items() if not contaminated(t)}


def test_run_equals_brute_force(spark, tmp_path):
    """Planted toxic documents, repeated and like lines, near copies and benchmark passages among clean documents."""
    folder, rng = str(tmp_path), random.Random(8)
    common = [a + b for a in ("sto", "mer", "lan", "quo", "vib", "tes", "ard", "pol") for b in ("na", "ril", "dem", "ost", "ux", "ith", "eg", "ap", "ol", "em")]

    def line(n):
        return " ".join(rng.choice(common) + str(rng.randrange(10**6)) for _ in range(n))

    docs = {k: "\n".join(line(rng.randint(6, 14)) for _ in range(rng.randint(2, 4))) for k in range(120)}
    docs |= {200 + k: f"{line(12)}\n{line(5)} {('vileness', 'grimly')[k % 2]} {line(6)}" for k in range(60)}
    shared, passage, item = line(20), line(40), line(30)
    docs |= {300 + k: f"{line(9)}\n{shared if k else shared + ' more'}\n{line(7)}" for k in range(6)}  # one line in six documents, once with a further word
    words = [line(1) for _ in range(200)]
    near = [[*words[:k], f"changed{k}", *words[k + 1 :]] for k in (30, 90, 150)]
    # Near copies whose lines are cut at different places, so that no two lines are alike.
    docs |= {400 + k: "\n".join(" ".join(w[a : a + cut]) for a in range(0, 200, cut)) for k, (w, cut) in enumerate(zip([words, *near], (200, 67, 29, 13)))}
    docs |= {500: passage, 501: passage, 502: f"{line(8)}\n{passage}", 503: "", 504: "short"}
    docs |= {600: f"{line(10)}\n{item}", 601: f"{line(6)} {' '.join(item.split()[5:22])} {line(6)}", 602: f"{line(6)} {' '.join(item.split()[5:15])} {line(6)}"}
    labels = [(i, 1, int(200 <= i < 260)) for i in docs if i < 260]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet"
    )
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    wanted = brute(docs, {"vileness", "grimly"}, [item])
    gone = set(docs) - set(wanted)
    assert {*range(200, 260), 401, 402, 403, 501, 600, 601} <= gone and {300, 305, 400, 500, 502, 503, 504, 602} <= set(wanted)
    kept = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        kept = materialise(stage(spark, kept, folder), name)
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == wanted
    rows = pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == set(wanted) and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)

import duckdb

from platewise.llm import op5_decontaminate as op
from platewise.llm.queries import oracle_sql, queries
from tests.llm.conftest import FOLDER


def test_query_equals_reference(spark):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = con.execute(oracle_sql()["op5_decontaminate"])
    names = [d[0] for d in cursor.description]
    df = queries()["op5_decontaminate"](spark, FOLDER)
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(cursor.fetchall())


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


LONG = " ".join(f"b{i}" for i in range(20))


def test_windows_short_items_and_ties(spark):
    bench = items(spark, [(1, LONG), (1, LONG), (2, "Only Three words"), (3, None), (4, " . "), (None, "red green blue"), (5, LONG)])
    docs = spark.createDataFrame(
        [(1, "x " + LONG.upper() + " y"), (2, "here ONLY three, Words."), (3, " ".join(LONG.split()[:12])), (4, None), (5, "red green blue")],
        "doc_id long, text string")
    out = {r["doc_id"]: r for r in op.report(docs, bench).collect()}
    assert [(out[k]["n_words"], out[k]["n_hit"], out[k]["n_items"], out[k]["contaminated"]) for k in range(1, 6)] == [
        (22, 20, 2, True), (4, 3, 1, True), (12, 0, 0, False), (0, 0, 0, False), (3, 0, 0, False)]


def test_blocks_give_the_same(spark, odd_docs):
    bench = items(spark, [(k, " ".join(f"w{(7 * k + j) % 977}" for j in range(15))) for k in range(30)] + [(99, "and there")])
    whole = op.scan(odd_docs, bench).select("row.doc_id", "n_words", op.hit_words().alias("n"), "items")
    parts = op.scan(odd_docs, bench, block_bytes=300).select("row.doc_id", "n_words", op.hit_words().alias("n"), "items")
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    assert whole.where("n > 0").count() >= 2


def test_removal(spark, odd_docs, no_docs):
    bench = items(spark, [(1, "and there, 12 times over")])
    kept = op.remove_documents(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == 6
    cut = {r["doc_id"]: r["text"] for r in op.remove_spans(odd_docs, bench).collect()}
    assert cut[4] == "naïve 漢字 😀 it's here\n " and cut[1] is None and cut[2] == ""
    two = spark.createDataFrame([(1, "x a b c d, c d e", 3)], "doc_id long, text string, hits int")
    assert [r["text"].split() for r in op.remove_spans(two, items(spark, [(1, "a b"), (2, "c d")])).collect()] == [["x", ",", "e"]]
    assert op.remove_documents(no_docs, bench).count() == 0
    assert op.remove_documents(odd_docs, items(spark, [])).count() == 8

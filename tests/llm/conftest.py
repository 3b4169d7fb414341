import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark):
    """(doc_id, text) of the smallest documents table."""
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names operators use themselves."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (1, None, "a", 1.0, True),
        (2, "", "b", None, None),
        (3, " \t\n ", None, 2.0, False),
        (4, "naïve 漢字 😀 it's here\nand there, 12 times over", "c", 3.0, True),
        (4, "naïve 漢字 😀 it's here\nand there, 12 times over", "c", 3.0, True),
        (5, long, "d", 4.0, None),
        (6, long + " end", "d", 5.0, None),
        (None, "a row without an id has five words", "e", 6.0, None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, score double, kept boolean").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, spans string, score double, kept boolean")

import hashlib
import os
import random

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F

from platewise.llm import op8_byte_bpe as op
from platewise.llm import pieces
from platewise.llm.queries import queries
from tests.llm.conftest import FOLDER

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=pieces.read_ranks(PATH), special_tokens={})


def test_query_equals_the_other_library(spark, texts):
    own = reference()
    for row in queries()["op8_byte_bpe"](spark, FOLDER).collect():
        ids = own.encode_ordinary(texts[row["doc_id"]])
        digests = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), texts[row["doc_id"]].encode())]
        assert list(row)[1:] == [len(ids), *digests]


def test_random_and_periodic_texts():
    own, encoder = reference(), pieces.Encoder(pieces.definition(PATH, PATTERN), known=500, recent=100)
    table = pieces.ByteTable(pieces.definition(PATH, PATTERN))
    rng = random.Random(1)
    signs = ["'", "s", "t", "r", "e", "v", "l", "d", "m", " ", "  ", "\n", "\t", "a", "Z", "é", "ß", "1", "²", "Ⅷ", "!", "?", ".", "　", "\x85",
             "\x1c", "\xa0", "漢", "😀", "́", "ſ", "​", "\U0001fae9", "͸", "\0", "<|endoftext|>"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(4000)] + [None, ""]
    texts += [s * n for s in ("a", "ab", "aaab", " ", "=", "é") for n in (1, 2, 3, 7, 50, 120)]
    texts += ["".join(rng.choice("-=*a") for _ in range(60)) for _ in range(300)]
    got = encoder.encode(pa.array(texts, pa.string()))
    data, begins = table.decode(got.ids, got.first)
    for k, text in enumerate(texts):
        assert got.ids[got.first[k] : got.first[k + 1]].tolist() == own.encode_ordinary(text or "")
        assert data[begins[k] : begins[k + 1]].tobytes() == (text or "").encode()


def test_offsets_and_split_characters(spark):
    docs = spark.createDataFrame([(1, "naïve 漢字 😀 it's", 5), (2, None, 6), (3, "", 7)], "doc_id long, text string, ids int")
    rows = {r["doc_id"]: r for r in op.encode(docs, PATH, PATTERN, offsets=True).collect()}
    text = rows[1]["text"]
    assert rows[1]["starts"][0] == 0 and rows[1]["ends"][-1] == len(text)
    covered = [text[a:b] for a, b in zip(rows[1]["starts"], rows[1]["ends"])]
    assert "😀" in "".join(covered) and rows[2]["ids"] == [] and rows[3]["ids"] == []
    back = op.decode_text(op.encode(docs, PATH, PATTERN).drop("text"), PATH, PATTERN)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {1: text, 2: "", 3: ""}
    face = spark.createDataFrame([(1, "😀")], "doc_id long, text string")
    whole = op.encode(face, PATH, PATTERN).drop("text")
    if len(whole.first()["ids"]) > 1:
        cut = whole.withColumn("ids", F.slice("ids", 1, 1))
        assert op.decode_text(cut, PATH, PATTERN).first()["text"] == "�"
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert op.decode_text(nothing, PATH, PATTERN).first()["text"] == ""


def test_odd_rows(odd_docs, no_docs):
    assert op.round_trip(odd_docs, PATH, PATTERN).count() == 8
    checked = op.encode_checked(odd_docs, PATH, PATTERN)
    assert checked.where("round_trip").count() == 8 and "score" in checked.columns
    assert op.round_trip(no_docs, PATH, PATTERN).count() == 0

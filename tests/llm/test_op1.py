import hashlib

import numpy as np
import pytest

from platewise.llm import op1_fingerprint as op
from platewise.llm.queries import queries
from tests.llm.conftest import FOLDER

_GEAR = [int(x) >> 32 for x in op.byte_values()]


def chunks(text):
    """Byte by byte: what the array code does at once."""
    data, out, at, h, hashes = text.encode(), set(), 0, 0, []
    for c in data:
        h = ((h << 1) + _GEAR[c]) & 0xFFFFFFFF
        hashes.append(h)
    while at < len(data):
        cut = len(data)
        if len(data) - at > op.SMALLEST:
            cut = min(at + op.LARGEST, len(data))
            for end in range(at + op.SMALLEST, cut + 1):
                if hashes[end - 1] >> (32 - (op.STRICT_BITS if end < at + op.NORMAL else op.LOOSE_BITS)) == 0:
                    cut = end
                    break
        out.add(data[at:cut])
        at = cut
    return out


def likeness(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    return sum(map(len, a & b)) / min(sum(map(len, a)), sum(map(len, b)))


def test_query_equals_brute_force(spark, texts):
    found = {r["doc_id"]: r for r in queries()["op1_fingerprint"](spark, FOLDER).collect()}
    ids = sorted(texts, reverse=True)
    assert set(found) == set(ids)
    for k, i in enumerate(ids):
        text, following = texts[i], texts[ids[(k + 1) % len(ids)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        row = found[i]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        own = chunks(text)
        assert len(row["fingerprint"]) == 10 * len(own)
        assert row["near_edited"] == pytest.approx(likeness(own, chunks(edited)))
        assert row["near_next"] == pytest.approx(likeness(own, chunks(following)))
    prints = {}
    for i, text in texts.items():
        assert prints.setdefault(text, found[i]["fingerprint"]) == found[i]["fingerprint"]


def test_odd_rows(odd_docs, no_docs):
    rows = op.with_neighbours(odd_docs).collect()
    assert len(rows) == 8
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["fingerprint"] == b"" and by_id[1]["n_chars"] == 0 and by_id[2]["near_next"] == 1.0
    assert by_id[6]["near_next"] > 0.95  # the long text but for its end
    assert op.with_neighbours(no_docs).count() == 0 and op.fingerprints(no_docs).count() == 0
    assert {r["doc_id"]: r["fingerprint"] for r in op.fingerprints(odd_docs).collect()}[5] == by_id[5]["fingerprint"]


def test_a_single_document_is_its_own_neighbour(spark):
    row = op.with_neighbours(spark.createDataFrame([(7, "some text of a few words")], "doc_id long, text string")).first()
    assert row["near_next"] == 1.0


def test_fingerprints_survive_a_shift():
    import pyarrow as pa

    text = "".join(np.random.default_rng(1).choice(list("abcdefgh ijk"), 4000))
    prints = op.Prints(pa.array([text, "x" * 100 + text]))
    assert op.containment(prints.one(0), prints.one(1)) > 0.9
    assert (op.unpacked(op.packed(prints.one(0))) == prints.one(0)).all()

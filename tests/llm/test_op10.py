import hashlib
import random
import re

from platewise.llm import op10_pii as op
from platewise.llm.queries import queries
from tests.llm.conftest import FOLDER

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    digits = [c for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])]


def test_query_equals_brute_force(spark, texts):
    rows = queries()["op10_pii"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in op.KINDS] == [sum(s[0] == k for s in spans) for k in op.KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(r["spans"].split(",")) | {""}


def test_base_patterns_on_random_texts():
    rng = random.Random(2)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.@ +-()0259%_é٣4111") for _ in range(rng.randint(0, 40)))
        assert op.base_spans(text) == base(text), text
    for text in ("4111 1111 1111 1111", "a@b.c@d.e", "x@y", "1.2.3.4.5.6.7.8", "999.1.1.1", "00000255.1.1.1", "1" * 50_000, "a" * 50_000 + "@"):
        assert op.base_spans(text) == (base(text) if len(text) < 100 else [])


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(k, f"Please call Member Phone: +1 (555) 201-{1000 + k} today") for k in range(30)]
    rows += [(100, "new Member Phone: 0555-998877 is known"), (101, "order number 0555-998877 was shipped"), (102, None), (103, "")]
    rows += [(200 + k, f"order number 77{k}88{k} was shipped") for k in range(20)]
    out = {r["doc_id"]: r for r in op.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    start, end = map(int, out[100]["spans"].split(":")[1:])
    assert out[100]["spans"].startswith("phone:") and rows[30][1][start:end] == "0555-998877"
    assert out[101]["spans"] == "" and all(out[200 + k]["n_discovered"] == 0 for k in range(20)) and out[102]["n_phone"] == 0


def test_odd_rows(odd_docs, no_docs):
    assert op.report(odd_docs).count() == 8 and op.report(no_docs).count() == 0

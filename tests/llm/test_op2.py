import collections
import hashlib
import math
import random
import re
import string

from platewise.llm import op2_secrets as op
from platewise.llm.queries import queries
from tests.llm.conftest import FOLDER

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans).encode()).hexdigest()


def check(rows, texts):
    for row in rows:
        spans = base(texts[row["doc_id"]] or "")
        assert row["base_sha256"] == digest(spans)
        assert [row[f"n_{k}"] for k in op.KINDS[:3]] == [sum(s[2] == k for s in spans) for k in op.KINDS[:3]]
        listed = row["spans"].split(",") if row["spans"] else []
        assert [f"{k}:{a}:{b}" for a, _, k, b in spans] == [s for s in listed if not s.startswith("random")]


def test_query_equals_brute_force(spark, texts):
    rows = queries()["op2_secrets"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_base_patterns_on_random_pieces(spark):
    rng = random.Random(5)
    pieces = ["token", "=", ": ", "secret", '"', "'", " ", "api_key", "APIKEY", "Password", "AKIA", "ABCDEF123", "deadbeef" * 3, "0a9",
              "é", "😀", "xyz", "K", "ſecret", "-", "\n", "token=secret:abcdefgh1"]
    texts = {k: "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for k in range(2000)}
    texts |= {5000: None, 5001: "", 5002: "é token=abcdefgh1, " * 3000}
    check(op.report(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect(), texts)


def test_battery_tells_random_tokens_from_words(spark):
    rng = random.Random(7)
    signs = string.ascii_letters + string.digits
    texts = [(k, "see " + "".join(rng.choice(signs) for _ in range(rng.choice([24, 32, 40, 64]))) + " end") for k in range(200)]
    texts += [(1000 + k, "see " + "".join(rng.choice(["the", "ing", "12", "er", "2020", "on", "st"]) for _ in range(12))) for k in range(200)]
    rows = {r["doc_id"]: r["n_random"] for r in op.report(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert sum(rows[k] for k in range(200)) >= 190 and sum(rows[1000 + k] for k in range(200)) <= 10


def tail(z):
    return max(math.erfc(z / math.sqrt(2)) / 2, 1e-12)


def judged(token, rare, mean, deviation, hexadecimal):
    """Stratum, smallest of the four p-values times four, and the p-value as an identifier: the battery over again, one token at a time."""
    if re.match(op.GROUPS, token):
        token = token.replace("-", "")
    e = next((k for k, (_, pattern, _) in enumerate(op.ENCODINGS) if re.match(pattern, token)), len(op.ENCODINGS) - 1)
    classes = op.ENCODINGS[e][2]
    alphabet = "".join(classes)
    n, k = len(token), len(alphabet)
    chi = sum((token.count(c) - n / k) ** 2 / (n / k) for c in alphabet)
    if not set(token) <= set(alphabet):
        chi = sum(token.count(c) ** 2 for c in alphabet) * k / n - n
    by_class = 0
    for chars in classes:
        expected = n * len(chars) / k
        by_class += (sum(token.count(c) for c in chars) - expected) ** 2 / expected
    d = len(classes) - 1
    tests = [tail((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)), tail(((by_class / d) ** (1 / 3) - 1 + 2 / 9 / d) / math.sqrt(2 / 9 / d))]
    x = [alphabet.find(c) for c in token]
    high = [2 * v >= k for v in x]
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    if all(high) or not any(high):
        tests.append(max(2.0 ** (1 - n), 1e-12))
    else:
        expected = 2 * sum(high) * (n - sum(high)) / n + 1
        tests.append(2 * tail(abs(runs - expected) / math.sqrt(max((expected - 1) * (expected - 2) / (n - 1), 1e-9))))
    centre = sum(x) / n
    spread = sum((v - centre) ** 2 for v in x)
    joint = sum((v - centre) * (w - centre) for v, w in zip(x, x[1:]))
    tests.append(2 * tail(abs(joint / spread + 1 / n) * math.sqrt(n)) if spread > 0 else 1e-12)
    worth = [rare[ord(c) - 97] for c in token.lower() if "a" <= c <= "z"]
    rarity = tail((sum(worth) - len(worth) * mean) / deviation / math.sqrt(len(worth)) if worth else 0)
    if not set(token.lower()) - set("0123456789abcdef"):
        rarity = min(1, 2 * min(rarity, math.exp(len(worth) * hexadecimal)))
    kinds = ["0" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else "-" for c in token]
    rate = op.CHANGES["-" in kinds or {"A", "a"} <= set(kinds)]
    both = rarity * tail((sum(a != b for a, b in zip(kinds, kinds[1:])) - (n - 1) * rate) / math.sqrt((n - 1) * rate * (1 - rate)))
    return (e, sum(n >= limit for limit in op.LENGTHS)), min(1, 4 * min(tests)), max(both * (1 - math.log(both)), 1e-12)


def brute(texts):
    """``random`` spans of all texts: letters counted, tokens judged, the procedure by strata over steps of a tenth of a decade."""
    letters = [sum((t or "").lower().count(c) for t in texts.values()) for c in string.ascii_lowercase]
    total = [n + op.PRIOR * e / sum(op.ENGLISH) for n, e in zip(letters, op.ENGLISH)]
    shares = [n / sum(total) for n in total]
    rare = [-math.log(p) for p in shares]
    mean = sum(p * r for p, r in zip(shares, rare))
    deviation = math.sqrt(sum(p * r * r for p, r in zip(shares, rare)) - mean * mean)
    hexadecimal = math.log(sum(shares[:6]))
    tokens, strata = [], collections.defaultdict(list)
    for doc, text in texts.items():
        spans = base(text or "")
        for m in re.finditer(op.CANDIDATE, text or ""):
            if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and not any(a < m.end() and m.start() < b for a, _, _, b in spans):
                stratum, battery, p = judged(m[0], rare, mean, deviation, hexadecimal)
                tokens.append((doc, m.start(), m.end(), stratum, battery, min(120, int(-10 * math.log10(p)))))
                strata[stratum].append(tokens[-1][-1])
    out = collections.defaultdict(list)
    for doc, start, end, stratum, battery, step in tokens:
        steps = strata[stratum]
        found = [s for s in steps if 10 ** (-s / 10) <= op.LEVEL * sum(o >= s for o in steps) / len(steps)]
        if battery >= op.ALPHA and found and step >= min(found):
            out[doc].append((start, 3, "random", end))
    return out


ORDINARY = ("stream parser driver node value user account order price total count name index long very class number list table query build "
            "result cache local remote server client session handler request response buffer window column filter index2 batch42").split()


def identifier(rng, length):
    style, out = rng.randrange(3), ""
    while len(out) < length - 4:
        word = rng.choice(ORDINARY)
        out += word.capitalize() if style == 0 else ("_" + word if style == 1 and out else word)
    return out + str(rng.randrange(10, 9999))


def test_spans_equal_brute_force(spark, texts):
    rng = random.Random(11)
    signs = string.ascii_letters + string.digits
    some = dict(texts) | {10**9 + k: f"{identifier(rng, 24)} or {''.join(rng.choices(signs, k=rng.choice([20, 33, 70])))}, {identifier(rng, 60)}" for k in range(150)}
    some |= {2 * 10**9 + k: f"id {'-'.join(''.join(rng.choices('0123456789ABCDEF', k=g)) for g in (8, 4, 4, 4, 12))}." for k in range(50)}
    wanted = brute(some)
    assert sum(map(len, wanted.values())) > 150
    rows = op.report(spark.createDataFrame(list(some.items()), "doc_id long, text string")).collect()
    differ = [r["doc_id"] for r in rows if r["spans"] != ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(base(some[r["doc_id"]] or "") + wanted[r["doc_id"]]))]
    assert len(rows) == len(some) and not differ


def test_false_share_by_length(spark):
    """Of 3,000 identifiers and 600 random tokens of a length, most random tokens are reported and hardly an identifier."""
    rng = random.Random(3)
    signs = string.ascii_letters + string.digits
    for k, length in enumerate((20, 28, 40, 56)):
        rows = [(i, identifier(rng, length)) for i in range(3000)] + [(5000 + i, "".join(rng.choices(signs, k=length))) for i in range(600)]
        out = {r["doc_id"]: r["n_random"] for r in op.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        false, true = sum(n for d, n in out.items() if d < 5000), sum(n for d, n in out.items() if d >= 5000)
        assert false <= op.LEVEL * (false + true) and true >= (0.6, 0.85, 0.95, 0.95)[k] * 600


def test_single_identifiers_and_grouped_keys(spark):
    def reported(*rows):
        return [r["n_random"] for r in op.report(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).orderBy("doc_id").collect()]

    assert reported("MyVeryLongClassNameNumber12") == [0]
    assert reported(*[f"StreamParserDriver{4000 + k}" for k in range(200)]) == [0] * 200
    rng = random.Random(1)
    groups = ["-".join("".join(rng.choices("0123456789ABCDEF", k=g)) for g in (8, 4, 4, 4, 12)) for _ in range(200)]
    assert sum(reported(*groups)) >= 190


def test_procedure_discovers_by_stratum():
    assert op.least_discovered([(1, 0, 90), (1, 40, 10)]) == {1: 40}
    assert op.least_discovered([(1, 0, 100)]) == {1: op._STEPS + 1}
    assert op.least_discovered([]) == {}


def test_main_path_has_no_python(spark, plan, odd_docs):
    text = plan(op.report(odd_docs))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_odd_rows(odd_docs, no_docs):
    rows = op.report(odd_docs).collect()
    assert len(rows) == 8 and {r["spans"] for r in rows} == {""}
    assert op.report(no_docs).count() == 0

"""Secrets: three base patterns, and a randomness test battery for tokens that carry no name.

DataFrame functions only. Positions of matches come from the lengths of the pieces around them.

A candidate is a run of 20 or more characters of the usual encodings that no base span touches and that has letters and digits.
Its encoding is the smallest alphabet that holds all its characters; hyphens between groups of one case (as in a UUID) only part the groups. Four tests ask whether the
characters are a uniform random draw of that alphabet: chi-squared over single characters, chi-squared over its classes (digits, capitals, small letters, signs), the number of
runs above and below the alphabet's middle, and the serial correlation of neighbours. If the smallest of the p-values times four is below ``ALPHA``, the token is
no random draw and goes; so goes one in a hundred of true random tokens.

The others must stand out among ordinary identifiers, which are put together from words: the p-value that counts for false discoveries is that of an identifier whose letters
come as often as in the corpus and whose class of character changes at word borders. Two p-values under that null are combined by Fisher's method: of the rarity of the letters
(minus the logarithm of their shares, all letters a to z of all texts being counted; if all are hexadecimal, or of the chance of that if it is less, twice the lesser), and of the changes of
class between neighbours (one in three where both cases or signs occur, one in five elsewhere). Benjamini and Hochberg's procedure at level 0.01 then takes secrets as the discoveries, within each stratum of encoding and length, since the
power of the tests grows with the length. So the false share of spans of kind ``random`` is bounded, as far as identifiers are like that; the tests measure it by length.

The procedure needs the counts of p-values by stratum, in steps of a tenth of a decade: at most strata x 121 rows whatever the corpus, and one row of letter counts.
P-values below 1e-12 count as 1e-12. ``PRIOR`` letters of English stand beside the counted ones, so that a small table has a null too.

Edge cases: a null or empty text has no spans. Repeated documents give repeated rows and count as often in the strata. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.workspace import materialise

# The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

KINDS = ("assign", "access", "hex", "random")
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
LEVEL = 0.01  # of false ones among the reported, in each stratum
ALPHA = 0.01  # of random tokens that the battery may reject
PRIOR = 1_000_000
CHANGES = (1 / 5, 1 / 3)  # of class between neighbours in ordinary identifiers: of one case, and with both cases or signs
GROUPS = r"^(?:[0-9a-z]{2,}(?:-[0-9a-z]{2,})+|[0-9A-Z]{2,}(?:-[0-9A-Z]{2,})+)$"

# Letters of English text, a to z, in thousandths.
ENGLISH = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Name, pattern, and the alphabet in its classes; the first whose pattern holds counts.
ENCODINGS = (
    ("hex", r"^[0-9a-f]+$", (_DIGITS, _LOWER[:6])),
    ("HEX", r"^[0-9A-F]+$", (_DIGITS, _UPPER[:6])),
    ("base32", r"^[A-Z2-7]+$", (_UPPER, _DIGITS[2:8])),
    ("base36", r"^[0-9a-z]+$", (_DIGITS, _LOWER)),
    ("BASE36", r"^[0-9A-Z]+$", (_DIGITS, _UPPER)),
    ("base62", r"^[0-9A-Za-z]+$", (_DIGITS, _UPPER, _LOWER)),
    ("base64", r"^[0-9A-Za-z+/]+$", (_UPPER, _LOWER, _DIGITS, "+/")),
    ("base64url", r"^[0-9A-Za-z_-]+$", (_UPPER, _LOWER, _DIGITS, "-_")),
)
LENGTHS = (24, 32, 48, 64, 128)  # where a new stratum begins
_STEPS = 120
_RUN = 128


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: start, end (code points), the match and one of its groups.

    A match starts behind the gaps and matches before it. These lengths are summed within runs of ``_RUN`` matches and over the
    runs, so the work grows little faster than the number of matches.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    sized = F.filter(F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), groups.alias("group")), lambda x: x["hit"].isNotNull())
    last = F.floor((F.size(sized) - 1) / _RUN).cast("int")
    runs = F.transform(F.sequence(F.lit(0), last), lambda r: F.slice(sized, r * _RUN + 1, _RUN))
    ends = F.transform(runs, lambda run: F.aggregate(run, F.lit(0), lambda at, x: at + x["gap"] + F.length(x["hit"])))
    begins = F.transform(ends, lambda _, r: F.aggregate(F.slice(ends, 1, r), F.lit(0), lambda at, n: at + n))
    none = F.expr("cast(array() as array<struct<start:int,end:int,hit:string,group:string>>)")

    def place(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["hit"])
        found = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"), x["group"].alias("group"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(found)).alias("out"))

    def placed(run: Column, begin: Column) -> Column:
        return F.aggregate(run, F.struct(begin.alias("at"), none.alias("out")), place, lambda acc: acc["out"])

    return F.when(text.rlike(pattern), F.flatten(F.zip_with(runs, begins, placed))).otherwise(none)


def _spans(kind: str, found: Column) -> Column:
    rank = KINDS.index(kind)
    return F.transform(
        found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"))
    )


def base_spans(text: Column) -> Column:
    """Spans of the base patterns by start, then kind."""
    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["group"]) >= 8)
    # A run that is long enough is matched whole, and a shorter one holds no match: the same as dropping short matches.
    access = matches(text, r"AKIA[A-Z0-9]{12,}")
    digits = matches(text, r"[0-9a-f]{32,}")
    return F.array_sort(F.concat(_spans("assign", assign), _spans("access", access), _spans("hex", digits)))


def _pick(found: Column, values: list) -> Column:
    """The value at the place of the token's encoding."""
    out = F.lit(values[-1])
    for k in range(len(values) - 2, -1, -1):
        out = F.when(found == k, F.lit(values[k])).otherwise(out)
    return out


def upper_tail(z: Column) -> Column:
    """Probability that a normal variable exceeds z (a polynomial in 1 / (1 + 0.23 z), exact to 1e-7), at least 1e-12."""
    a = F.abs(z)
    t = 1 / (1 + F.lit(0.2316419) * a)
    # Coefficients of the approximation.
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) * 0.3989422804014327 * series
    return F.greatest(F.when(z >= 0, tail).otherwise(1 - tail), F.lit(1e-12))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def letters_seen(texts: DataFrame) -> list[int]:
    """How often each letter occurs in all texts, either case; one row comes back."""
    small = F.lower(F.coalesce("text", F.lit("")))
    counts = [F.sum(F.length(small) - F.length(F.replace(small, F.lit(c), F.lit("")))).alias(c) for c in _LOWER]
    return [n or 0 for n in texts.agg(*counts).first()]


def rarities(counts: list[int]) -> tuple[list[float], float, float, float]:
    """Minus the logarithm of each letter's share, mean and deviation of that over letters as they come, and the logarithm of the share of a to f."""
    counts = [n + PRIOR * e / sum(ENGLISH) for n, e in zip(counts, ENGLISH)]
    shares = [n / sum(counts) for n in counts]
    rare = [-math.log(p) for p in shares]
    mean = sum(p * r for p, r in zip(shares, rare))
    return rare, mean, math.sqrt(max(sum(p * (r - mean) ** 2 for p, r in zip(shares, rare)), 1e-9)), math.log(sum(shares[:6]))


def ordinary(hit: Column, letters: tuple[list[float], float, float, float]) -> Column:
    """P-value of a token under the null of an identifier made of words."""
    rare, mean, deviation, hexadecimal = letters
    worth = F.array(*[F.lit(v) for v in (0.0, *rare)])
    values = F.transform(F.split(F.lower(hit), ""), lambda c: F.element_at(worth, F.instr(F.lit(_LOWER), c) + 1))
    known = F.length(F.regexp_replace(hit, "[^A-Za-z]", "")).cast("double")
    rarity = upper_tail((_sum(values) - known * mean) / (deviation * F.sqrt(F.greatest(known, F.lit(1.0)))))
    chance = F.greatest(F.exp(known * hexadecimal), F.lit(1e-12))
    rarity = F.when(hit.rlike("^[0-9A-Fa-f]+$"), F.least(F.lit(1.0), 2 * F.least(rarity, chance))).otherwise(rarity)
    classes = hit
    for pattern, sign in (("[0-9]+", "0"), ("[A-Z]+", "A"), ("[a-z]+", "a"), ("[^0-9A-Za-z]+", "-")):
        classes = F.regexp_replace(classes, pattern, sign)
    free = (F.length(hit) - 1).cast("double")
    rate = F.when(hit.rlike("[A-Z].*[a-z]|[a-z].*[A-Z]|[^0-9A-Za-z]"), CHANGES[1]).otherwise(CHANGES[0])
    changes = upper_tail((F.length(classes) - 1 - free * rate) / F.sqrt(free * rate * (1 - rate)))
    both = rarity * changes
    return F.greatest(both * (1 - F.log(both)), F.lit(1e-12))


def battery(tokens: Column, letters: tuple[list[float], float, float, float]) -> Column:
    """Tokens (start, end, hit) with the stratum, whether they may be a random draw, and their p-value as ordinary identifiers in tenths of a decade."""
    alphabets = ["".join(classes) for _, _, classes in ENCODINGS]
    encoding = len(ENCODINGS) - 1

    def infer(m: Column) -> Column:
        out = F.lit(encoding)
        for k in range(encoding - 1, -1, -1):
            out = F.when(m["hit"].rlike(ENCODINGS[k][1]), F.lit(k)).otherwise(out)
        return out

    tokens = F.transform(
        tokens,
        lambda m: F.struct(m["start"], m["end"], F.when(m["hit"].rlike(GROUPS), F.replace(m["hit"], F.lit("-"), F.lit(""))).otherwise(m["hit"]).alias("hit")),
    )
    named = F.transform(tokens, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["hit"].alias("hit"), infer(m).alias("e")))
    read = F.transform(
        named,
        lambda m: F.struct(
            m["start"], m["end"], m["hit"], m["e"],
            F.length(m["hit"]).cast("double").alias("n"),
            _pick(m["e"], [float(len(a)) for a in alphabets]).alias("k"),
            F.split(_pick(m["e"], alphabets), "").alias("alphabet"),
            F.transform(F.split(m["hit"], ""), lambda c: (F.instr(_pick(m["e"], alphabets), c) - 1).cast("double")).alias("x"),
        ),
    )

    def squares(m: Column) -> Column:
        counts = F.transform(m["alphabet"], lambda c: (F.length(m["hit"]) - F.length(F.replace(m["hit"], c, F.lit("")))).cast("double"))
        return _sum(F.transform(counts, lambda c: c * c))

    def class_statistic(m: Column) -> Column:
        per_encoding = []
        for _, _, classes in ENCODINGS:
            size = float(sum(map(len, classes)))
            terms = []
            for chars in classes:
                kept = F.length(F.translate(m["hit"], chars, ""))
                expected = m["n"] * (len(chars) / size)
                seen = m["n"] - kept
                terms.append((seen - expected) * (seen - expected) / expected)
            per_encoding.append(sum(terms[1:], terms[0]))
        out = per_encoding[-1]
        for k in range(len(per_encoding) - 2, -1, -1):
            out = F.when(m["e"] == k, per_encoding[k]).otherwise(out)
        return out

    def halves(m: Column) -> Column:
        return F.transform(m["x"], lambda v: F.when(v * 2 >= m["k"], 1.0).otherwise(0.0))

    def pairs(values: Column, of) -> Column:
        size = F.size(values)
        return _sum(F.zip_with(F.slice(values, 1, size - 1), F.slice(values, 2, size - 1), of))

    gathered = F.transform(
        read,
        lambda m: F.struct(
            m["start"], m["end"], m["e"], m["n"], m["k"],
            ordinary(m["hit"], letters).alias("ordinary"),
            (m["k"] / m["n"] * squares(m) - m["n"]).alias("chi"),
            class_statistic(m).alias("classes"),
            _sum(halves(m)).alias("high"),
            (1 + pairs(halves(m), lambda a, b: F.when(a != b, 1.0).otherwise(0.0))).alias("runs"),
            (_sum(m["x"]) / m["n"]).alias("mean"),
            _sum(F.transform(m["x"], lambda v: v * v)).alias("square"),
            pairs(m["x"], lambda a, b: a * b).alias("product"),
            m["x"][0].alias("first"),
            F.element_at(m["x"], -1).alias("last"),
        ),
    )

    def p_value(m: Column) -> Column:
        n, k = m["n"], m["k"]
        chi = upper_tail((m["chi"] - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n))
        degrees = _pick(m["e"], [float(len(c) - 1) for _, _, c in ENCODINGS])
        # Cube root transformation of chi-squared.
        classes = upper_tail((F.pow(m["classes"] / degrees, F.lit(1 / 3)) - (1 - 2 / (9 * degrees))) / F.sqrt(2 / (9 * degrees)))
        mean = 2 * m["high"] * (n - m["high"]) / n + 1
        spread = F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9))
        one_sided = (m["high"] == 0) | (m["high"] == n)
        runs = F.when(one_sided, F.greatest(F.pow(F.lit(2.0), 1 - n), F.lit(1e-12))).otherwise(
            2 * upper_tail(F.abs((m["runs"] - mean) / F.sqrt(spread)))
        )
        centred = m["square"] - n * m["mean"] * m["mean"]
        # Sum of (x - mean) * (next - mean) over neighbours.
        joint = m["product"] - m["mean"] * (2 * n * m["mean"] - m["first"] - m["last"]) + (n - 1) * m["mean"] * m["mean"]
        serial = F.when(centred <= 0, F.lit(1e-12)).otherwise(
            2 * upper_tail(F.abs((joint / F.greatest(centred, F.lit(1e-9)) + 1 / n) * F.sqrt(n)))
        )
        return F.least(F.lit(1.0), 4 * F.least(chi, classes, runs, serial))

    def stratum(m: Column) -> Column:
        length = F.lit(0)
        for limit in LENGTHS:
            length = length + F.when(m["n"] >= limit, 1).otherwise(0)
        return m["e"] * (len(LENGTHS) + 1) + length

    return F.transform(
        gathered,
        lambda m: F.struct(
            m["start"].alias("start"),
            m["end"].alias("end"),
            stratum(m).alias("stratum"),
            (p_value(m) >= ALPHA).alias("drawn"),
            F.greatest(F.lit(0), F.least(F.lit(_STEPS), F.floor(F.log10(m["ordinary"]) * -10))).cast("int").alias("step"),
        ),
    )


def candidates(text: Column, base: Column) -> Column:
    """Long tokens with letters and digits that no base span touches."""
    mixed = F.filter(matches(text, CANDIDATE), lambda m: m["hit"].rlike("[0-9]") & m["hit"].rlike("[A-Za-z]"))
    return F.filter(mixed, lambda m: ~F.exists(base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))


def least_discovered(counts: list[tuple[int, int, int]], level: float = LEVEL) -> dict[int, int]:
    """For each stratum the smallest step whose tokens are discoveries, from (stratum, step, count) rows of all tokens."""
    out = {}
    for stratum, rows in itertools.groupby(sorted(counts), key=lambda r: r[0]):
        steps = {step: n for _, step, n in rows}
        total, below = sum(steps.values()), 0
        out[stratum] = _STEPS + 1
        for step in sorted(steps, reverse=True):
            below += steps[step]
            if 10 ** (-step / 10) <= level * below / total:
                out[stratum] = step
    return out


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``random`` spans (start, rank, end, kind) of every document."""
    letters = rarities(letters_seen(docs))
    read = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("base", base_spans(F.col("text")))
    read = read.select("doc_id", "base", battery(candidates(F.col("text"), F.col("base")), letters).alias("tested"))
    read = materialise(read, "secret-candidates")
    counted = read.select(F.explode("tested").alias("t")).groupBy("t.stratum", "t.step").agg(F.count("*").alias("n")).collect()
    limits = least_discovered([(r["stratum"], r["step"], r["n"]) for r in counted])
    limit = F.create_map(*[F.lit(v) for item in limits.items() for v in item]) if limits else None
    kept = F.filter("tested", lambda t: t["drawn"] & (t["step"] >= limit[t["stratum"]])) if limits else F.col("tested")
    return read.select("doc_id", "base", _spans("random", kept).alias("random"))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: base counts by kind, the digest of the base spans, and all spans."""
    found = find(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.array_sort(F.concat("base", "random"))).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )

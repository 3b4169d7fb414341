"""Personal data: base patterns, and contextual extraction bootstrapped from what they find.

The base kinds (email, ip, card, phone) come from fixed patterns. Their matches are the seed entities. Every number in groups (joined by single
spaces, dots, hyphens or parentheses) and every other token that looks like an identifier (it holds a digit or an @) is an instance with a lexical pattern: the two words before it. Patterns and instances form a
graph. Spark scores it in rounds: a pattern is as credible as the mean credibility of its instances of one kind, drawn to
zero by ``DOUBT`` unknown ones; an instance is as credible as its best pattern; seeds keep 1. Every pattern that shares an instance with a
credible one is scored in the next round. Its support is its different seeds and the instances that a pattern of ``CONFIDENT`` credibility named.
Patterns that reach ``CONFIDENT`` with a support of ``SUPPORT`` give up their other instances: unseen identifiers of the pattern's kind.

Base spans always stay. A discovered span never overlaps a base span, and has the shape of its kind: enough digits for numbers,
an @ for addresses. Patterns and instances are counted in partial sums before they move; a pattern then has one row for each different instance. Where that, or the instances of a pattern in the
texts, are more than ``hot_rows``, the look-up of its score is spread over parts. The number of rounds is fixed. Identifiers may have any length; a number in groups has at most ``MOST_DIGITS`` digits.

Edge cases: a null or empty text has no spans. Repeated documents give repeated rows and count once each in the graph. Without any seed nothing
is discovered. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.arrays import let_workers_import, slices
from platewise.operators.lookup import HOT_ROWS, hot_keys, lookup
from platewise.workspace import materialise

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
DOUBT = 2.0  # unknown instances that every pattern is charged with
CONFIDENT = 0.7
SUPPORT = 5  # different seeds that a pattern must have
LEAST_DIGITS = 6  # of a discovered number
MOST_DIGITS = 64  # of a number in groups; longer runs are tables, not identifiers

_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\s\"'(),;:<>=\[\]{}|]*[0-9@][^\s\"'(),;:<>=\[\]{}|]*")
_RUN = re.compile(r"(?<![^\s\"'(),;:<>=\[\]{}|])\+?(?:\([0-9]++\)|[0-9]++)(?:[ .-]?(?:\([0-9]++\)|[0-9]++))*+")
_TAIL = re.compile(r"[^\s\"'(),;:<>=\[\]{}|]*")
_BEFORE = re.compile(r"[^\W\d_]+|[:=#@]")
_CLOSING = ".!?*#&%$"  # not part of a token that they end
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Found from each @: the run of allowed characters before it, the labels behind it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        else:
            free = at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, by kind as listed, then start."""
    out: list[Span] = [("email", a, b) for a, b in emails(text)]
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.findall(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def pattern_before(text: str, at: int) -> str:
    """The two words or signs before a place, lower-cased; nearer than 40 code points."""
    return " ".join(w.lower() for w in _BEFORE.findall(text, max(0, at - 40), at)[-2:])


def number_runs(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Groups of digits joined by single spaces, dots, hyphens or parentheses, between the places that are ``taken``."""
    free = 0
    for low, high in [*taken, (len(text), len(text))]:
        for m in _RUN.finditer(text, free, max(low, free)):
            a, b = m.span()
            if _TAIL.match(text, b)[0].rstrip(_CLOSING):  # the last group is part of another word
                b = text.rfind(" ", a, b)
            if b > a and (" " in text[a:b] or "(" in text[a:b]) and len(_DIGITS.findall(text, a, b)) <= MOST_DIGITS:
                yield a, b
        free = max(free, high)


def instances(text: str, base: list[Span]) -> list[tuple[str, str, int, int, str]]:
    """(pattern, identifier, start, end, kind): base matches, and what no base match touches: numbers in groups, other tokens with a digit or @."""
    out = [(pattern_before(text, a), text[a:b], a, b, kind) for kind, a, b in base]
    taken = sorted((a, b) for _, a, b in base)
    runs = list(number_runs(text, taken))
    out += [(pattern_before(text, a), text[a:b], a, b, "") for a, b in runs]
    taken = sorted(taken + runs)
    k = 0
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while b > a and text[b - 1] in _CLOSING:
            b -= 1
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k < len(taken) and taken[k][0] < b:
            continue
        out.append((pattern_before(text, a), text[a:b], a, b, ""))
    return out


_INSTANCE = pa.struct([("pattern", pa.string()), ("name", pa.binary()), ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("shape", pa.string())])
_BASE = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def _shape(name: str) -> str:
    """Kinds that an identifier could be of."""
    digits = len(_DIGITS.findall(name))
    if "@" in name[1:-1]:
        return "email"
    return "number" if digits >= LEAST_DIGITS else ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        base, found = [], []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text or "")
            base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            found.append(
                [
                    {"pattern": p, "name": hashlib.blake2b(name.encode(), digest_size=16).digest(), "start": a, "end": b, "kind": kind, "shape": _shape(name)}
                    for p, name, a, b, kind in (instances(text, spans) if text else [])
                    if p and (kind or _shape(name))
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(base, pa.list_(_BASE)), pa.array(found, pa.list_(_INSTANCE))], names=["doc_id", "base", "found"]
        )


_FOUND = (
    "doc_id long, base array<struct<kind:string,start:int,end:int>>, "
    "found array<struct<pattern:string,name:binary,start:int,end:int,kind:string,shape:string>>"
)


def confident_patterns(edges: DataFrame, rounds: int = ROUNDS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``pattern`` and ``kind`` of the patterns that may name unseen identifiers, from the graph of patterns and instances.

    ``edges`` has a row for each different (``pattern``, ``name``, ``kind``, ``shape``); ``kind`` is empty for instances that are no seeds.
    """
    seeds = edges.where("kind <> ''").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    rest = materialise(edges.where("kind = ''").select("pattern", "name", "shape").distinct(), "pii-edges")
    hot_patterns, hot_names = (hot_keys(rest, [key], hot_rows) for key in ("pattern", "name"))
    size = rest.groupBy("pattern").agg(F.count("*").alias("others"))
    all_seeds = seeds.groupBy("pattern").agg(F.sum("seeds").alias("all_seeds"))
    sizes = size.join(all_seeds, "pattern", "full").fillna(0, ["others", "all_seeds"])
    sizes = materialise(sizes, "pii-sizes")
    # Credibility of (pattern, kind): the seeds count 1 each, the others what their patterns gave them the round before.
    # Supported by seeds, and by others that a confident pattern named.
    score = (F.col("seeds") + F.col("gained")) / (F.col("all_seeds") + F.col("others") + F.lit(DOUBT))
    scored = seeds.withColumns({"gained": F.lit(0.0), "support": F.col("seeds")})
    for last in [False] * rounds + [True]:
        named = scored.join(sizes, "pattern").select("pattern", "kind", score.alias("score"), "support").where(F.col("support") >= SUPPORT)
        named = materialise(named, "pii-patterns")
        if last:
            return named.select("pattern", "kind", "score").where(F.col("score") >= CONFIDENT)
        fits = (F.col("shape") == "email") == (F.col("kind") == "email")
        credible = lookup(rest, named, ["pattern"], "inner", hot=hot_patterns).where(fits).groupBy("name", "kind").agg(F.max("score").alias("score"))
        credible = materialise(credible, "pii-credible")
        gained = lookup(rest, credible, ["name"], "inner", hot=hot_names).groupBy("pattern", "kind").agg(
            F.sum("score").alias("gained"), F.sum((F.col("score") >= CONFIDENT).cast("long")).alias("named")
        )
        scored = seeds.join(gained, ["pattern", "kind"], "full").fillna(0, ["seeds", "gained", "named"])
        scored = scored.withColumn("support", F.col("seeds") + F.col("named")).drop("named")


def find(docs: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``doc_id``, ``base`` and ``discovered`` spans (kind, start, end) of every document."""
    docs = let_workers_import(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    extracted = docs.mapInArrow(_extract, _FOUND).withColumn("row", F.monotonically_increasing_id())
    extracted = materialise(extracted, "pii-found")
    each = extracted.select("row", F.explode("found").alias("i")).select("row", "i.*")
    edges = materialise(each.groupBy("pattern", "name", "kind", "shape").agg(F.count("*").alias("n")), "pii-graph")
    patterns = materialise(confident_patterns(edges, hot_rows=hot_rows), "pii-confident")
    fits = (F.col("shape") == "email") == (F.col("as_kind") == "email")
    best = patterns.groupBy("pattern").agg(F.max(F.struct("score", "kind"))["kind"].alias("as_kind"))
    unseen = lookup(each.where("kind = ''"), best, ["pattern"], "inner", hot_rows=hot_rows).where(fits)
    span = F.struct(F.col("as_kind").alias("kind"), "start", "end")
    # Spans of one document, which is itself a row.
    unseen = unseen.groupBy("row").agg(F.sort_array(F.collect_set(span)).alias("discovered"))
    out = extracted.select("row", "doc_id", "base").join(unseen, "row", "left")
    return out.select("doc_id", "base", F.coalesce("discovered", F.filter("base", lambda s: F.lit(False))).alias("discovered"))


def spans_text(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def listed(spans):
    """Kinds in their listed order, then by start."""
    rank = F.transform(
        spans, lambda s: F.struct(F.array_position(F.lit(list(KINDS)), s["kind"]).alias("rank"), s["start"], s["end"], s["kind"])
    )
    return F.array_sort(rank)


def _of_kind(kind: str):
    return F.filter("base", lambda s: s["kind"] == kind)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: base counts by kind, the digest of the base spans, and all spans."""
    found = find(docs)
    counts = [F.size(_of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(spans_text(listed(F.col("base"))), 256).alias("base_sha256"),
        spans_text(listed(F.concat("base", "discovered"))).alias("spans"),
        F.size("discovered").cast("long").alias("n_discovered"),
    )

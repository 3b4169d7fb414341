"""Identifiers that only contexts give away."""

import collections

import pytest

from platewise.llm import op10_pii as op


def found(spark, texts):
    rows = op.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    out = {}
    for r in rows:
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        out[r["doc_id"]] = [(kind, texts[r["doc_id"]][int(a) : int(b)]) for kind, a, b in spans]
    return [out[k] for k in range(len(texts))]


def test_discovered_identifiers_lead_to_further_contexts(spark):
    texts = [f"Member Phone: +1 (555) 201-{1000 + k} today" for k in range(60)]
    # Eight unseen numbers in the seeded context come again in a context without any seed, which has one of its own.
    texts += [f"Member Phone: 0555-99800{k} today" for k in range(8)]
    texts += [f"ring desk 0555-99800{k} again" for k in range(8)] + ["ring desk 0777-123456 again"]
    texts += [f"order number 77{k}88{k} was shipped" for k in range(20)]
    out = found(spark, texts)
    assert all(out[60 + k] == [("phone", f"0555-99800{k}")] for k in range(8))
    assert all(out[68 + k] == [("phone", f"0555-99800{k}")] for k in range(8))
    assert out[76] == [("phone", "0777-123456")]
    assert not any(out[77:])


def test_numbers_in_groups_are_one_identifier(spark):
    cards = [c for c in (f"4111 1111 1111 {k}" for k in range(1000, 3000)) if op.luhn(c.replace(" ", ""))]
    texts = [f"Member Phone: +1 (555) 201-{1000 + k} today" for k in range(60)]
    texts += [f"paid by card number: {c}" for c in cards[:60]]
    unseen = ["0555 998 877", "(555) 201-1000", "0555.998 (877)"]
    texts += [f"Member Phone: {x}. Thanks" for x in unseen] + ["paid by card number: 4111 1111 1111 1112"]
    out = found(spark, texts)
    assert out[120:] == [[("phone", x)] for x in unseen] + [[("card", "4111 1111 1111 1112")]]


def test_where_numbers_in_groups_begin_and_end():
    def runs(text):
        return [text[a:b] for a, b in op.number_runs(text, sorted((a, b) for _, a, b in op.base_spans(text)))]

    assert runs("call 0555 998 877 now") == ["0555 998 877"]
    assert runs("(see 555 998)") == ["555 998"] and runs("1  2, 3") == [] and runs("a1 2b 30 40x") == []
    assert runs("at 10.0.0.1 555 998 then") == ["555 998"]
    assert runs("1 " * 50_000) == [] and runs("1 " * 50_000 + "x") == []


def test_long_identifiers_are_found(spark):
    texts = [f"write to contact: user{k}@example.org today" for k in range(40)]
    names = ["short@localhost", "a" * 70 + "@localhost", "b" * 200 + "@localhost"]
    out = found(spark, texts + [f"write to contact: {name} today" for name in names])
    assert out[40:] == [[("email", name)] for name in names]


def graph(texts):
    """Spans by a plain version of the pattern graph: sets of names by pattern, scored in rounds."""
    each, seeds, others = {}, collections.defaultdict(set), collections.defaultdict(set)
    for doc, text in texts.items():
        each[doc] = [(p, name, a, b, kind, op._shape(name)) for p, name, a, b, kind in op.instances(text or "", op.base_spans(text or ""))]
        for p, name, _, _, kind, shape in each[doc]:
            if p and kind:
                seeds[p, kind].add(name)
            elif p and shape:
                others[p].add((name, shape))

    def fits(shape, kind):
        return (shape == "email") == (kind == "email")

    seeded = collections.Counter()
    for (p, _), names in seeds.items():
        seeded[p] += len(names)
    gained, support = collections.Counter(), {k: len(v) for k, v in seeds.items()}
    for last in [False] * op.ROUNDS + [True]:
        score = {
            (p, kind): (len(seeds.get((p, kind), ())) + gained[p, kind]) / (seeded[p] + len(others.get(p, ())) + op.DOUBT)
            for (p, kind), n in support.items() if n >= op.SUPPORT
        }
        if last:
            break
        credible = collections.defaultdict(float)
        for (p, kind), value in score.items():
            for name, shape in others.get(p, ()):
                if fits(shape, kind):
                    credible[name, kind] = max(credible[name, kind], value)
        gained, support = collections.Counter(), collections.Counter({k: len(v) for k, v in seeds.items()})
        kinds = collections.defaultdict(list)
        for (name, kind), value in credible.items():
            kinds[name].append((kind, value))
        for p, members in others.items():
            for name, _ in members:
                for kind, value in kinds[name]:
                    gained[p, kind] += value
                    support[p, kind] += value >= op.CONFIDENT
    best = {}
    for (p, kind), value in score.items():
        if value >= op.CONFIDENT:
            best[p] = max(best.get(p, (0, "")), (value, kind))
    out = {}
    for doc, members in each.items():
        spans = {(kind, a, b) for _, _, a, b, kind, _ in members if kind} | set(op.base_spans(texts[doc] or ""))
        spans |= {(best[p][1], a, b) for p, _, a, b, kind, shape in members if not kind and shape and p in best and fits(shape, best[p][1])}
        out[doc] = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (op.KINDS.index(x[0]), x[1], x[2])))
    return out


@pytest.mark.parametrize("hot_rows", [op.HOT_ROWS, 20])
def test_spans_equal_a_plain_graph(spark, texts, hot_rows):
    some = dict(texts) | {10**9 + k: f"Member Phone: +1 (555) 201-{1000 + k} today, write to contact: user{k}@example.org" for k in range(80)}
    some |= {10**9 + 100 + k: f"Member Phone: 0555-99{8000 + k} today, contact: host{k % 9}@intranet and order number 77{k}8812" for k in range(25)}
    some |= {10**9 + 200 + k: f"ring desk 0555-99{8000 + k} again, reply via host{k % 9}@intranet or reply via me{k}@intranet" for k in range(20)}
    wanted = graph(some)
    frame = op.find(spark.createDataFrame(list(some.items()), "doc_id long, text string"), hot_rows)
    rows = frame.select("doc_id", op.spans_text(op.listed(op.F.concat("base", "discovered"))).alias("spans"), op.F.size("discovered").alias("n")).collect()
    assert {r["doc_id"]: r["spans"] for r in rows} == wanted and sum(r["n"] for r in rows) > 40

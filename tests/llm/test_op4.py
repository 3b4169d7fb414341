import re

import pytest

from platewise.llm import op4_licenses as op
from platewise.llm.queries import queries
from tests.llm.conftest import FOLDER


def words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", "".join(c.lower() if c.isascii() else c for c in text).encode())


WHOLE = {tuple(words(t)): name for name, t in reversed(op.DEFAULT.sentences)}
ANYWHERE = {tuple(words(t)): name for name, t in reversed(op.DEFAULT.notices)}
LONGEST = max(map(len, [*WHOLE, *ANYWHERE]))


def brute(text):
    """Every run of words, the leftmost and longest first, against the wordings; sentences only from unit to unit."""
    every, begins, ends = [], set(), set()
    for unit in re.split(r"\n|(?<=[.!?;:])(?=[ \t\n\v\f\r])", text):
        begins.add(len(every))
        every += words(unit)
        ends.add(len(every))
    found, at = [], 0
    while at < len(every):
        for to in range(min(len(every), at + LONGEST), at, -1):
            run = tuple(every[at:to])
            name = (WHOLE.get(run) if at in begins and to in ends else None) or ANYWHERE.get(run)
            if name:
                found.append((at, to, name))
                at = to
                break
        else:
            at += 1
    return found


def test_query_equals_brute_force(spark, texts):
    rows = queries()["op4_licenses"](spark, FOLDER).collect()
    assert len(rows) == len(texts) and any(r["licenses"] for r in rows)
    for row in rows:
        found = brute(texts[row["doc_id"]])
        assert row["sentence_ids"] == ",".join(s[2] for s in found)
        assert row["licenses"] == ",".join(dict.fromkeys(m[0] for m in op.licenses(found)))


def test_wrapped_text_and_rule_order(spark):
    full = "Copyright\n" + "\n".join(op.SENTENCES[k].replace(", ", ",\n") for k in ("mit-grant", "mit-notice", "mit-warranty", "mit-liability"))
    apart = op.SENTENCES["mit-grant"] + " " + "word " * (op.GAP + 1) + ". " + op.SENTENCES["mit-notice"]
    three = "\n".join(op.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"))
    swapped = "\n".join(op.SENTENCES[k] for k in ("bsd-source", "bsd-grant"))
    both = "Released under the MIT License.\nLicensed under CC BY-NC 4.0."
    rows = [(1, full), (2, apart), (3, three), (4, swapped), (5, both), (6, "x Released by the MIT License.")]
    out = {r["doc_id"]: r for r in op.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[k]["licenses"] for k in range(1, 7)] == ["MIT", "", "BSD-3-Clause", "", "MIT,CC-BY-NC-4.0", ""]
    start, end = map(int, out[1]["spans"].split(":")[1:])
    assert full[start:end].startswith("Permission is") and full[:end].endswith("SOFTWARE")


def test_usual_licences_in_their_own_words(spark):
    def of(*names):
        return "\n".join(dict(reversed(op.DEFAULT.sentences + op.DEFAULT.notices))[n] for n in names)

    lesser = of("lgpl-2.1-grant").replace("This program", "This library")
    texts = {
        "LGPL-2.1": lesser + "\n" + of("gpl-warranty", "lgpl-details"),
        "AGPL-3.0": of("agpl-3.0-grant"),
        "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 "
        "as published by the Free Software Foundation.",
        "MPL-2.0": of("mpl-2.0-terms") + " " + of("mpl-2.0-copy"),
        "EPL-2.0": "Project: published under the Eclipse Public License v2.0, see LICENSE",
        "ISC": of("isc-grant", "isc-warranty"),
        "BSD-3-Clause": of("bsd-grant", "bsd-source", "bsd-binary") + "\nNeither the name of Example, Inc. " + of("bsd-names-end"),
        "CC0-1.0": "To the extent possible under law, the author has " + of("cc0-1.0-dedicated") + ".",
        "Unlicense": of("unlicense-domain", "unlicense-grant"),
        "MIT": "This file is released under the MIT License.",
        "Apache-2.0": "# SPDX-License-Identifier: Apache-2.0",
        "GPL-3.0": "/* SPDX-License-Identifier: GPL-3.0-or-later */",
        "LGPL-3.0": "The code is licensed under the terms of the GNU Lesser General Public License, version 3, or any later version.",
        "": "Work under MIT supervision; the CC0 sensor is available. Licensed under a licence of ours.",
    }
    rows = list(enumerate(texts.values()))
    out = {r["doc_id"]: r["licenses"] for r in op.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[k] for k in range(len(rows))] == list(texts)


def test_table_is_a_parameter(spark):
    table = op.Table.of({"a": ("One rule here.", "Another rule here.")}, {"b": "house licence", "none": "..."}, [("House", ("a", "b")), ("Part", ("a",))])
    docs = spark.createDataFrame([(1, "Another rule here. It is the House Licence of us."), (2, "one rule here"), (3, "Released under the MIT License.")], "doc_id long, text string")
    out = {r["doc_id"]: (r["sentence_ids"], r["licenses"]) for r in op.report(docs, table).collect()}
    assert out == {1: ("a,b", "House"), 2: ("a", "Part"), 3: ("", "")}
    assert op.report(docs, op.Table.of({}, {}, [])).where("licenses <> ''").count() == 0
    for sentences, rules in (({"a": "x" * (op.MOST_TEXT + 1)}, []), ({"a": "x"}, [("L", ("b",))]), ({"a": "x"}, [("L", ())])):
        with pytest.raises(ValueError):
            op.Table.of(sentences, {}, rules)


def test_odd_rows(odd_docs, no_docs):
    assert {tuple(r)[1:] for r in op.report(odd_docs).collect()} == {(0, "", "", "")}
    assert op.report(odd_docs).count() == 8 and op.report(no_docs).count() == 0

"""Licence recognition by sentences: known sentences become identifiers, identifier sequences match ordered licence rules.

A text is cut into units at line ends and after . ! ? ; and : before white space. A known sentence is found where its normalised words (ASCII
capitals lower-cased, punctuation dropped) begin at a unit's beginning and end at a unit's end, so a sentence wrapped over
lines is found too. A known notice ("released under the MIT License", "SPDX-License-Identifier: MIT") is found anywhere, whatever stands before or
behind it. Hash hits are verified on the words. Of those that overlap, the one that begins first and is longest counts. A
rule is a sequence of identifiers with at most ``GAP`` other words between two of them; rules are tried in the order given and the
first that matches takes its sentences.

What is known is a ``Table``, the argument ``table`` of ``find`` and ``report``: sentences and notices, each an identifier with one or more wordings, and rules. It travels
with the tasks and may hold ``MOST_TEXT`` characters; a larger one is refused. Documents are scanned where they lie.

``DEFAULT`` knows Apache-2.0, MIT, GPL-2.0 and -3.0, LGPL-2.1 and -3.0, AGPL-3.0, MPL-2.0, EPL-2.0, ISC, BSD-2, -3 and -4-Clause, CC0-1.0, Unlicense, Zlib,
BSL-1.0 and the six CC licences 4.0: the grant and conditions of their texts or notices, their names after "licensed under" and the like, and their SPDX lines ("-only" and
"-or-later" count as the licence itself; of an expression with OR, AND or WITH the first licence counts). It does not know other licences, other
versions, translations, or a text from which the grant is missing.

Edge cases: a null or empty text has no sentence. Repeated documents give repeated rows. Other columns are ignored. An empty table of sentences finds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.arrays import LETTERS_AND_DIGITS, RunHash, Words, code_points_before, let_workers_import, slices, split_words, text_bytes

GAP = 60
MOST_TEXT = 4_000_000

# Sentences of public licence texts and notices, by identifier.
SENTENCES: dict[str, str | tuple[str, ...]] = {
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-grant": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-2.0-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-2.0-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-2.0-limits": "See the License for the specific language governing permissions and limitations under the License.",
    "mit-short": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
    "furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "gpl-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-details": "See the GNU General Public License for more details.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.",
    "bsd-advertising": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "mpl-2.0-terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-2.0-copy": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "epl-2.0-terms": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "http://www.eclipse.org/legal/epl-2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution",
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
    ),
    "isc-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
    "redistribute it freely, subject to the following restrictions:",
    "bsl-1.0-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
    "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to "
    "prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "unlicense-domain": "This is free and unencumbered software released into the public domain.",
    "unlicense-grant": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
    "compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "cc0-1.0-title": "CC0 1.0 Universal",
    "cc-by-nc-4.0-short": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-short": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-short": "Licensed under CC BY-SA 4.0.",
    "cc-by-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}

# The grants of the GNU licences: one wording for each kind of work, with any later version or without.
_GNU = {  # licence: name and version
    "GPL-3.0": ("General Public License", "3"),
    "GPL-2.0": ("General Public License", "2"),
    "LGPL-3.0": ("Lesser General Public License", "3"),
    "LGPL-2.1": ("Lesser General Public License", "2.1"),
    "AGPL-3.0": ("Affero General Public License", "3"),
}
_WORKS = ("program", "library", "file", "software")


def _gnu_grants(name: str, version: str) -> tuple[str, ...]:
    out = []
    for work in _WORKS:
        free = f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name}"
        out += [
            f"{free} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
            f"{free} as published by the Free Software Foundation; version {version} of the License.",
            f"{free} as published by the Free Software Foundation, version {version}.",
            f"{free} version {version} as published by the Free Software Foundation.",
        ]
    return tuple(out)


SENTENCES |= {f"{licence.lower()}-grant": _gnu_grants(*of) for licence, of in _GNU.items()}
SENTENCES["gpl-warranty"] = tuple(
    f"This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
    "FITNESS FOR A PARTICULAR PURPOSE."
    for work in _WORKS
)
SENTENCES |= {f"{kind}-details": f"See the GNU {name} Public License for more details." for kind, name in (("lgpl", "Lesser General"), ("agpl", "Affero General"))}

# Names that stand for a licence behind "licensed under" and the like.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache 2.0", "Apache Software License 2.0"),
    "MIT": ("MIT License", "MIT licence", "MIT", "Expat License"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL version 3", "GNU GPL v3", "GPLv3", "GPL v3", "GPL 3.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL version 2", "GNU GPL v2", "GPLv2", "GPL v2", "GPL 2.0"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "GNU LGPL v3", "LGPLv3", "LGPL v3", "LGPL 3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "GNU LGPL v2.1", "LGPLv2.1", "LGPL v2.1", "LGPL 2.1"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "GNU AGPL v3", "AGPLv3", "AGPL v3", "AGPL 3.0"),
    "MPL-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License v2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, version 2.0", "EPL 2.0"),
    "ISC": ("ISC License", "ISC licence", "ISC"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License", "BSD 2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD 3-Clause"),
    "BSD-4-Clause": ("BSD 4-Clause License", "Original BSD License"),
    "CC0-1.0": ("CC0 1.0 Universal", "CC0 1.0", "CC0"),
    "Unlicense": ("Unlicense",),
    "Zlib": ("zlib License",),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0 International"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike 4.0 International"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
}
_VERBS = ("licensed", "released", "distributed", "available", "published", "provided", "covered", "shared")
_ARTICLES = ("", "the ", "a ", "an ", "the terms of the ", "the terms and conditions of the ")


def _notices() -> dict[str, tuple[str, ...]]:
    out = {}
    for licence, names in NAMES.items():
        key = licence.lower()
        out[f"{key}-named"] = tuple(f"{verb} under {article}{name}" for verb in _VERBS for article in _ARTICLES for name in (*names, licence))
        out[f"{key}-spdx"] = tuple(f"SPDX-License-Identifier: {licence}{end}" for end in ("", "-only", "-or-later"))
    return out


NOTICES = _notices() | {
    "bsd-names-end": "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior "
    "written permission.",
    "cc0-1.0-waiver": "has waived all copyright and related or neighboring rights",
    "cc0-1.0-dedicated": (
        "dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
        "dedicated all copyright and related and neighboring rights to this work to the public domain worldwide",
    ),
}

# Rules in the order in which they are tried.
RULES = (
    ("Apache-2.0", ("apache-2.0-grant", "apache-2.0-copy", "apache-2.0-warranty", "apache-2.0-limits")),
    ("Apache-2.0", ("apache-2.0-grant",)),
    ("Apache-2.0", ("apache-2.0-short",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-licensed",)),
    ("GPL-3.0", ("gpl-3.0-grant", "gpl-warranty", "gpl-details")),
    ("GPL-3.0", ("gpl-3.0-grant",)),
    ("GPL-3.0", ("gpl-3.0-short",)),
    ("GPL-2.0", ("gpl-2.0-grant", "gpl-warranty", "gpl-details")),
    ("GPL-2.0", ("gpl-2.0-grant",)),
    ("LGPL-3.0", ("lgpl-3.0-grant", "gpl-warranty", "lgpl-details")),
    ("LGPL-3.0", ("lgpl-3.0-grant",)),
    ("LGPL-2.1", ("lgpl-2.1-grant", "gpl-warranty", "lgpl-details")),
    ("LGPL-2.1", ("lgpl-2.1-grant",)),
    ("AGPL-3.0", ("agpl-3.0-grant", "gpl-warranty", "agpl-details")),
    ("AGPL-3.0", ("agpl-3.0-grant",)),
    ("MPL-2.0", ("mpl-2.0-terms", "mpl-2.0-copy")),
    ("MPL-2.0", ("mpl-2.0-terms",)),
    ("EPL-2.0", ("epl-2.0-terms",)),
    ("ISC", ("isc-grant", "isc-warranty")),
    ("ISC", ("isc-grant",)),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names-end")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Zlib", ("zlib-grant",)),
    ("BSL-1.0", ("bsl-1.0-grant",)),
    ("Unlicense", ("unlicense-domain", "unlicense-grant")),
    ("Unlicense", ("unlicense-domain",)),
    ("CC0-1.0", ("cc0-1.0-title",)),
    ("CC0-1.0", ("cc0-1.0-waiver",)),
    ("CC0-1.0", ("cc0-1.0-dedicated",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0-short",)),
    ("CC-BY-4.0", ("cc-by-4.0-short",)),
    ("CC-BY-4.0", ("cc-by-4.0-long",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0-short",)),
    *((licence, (f"{licence.lower()}-{kind}",)) for licence in NAMES for kind in ("named", "spdx")),
)


@dataclass(frozen=True)
class Table:
    """What is known: (identifier, wording) of sentences and notices, and (licence, identifiers) of rules in the order in which they are tried."""

    sentences: tuple[tuple[str, str], ...]
    notices: tuple[tuple[str, str], ...]
    rules: tuple[tuple[str, tuple[str, ...]], ...]

    @staticmethod
    def of(sentences: dict, notices: dict, rules) -> Table:
        """Identifiers map to one wording or to a tuple of them."""

        def flat(known: dict) -> tuple[tuple[str, str], ...]:
            return tuple((name, text) for name, of in known.items() for text in ((of,) if isinstance(of, str) else of))

        table = Table(flat(sentences), flat(notices), tuple((licence, tuple(rule)) for licence, rule in rules))
        size = sum(len(text) for _, text in table.sentences + table.notices)
        if size > MOST_TEXT:
            raise ValueError(f"the known sentences have {size} characters, more than {MOST_TEXT}")
        unknown = {name for _, rule in table.rules for name in rule} - {name for name, _ in table.sentences + table.notices}
        if unknown or not all(rule for _, rule in table.rules):
            raise ValueError(f"rules without sentences: {sorted(unknown)}")
        return table


DEFAULT = Table.of(SENTENCES, NOTICES, RULES)

Sentence = tuple[int, int, str]  # first word, last word (exclusive), identifier

_SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_ENDS = np.isin(np.arange(256), [ord(c) for c in ".!?;:"])


class Known:
    """Known sentences and notices by number of words, as sorted hashes with the words behind each."""

    def __init__(self, table: Table) -> None:
        self.whole, self.whole_by_length = self._indexed(table.sentences)
        self.anywhere, self.anywhere_by_length = self._indexed(table.notices)
        first = [w.split(b" ")[0].decode() for w in self.anywhere]
        self.first_words = np.unique(split_words(*text_bytes(pa.array(sorted(set(first)), pa.string())), LETTERS_AND_DIGITS).hashes)

    @staticmethod
    def _indexed(known: tuple[tuple[str, str], ...]) -> tuple[dict[bytes, str], dict[int, np.ndarray]]:
        names: dict[bytes, str] = {}
        words = split_words(*text_bytes(pa.array([text for _, text in known], pa.string())), LETTERS_AND_DIGITS)
        lengths = np.diff(words.first)
        for (name, _), low, n in zip(known, words.first.tolist(), lengths.tolist()):
            if n:  # of equal wordings the first counts
                names.setdefault(b" ".join(words.word(i) for i in range(low, low + n)), name)
        hashes = RunHash(words.hashes).of(words.first[:-1], words.first[1:])
        return names, {n: np.unique(hashes[lengths == n]) for n in np.unique(lengths).tolist() if n}


@cache
def _known(table: Table) -> Known:
    return Known(table)


def unit_edges(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each word, whether a unit begins with it and whether one ends with it."""
    n = len(words.start)
    data = words.lower
    after = np.zeros(len(data), bool)  # a cut lies behind this byte
    after[data == 0x0A] = True
    spaced = np.ones(len(data), bool)
    spaced[:-1] = _SPACES[data[1:]]
    after |= _ENDS[data] & spaced
    count = np.zeros(len(data) + 1, np.int64)
    np.cumsum(after, out=count[1:])
    begins = np.ones(n, bool)
    begins[1:] = (count[words.start[1:]] > count[words.end[:-1]]) | (words.text_of[1:] != words.text_of[:-1])
    return begins, np.append(begins[1:], True)[:n]


def sentences(words: Words, known: Known) -> list[list[Sentence]]:
    """Known sentences of each text in order; of overlapping ones the first and longest. Words are counted within the text."""
    n, texts = len(words.start), len(words.first) - 1
    out: list[list[Sentence]] = [[] for _ in range(texts)]
    if not n:
        return out
    begins, ends = unit_edges(words)
    heads, likely = np.flatnonzero(begins), np.flatnonzero(np.isin(words.hashes, known.first_words))  # a notice begins with one of few words
    stop = words.first[1:][words.text_of]
    runs = RunHash(words.hashes)

    def hits(at: np.ndarray, length: int, hashes: np.ndarray) -> list[tuple[int, int]]:
        h = runs.of(at, at + length)
        place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        return [(i, i + length) for i in at[hashes[place] == h].tolist()]

    found: dict[tuple[int, int], str | None] = {}  # a sentence counts before a notice of the same words
    for length, hashes in known.whole_by_length.items():
        at = heads[heads + length <= stop[heads]]
        for span in hits(at[ends[at + length - 1]], length, hashes):
            found[span] = known.whole.get(b" ".join(words.word(i) for i in range(*span)))
    for length, hashes in known.anywhere_by_length.items():
        at = likely[likely + length <= stop[likely]]
        for span in hits(at, length, hashes):
            found[span] = found.get(span) or known.anywhere.get(b" ".join(words.word(i) for i in range(*span)))
    free = 0
    for (low, high), name in sorted(found.items(), key=lambda f: (f[0][0], -f[0][1])):
        if name and low >= free:
            free = high
            text = int(words.text_of[low])
            base = int(words.first[text])
            out[text].append((low - base, high - base, name))
    return out


def licenses(found: list[Sentence], rules=RULES, gap: int = GAP) -> list[tuple[str, int, int]]:
    """(licence, first sentence, last sentence exclusive) for the identifiers of one text."""
    out, at = [], 0
    while at < len(found):
        for licence, rule in rules:
            to = at + len(rule)
            same = to <= len(found) and all(found[at + k][2] == name for k, name in enumerate(rule))
            if same and all(found[k + 1][0] - found[k][1] <= gap for k in range(at, to - 1)):
                out.append((licence, at, to))
                at = to
                break
        else:
            at += 1
    return out


_MATCH = pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("sentences", pa.list_(pa.string()))])


def _scan(table: Table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(table)
        for batch in slices(batches):
            words = split_words(*text_bytes(batch.column("text")), LETTERS_AND_DIGITS)
            ids, matches = [], []
            for text, found in enumerate(sentences(words, known)):
                base, home = words.first[text], words.begins[text : text + 1]
                ids.append([name for _, _, name in found])
                matches.append([])
                for licence, low, high in licenses(found, table.rules):
                    first, last = words.start[base + found[low][0]], words.end[base + found[high - 1][1] - 1]
                    start, end = code_points_before(words.lower, np.array([first, last]), np.repeat(home, 2)).tolist()
                    matches[-1].append({"license": licence, "start": start, "end": end, "sentences": [s[2] for s in found[low:high]]})
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.string())), pa.array(matches, pa.list_(_MATCH))],
                names=["doc_id", "sentences", "matches"],
            )

    return run


def find(docs: DataFrame, table: Table = DEFAULT) -> DataFrame:
    """``doc_id``, ``sentences`` (identifiers in order) and ``matches`` (licence, code points, sentences) of every document."""
    docs = let_workers_import(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return docs.mapInArrow(
        _scan(table),
        "doc_id long, sentences array<string>, "
        "matches array<struct<license:string,start:int,end:int,sentences:array<string>>>",
    )


def report(docs: DataFrame, table: Table = DEFAULT) -> DataFrame:
    """One row per document: sentence identifiers in order, licences, and where each was found."""
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string")))
    return find(docs, table).select(
        "doc_id",
        F.size("sentences").cast("long").alias("n_sentences"),
        F.array_join("sentences", ",").alias("sentence_ids"),
        F.array_join(F.array_distinct(F.transform("matches", lambda m: m["license"])), ",").alias("licenses"),
        F.array_join(spans, ",").alias("spans"),
    )

"""License scan by template-markup matching.

A template is a license's wording with markup for what may differ:

* ``<<beginOptional>> ... <<endOptional>>``: a region that may be left out;
* ``<<var;words="a-b">>``: a region replaceable by a to b words.

Each template is compiled to an automaton over words.  A text is accepted
where all mandatory words stand in order and exactly, with nothing between but
what the markup allows; the longest acceptance from a place counts.  Words are
runs of letters, digits and characters beyond ASCII, in lower case (A-Z only),
so punctuation, case and line breaks never matter.

A template is tried only in texts that have its longest run of mandatory words
(one substring search), and only from words it can begin with.  Beside the
templates, short base phrases that name a license are reported wherever they
stand.  Documents are scanned where they are read: no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwell.llm.common import ship, steps, table, text_of

# Phrases that name a license, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Licenses whose tag in a file's head is looked for.
TAGGED = [
    "Apache-2.0", "MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1",
    "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "EPL-2.0", "BSL-1.0", "Zlib", "Unlicense", "CC0-1.0", "CC-BY-4.0",
    "CC-BY-SA-4.0", "CC-BY-NC-4.0",
]

#: Licenses of one family: label, name in the notice, version there, and the
#: date at the head of the whole text.
GNU = [
    ("gpl-2.0", "GNU General Public License", "2", "June 1991"),
    ("gpl-3.0", "GNU General Public License", "3", "29 June 2007"),
    ("lgpl-2.0", "GNU Library General Public License", "2", "June 1991"),
    ("lgpl-2.1", "GNU Lesser General Public License", "2.1", "February 1999"),
    ("lgpl-3.0", "GNU Lesser General Public License", "3", "29 June 2007"),
    ("agpl-3.0", "GNU Affero General Public License", "3", "19 November 2007"),
]


def _tag(license_: str) -> tuple[str, str]:
    # the kinds with "only" and "or later" are those of the same license
    return license_.lower(), (
        f"SPDX-License-Identifier: {license_}<<beginOptional>> only<<endOptional>><<beginOptional>> or later<<endOptional>>"
    )


def _gnu(label: str, name: str, version: str, date: str) -> list[tuple[str, str]]:
    can = "you can redistribute it and/or modify it under the terms of the "
    return [
        (label, f"{can}{name} as published by the Free Software Foundation<<beginOptional>>,<<endOptional>> "
                f"<<beginOptional>>either <<endOptional>>version {version} of the License"
                "<<beginOptional>>, or (at your option) any later version<<endOptional>>"),
        (label, f"{can}{name}<<beginOptional>>,<<endOptional>> version {version}<<beginOptional>>,<<endOptional>> "
                "as published by the Free Software Foundation"),
        (label, f"{name} Version {version}, {date}"),
    ]


# Wording of public licenses, of their usual notices and of the
# heads of their whole texts.
TEMPLATES = [
    *(wording for g in GNU for wording in _gnu(*g)),
    *map(_tag, TAGGED),
    ("apache-2.0", "Apache License Version 2.0, January 2004"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
     'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the '
     "License for the specific language governing permissions and limitations under the License."),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
     'this file, You can obtain one at <<var;words="1-1">>://mozilla.org/MPL/2.0/'),
    ("mpl-2.0", "Mozilla Public License<<beginOptional>>,<<endOptional>> Version 2.0"),
    *(("epl-2.0", f"Eclipse Public License {version}") for version in ("- v 2.0", "v2.0", "2.0", "Version 2.0")),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
     "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for "
     "any purpose, commercial or non-commercial, and by any means."),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
     'software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
     "distribute, execute, and transmit the Software, and to prepare derivative works of the Software"),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
     "to alter it and redistribute it freely, subject to the following restrictions:"),
    ("0bsd", "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any "
     'purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS"'),
    ("cc0-1.0", 'To the extent possible under law, <<var;words="1-12">> waived all copyright and related or neighboring '
     "rights to"),
    ("apache-2.0", '<<beginOptional>>This <<var;words="1-4">> is <<endOptional>>licensed under the '
     "<<beginOptional>>terms of the <<endOptional>>Apache License, Version 2.0"
     "<<beginOptional>> (the \"License\"); you may not use this file except in compliance with the License."
     " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
     "<<endOptional>>"),
    ("gpl-2.0", '<<beginOptional>>This <<var;words="1-4">> is <<endOptional>>licensed under the '
     "<<beginOptional>>terms of the <<endOptional>>GNU General Public License, version 2"
     "<<beginOptional>> of the License<<endOptional>>"),
    ("gpl-3.0", '<<beginOptional>>This <<var;words="1-4">> is <<endOptional>>licensed under the '
     "<<beginOptional>>terms of the <<endOptional>>GNU General Public License, version 3"
     "<<beginOptional>> of the License<<endOptional>>"),
    ("cc-by-nc-4.0", '<<beginOptional>>This <<var;words="1-4">> is <<endOptional>>licensed under '
     "<<beginOptional>>a <<endOptional>><<beginOptional>>the <<endOptional>>CC BY-NC 4.0"
     "<<beginOptional>> license<<endOptional>>"),
    ("cc-by-sa-4.0", '<<beginOptional>>This <<var;words="1-4">> is <<endOptional>>licensed under '
     "<<beginOptional>>a <<endOptional>><<beginOptional>>the <<endOptional>>CC BY-SA 4.0"
     "<<beginOptional>> license<<endOptional>>"),
    ("cc-by-4.0", '<<beginOptional>>This <<var;words="1-4">> is <<endOptional>>licensed under '
     "<<beginOptional>>a <<endOptional>><<beginOptional>>the <<endOptional>>CC BY 4.0"
     "<<beginOptional>> license<<endOptional>>"),
    ("mit", '<<var;words="1-4">> <<beginOptional>>is <<endOptional>><<beginOptional>>are <<endOptional>>'
     "under the <<beginOptional>>terms of the <<endOptional>>MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
     '<<var;words="1-6">> and associated documentation files (the "Software"), to deal in the Software without '
     "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
     "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to "
     "do so, subject to the following conditions: The above copyright notice and this permission notice "
     "<<beginOptional>>(including the next paragraph) <<endOptional>>shall be included in all copies or "
     "substantial portions of the Software."),
    ("isc", "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for "
     "any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
     "permission notice appear in all copies."),
    ("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met: <<beginOptional>>1. <<endOptional>>"
     "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
     "following disclaimer. <<beginOptional>>2. <<endOptional>>Redistributions in binary form must reproduce the "
     "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
     "other materials provided with the distribution."),
    ("bsd-3-clause", "Redistributions in binary form must reproduce the above copyright notice, this list of "
     "conditions and the following disclaimer in the documentation and/or other materials provided with the "
     'distribution. <<beginOptional>>3. <<endOptional>>Neither the name of <<var;words="1-12">> nor the names of '
     "its contributors may be used to endorse or promote products derived from this software without specific "
     "prior written permission."),
]

#: ASCII to the words' alphabet: lower case, all but letters and digits to spaces.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_markup = re.compile(r'<<beginOptional>>|<<endOptional>>|<<var;words="(\d+)-(\d+)">>')


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


class Template:
    """A template as an automaton.  State n stands before element n; ``free``
    are the states that are reached from a state without a word."""

    def __init__(self, label: str, text: str):
        self.label = label
        self.elements: list[bytes | None] = []  # a word, or None for any word
        skips: list[tuple[int, int]] = []
        runs, begins, at = [[]], [], 0
        for m in [*_markup.finditer(text), None]:
            plain = words_of(text[at : m.start() if m else len(text)])
            self.elements += plain
            if not begins:
                runs[-1] += plain
            if m is None:
                break
            runs.append([])
            at, here = m.end(), len(self.elements)
            if m[0] == "<<beginOptional>>":
                begins.append(here)
            elif m[0] == "<<endOptional>>":
                skips.append((begins.pop(), here))
            else:
                least, most = int(m[1]), int(m[2])
                self.elements += [None] * most
                skips += [(k, here + most) for k in range(here + least, here + most)]
        if begins:
            raise ValueError(f"{label}: an optional region does not end")
        self.required = b" " + b" ".join(max(runs, key=lambda r: (len(r), sum(map(len, r))))) + b" "
        if not self.required.strip():
            raise ValueError(f"{label}: no mandatory words")
        self.end = len(self.elements)
        self.free = [self._closure(n, skips) for n in range(self.end + 1)]
        first = {self.elements[n] for n in self.free[0] if n < self.end}
        self.first = None if None in first else first

    @staticmethod
    def _closure(state: int, skips: list[tuple[int, int]]) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            s = todo.pop()
            for a, b in skips:
                if a == s and b not in seen:
                    seen.add(b)
                    todo.append(b)
        return frozenset(seen)

    def longest(self, words: list[bytes], at: int) -> int | None:
        """End of the longest accepted run of words from ``at``."""
        states, found = self.free[0], None
        for i in range(at, len(words) + 1):
            if self.end in states:
                found = i
            if i == len(words):
                break
            w = words[i]
            states = frozenset().union(
                *(self.free[s + 1] for s in states if s < self.end and self.elements[s] in (None, w))
            )
            if not states:
                break
        return found

    def accepts(self, text: str) -> bool:
        """The whole text is this template's wording."""
        words = words_of(text)
        return self.longest(words, 0) == len(words)

    def find(self, words: list[bytes], joined: bytes) -> Iterator[tuple[int, int]]:
        """Accepted runs (start, end), leftmost and not overlapping."""
        if self.required not in joined:
            return
        at = 0
        while at < len(words):
            if self.first is None or words[at] in self.first:
                end = self.longest(words, at)
                if end is not None:
                    yield at, end
                    at = end - 1
            at += 1


def phrase_places(joined: bytes, phrase: bytes) -> list[int]:
    """Word numbers where the phrase's words stand consecutively."""
    out, at, word = [], 0, 0
    while (found := joined.find(phrase, at)) >= 0:
        word += joined.count(b" ", at, found)
        out.append(word)
        at = found + 1
        word += 1
    return out


SCAN_DDL = (
    "doc_id long, n_words long, base array<struct<label:string,start:long,end:long>>, "
    "templates array<struct<label:string,start:long,end:long>>"
)
_PLACES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_licenses(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    phrases: dict[str, str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``SCAN_DDL`` (places are word numbers, end
    exclusive).  Null text is empty and has no places; null and repeated ids
    are kept; other columns are not read; an empty table gives no rows.  The
    whole text is scanned; a task holds one step of texts."""
    ship(docs.sparkSession)
    wording = TEMPLATES if templates is None else templates
    named = PHRASES if phrases is None else phrases

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [Template(*t) for t in wording]
        sought = [(b" " + b" ".join(words_of(p)) + b" ", label, len(words_of(p))) for p, label in named.items()]
        for batch in batches:
            for part in steps(batch, 1):
                counts, base, found = [], [], []
                for text in part.column(1).to_pylist():
                    words = words_of(text)
                    joined = b" " + b" ".join(words) + b" "
                    counts.append(len(words))
                    base.append(
                        [
                            {"label": label, "start": k, "end": k + n}
                            for phrase, label, n in sought
                            if phrase in joined
                            for k in phrase_places(joined, phrase)
                        ]
                    )
                    found.append(
                        [{"label": t.label, "start": a, "end": b} for t in compiled for a, b in t.find(words, joined)]
                    )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(base, _PLACES), pa.array(found, _PLACES)],
                    names=["doc_id", "n_words", "base", "templates"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, SCAN_DDL)


def covered(spans) -> Column:
    """Number of words that lie in at least one of the spans (struct arrays)."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"])))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        ordered, start,
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            (acc["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(acc["at"], s["start"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))

    def labels(places) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    every = F.concat("base", "templates")
    starts = F.transform("base", lambda p: p["start"])
    return found.select(
        "doc_id", "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(F.col("base")).alias("base_labels"),
        labels(every).alias("labels"),
        F.when(F.col("n_words") > 0, covered(every) / F.col("n_words")).otherwise(F.lit(0.0)).alias("score"),
    )

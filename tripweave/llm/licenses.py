"""License scans by patience alignment.

A template and a stretch of a document are aligned at words that occur once in each: their longest increasing
subsequence gives anchors, and the gaps between anchors are aligned in the same way; equal words at the ends of a gap
count too. The coverage is the share of the template's words that found their place. Stretches are laid where the
document holds pairs of words of a template, one stretch for each run of pairs in the template's order, so a notice
that is repeated is found each time.

Words are runs of letters and digits (inner dots, hyphens and plus signs stay), lower-cased. Null and empty texts hold
no license. Of overlapping finds the one that matched most words stays (ties: the first template by name). Repeated
rows give repeated results, an empty table none; extra columns pass through and those named like the output are
replaced. Whole texts are read; memory follows one text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import table, without

COVERAGE = 0.8
WORD = re.compile(r"[^\W_]+(?:[.+-][^\W_]+)*")
LICENSES = "array<struct<license:string, coverage:double, start:int, end:int, words:int>>"
_ARROW = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32())]))

# Notices and texts of common licenses.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS."
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "mit-notice": "Released under the MIT License.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def words_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Words, and where each stands in the text."""
    found = list(WORD.finditer(text))
    return [m.group().lower() for m in found], [m.span() for m in found]


def increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back.append(piles[k - 1] if k else -1)
        if k == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[k], piles[k] = v, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched ``(place in the text, place in the template)``, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        at = {w: i for i, w in enumerate(text[a:b], a) if here[w] == 1}
        both = [(at[w], j) for j, w in enumerate(template[c:d], c) if there[w] == 1 and w in at]
        anchors = [both[k] for k in increasing([i for i, _ in both])]
        out += anchors
        if anchors:
            ends = [(a - 1, c - 1), *anchors, (b, d)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:]) if k > i + 1 and m > j + 1]
    return sorted(out)


class TemplateIndex:
    """Templates as words, and the places of each pair of neighbouring words."""

    def __init__(self, templates: dict[str, str]):
        self.words = {name: words_of(text)[0] for name, text in sorted(templates.items())}
        self.pairs: dict[tuple[str, str], dict[str, list[int]]] = {}
        for name, words in self.words.items():
            for at, pair in enumerate(zip(words, words[1:])):
                self.pairs.setdefault(pair, {}).setdefault(name, []).append(at)

    def stretches(self, words: list[str]) -> list[tuple[str, int, int]]:
        """``(template, first word, last word + 1)`` around runs of pairs in the template's order."""
        runs: dict[str, tuple[int, int, int]] = {}  # estimated first word, last word, last place
        out = []
        get = self.pairs.get
        for i, pair in enumerate(zip(words, words[1:])):
            for name, places in (get(pair) or {}).items():
                run = runs.get(name)
                if run and i - run[1] <= len(self.words[name]):
                    later = next((at for at in places if at > run[2]), None)
                    if later is not None:
                        runs[name] = (run[0], i + 1, later)
                        continue
                if run:
                    out.append((name, run[0], run[1]))
                runs[name] = (i - places[0], i + 1, places[0])
        out += [(name, first, last) for name, (first, last, _) in runs.items()]
        return [
            (name, max(0, first - 2), min(len(words), max(last + 1, first + len(self.words[name])) + 2)) for name, first, last in out
        ]

    def scan(self, text: str) -> list[dict]:
        words, places = words_of(text)
        found = []
        for name, first, last in self.stretches(words):
            template = self.words[name]
            matched = align(words[first:last], template)
            if matched and len(matched) >= COVERAGE * len(template):
                a, b = first + matched[0][0], first + matched[-1][0]
                found.append((-len(matched), name, a, b, len(matched) / len(template)))
        out: list[tuple] = []  # disjoint, by place
        for size, name, a, b, share in sorted(found):
            at = bisect_left(out, (a,))
            if (at == 0 or out[at - 1][1] < a) and (at == len(out) or out[at][0] > b):
                out.insert(at, (a, b, name, -size, share))
        return [
            {"license": name, "coverage": share, "start": places[a][0], "end": places[b][1], "words": size}
            for a, b, name, size, share in out
        ]


def templates_from(df: DataFrame, name: str = "name", text: str = "text", most: int = 5_000) -> dict[str, str]:
    """Templates of a table, for :func:`scan`; rows without a name or a word are left out, equal names are refused.

    Templates go to every task, so a table of more than ``most`` is refused too.
    """
    rows = df.select(F.col(name).alias("name"), F.col(text).alias("text")).filter("name is not null and text is not null")
    found = [(r["name"], r["text"]) for r in rows.limit(most + 1).collect()]
    if len(found) > most or len({n for n, _ in found}) < len(found):
        raise ValueError(f"templates need different names and may be {most} at most")
    return {n: t for n, t in found if WORD.search(t)}


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, text: str = "text") -> DataFrame:
    """Append ``licenses``: name, coverage, stretch in characters and matched words of each find."""

    @F.arrow_udf(LICENSES)
    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = TemplateIndex(templates)
        for texts in batches:
            yield pa.array([index.scan(x) if x else [] for x in texts.to_pylist()], _ARROW)

    return without(docs, "licenses").withColumn("licenses", look(F.col(text)))


def op8_license_scan(spark, sf_dir):
    """One row per license notice or text found in a document."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.explode("licenses").alias("l")).select(
        "doc_id", "l.license", "l.coverage", F.col("l.start").alias("start_char"), F.col("l.end").alias("end_char"), F.col("l.words").alias("n_words")
    )

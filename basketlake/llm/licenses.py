"""Operator 10: licence scans with a suffix automaton of licence texts and chains of long matches."""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlake.llm.automaton import SuffixAutomaton, known_runs
from basketlake.llm.common import table, token_words

#: Phrases whose places are counted, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Public licence notices, by label.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)
LEAST_MATCH, GAP, COVERAGE = 3, 8, 0.75


class TemplateScanner:
    """The automaton of all templates, and for each state where in which template its runs end."""

    def __init__(self, templates) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.labels = [label for label, _ in templates]
        self.ids = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in token_words(text)] for _, text in templates]
        self.phrases = [([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in p.encode().split()], label) for p, label in PHRASES.items()]
        self.automaton = SuffixAutomaton()
        for ids in self.ids:
            self.automaton.add(ids)
        self.least = min([len(p) for p, _ in self.phrases])
        self.ends: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, ids in enumerate(self.ids):
            for end, (state, _) in enumerate(self.automaton.stream(ids), 1):
                while state > 0:
                    self.ends[state].append((t, end))
                    state = self.automaton.link[state]

    def known(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter((self.vocabulary.get(w, -1) for w in words), dtype=np.int64, count=len(words))

    def places(self, ids: np.ndarray) -> list[tuple[int, str]]:
        """(start, label) of every place of a phrase."""
        out = []
        for phrase, label in self.phrases:
            if len(ids) >= len(phrase):
                hit = np.ones(len(ids) - len(phrase) + 1, dtype=bool)
                for i, word in enumerate(phrase):
                    hit &= ids[i : i + len(hit)] == word
                out += [(int(x), label) for x in np.flatnonzero(hit)]
        return out

    def matches(self, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(template, start, start in the template, length) of matches that cannot be extended, of LEAST_MATCH words or more."""
        out = []
        for a, b in known_runs(ids, LEAST_MATCH):
            walked = self.automaton.stream(ids[a:b].tolist())
            for i, (state, n) in enumerate(walked):
                if n < LEAST_MATCH or i + 1 < len(walked) and walked[i + 1][1] == n + 1:
                    continue
                out += [(t, a + i + 1 - n, end - n, n) for t, end in self.ends[state]]
        return out

    def spans(self, ids: np.ndarray) -> list[tuple[str, int, int, float]]:
        """(label, start, end, coverage) of chains that cover COVERAGE of a template.

        A chain takes matches of one template in order, in the text and in the template, with at most GAP words of the
        text between neighbours; for each match the best chain that ends with it is kept.
        """
        by: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for t, start, at, n in self.matches(ids):
            by[t].append((start, at, n))
        out = []
        for t, found in by.items():
            need = COVERAGE * len(self.ids[t])
            best: list[tuple[int, int, int, int, int]] = []  # (end, end in the template, covered, first word, own start)
            for start, at, n in sorted(found):
                total, first = n, start
                for end, end_at, c, f, _ in reversed(best):
                    if end < start - GAP - 2 * len(self.ids[t]):
                        break
                    if start - GAP <= end <= start and end_at <= at and c + n > total:
                        total, first = c + n, f
                best.append((start + n, at + n, total, first, start))
            out += [(self.labels[t], f, end, min(1.0, c / len(self.ids[t]))) for end, _, c, f, _ in best if c >= need]
        return out


@lru_cache(maxsize=2)
def scanner(templates=TEMPLATES) -> TemplateScanner:
    return TemplateScanner(templates)


RESULT = (
    "struct<n_words:long, n_base:long, first_word:long, last_word:long, base_labels:string, labels:string, score:double, "
    "spans:array<struct<label:string, start:int, end:int, coverage:double>>>"
)


def scan_text(text: str | None) -> dict:
    """What one text holds. Score: the best coverage of a template by a chain, 1 where a phrase stands."""
    it = scanner()
    ids = it.known(token_words(text or ""))
    places, spans = it.places(ids), it.spans(ids)
    base, labels = {x for _, x in places}, {x[0] for x in spans}
    starts = [x for x, _ in places]
    return {
        "n_words": len(ids), "n_base": len(places), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | labels)),
        "score": 1.0 if base else max([0.0, *(x[3] for x in spans)]),
        "spans": [{"label": a, "start": b, "end": c, "coverage": d} for a, b, c, d in sorted(set(spans))],
    }


def scan(text: Column) -> Column:
    """A struct per whole text: phrases, labels, score, and the spans of licence notices in words.

    Null and empty texts have no words and no labels; repeated rows get equal results.
    """
    kind = pa.struct([
        ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("coverage", pa.float64())]))),
    ])

    @F.arrow_udf(RESULT)
    def scanned(texts: pa.Array) -> pa.Array:
        return pa.array([scan_text(t.as_py()) for t in texts], type=kind)

    return scanned(text)


def op10(spark, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", scan(F.col("text")).alias("s"))
    return found.select("doc_id", *(F.col(f"s.{c}").alias(c) for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")))

"""License scans by template-markup matching.

A template is the wording of a license notice with two kinds of markup:
``[[ ... ]]`` is optional text (may nest), ``<<name:k>>`` a replaceable region of
1 to k words.  Templates compile to automata over words (Thompson construction,
empty moves removed); a text matches where an automaton accepts a run of its
words, that is where all mandatory wording stands exactly, in order.  Only
documents that hold all of a template's mandatory words are simulated at all.

MIT, BSD (two and three clauses), ISC and the notices of Apache 2.0 and the GPL are
whole templates: an altered rest is not accepted.  Their first words are templates of their
own (``...-opening``), so that such a text is still found, under another label.

Base labels are places where a phrase's words stand consecutively.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased.
Edge cases: NULL and empty texts have no words, no labels and score 0; every
input row gives one row, whatever its id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common as c

# Base phrases with their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# License texts and notices by label (public license wording).
_MIT_WARRANTY = ("the software is provided as is without warranty of any kind express or implied including but not limited to the "
                 "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall "
                 "<<holder:12>> be liable for any claim damages or other liability whether in an action of contract tort or "
                 "otherwise arising from out of or in connection with the software or the use or other dealings in the software")
_BSD_TERMS = ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
              "following conditions are met [[1]] redistributions of source code must retain the above copyright notice this "
              "list of conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above "
              "copyright notice this list of conditions and the following disclaimer in the documentation and or other "
              "materials provided with the distribution")
_BSD_WARRANTY = ("this software is provided by <<holder:12>> as is and any express or implied warranties including but not "
                 "limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in "
                 "no event shall <<holder:12>> be liable for any direct indirect incidental special exemplary or "
                 "consequential damages including but not limited to procurement of substitute goods or services loss of use "
                 "data or profits or business interruption however caused and on any theory of liability whether in contract "
                 "strict liability or tort including negligence or otherwise arising in any way out of the use of this "
                 "software even if advised of the possibility of such damage")
TEMPLATES = {
    "apache-2.0-notice": "licensed under the apache license version 2 0 the license you may not use this [[file]] <<work:3>> except in "
                         "compliance with the license you may obtain a copy of the license at [[http]] [[https]] [[www]] apache "
                         "org licenses license 2 0 [[html]] [[txt]] unless required by applicable law or agreed to in writing "
                         "software distributed under the license is distributed on an as is basis without warranties or "
                         "conditions of any kind either express or implied see the license for the specific language "
                         "governing permissions and limitations under the license",
    "apache-2.0-opening": "licensed under the apache license version 2 0 [[the license [[you may not use this file except in "
                          "compliance with the license]]]]",
    "bsd-2-clause": f"{_BSD_TERMS} {_BSD_WARRANTY}",
    "bsd-3-clause": f"{_BSD_TERMS} [[3]] neither the name of <<holder:12>> nor the names of [[its]] [[the]] [[other]] contributors "
                    f"may be used to endorse or promote products derived from this software without specific prior written "
                    f"permission {_BSD_WARRANTY}",
    "bsd-opening": "redistribution and use in source and binary forms with or without modification are permitted "
                   "provided that the following conditions are met",
    "cc-by-notice": "[[this work is]] licensed under [[a]] [[the]] cc by [[nc]] [[nd]] [[sa]] <<major:1>> <<minor:1>> [[license]]",
    "gpl-notice": "[[this work is]] licensed under the gnu [[lesser]] [[affero]] general public license [[version <<version:1>>]]",
    "gpl-opening": "is free software you can redistribute it and or modify it under the terms of the gnu general "
                   "public license [[version <<version:1>>]] as published by the free software foundation",
    "gpl-program-notice": "is free software you can redistribute it and or modify it under the terms of the gnu [[lesser]] [[affero]] "
                          "general public license as published by the free software foundation [[either]] version <<version:1>> "
                          "of the license [[or at your option any later version]] <<program:12>> is distributed in the hope that it "
                          "will be useful but without any warranty without even the implied warranty of merchantability or "
                          "fitness for a particular purpose see the gnu [[lesser]] [[affero]] general public license for more "
                          "details you should have received a copy of the gnu [[lesser]] [[affero]] general public license along "
                          "with <<program:12>>",
    "isc": "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted "
           "provided that the above copyright notice and this permission notice appear in all copies the software is provided "
           "as is and <<author:12>> disclaims all warranties with regard to this software including all implied warranties of "
           "merchantability and fitness in no event shall <<author:12>> be liable for any special direct indirect or "
           "consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action "
           "of contract negligence or other tortious action arising out of or in connection with the use or performance of "
           "this software",
    "isc-opening": "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is "
                   "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
           "documentation files the software to deal in the software without restriction including without limitation the rights "
           "to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to "
           "whom the software is furnished to do so subject to the following conditions the above copyright notice and this "
           "permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the "
           f"software {_MIT_WARRANTY}",
    "mit-notice": "[[<<work:6>> is]] released under the mit license",
    "mit-opening": "permission is hereby granted free of charge to any person obtaining a copy of this <<software:4>> "
                   "[[and associated documentation files]] [[the <<name:2>>]] to deal in the <<software:4>> without restriction",
}
OPENING = "-opening"  # labels of a license's first words alone, whatever follows

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARK = re.compile(r"\[\[|\]\]|<<\w+:\d+>>|[^\s\[\]<>]+")


def parse(template: str) -> list:
    """Nested items: a word (str), a region's most words (int), an optional part (list)."""
    stack: list[list] = [[]]
    for t in _MARK.findall(template):
        if t == "[[":
            stack.append([])
        elif t == "]]":
            part = stack.pop()
            stack[-1].append(part)
        elif t.startswith("<<"):
            stack[-1].append(int(t[2:-2].split(":")[1]))
        else:
            stack[-1].append(t.lower())
    if len(stack) != 1:
        raise ValueError(f"unbalanced markup: {template}")
    return stack[0]


class Automaton:
    """Word automaton of one template."""

    def __init__(self, template: str):
        items = parse(template)
        self.words: list[tuple[bytes | None, int]] = []  # state -> (word or any, next state)
        self.empty: list[list[int]] = []
        start = self._state()
        end = self._sequence(items, start)
        self.final = end
        self.closed = [self._closure(s) for s in range(len(self.words))]
        self.start = self.closed[start]
        self.mandatory = frozenset(w.encode() for w in items if isinstance(w, str))
        if not self.mandatory:
            raise ValueError(f"no mandatory wording: {template}")
        self.gate = max(sorted(self.mandatory), key=len)
        self.first = frozenset(self.words[s][0] for s in self.start if self.words[s][1] >= 0)

    def _state(self) -> int:
        self.words.append((None, -1))
        self.empty.append([])
        return len(self.words) - 1

    def _sequence(self, items: list, at: int) -> int:
        for item in items:
            if isinstance(item, str):
                to = self._state()
                self.words[at] = (item.encode(), to)
            elif isinstance(item, int):
                past = self._state()
                for k in range(item):
                    to = self._state()
                    self.words[at] = (None, to)
                    self.empty[to].append(past)
                    at = to
                to = past
            else:
                inner = self._state()
                self.empty[at].append(inner)
                to = self._sequence(item, inner)
                past = self._state()
                self.empty[to].append(past)
                self.empty[at].append(past)
                to = past
            at = to
            nxt = self._state()
            self.empty[at].append(nxt)
            at = nxt
        return at

    def _closure(self, s: int) -> frozenset[int]:
        seen, todo = {s}, [s]
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def match(self, words: list[bytes], at: int) -> int:
        """End of the longest accepted run of words from ``at``; -1 if none."""
        live, end = self.start, -1
        while live:
            if self.final in live:
                end = at
            if at >= len(words):
                break
            w, nxt = words[at], set()
            for s in live:
                word, to = self.words[s]
                if to >= 0 and (word is None or word == w):
                    nxt |= self.closed[to]
            live, at = nxt, at + 1
        return end


class Scanner:
    def __init__(self, base: dict[str, str], templates: dict[str, str]):
        self.base = [(tuple(p.encode().split()), label) for p, label in sorted(base.items())]
        self.templates = [(Automaton(t), label) for label, t in sorted(templates.items())]
        self.gates = frozenset(p[0] for p, _ in self.base) | frozenset(a.gate for a, _ in self.templates)

    def scan(self, words: list[bytes]):
        """Places of base phrases, their labels, and template hits (label, first, past)."""
        if self.gates.isdisjoint(words):
            return [], set(), []
        own, places, labels, hits = set(words), [], set(), []
        for phrase, label in self.base:
            if own.issuperset(phrase):
                k = len(phrase)
                found = [i for i, w in enumerate(words) if w == phrase[0] and tuple(words[i:i + k]) == phrase]
                places += found
                labels |= {label} if found else set()
        for auto, label in self.templates:
            if own.issuperset(auto.mandatory):
                for i, w in enumerate(words):
                    if w in auto.first or None in auto.first:
                        end = auto.match(words, i)
                        if end >= 0:
                            hits.append((label, i, end))
        return places, labels, hits


def _score(labels: set, hits: list) -> float:
    if any(not label.endswith(OPENING) for label, _, _ in hits):
        return 1.0
    return 0.75 if hits else 0.5 if labels else 0.0


def scan(docs: DataFrame, base: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, matches): score is 1 with an accepted license or notice, 3/4 with an opening,
    1/2 with base phrases only, else 0; ``matches`` are the accepted runs (label, first, past)."""
    base, templates = BASE if base is None else base, TEMPLATES if templates is None else templates
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("past", pa.int64())])
    kinds = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
             ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
             ("matches", pa.list_(span))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, templates)
        for b in batches:
            data, offs = c.text_buffers(b.column(1))
            raw = c.ascii_lower(data).tobytes()
            out = []
            for i in range(b.num_rows):
                words = _WORD.findall(raw, offs[i], offs[i + 1])
                places, labels, hits = scanner.scan(words)
                every = labels | {h[0] for h in hits}
                out.append((len(words), len(places), min(places, default=None), max(places, default=None),
                            ",".join(sorted(labels)), ",".join(sorted(every)), _score(labels, hits),
                            [dict(zip(("label", "first", "past"), h)) for h in hits]))
            cols = list(zip(*out)) if out else [[]] * (len(kinds) - 1)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, t) for v, (_, t) in zip(cols, kinds[1:]))],
                                             names=[k for k, _ in kinds])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
             "score double, matches array<struct<label:string,first:long,past:long>>")


def _regex(items: list) -> str:
    """A template over text whose words are each followed by one space."""
    out = ""
    for item in items:
        if isinstance(item, str):
            out += re.escape(item) + " "
        elif isinstance(item, int):
            out += f"(?:[^ ]+ ){{1,{item}}}"
        else:
            out += f"(?:{_regex(item)})?"
    return out


def oracle(base: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> str:
    """DuckDB SQL: phrases by list positions, templates as regular expressions."""
    base, templates = BASE if base is None else base, TEMPLATES if templates is None else templates
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    places, flags = [], []
    for phrase, label in sorted(base.items()):
        w = phrase.split()
        test = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(w))
        places.append(f"list_filter(range(1, len(w) + 1), lambda i: {test})")
        flags.append((label, f"contains(joined, ' {phrase} ')"))
    more = [(label, f"regexp_matches(joined, '(^| ){_regex(parse(t))}')") for label, t in sorted(templates.items())]

    def joined(tests):
        cases = ", ".join(f"CASE WHEN {t} THEN '{label}' END" for label, t in tests)
        return f"array_to_string(list_sort(list_distinct(list_filter([{cases}], lambda x: x IS NOT NULL))), ',')"
    any_full, any_opening = (" OR ".join(t for label, t in more if label.endswith(OPENING) == o) or "FALSE" for o in (False, True))
    any_base = " OR ".join(t for _, t in flags)
    return rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
spots AS (
  SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS joined,
         flatten([{', '.join(places)}]) AS spot FROM words)
SELECT doc_id, len(w)::BIGINT AS n_words, len(spot)::BIGINT AS n_base, (list_min(spot) - 1)::BIGINT AS first_word,
       (list_max(spot) - 1)::BIGINT AS last_word, {joined(flags)} AS base_labels, {joined(flags + more)} AS labels,
       CASE WHEN {any_full} THEN 1.0 WHEN {any_opening} THEN 0.75 WHEN {any_base} THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM spots
"""

"""License scans by template-markup matching.

A template is a license's wording in words, with optional regions ``[...]``
(which may nest) and replaceable regions ``<n>`` (any 0 to n words: names,
years). It is compiled into a token automaton: a word edge for every mandatory
word, an empty edge around each optional region, wildcard edges in replaceable
ones. A place is accepted if the mandatory wording stands there exactly, word
by word, whatever the case, punctuation and line breaks; the longest
acceptance counts. Base phrases are found apart from the templates and always
count.

Words are runs of digits, letters and non-ASCII characters after lower-casing
A-Z. Null texts count as empty (no words, no labels, score 0); repeated rows
each get their result; an empty table gives an empty result; whole texts are
read, whatever their length. Only the id and text columns are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pondlens.llm import textops as T

# Base phrases and labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_GRANT = ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
          "documentation files the software to deal in the software without restriction including without limitation the "
          "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
          "persons to whom the software is furnished to do so subject to the following conditions ")
_BSD = ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met [1] redistributions of source code must retain the above copyright notice this list "
        "of conditions and the following disclaimer [2] redistributions in binary form must reproduce the above copyright "
        "notice this list of conditions and the following disclaimer in the documentation and or other materials provided "
        "with the distribution ")

# Wording of public licenses and of their usual notices.
TEMPLATES = {
    "mit": [_GRANT + "the above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the software [the software is provided as is without warranty of any kind]",
            "[released | licensed | distributed | available] under the [terms of the] mit license",
            "spdx license identifier mit"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"],
    "bsd-2": [_BSD + "this software is provided by <12> as is"],
    "bsd-3": [_BSD + "[3] neither the name of <12> nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission"],
    "apache-2": ["licensed under the apache license version 2 [0] [the license]", "spdx license identifier apache 2 0"],
    "gpl-2": ["licensed under the gnu general public license [as published by the free software foundation] version 2",
              "spdx license identifier gpl 2 0"],
    "gpl-3": ["licensed under the gnu general public license [as published by the free software foundation] version 3",
              "redistribute it and or modify it under the terms of the gnu general public license as published by the free "
              "software foundation either version 3", "spdx license identifier gpl 3 0"],
    "lgpl": ["[licensed] under the [terms of the] gnu lesser general public license [as published by the free software "
             "foundation] [either] version <1>"],
    "mpl-2": ["subject to the terms of the mozilla public license v 2 0", "spdx license identifier mpl 2 0"],
    "cc-by": ["licensed under [a | the] [creative commons] cc by 4 0",
              "licensed under [a | the] creative commons attribution [3 | 4] [0] [international] license"],
    "cc-by-sa": ["licensed under [a | the] [creative commons] cc by sa",
                 "licensed under [a | the] creative commons attribution sharealike [3 | 4] [0] [international] license"],
    "cc-by-nc": ["licensed under [a | the] [creative commons] cc by nc [3 | 4] [0]",
                 "licensed under [a | the] creative commons attribution noncommercial [3 | 4] [0] [international] license"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}


class Automaton:
    """A token automaton over several templates; ``accept`` maps a state to its label.

    ``step[s]`` maps a word to the next state; ``skip[s]`` are the states
    reached without a word; ``wild[s]`` is the state reached by any word.
    """

    def __init__(self, templates: dict[str, list[str]]):
        self.step: list[dict[bytes, int]] = []
        self.skip: list[list[int]] = []
        self.wild: list[int] = []
        self.accept: dict[int, str] = {}
        starts = []
        for label, texts in templates.items():
            for text in texts:
                first = self._new()
                starts.append(first)
                tokens = re.findall(r"\[|\]|\||<\d+>|[^\s\[\]|<>]+", text)
                end, rest = self._sequence(first, tokens)
                if rest:
                    raise ValueError(f"unbalanced region in template of {label}")
                self.accept[end] = label
        self.close = [self._closure(s) for s in range(len(self.step))]
        #: first word -> states after it
        self.starts: dict[bytes, set[int]] = {}
        for s in starts:
            for t in self.close[s]:
                for word, to in self.step[t].items():
                    self.starts.setdefault(word, set()).update(self.close[to])

    def _new(self) -> int:
        self.step.append({})
        self.skip.append([])
        self.wild.append(-1)
        return len(self.step) - 1

    def _sequence(self, at: int, tokens: list[str]) -> tuple[int, list[str]]:
        """Add tokens from state ``at`` up to a closing bracket or the end."""
        while tokens and tokens[0] not in "]|":
            token, *tokens = tokens
            if token == "[":
                end = self._new()
                self.skip[at].append(end)
                while True:
                    branch = self._new()
                    self.skip[at].append(branch)
                    last, tokens = self._sequence(branch, tokens)
                    self.skip[last].append(end)
                    if not tokens:
                        raise ValueError("an optional region is not closed")
                    mark, *tokens = tokens
                    if mark == "]":
                        break
                at = end
            elif token[0] == "<":
                end = self._new()
                for _ in range(int(token[1:-1])):
                    self.skip[at].append(end)
                    self.wild[at] = self._new()
                    at = self.wild[at]
                self.skip[at].append(end)
                at = end
            else:
                to = self._new()
                self.step[at][token.encode()] = to
                at = to
        return at, tokens

    def _closure(self, s: int) -> frozenset[int]:
        seen, todo = {s}, [s]
        while todo:
            for t in self.skip[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def matches(self, words: list[bytes]) -> list[tuple[str, int, int]]:
        """(label, first word, end word) of the longest acceptance of each label at each place."""
        found = []
        for i, w in enumerate(words):
            states = self.starts.get(w)
            if not states:
                continue
            ends, j = {}, i + 1
            while states:
                for s in states:
                    if s in self.accept:
                        ends[self.accept[s]] = j
                if j == len(words):
                    break
                nxt: set[int] = set()
                for s in states:
                    to = self.step[s].get(words[j], -1)
                    if to >= 0:
                        nxt |= self.close[to]
                    if self.wild[s] >= 0:
                        nxt |= self.close[self.wild[s]]
                states, j = nxt, j + 1
            found += [(label, i, end) for label, end in ends.items()]
        return found


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: A text that holds none of these has neither a base phrase nor an accepted template.
ANCHOR = re.compile(rb"licen|cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+by|permission|redistribution|unencumbered")
SPAN = "struct<label:string,start:bigint,end:bigint>"


def base_places(words: list[bytes]) -> list[tuple[str, int, int]]:
    """(label, first word, end word) of every place of a base phrase."""
    found = []
    for phrase, label in BASE.items():
        p = phrase.encode().split()
        found += [(label, i, i + len(p)) for i, w in enumerate(words) if w == p[0] and words[i:i + len(p)] == p]
    return sorted(found, key=lambda x: x[1:])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, n_words, base and found (arrays of label, start, end in words)."""
    T.bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    automaton = Automaton(TEMPLATES if templates is None else templates)
    anchored = templates is None

    def run(batches):
        span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            n, base, found = [np.zeros(0, np.int64)], [], []
            for block in T.blocks(b["text"]):
                low = T.lowered(block)
                n.append(np.diff(T.words(low, T.PLAIN_WORD)[2]))
                data, off = low.data.tobytes(), low.offsets.tolist()
                for lo, hi in zip(off[:-1], off[1:]):
                    if anchored and not ANCHOR.search(data, lo, hi):
                        base.append([])
                        found.append([])
                        continue
                    words = WORD.findall(data, lo, hi)
                    base.append([dict(zip(("label", "start", "end"), x)) for x in base_places(words)])
                    found.append([dict(zip(("label", "start", "end"), x)) for x in automaton.matches(words)])
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(np.concatenate(n).astype(np.int64)), pa.array(base, type=span), pa.array(found, type=span)],
                names=["doc_id", "n_words", "base", "found"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, base array<{SPAN}>, found array<{SPAN}>")


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is the share of the text's words that lie in a base phrase or an
    accepted template, counted from each region's own words (1 at most).
    """
    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    every = F.concat("base", "found")
    starts = F.transform("base", lambda s: s["start"])
    # regions sorted by start; each adds what lies beyond the furthest end so far
    order = F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"))))
    zero = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("sum"))
    covered = F.aggregate(order, zero, lambda acc, s: F.struct(
        F.greatest(acc["end"], s["b"]).alias("end"),
        (acc["sum"] + F.greatest(s["b"] - F.greatest(acc["end"], s["a"]), F.lit(0))).alias("sum")))["sum"]
    score = F.when(F.col("n_words") > 0, covered / F.col("n_words")).otherwise(0.0)
    return scanned.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
                          F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                          labels(F.col("base")).alias("base_labels"), labels(every).alias("labels"),
                          score.cast("double").alias("score"))

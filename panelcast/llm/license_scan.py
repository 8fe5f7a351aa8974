"""Licence scan with a positional index of rare template words.

The corpus decides which licence words are rare: one pass counts in how many texts each word of the templates
occurs (a count per word and task is all that is shuffled). A template is indexed by word: for every word the
positions at which it stands. For a text, its licence words of highest idf are looked up; each meeting of a
text position with a template position votes for their difference, where the template would begin. A beginning
with enough votes is scored by the idf of the template words that stand in their place, and counts only if a
phrase without which the licence is not that licence stands within it.

Besides, the plain names of licences are found wherever their words stand side by side.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from dataclasses import dataclass
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import bounded_batches, raw, text_or_empty

#: Names of licences and their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
#: Fixed values: (label, public notice or opening of a licence, phrases of which one must be present).
TEMPLATES = (
    ("mit", "Released under the MIT License", ("mit license",)),
    ("mit", "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the Software to deal in the Software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the Software", ("permission is hereby granted free of charge",)),
    ("apache", "Licensed under the Apache License Version 2 0 the License you may not use this file except in compliance with the License", ("apache license",)),
    ("apache", "Licensed under the Apache License Version 2 0", ("apache license",)),
    ("gpl", "This work is licensed under the GNU General Public License version 3", ("general public license",)),
    ("gpl", "This program is free software you can redistribute it and or modify it under the terms of the GNU General Public License as published by the Free Software Foundation either version 3 of the License or at your option any later version", ("general public license", "free software foundation")),
    ("bsd", "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms",)),
    ("isc", "Permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ("with or without fee",)),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License v 2 0", ("mozilla public license",)),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4 0 International License", ("creative commons attribution",)),
    ("cc-by", "Licensed under CC BY 4 0", ("cc by 4", "cc by 3", "cc by 2")),
    ("cc-by-nc", "Licensed under CC BY NC 4 0", ("cc by nc",)),
    ("cc-by-sa", "Licensed under CC BY SA 4 0", ("cc by sa",)),
    ("unlicense", "This is free and unencumbered software released into the public domain", ("released into the public domain",)),
)
#: Of a text's licence words, the share of highest idf that is looked up, and the least number.
RARE_SHARE, RARE_LEAST = 0.6, 8
#: Score from which a template counts as present.
ENOUGH = 0.75
#: A beginning needs a vote for so many words of its template.
LEAST_VOTES = 6
#: Words by which an edited copy may be shifted inside a template.
SHIFT = 2
SEPARATORS = bytes([b for b in range(0x80) if not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)])
CLEAN = bytes(0x20 if b in SEPARATORS and not 0x41 <= b <= 0x5A else (b + 32 if 0x41 <= b <= 0x5A else b) for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words: runs of digits, letters and everything beyond ASCII."""
    return text.translate(CLEAN).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    keys: tuple[bytes, ...]


def templates() -> list[Template]:
    return [Template(label, tuple(words_of(text.encode())), tuple(k.encode() for k in keys)) for label, text, keys in TEMPLATES]


def document_frequency(df: DataFrame, text: str = "text") -> tuple[int, dict[bytes, int]]:
    """Number of texts, and for each template word the number of texts that hold it. The list of words is fixed."""
    bounded_batches(df.sparkSession)
    wanted = sorted({w for t in templates() for w in t.words})

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, known = Counter(), frozenset(wanted)
        for batch in batches:
            for value in raw(batch.column(0)):
                found.update(known.intersection(words_of(value)))
                found[b""] += 1
        yield pa.RecordBatch.from_pydict({"word": [w.decode() for w in found], "texts": list(found.values())})

    each = df.select(text_or_empty(text).alias("text")).mapInArrow(counted, "word string, texts bigint")
    sums = {r["word"].encode(): r["texts"] for r in each.groupBy("word").agg(F.sum("texts").alias("texts")).collect()}
    return sums.pop(b"", 0), sums


class Index:
    """Postings of the template words, with their idf."""

    def __init__(self, texts: int, frequency: dict[bytes, int]):
        self.templates = templates()
        self.idf = {w: math.log((texts + 1) / (frequency.get(w, 0) + 1)) + 1.0 for t in self.templates for w in t.words}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for i, t in enumerate(self.templates):
            for at, w in enumerate(t.words):
                self.postings[w].append((i, at))
        self.whole = [sum(self.idf[w] for w in t.words) for t in self.templates]

    def beginnings(self, places: dict[bytes, list[int]]) -> dict[tuple[int, int], int]:
        """Votes for (template, first word): meetings of the text's rarest licence words with the index."""
        ranked = sorted(places, key=lambda w: (-self.idf[w], w))
        votes: dict[tuple[int, int], int] = Counter()
        for w in ranked[: max(RARE_LEAST, math.ceil(RARE_SHARE * len(ranked)))]:
            for i, at in self.postings[w]:
                for place in places[w]:
                    votes[i, place - at] += 1
        return votes

    def score(self, i: int, begin: int, places: dict[bytes, list[int]]) -> float:
        """Share, by idf, of the template words that stand where the beginning puts them, give or take a shift."""
        got = 0.0
        for at, w in enumerate(self.templates[i].words):
            spots = places.get(w)
            if spots:
                k = bisect_left(spots, begin + at - SHIFT)
                if k < len(spots) and spots[k] <= begin + at + SHIFT:
                    got += self.idf[w]
        return got / self.whole[i]

    def matches(self, words: list[bytes]) -> tuple[list[str], float]:
        """Labels whose templates are present, and the best score of any template that has its key phrase."""
        places: dict[bytes, list[int]] = defaultdict(list)
        idf = self.idf
        for at, w in enumerate(words):
            if w in idf:
                places[w].append(at)
        labels, best = set(), 0.0
        for (i, begin), votes in self.beginnings(places).items():
            t = self.templates[i]
            if votes * LEAST_VOTES < len(t.words):
                continue
            score = self.score(i, begin, places)
            if score <= best and score < ENOUGH:
                continue
            around = b" " + b" ".join(words[max(0, begin - SHIFT) : begin + len(t.words) + SHIFT]) + b" "
            if any(b" " + k + b" " in around for k in t.keys):
                best = max(best, score)
                if score >= ENOUGH:
                    labels.add(t.label)
        return sorted(labels), min(best, 1.0)


def named(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place at which the words of a licence's name stand side by side."""
    found: list[tuple[int, str]] = []
    if b"license" not in words:
        return found
    joined = b" " + b" ".join(words) + b" "
    for phrase, label in PHRASES:
        needle = b" " + phrase.encode() + b" "
        at, word, before = joined.find(needle), 0, 0
        while at >= 0:
            word += joined.count(b" ", before, at)
            before = at
            found.append((word, label))
            at = joined.find(needle, at + 1)
    return sorted(found)


RESULT = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, n_base, first_word, last_word, base_labels, labels and score for every text.

    ``labels`` holds the names found and the templates present, both distinct, sorted and comma-joined; a text
    with a licence's name scores 1. Null and empty texts have no words, no labels and score 0. Columns of these
    names are replaced, all others and repeated rows stay; an empty table gives an empty result.
    """
    bounded_batches(df.sparkSession)
    texts, frequency = document_frequency(df, text)

    @F.arrow_udf("struct<" + ", ".join(c.replace(" ", ": ", 1) for c in RESULT.split(", ")) + ">")
    def scanned(values: pa.Array) -> pa.Array:
        index = Index(texts, frequency)
        columns: list[list] = [[] for _ in range(7)]
        for value in raw(values):
            words = words_of(value)
            base = named(words)
            labels, score = index.matches(words)
            plain = sorted({label for _, label in base})
            row = (
                len(words),
                len(base),
                base[0][0] if base else None,
                base[-1][0] if base else None,
                ",".join(plain),
                ",".join(sorted({*plain, *labels})),
                1.0 if base else score,
            )
            for column, v in zip(columns, row):
                column.append(v)
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = [c.split(" ")[0] for c in RESULT.split(", ")]
        return pa.StructArray.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names)

    found = df.withColumn("_licence", scanned(text_or_empty(text)))
    return found.withColumns({c.split(" ")[0]: F.col(f"_licence.{c.split(' ')[0]}") for c in RESULT.split(", ")}).drop("_licence")

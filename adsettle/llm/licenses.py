"""License scans: base phrases, and an exact set-similarity join of text blocks with license templates.

Blocks are lines, paragraphs (lines between blank ones) and all windows of as many words as the template has, whatever
line ends they cross, so that a wrapped notice is found. A block is joined with a template if it holds at least
THRESHOLD of the template's distinct words. Words are ordered by their frequency in the whole corpus, rarest first. A
block that holds at least o of a template's t words holds one of the template's first t - o + 1 (prefix filter), has at
least o distinct words itself (length filter), and the words that both still have behind a first common one must suffice
for o (positional filter). What passes is counted exactly, so every such block is found and no other. The same filters
run over the whole text first: a template that the text as one block isn't joined with is joined with none of its blocks.

Words alone don't make a notice: a long sentence may hold those of a short one in any order. A joined block therefore
matches only if it also holds IN_ORDER of the template's distinct pairs of neighbouring words.

Templates are a fixed, small list and go to every task with the counts of their words; nothing else is broadcast.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from dataclasses import dataclass
from itertools import chain, groupby
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsettle.llm.base import bytes_of, query, table, with_text_columns

THRESHOLD = 0.9
IN_ORDER = 0.85

# Phrases of the base rules and their labels.
PHRASES = {
    b"cc by": "cc-by",
    b"general public license": "gpl",
    b"all rights reserved": "reserved",
}

# Usual notices of public licenses, and the method's labels.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit", "Released under the MIT License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("gpl", "Licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"),
    ("cc-by", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("public-domain", "This work is dedicated to the public domain"),
    ("reserved", "Copyright all rights reserved"),
    ("mit", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not "
     "limited to the warranties of merchantability, fitness for a particular purpose and noninfringement"),
    ("bsd", "This software is provided by the copyright holders and contributors \"as is\" and any express or implied "
     "warranties, including, but not limited to, the implied warranties of merchantability and fitness for a "
     "particular purpose are disclaimed"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
     "be held liable for any damages arising from the use of this software"),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
     "software and accompanying documentation covered by this license"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
     "published by the Free Software Foundation"),
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
     "published by the Free Software Foundation"),
    ("gfdl", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
     "Documentation License"),
    ("cc0", "has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide "
     "under copyright law"),
    ("cc-by-sa", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nd", "Licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
     "License"),
    ("ofl-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1"),
]

#: ASCII letters and digits and everything beyond ASCII make words; A-Z are lowered.
TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
#: The same with line ends kept, to cut blocks.
TO_LINES = TO_WORDS[:10] + b"\n" + TO_WORDS[11:]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


def pairs_of(words: list[bytes]) -> list[tuple[bytes, bytes]]:
    return list(zip(words, words[1:]))


@dataclass
class Templates:
    """Templates as token lists in the order of global frequency."""

    tokens: list[list[bytes]]
    labels: list[str]
    sizes: list[int]  # words of each template, repeated ones too
    pairs: list[frozenset[tuple[bytes, bytes]]]
    threshold: float = THRESHOLD
    in_order: float = IN_ORDER

    @staticmethod
    def order(templates: list[tuple[str, str]], counts: dict[bytes, int], threshold: float = THRESHOLD) -> Templates:
        lists = [words_of(text.encode()) for _, text in templates]
        return Templates(
            [sorted(set(x), key=lambda w: (counts.get(w, 0), w)) for x in lists], [label for label, _ in templates],
            [len(x) for x in lists], [frozenset(pairs_of(x)) for x in lists], threshold,
        )

    def __post_init__(self) -> None:
        self.overlap = [ceil(self.threshold * len(t) - 1e-9) for t in self.tokens]
        self.neighbours = [ceil(self.in_order * len(p) - 1e-9) for p in self.pairs]
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for i, tokens in enumerate(self.tokens):
            for place, token in enumerate(tokens[: len(tokens) - self.overlap[i] + 1]):
                self.prefix.setdefault(token, []).append((i, place))
        self.starts = frozenset(self.prefix)

    def matches(self, block: set[bytes]) -> dict[int, float]:
        """Containment by template of those that the block matches."""
        first: dict[int, int] = {}
        for token in self.starts & block:
            for i, place in self.prefix[token]:
                first[i] = min(place, first.get(i, place))
        found = {}
        for i, place in first.items():
            need, tokens = self.overlap[i], self.tokens[i]
            if len(block) < need or len(tokens) - place < need:
                continue
            shared = len(block.intersection(tokens))
            if shared >= need:
                found[i] = shared / len(tokens)
        return found

    def ordered(self, words: list[bytes], i: int) -> bool:
        """Whether enough of template i's pairs of neighbours stand in a block."""
        return len(self.pairs[i].intersection(pairs_of(words))) >= self.neighbours[i]

    def window(self, words: list[bytes], i: int) -> float:
        """The greatest containment of template i in a window of its size that matches, 0 where none does."""
        tokens, size, most = frozenset(self.tokens[i]), self.sizes[i], 0
        held, pairs = Held(), Held()
        before = None
        for place, word in enumerate(words):
            if word in tokens:
                held.leave(place - size)
                pairs.leave(place - size + 1)  # a pair lies at its second word
                held.add(place, word)
                if (before, word) in self.pairs[i]:
                    pairs.add(place, (before, word))
                if len(pairs.counts) >= self.neighbours[i]:
                    most = max(most, len(held.counts))
            before = word
        return most / len(tokens) if most >= self.overlap[i] else 0.0


class Held:
    """What a window that moves on holds, and how often."""

    def __init__(self):
        self.places: deque[tuple[int, object]] = deque()
        self.counts: Counter = Counter()

    def add(self, place: int, what: object) -> None:
        self.places.append((place, what))
        self.counts[what] += 1

    def leave(self, last: int) -> None:
        """Forget what lies at ``last`` or before."""
        while self.places and self.places[0][0] <= last:
            _, what = self.places.popleft()
            self.counts[what] -= 1
            if not self.counts[what]:
                del self.counts[what]


def phrase_places(joined: bytes, phrase: bytes) -> list[int]:
    """Where the phrase stands in words joined, begun and ended by spaces. Places may overlap."""
    return [m.start() for m in re.finditer(b"(?= " + re.escape(phrase) + b" )", joined)]


def scan(text: bytes, templates: Templates) -> tuple:
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" "
    base, places = set(), []
    for phrase, label in PHRASES.items():
        if phrase in joined and (own := phrase_places(joined, phrase)):
            base.add(label)
            places += own
    labels, score = set(base), 1.0 if base else 0.0
    if proposed := templates.matches(set(words)):
        found = [(i, templates.window(words, i)) for i in proposed]
        lines = [line.split() for line in text.translate(TO_LINES).split(b"\n")]
        paragraphs = [list(chain.from_iterable(own)) for some, own in groupby(lines, bool) if some]
        for block in lines + paragraphs:
            found += [(i, x) for i, x in templates.matches(set(block)).items() if templates.ordered(block, i)]
        for i, containment in found:
            if containment:
                labels.add(templates.labels[i])
                score = max(score, containment)
    first = joined[: min(places)].count(b" ") if places else None
    last = joined[: max(places)].count(b" ") if places else None
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score


def word_counts(docs: DataFrame, words: set[bytes]) -> dict[bytes, int]:
    """How often each of the few given words stands in the whole corpus."""

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for text in bytes_of(batch.column(0)):
                if text:
                    total.update(filter(words.__contains__, words_of(text)))
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(list(total), pa.binary()), "n": pa.array(list(total.values()), pa.int64())}
        )

    counted = docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in counted.collect()}


RESULT = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(),
}


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """doc_id and what the scan finds in each row's whole text.

    score is the greatest containment of a matched template, 1 where a base phrase stands, else 0. Null and empty
    texts have no words and no labels. Repeated rows get the same result each; other columns are not looked at.
    """
    docs = docs.select("doc_id", "text")
    known = {w for _, text in templates for w in words_of(text.encode())}
    ordered = Templates.order(templates, word_counts(docs, known))

    def rows(texts: list[bytes | None]) -> dict[str, pa.Array]:
        found = [scan(t or b"", ordered) for t in texts]
        return {f: pa.array([x[i] for x in found], kind) for i, (f, kind) in enumerate(RESULT.items())}

    added = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return with_text_columns(docs, "text", added, rows).drop("text")


@query()
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return license_scan(table(spark, sf_dir, "documents"))

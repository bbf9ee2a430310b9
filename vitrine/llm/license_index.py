"""Licence scan with a positional index of rare words.

The words of licence texts are indexed by template and position. The rarest places of
each template in the corpus are its probes, so many that any notice with MIN_SHARE of
the words keeps MIN_VOTES of them; probes found in a file vote for a template at a
relative position, and a place with enough votes is verified word by word and by the
template's mandatory phrase.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import batch_of, folded_words, slices, texts

# Phrases whose places are counted in every file, with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Label, notice or its best known passage, mandatory phrase.
TEMPLATES = (
    ("agpl-3.0", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "affero general public license"),
    ("agpl-3.0", "licensed under the GNU Affero General Public License, version 3", "affero general public license"),
    ("apache-2.0", "licensed under the Apache License, Version 2.0", "apache license"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http www apache org licenses LICENSE-2.0", "apache org licenses"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met", "source and binary forms"),
    ("bsd", "released under the BSD license", "bsd license"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0", "cc by nc"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "attribution noncommercial"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0", "cc by sa"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "attribution sharealike"),
    ("cc-by", "licensed under CC BY 4.0", "cc by 4"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License", "attribution 4 0 international"),
    ("cc0", "dedicated to the public domain under CC0 1.0 Universal", "cc0 1 0"),
    ("gpl", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version", "gnu general public license"),
    ("gpl-3.0", "this work is licensed under the GNU General Public License, version 3", "public license version 3"),
    ("gpl-2.0", "this work is licensed under the GNU General Public License, version 2", "public license version 2"),
    ("isc", "Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted",
     "with or without fee is hereby granted"),
    ("lgpl", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "lesser general public license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
     "hereby granted free of charge"),
    ("mit", "released under the MIT license", "mit license"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license"),
    ("unlicense", "This is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
MIN_VOTES = 2
SHIFT = 2  # words by which a place may drift inside a notice
MIN_SHARE, BASE_SCORE = 0.7, 0.5
SCANNED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                     ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])
SCANNED_SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def probes(length: int) -> int:
    """Places of a template of which MIN_VOTES stand in any notice with MIN_SHARE of them."""
    return min(length, sum(missing / length <= 1 - MIN_SHARE + 1e-9 for missing in range(1, length)) + MIN_VOTES)


def split(text: str) -> list[bytes]:
    return folded_words(text.encode())


@dataclass
class Index:
    templates: list[tuple[str, list[bytes], list[bytes]]]
    postings: dict[bytes, list[tuple[int, int]]]
    base: dict[bytes, list[tuple[list[bytes], str]]]

    @classmethod
    def build(cls, holders: dict[bytes, int]) -> Index:
        """Postings of each template's rarest places; `holders` has the documents with a word."""
        templates = [(label, split(text), split(phrase)) for label, text, phrase in TEMPLATES]
        postings: dict[bytes, list[tuple[int, int]]] = {}
        for number, (_, words, _) in enumerate(templates):
            rare = sorted(range(len(words)), key=lambda at: (holders.get(words[at], 0), words[at], at))[:probes(len(words))]
            for at in sorted(rare):
                postings.setdefault(words[at], []).append((number, at))
        base: dict[bytes, list[tuple[list[bytes], str]]] = {}
        for phrase, label in PHRASES:
            base.setdefault(split(phrase)[0], []).append((split(phrase), label))
        return cls(templates, postings, base)

    def places(self, words: list[bytes]) -> list[tuple[int, str]]:
        """Starts and labels of the base phrases."""
        out = []
        if not self.base.keys().isdisjoint(words):
            for i, word in enumerate(words):
                for phrase, label in self.base.get(word, ()):
                    if words[i:i + len(phrase)] == phrase:
                        out.append((i, label))
        return out

    def candidates(self, words: list[bytes]) -> set[tuple[int, int]]:
        """Templates and starts at which MIN_VOTES different probes agree, give or take SHIFT words."""
        if self.postings.keys().isdisjoint(words):
            return set()
        votes: dict[tuple[int, int], set[int]] = {}
        for i, word in enumerate(words):
            for number, at in self.postings.get(word, ()):
                for drift in range(-SHIFT, SHIFT + 1):
                    votes.setdefault((number, i - at + drift), set()).add(at)
        return {k for k, v in votes.items() if len(v) >= MIN_VOTES}

    def verified(self, words: list[bytes]) -> dict[str, float]:
        """Labels of the templates found, with the best share of their words in place."""
        out: dict[str, float] = {}
        for number, start in self.candidates(words):
            label, template, phrase = self.templates[number]
            lo = max(0, start - SHIFT)
            near = words[lo:start + len(template) + SHIFT]
            if not any(near[i:i + len(phrase)] == phrase for i in range(len(near) - len(phrase) + 1)):
                continue
            hits = sum(word in words[max(0, start + at - SHIFT):max(0, start + at + SHIFT + 1)] for at, word in enumerate(template))
            share = hits / len(template)
            if share >= MIN_SHARE:
                out[label] = max(out.get(label, 0.0), share)
        return out


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task the documents that hold each licence word."""
    vocabulary = {w for _, text, _ in TEMPLATES for w in split(text)}
    found: Counter[bytes] = Counter()
    for batch in batches:
        for part in slices(batch):
            for text in part.column("text").to_pylist():
                found.update(vocabulary.intersection(folded_words(text)))
    words = sorted(found)
    yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([found[w] for w in words], pa.int64())], names=["word", "n"])


def scanner(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = {n: [] for n in SCANNED.names}
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    words = folded_words(text)
                    places, found = index.places(words), index.verified(words)
                    base = {label for _, label in places}
                    score = max([*found.values(), BASE_SCORE if base else 0.0])
                    row = (doc_id, len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
                           ",".join(sorted(base)), ",".join(sorted(base | found.keys())), score)
                    for name, value in zip(SCANNED.names, row):
                        out[name].append(value)
                yield batch_of(SCANNED, **out)
    return run


def scan_licences(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row.

    The score is the best share of a verified notice's words in place, BASE_SCORE
    where only a base phrase stands, else 0. Null and empty texts have no words and
    empty labels. Rarity is counted over all documents.
    """
    source = texts(docs)
    counted = source.select("text").mapInArrow(count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # One row per word of the templates: bounded by their fixed text.
    index = Index.build({bytes(r["word"]): r["n"] for r in counted.collect()})
    return source.mapInArrow(scanner(index), SCANNED_SCHEMA)

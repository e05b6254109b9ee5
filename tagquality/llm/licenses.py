"""License scans by a positional rare-token index.

Templates are word sequences. The index maps each template's rarest words, by their document frequency in the
whole corpus, to their places in the template. A file looks up those of its words that the index has,
rarest first; places in the file less places in the template must agree. Then the mandatory key phrases must stand
in the stretch of the file that the places point to.

A phrase template is short: all its words are in the index, and they must agree exactly; this finds each
place where its words stand consecutively. A text template is long: of its RARE_WORDS rarest words
at least AGREE must agree within SLACK words, and its score is the share of its words, weighted by their rarity, that
the stretch has.

A-Z are lower-cased; a word is a run of digits, letters a to z and code points past ASCII. Null texts are
empty; a text without a license has no labels and score 0. Rows that repeat come out as often; a null doc_id stays null;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RARE_WORDS = 12
AGREE = 8
SLACK = 12
#: Least weighted share of a text template's words.
LEAST_SCORE = 0.5


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: Phrases that must stand in the file; none for a phrase template, which must stand whole.
    phrases: tuple[str, ...] = ()


# Phrases and their labels.
BASE = (
    Template("gpl", "gnu general public license"),
    Template("apache", "apache license"),
    Template("cc-by", "cc by"),
    Template("mit", "mit license"),
)

# License names with a version, and sentences of well-known licenses.
ADDED = (
    Template("gpl-2.0", "gnu general public license version 2"),
    Template("gpl-3.0", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("apache-2.0", "apache license version 2 0"),
    Template("cc-by-4.0", "cc by 4 0"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc0", "cc0 1 0 universal"),
    Template("mpl-2.0", "mozilla public license version 2 0"),
    Template(
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software.",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template(
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        ("with or without fee", "appear in all copies"),
    ),
    Template(
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        ("source and binary forms", "must reproduce the above copyright notice"),
    ),
    Template(
        "apache-2.0-text",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
        ("apache license version 2 0", "in compliance with the license"),
    ),
    Template(
        "gpl-text",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        ("gnu general public license", "free software foundation"),
    ),
    Template(
        "mpl-2.0-text",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        ("mozilla public license v 2 0", "source code form"),
    ),
    Template(
        "unlicense-text",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
        ("unencumbered software", "public domain"),
    ),
)

_MAP = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_MAP).split()


class Index:
    """Postings of the templates' rarest words; `df` has the documents of each word, of `total` in all."""

    def __init__(self, templates: Sequence[Template], df: dict[bytes, int], total: int) -> None:
        self.templates = [t for t in templates if words_of(t.text.encode())]
        self.ids: dict[bytes, int] = {}
        name = lambda w: self.ids.setdefault(w, len(self.ids))
        self.words = [[name(w) for w in words_of(t.text.encode())] for t in self.templates]
        self.phrases = [[[name(w) for w in words_of(p.encode())] for p in t.phrases] for t in self.templates]
        self.idf = [math.log((total + 1) / (df.get(w, 0) + 1)) + 1 for w in self.ids]
        rank = {k: (-self.idf[k], w) for w, k in self.ids.items()}
        #: Of each template its rarest words, rarest first, with their places.
        self.postings: list[list[tuple[int, list[int]]]] = []
        #: The templates that have a word as their rarest, or as one of their rarest.
        self.lookup: dict[int, list[int]] = {}
        for t, words in enumerate(self.words):
            rare = sorted(set(words), key=rank.__getitem__)
            rare = rare[:RARE_WORDS] if self.phrases[t] else rare
            self.postings.append([(w, [k for k, x in enumerate(words) if x == w]) for w in rare])
            for w in rare if self.phrases[t] else rare[:1]:
                self.lookup.setdefault(w, []).append(t)

    def places(self, words: list[bytes]) -> dict[int, np.ndarray]:
        """The places of each licence word of a file."""
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int32, len(words))
        at = np.flatnonzero(ids >= 0)
        if not len(at):
            return {}
        order = np.argsort(ids[at], kind="stable")
        at, known = at[order], ids[at][order]
        cuts = np.flatnonzero(np.diff(known)) + 1
        return dict(zip(known[np.r_[0, cuts]].tolist(), np.split(at, cuts), strict=True))

    def scan(self, words: list[bytes]) -> tuple[dict[int, np.ndarray], dict[int, float]]:
        """Of a file, the starts of each phrase template and the score of each text template found."""
        places = self.places(words)
        rarest = sorted(places.keys() & self.lookup.keys(), key=lambda w: -self.idf[w])
        looked = dict.fromkeys(t for w in rarest for t in self.lookup[w])
        starts, scores = {}, {}
        for t in looked:
            if not self.phrases[t]:
                found = consecutive(self.postings[t], places)
                if len(found):
                    starts[t] = found
            else:
                score = self._score(t, places)
                if score >= LEAST_SCORE:
                    scores[t] = score
        return starts, scores

    def _score(self, t: int, places: dict[int, np.ndarray]) -> float:
        """The best score of the stretches to which enough rare words point and which have all key phrases."""
        size = len(self.words[t])
        hits = [(w, q) for w, q in self.postings[t] if w in places]
        if len(hits) < min(AGREE, len(self.postings[t])):
            return 0.0
        offsets = np.concatenate([(places[w][:, None] - np.array(q)).ravel() for w, q in hits])
        owner = np.concatenate([np.full(len(places[w]) * len(q), k) for k, (w, q) in enumerate(hits)])
        # Offsets within SLACK of each other share one of two neighbouring bins.
        bins = np.unique(np.stack([offsets // SLACK, owner], axis=1), axis=0)
        bins = np.unique(np.concatenate([bins, bins - [1, 0]]), axis=0)
        values, counts = np.unique(bins[:, 0], return_counts=True)
        best = 0.0
        total = sum(self.idf[w] for w in set(self.words[t]))
        keys = [consecutive([(w, [k]) for k, w in enumerate(p)], places) for p in self.phrases[t]]
        for b in values[counts >= min(AGREE, len(self.postings[t]))].tolist():
            first, last = (b - 1) * SLACK, (b + 2) * SLACK + size + SLACK
            inside = lambda at: np.searchsorted(at, last) > np.searchsorted(at, first)  # noqa: E731, B023
            if all(inside(k) for k in keys):
                best = max(best, sum(self.idf[w] for w in set(self.words[t]) if w in places and inside(places[w])) / total)
        return best


def consecutive(postings: list[tuple[int, list[int]]], places: dict[int, np.ndarray]) -> np.ndarray:
    """Starts at which all postings agree, in order."""
    found = None
    for w, at in postings:
        if w not in places:
            return np.zeros(0, np.int64)
        for q in at:
            starts = places[w] - q
            found = starts if found is None else found[np.isin(found, starts, assume_unique=True)]
            if not len(found):
                return found
    return found


def document_frequencies(docs: DataFrame, templates: Sequence[Template]) -> tuple[dict[bytes, int], int]:
    """How many documents have each word of the templates, and all documents; one row for each word to the driver."""
    known = {w: k for k, w in enumerate(Index(templates, {}, 0).ids)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(known) + 1, np.int64)
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                seen = known.keys() & set(words_of(text or b""))
                counts[[known[w] for w in seen]] += 1
                counts[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts))), pa.array(counts)], names=["word", "n"])

    seen = _texts(docs).select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r["word"]: r["n"] for r in seen.collect()}
    return {w: counts.get(k, 0) for w, k in known.items()}, counts.get(len(known), 0)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def scan(docs: DataFrame, base: Sequence[Template] = BASE, added: Sequence[Template] = ADDED) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of each row's whole text.

    n_base counts all places of base phrases, first_word and last_word are their smallest and largest start (else
    null). score is 1 where a phrase template stands, else the best score of a text template, else 0.
    `base` must be phrase templates.
    """
    templates = [*base, *added]
    index = Index(templates, *document_frequencies(docs, templates))
    core = {t for t, template in enumerate(index.templates) if template in base}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = lambda ts: ",".join(sorted({index.templates[t].label for t in ts}))
        for batch in batches:
            rows = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = words_of(text or b"")
                starts, scores = index.scan(words)
                mine = [starts[t] for t in starts if t in core]
                ends = (int(min(s[0] for s in mine)), int(max(s[-1] for s in mine))) if mine else (None, None)
                score = 1.0 if starts else max(scores.values(), default=0.0)
                rows.append((len(words), sum(map(len, mine)), *ends, name(starts.keys() & core), name([*starts, *scores]), score))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            columns = [batch.column("doc_id"), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))]
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    return _texts(docs).mapInArrow(run, SCHEMA)


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)
NAMES = [field.split()[0] for field in SCHEMA.split(", ")]

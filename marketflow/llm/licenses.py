"""License scan: a positional rare-token index over licence phrases and notices.

The library holds short phrases, of which every word must stand in place, and notices with a mandatory key phrase. The
document frequencies of the licence words are counted over all documents first. A file's licence words are looked up
rarest first, and the postings of a template are intersected by relative position:

* Phrases: each word gives the places where the phrase would begin; they are intersected over all its words, so what is
  left are all places where it stands. A phrase whose rarest word is absent costs nothing.
* Notices: the words of the key phrase are intersected around each place of its rarest word, in order and with at most
  `GAP` other words among them. Around a key that is found the notice is aligned to the file, with words put in, left out
  or replaced, up to `DRIFT` words on each side; it counts if at least `COVER` of its words stand there in order.

Words: letters and digits, A-Z in lower case. Null and empty texts have no words and no labels. Repeated rows get
equal results; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import alnum_words, with_columns

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Fixed values: (label, key phrase, words of the notice) of well-known licence notices, and short names.
NOTICES = [
    ("gpl", "gnu general public license",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license", "under the terms of the gnu lesser general public license"),
    ("agpl", "gnu affero general public license", "under the terms of the gnu affero general public license"),
    ("apache-2.0", "apache license version 2 0", "licensed under the apache license version 2 0"),
    ("mit", "permission is hereby granted free of charge",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa"),
    ("cc-by", "creative commons attribution", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("gpl-3.0", "gnu general public license version 3", "licensed under the gnu general public license version 3"),
]
COVER = 0.6  # least share of a notice's words that stand in order
GAP = 3  # other words within a key phrase
DRIFT = 12  # words by which a notice may be longer on each side of its key phrase


class Index:
    """Templates with their words from the rarest on."""

    def __init__(self, rarity: dict[bytes, float]):
        self.templates = [(label, words.encode().split(), words.encode().split(), True) for words, label in PHRASES.items()]
        self.templates += [(label, key.encode().split(), words.encode().split(), False) for label, key, words in NOTICES]
        self.order = [sorted(range(len(key)), key=lambda i: (-rarity.get(key[i], 0.0), key[i], i)) for _, key, _, _ in self.templates]
        self.postings: dict[bytes, list[int]] = defaultdict(list)  # templates by the rarest word of their keys
        for k, (_, key, _, _) in enumerate(self.templates):
            self.postings[key[self.order[k][0]]].append(k)
        self.words = {w for _, key, _, _ in self.templates for w in key}

    def scan(self, words: list[bytes]) -> tuple[dict[int, list[int]], dict[int, list[tuple[int, float]]]]:
        """Places of phrases, and places with coverage of notices, by number of the template."""
        present = self.words.intersection(words)
        wanted = [k for w in present & self.postings.keys() for k in self.postings[w] if present.issuperset(self.templates[k][1])]
        if not wanted:
            return {}, {}
        places: dict[bytes, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            if w in present:
                places[w].append(i)
        phrases, notices = {}, {}
        for k in wanted:
            _, key, template, exact = self.templates[k]
            if exact:
                if found := self._intersected(k, places):
                    phrases[k] = found
            elif found := [(s, c) for s, c in self._aligned(key, template, self._keys(k, places, words), words) if c >= COVER]:
                notices[k] = found
        return phrases, notices

    def _intersected(self, k: int, places: dict[bytes, list[int]]) -> list[int]:
        """Starts that all words of a phrase agree on."""
        key = self.templates[k][1]
        first, *rest = self.order[k]
        starts = {i - first for i in places[key[first]]}
        for at in rest:
            starts &= {i - at for i in places[key[at]]}
            if not starts:
                break
        return sorted(starts)

    def _keys(self, k: int, places: dict[bytes, list[int]], words: list[bytes]) -> list[tuple[int, int]]:
        """First and last place of each key phrase: the nearest key words in order around each place of the rarest."""
        key, order, found = self.templates[k][1], self.order[k], set()
        for at in (i for i in range(len(key)) if key[i] == key[order[0]]):
            starts = {i - at for i in places[key[at]]}
            for other in order[1:]:  # rarest first; a start stays while each word agrees with it up to the gap
                near = {i - other + d for i in places[key[other]] for d in range(-GAP, GAP + 1)}
                starts &= near
            for s in starts:
                low = high = s + at
                for w in key[at + 1 :]:
                    high = next((i for i in range(high + 1, min(len(words), low + len(key) + GAP)) if words[i] == w), len(words))
                for w in reversed(key[:at]):
                    low = next((i for i in range(low - 1, max(-1, high - len(key) - GAP), -1) if words[i] == w), -len(words))
                if 0 <= low and high < len(words) and high - low < len(key) + GAP:
                    found.add((low, high))
        return sorted(found)

    @staticmethod
    def _aligned(key: list[bytes], template: list[bytes], keys: list[tuple[int, int]], words: list[bytes]) -> Iterator[tuple[int, float]]:
        """Start and coverage of the notice around each of its key phrases."""
        before = next((i for i in range(len(template)) if template[i : i + len(key)] == key), 0)
        after = len(template) - before - len(key)
        for low, high in keys:
            part = words[max(0, low - before - DRIFT) : high + 1 + after + DRIFT]
            yield max(0, low - before), in_order(template, part) / len(template)


def in_order(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        corner = 0
        for j, y in enumerate(b, 1):
            up = row[j]
            row[j] = corner + 1 if x == y else max(up, row[j - 1])
            corner = up
    return row[-1]


def vocabulary() -> set[bytes]:
    return {w for text in [*PHRASES, *(n[2] for n in NOTICES), *(n[1] for n in NOTICES)] for w in text.encode().split()}


def rarity(docs: DataFrame) -> dict[bytes, float]:
    """Inverse document frequency of each licence word over all documents; as many numbers as the library has words."""
    known = vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(known.intersection(alnum_words(text or b"")))
            n += batch.num_rows
        found[b""] = n
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    counted = docs.select(F.col("text").cast("binary")).mapInArrow(run, "word binary, n long")
    count = {bytes(r.word): r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = count.pop(b"", 0)
    return {w: math.log((1 + total) / (1 + count.get(w, 0))) for w in known}


MATCH = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("words", pa.int64()), ("cover", pa.float64())]))


def scan(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns in `keep`) with n_words, n_base, first_word, last_word, base_labels, labels, score and matches (word places)."""
    held = docs.sparkSession.sparkContext.broadcast(rarity(docs))
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]

    def make():
        index = Index(held.value)

        def one(text):
            words = alnum_words(text or b"")
            phrases, notices = index.scan(words)
            starts = [s for found in phrases.values() for s in found]
            base = {index.templates[k][0] for k in phrases}
            matches = [(index.templates[k][0], s, len(index.templates[k][2]), 1.0) for k, found in phrases.items() for s in found]
            matches += [(index.templates[k][0], s, len(index.templates[k][2]), c) for k, found in notices.items() for s, c in found]
            every = base | {index.templates[k][0] for k in notices}
            score = max((m[3] for m in matches), default=0.0)
            return (
                len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                ",".join(sorted(every)), score,
                [dict(zip(("label", "start", "words", "cover"), m, strict=True)) for m in sorted(matches, key=lambda m: (m[1], m[0]))],
            )

        def run(texts):
            rows = [one(t) for t in texts]
            return {c: [r[i] for r in rows] for i, c in enumerate(names)}

        return run

    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), MATCH]
    types = ["long"] * 4 + ["string"] * 2 + ["double", "array<struct<label:string,start:long,words:long,cover:double>>"]
    return with_columns(docs, dict(zip(names, kinds, strict=True)), dict(zip(names, types, strict=True)), make, keep)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document as the registered query returns it."""
    return scan(docs, ["doc_id"]).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )

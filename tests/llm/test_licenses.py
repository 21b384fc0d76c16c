"""Phrases and notices against a plain version that reads every place of a text."""

import random

import pytest

from marketflow.llm import licenses
from tests.llm import brute


def common(a, b):
    """Longest common subsequence, from the definition."""
    known = {}

    def of(i, j):
        if i == len(a) or j == len(b):
            return 0
        if (i, j) not in known:
            known[i, j] = 1 + of(i + 1, j + 1) if a[i] == b[j] else max(of(i + 1, j), of(i, j + 1))
        return known[i, j]

    return of(0, 0)


def covers(text, key, notice, rarest):
    """Coverage around each place of the key's rarest word that the other key words stand around in order."""
    w, k, n = [x.encode() for x in brute.words(text)], key.encode().split(), notice.encode().split()
    before = next((i for i in range(len(n)) if n[i : i + len(k)] == k), 0)
    out = []
    for at in range(len(k)):
        for i in range(len(w)):
            if k[at] != rarest or w[i] != rarest:
                continue
            low, high = i, i
            for x in k[at + 1 :]:
                high = w.index(x, high + 1) if x in w[high + 1 :] else 10**9
            for x in reversed(k[:at]):
                low = max((j for j in range(low) if w[j] == x), default=-(10**9))
            if high - low < len(k) + licenses.GAP:
                part = w[max(0, low - before - licenses.DRIFT) : high + 1 + len(n) - before - len(k) + licenses.DRIFT]
                out.append(common(n, part) / len(n))
    return [c for c in out if c >= licenses.COVER]


def labels_of(text, index):
    base = set(brute.phrases(text, licenses.PHRASES)[4].split(",")) - {""}
    best = [1.0] if base else []
    for i, (label, key, notice) in enumerate(licenses.NOTICES, len(licenses.PHRASES)):
        if found := covers(text, key, notice, index.templates[i][1][index.order[i][0]]):
            base.add(label)
            best += found
    return ",".join(sorted(base)), max(best, default=0.0)


def edited(rng, words):
    """Words put in, left out or replaced."""
    out = []
    for w in words:
        u = rng.random()
        out += [] if u < 0.06 else [w, rng.choice(["kindly", "the", "version", "2"])] if u < 0.14 else ["other"] if u < 0.18 else [w]
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    out = []
    for _ in range(300):
        parts = [["lorem", "the", "license", "of", "public"] * rng.randint(0, 4)]
        for _ in range(rng.randint(0, 3)):
            picked = rng.choice([*licenses.PHRASES, *(n[2] for n in licenses.NOTICES)]).split()
            parts += [picked if rng.random() < 0.3 else edited(rng, picked), ["ipsum"] * rng.randint(0, 20)]
        out.append(" ".join(w for p in parts for w in p))
    return out


def test_labels_against_the_plain_version(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = licenses.Index(licenses.rarity(df))
    found = {r.doc_id: (r.labels, r.score) for r in licenses.digest(df).collect()}
    want = {i: labels_of(t, index) for i, t in enumerate(texts)}
    assert {i: x[0] for i, x in found.items()} == {i: x[0] for i, x in want.items()}
    assert all(found[i][1] == pytest.approx(want[i][1]) for i in want)
    assert len({x[0] for x in want.values()}) > 20


MIT = "permission is hereby kindly granted free of charge to any person obtaining a copy of this software and associated documentation files"
GPL = """This program is free software; you can redistribute it and/or modify it under the terms of version 2 of
 the GNU General Public License as published by the Free Software Foundation."""


def test_words_put_in(spark):
    df = spark.createDataFrame([(1, MIT), (2, GPL), (3, "permission is hereby not at all ever granted free of charge"), (4, "granted permission free")], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert found[1].labels == "mit" and found[1].matches[0].cover == 1.0
    assert found[2].labels == "gpl" and [m.words for m in found[2].matches] == [29, 4] and found[2].matches[0].cover == 1.0
    assert found[3].labels == found[4].labels == ""


def test_phrases_are_intersected():
    index = licenses.Index({b"gnu": 3.0, b"cc": 2.0})
    words = b"cc by cc by by cc gnu general public license license".split()
    assert index.scan(words)[0] == {0: [6], 2: [0, 2]}
    assert index.scan(b"gnu public general license by cc".split()) == ({}, {})

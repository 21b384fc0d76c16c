"""Automata and collocations against plain versions."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from marketflow.llm import automata, collocations
from tests.conftest import SMALL

LOWER = {c: c + 32 for c in range(65, 91)}
KEYS = st.dictionaries(st.lists(st.sampled_from([b"a", b"b", b"ab", b""]), max_size=5).map(tuple), st.integers(0, 10**9), max_size=40)


@given(KEYS)
@settings(max_examples=200, deadline=None)
def test_transducers_hold_their_keys(table):
    found = automata.built(sorted(table.items()))
    assert list(found.items()) == sorted(table.items())
    states = [(found.final[s], tuple(zip(*(x[found.first[s] : found.first[s + 1]] for x in (found.label, found.target, found.weight)), strict=True))) for s in range(len(found.final) - 1)]
    assert len(set(states)) == len(states)  # minimal: no two states alike


@given(KEYS, KEYS)
@settings(max_examples=200, deadline=None)
def test_union_and_composition(a, b):
    x, y = automata.built(sorted(a.items())), automata.built(sorted(b.items()))
    assert dict(automata.union([x, y]).items()) == dict(Counter(a) + Counter(b)) | {k: 0 for k in a.keys() | b.keys() if a.get(k, 0) + b.get(k, 0) == 0}
    asked = automata.built((k, 0) for k in sorted(a))
    assert dict(asked.compose(y)) == {k: n for k, n in b.items() if k in a}
    batch = pa.RecordBatch.from_arrays(automata.columns_of([x, y]), list(automata.COLUMNS))
    assert dict(automata.from_row(batch, 1).items()) == b


def test_equal_tails_are_one_state():
    table = {(a, b"x", b"y"): 7 * i for i, a in enumerate([b"p", b"q", b"r"], 1)}
    assert len(automata.built(sorted(table.items())).final) == 4


def plain(rows, least=100, longest=5, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang) rows."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inside = Counter()
    for p, a in candidates.items():
        for i in range(1, len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p) - 1:
                    part = (p[0], *p[i:j])
                    inside[part] = max(inside[part], a)
    out = {}
    for p, a in candidates.items():
        if 100 * inside[p] >= 100 * a:
            continue
        cuts = [(1000 * a * n[p[0]] // (f[p[: k + 1]] * f[(p[0], *p[k + 1 :])]), k, f[p[: k + 1]], f[(p[0], *p[k + 1 :])]) for k in range(1, len(p) - 1)]
        score, _, left, right = min(cuts)
        out.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), a, left, right, n[p[0]], score))
    return {(lang, i, p.decode(), *rest) for lang, found in out.items() for i, (_, _, p, *rest) in enumerate(sorted(found)[:top], 1)}


def as_set(df):
    rows = df.collect()
    out = {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query(spark):
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = plain(rows)
    assert want and as_set(entry.queries()["op13_collocations"](spark, SMALL)) == want


@pytest.mark.parametrize(("flush", "block"), [(3_000_000, 20_000), (300, 7)])
def test_dense_phrases(spark, flush, block, monkeypatch):
    """Few words, so that phrases overlap, hold each other, tie, and repeat a word; small shards and blocks."""
    rng = random.Random(4)
    words = ["a", "a", "A", "é", "the", "of", "b\x1c"]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) + rng.choice([". ", "\n", "\t", " ; "]) + "new york city hall. " * rng.randint(0, 2), rng.choice(["x", "y", None, "und"])) for _ in range(400)]
    for name, value in (("FLUSH", flush), ("BLOCK", block), ("FAN", 3)):
        monkeypatch.setattr(collocations, name, value)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    for least, top in ((20, 2000), (300, 5)):
        want = plain(rows, least, top=top)
        assert want and as_set(collocations.collocations(df, least, top=top)) == want


def test_cells_prune_nothing_frequent():
    rng = np.random.default_rng(3)
    t = rng.integers(0, 5, 3000)
    h = collocations.hashes([b"", b"a", b"b", b"c", b"d"])
    for k, (ok, cell) in enumerate(collocations.cells_of(h, t, b"x", 16)):
        whole = [tuple(t[i : i + k + 1]) for i in range(len(t) - k)]
        assert [0 not in w for w in whole] == ok.tolist()
        assert len({(w, c) for w, c, o in zip(whole, cell.tolist(), ok, strict=True) if o}) == len({w for w in whole if 0 not in w})


def test_big_scores_are_exact(spark):
    """1000 * a * n passes 64 bits."""
    rows = [(bytearray(b"x"), [bytearray(b"p"), bytearray(b"q")], 4 * 10**14, 10**18 + 1)]
    df = spark.createDataFrame(rows, "lang binary, words array<binary>, a long, total long")
    parts = spark.createDataFrame([(0, bytearray(b"x"), [bytearray(w)], 5 * 10**14) for w in (b"p", b"q")], "home int, lang binary, words array<binary>, n long")
    assert collocations.scored(df, parts, []).first().score == 1000 * 4 * 10**14 * (10**18 + 1) // (5 * 10**14) ** 2


def test_odd_rows(spark):
    """Nulls, empty and very long texts, repeated rows, clashing columns, an empty table."""
    rows = [(None, "x"), ("", None), (" \t ", "x"), ("one two three " * 200_000, "x"), ("one two", None), ("one two", None), ("é è. " * 300, "")]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "text string, lang string, n long, words string")
    want = plain(rows, 2)
    assert as_set(collocations.collocations(df, 2)) == want
    assert collocations.collocations(df.where("false")).count() == 0

"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from marketflow.llm import spelling
from tests.conftest import SMALL

LOWER = {c: c + 32 for c in range(65, 91)}


def words(rows, least=7, times=2):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= least and n >= times}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain(seen):
    """word -> (form, root, n, n_near, form_n); near words by their texts with one character left out."""
    gaps = {}
    for w in seen:
        for i in range(len(w) + 1):
            gaps.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    near = {w: {v for i in range(len(w) + 1) for v in gaps[w[:i] + w[i + 1 :]] | ({w[:i] + w[i + 1 :]} & seen.keys()) if one_apart(w, v)} for w in seen}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-seen[v], v), default=None)
        form[w] = best if best is not None and seen[best] >= 10 * seen[w] else None
    out = {}
    for w in seen:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, seen[w], len(near[w]), seen.get(form[w]))
    return out


def as_dict(rows):
    rows = rows.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_plain_version():
    seen = {"aaaaaaa": 5, "aaaaaaaa": 50, "aaaaaab": 2, "baaaaaaa": 500, "zzzzzzz": 9}
    assert {w: r[3] for w, r in plain(seen).items()} == {w: sum(one_apart(w, v) for v in seen) for w in seen}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert as_dict(entry.queries()["op12_spelling"](spark, SMALL)) == plain(words(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_words(spark, seed, monkeypatch):
    """Few letters, so that words have many neighbours, runs of equal letters, ties, and chains of forms; few rows a
    task, so that many prefixes reach over borders."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(150)] + ["aaaaaaa", "aaaaaaaa", "a" * 9, "baaaaaaa"]
    rows = [(i, " ".join(rng.choices(base, [10 ** (k % 4) for k in range(len(base))], k=400))) for i in range(40)]
    rows.append((100, "chainab " * 3 + "chainac " * 40 + "chainacd " * 500))
    monkeypatch.setattr(spelling, "KEYS_PER_TASK", 100)
    found = as_dict(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    want = plain(words(rows))
    assert found == want and any(w[0] is not None and w[0] != w[1] for w in want.values())


def test_odd_rows(spark):
    """Nulls, empty and very long texts, long words, repeated rows, letters outside the class, an empty table."""
    long = "q" * 20000
    rows = [(1, "Spelling spelling SPELLING speling speling"), (1, "spelling"), (None, "spelling speling"), (2, None), (3, ""), (4, "ÀÉÎõÜßÿ ÀÉÎõÜßÿ àéîõüßÿ"),
            (5, f"{long} {long} {long}q {long}q"), (6, "spelling, " * 3000), (7, "spellingЖ spelling_x 7spelling"), (8, "short no")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, word long, n long")
    want = plain({w: n for w, n in words(rows).items() if len(w) < 100})
    found = as_dict(spelling.variants(df))
    assert {w: r for w, r in found.items() if len(w) < 100} == want
    assert {len(w): r[3] for w, r in found.items() if len(w) > 100} == {20000: 1, 20001: 1}
    assert spelling.variants(df.where("false")).count() == 0


def test_met_leaves_no_pairs():
    """A key shared by many words gives each one row."""
    n = 90
    found = spelling.met(*(np.array(x) for x in ([1] * n, [2] * n, [0] * n, list(range(n)), [5] * n)))
    assert [len(x) for x in found] == [n] * 4 and set(found[1].tolist()) == {n - 1}
    assert found[3].tolist() == [1, *[0] * (n - 1)]

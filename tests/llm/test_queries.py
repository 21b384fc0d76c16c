"""Registered queries over whole tables, against the plain versions and the SQL."""

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import difference, views
from marketflow.llm import licenses
from tests.conftest import SMALL
from tests.llm import brute


def run(spark, name):
    return entry.queries()[name](spark, SMALL).collect()


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def test_op1(spark, texts):
    found, want = run(spark, "op1_fingerprints"), brute.edited(list(texts.items()))
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in found} == {d: (n, brute.sha(t)) for d, (n, t) in want.items()}
    assert np.median([r.near_edited for r in found]) > 0.6 > 0.1 > np.median([r.near_next for r in found])


def test_op2(spark, texts):
    assert {r.doc_id: tuple(r[1:6]) for r in run(spark, "op2_licenses")} == {d: brute.phrases(t, licenses.PHRASES) for d, t in texts.items()}


def test_op3(spark, texts):
    assert {r.doc_id: tuple(r[1:]) for r in run(spark, "op3_substrings")} == brute.repeats(list(texts.items()))


def test_op4(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet")
    found = entry.queries()["op4_conversations"](spark, SMALL)
    assert found.count() == rows.count() and not found.where("n_quotes > 0").count()
    assert found.select(*rows.columns).exceptAll(rows).count() == 0


def test_op5(spark, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert {r.doc_id: tuple(r[1:]) for r in run(spark, "op5_decontamination")} == {d: brute.contamination(t, items) for d, t in texts.items()}


def test_op6(spark, texts):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in run(spark, "op6_near_duplicates")} == brute.near_duplicates(list(texts.items()))


def test_op7(spark):
    right = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    held = [r for r in run(spark, "op7_language") if r.held_out]
    assert np.mean([r.lang_pred == right[r.doc_id] for r in held]) > 0.95


def test_op8(spark):
    assert difference(spark, views(SMALL), SMALL, "op8_mixture") is None


def test_op9_held_out(spark):
    big = SMALL.replace("sf0.001", "sf0.1")
    right = {r.doc_id: r.toxic for r in spark.read.parquet(f"{big}/labels.parquet").collect()}
    held = [r for r in entry.queries()["op9_toxicity"](spark, big).collect() if r.held_out and r.doc_id in right]
    toxic = np.array([right[r.doc_id] for r in held]) == 1
    said = np.array([r.predicted for r in held]) == 1
    assert said[toxic].mean() > 0.8 and said[~toxic].mean() < 0.02


def test_op10(spark, texts):
    gone = brute.repeated_lines(list(texts.items()))
    for r in run(spark, "op10_lines"):
        lines = texts[r.doc_id].split("\n")
        kept = [x for i, x in enumerate(lines) if (r.doc_id, i) not in gone]
        assert (r.n_lines, r.n_removed, r.text) == (len(lines), len(lines) - len(kept), "\n".join(kept))


def test_pipeline(spark, texts):
    """Every stage against the plain version over what the stage before kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(corpus_pipeline.stored(stage(spark, steps[-1], SMALL)))
    assert all(s.columns == docs.columns for s in steps[:-1])
    known, lined, near, clean, mixed = ({r.doc_id: r for r in s.collect()} for s in steps[1:])
    assert len(known) > 0.98 * len(texts)
    gone = brute.repeated_lines([(d, r.text) for d, r in known.items()])
    left = {d: "\n".join(x for i, x in enumerate(r.text.split("\n")) if (d, i) not in gone) for d, r in known.items()}
    assert {d: r.text for d, r in lined.items()} == {d: t for d, t in left.items() if t.strip() or t == known[d].text}
    homes = brute.near_duplicates([(d, r.text) for d, r in lined.items()])
    assert set(near) == {d for d, (_, home) in homes.items() if home == d}
    assert set(clean) == {d for d, r in near.items() if not brute.contamination(r.text, items)[-1]}
    words = {d: len(brute.words(r.text, brute.BLANK)) for d, r in clean.items()}
    assert sum(r.taken for r in mixed.values()) == sum(words.values()) and set(mixed) <= set(clean)
    assert entry.queries()["pipeline"](spark, SMALL).count() == len(mixed)

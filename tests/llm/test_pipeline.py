"""The whole pipeline on nulls, empty texts, repeated rows, several texts of one doc_id, clashing columns, empty tables."""

import random

import corpus_pipeline
from tests.llm.test_language import text_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __gone string, node int, size string"


def documents():
    rng = random.Random(9)
    rows = [(i, "\n".join(text_of(rng, lang, 12) for _ in range(5)), lang, f"s{i % 3}") for i in range(150) for lang in [("aa", "bb")[i % 2]]]
    copy = rows[4]
    rows += [(200, copy[1], "aa", "s1"), copy, copy, (201, None, "aa", None), (202, "", None, "s0"), (203, " \n\t", "bb", "s0"), (None, rows[7][1], None, None)]
    rows += [(204, rows[6][1] + " extra", "aa", "s2"), (7, text_of(rng, "aa", 40), "aa", "s2"), (205, "12 34", "aa", "s2")]
    rows.append((206, text_of(rng, "aa", 3) + " " + "what is the tall tower in the old town by the wide river called today my friend", "aa", "s0"))
    return [(*r, None, "x", 1, "y") for r in rows]


def written(spark, folder, rows, items):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_pipeline_on_odd_rows(spark, tmp_path):
    rows = documents()
    items = [(1, "What is the tall tower in the old town by the wide river called today my friend"), (2, None), (3, "")]
    folder = written(spark, tmp_path / "a", rows, items)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder))
    clean = docs.collect()
    ids = {r.doc_id for r in clean}
    assert not {200, 201, 202, 203, 205, 206} & ids  # repeats, no text, no letters, contaminated
    assert set(range(150)) <= ids
    assert {(r["__gone"], r.node, r["size"]) for r in clean} == {("x", 1, "y")}
    lines = {}
    for d, text, *_ in rows:
        lines.setdefault(d, set()).update((text or "").split("\n"))
    assert all(set(r.text.split("\n")) <= lines[r.doc_id] for r in clean)
    found = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in found} <= ids and sum(r.taken for r in found) > 0


def test_pipeline_on_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path / "b", [], [])).count() == 0
    assert corpus_pipeline.run(spark, written(spark, tmp_path / "c", documents()[:20], [])).count() > 0

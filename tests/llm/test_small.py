"""Nulls, empty texts, ties, repeated rows, empty tables and clashing columns, against the plain versions."""

import random
from pathlib import Path
from types import SimpleNamespace

import pyarrow as pa
import pytest

from marketflow.llm import common, decontaminate, fingerprint, language, licenses, lines, minhash, mixing, quotes, substrings, toxicity
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [a + b for a in ("ka", "lo", "mi", "ru", "te", "zü") for b in ("ban", "der", "fis", "gor", "hul", "jam", "pel")]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def corpus(seed=3):
    """Copies, near copies, shared passages, one very long text, nulls, empty and blank texts, repeated rows."""
    rng = random.Random(seed)
    passage, base = prose(rng, 30), prose(rng, 120)
    texts = [prose(rng, rng.randint(1, 200)) for _ in range(20)]
    texts += [base, base, base] + [base.replace(rng.choice(base.split()), "other", 1) for _ in range(12)]
    texts += [f"{prose(rng, 20)}\n{passage}\n{prose(rng, 15)}" for _ in range(8)]
    texts += [f"{prose(rng, 9)} {passage}", passage, passage[:60], "x" * 300, "ab" * 400, "x" * 49, None, "", " \n\t ", "# Head\n\nOne.\n"]
    texts += [prose(rng, 20000), "Licensed under the MIT License", "THE GNU GENERAL PUBLIC LICENSE, apache license cc by cc by-nc"]
    rows = [(i * 3, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 4}", None) for i, t in enumerate(texts)]
    return rows + [rows[2], rows[21]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    return SimpleNamespace(df=spark.createDataFrame(rows, SCHEMA).repartition(5), rows=rows, by_id={r[0]: r[1] for r in rows})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_fingerprints(docs, empty):
    found = fingerprint.with_edits(docs.df).collect()
    assert len(found) == len(docs.rows)
    want = brute.edited(list(docs.by_id.items()))
    repeated = {docs.rows[2][0], docs.rows[21][0]}  # the first of equal rows is followed by its like
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.fingerprint == fingerprint.fingerprint(docs.by_id[r.doc_id])
        if r.doc_id not in repeated:
            assert (r.n_chars, r.edited_sha256) == (want[r.doc_id][0], brute.sha(want[r.doc_id][1]))
    assert fingerprint.with_edits(empty).count() == 0


def test_fingerprint_locates_edits():
    a = "One two three. Four.\n\nSecond section here.\nNext line of it.\n\nLast."
    b = a.replace("Next", "Other")
    x, y = fingerprint.fingerprint(a), fingerprint.fingerprint(b)
    assert fingerprint.likeness(x, x) == 1 and 0 < fingerprint.likeness(x, y) < 1
    where = fingerprint.changed(x, y)
    assert len(where) == 1
    assert fingerprint.likeness(fingerprint.fingerprint(""), fingerprint.fingerprint(None)) == 1


def test_fingerprints_without_ids(spark):
    rows = [(None, "aaaa"), (5, "bbbb"), (None, None), (9, "cccc")]
    found = fingerprint.with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {(None, ""), (None, "aaab"), (5, "bbbc"), (9, "ccc")}
    assert {(r.doc_id, r.edited_sha256) for r in found} == {(d, brute.sha(t)) for d, t in want}


def test_licenses(docs, empty):
    found = licenses.digest(docs.df).collect()
    assert len(found) == len(docs.rows)
    for r in found:
        assert tuple(r[1:6]) == brute.phrases(docs.by_id[r.doc_id], licenses.PHRASES)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
    assert licenses.digest(empty).count() == 0


def test_notice_with_other_words(spark):
    notice = licenses.NOTICES[4][2].split()
    notice[-3] = "related"
    text = "Start here. " + " ".join(notice) + " and more"
    [row] = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.labels == "mit" and row.n_base == 0 and 0.9 < row.score < 1 and row.matches[0].start == 2


def test_substrings(docs, empty):
    found = substrings.digest(docs.df).collect()
    want = brute.repeats(list(docs.by_id.items()))
    assert sorted(tuple(r) for r in found) == sorted((r[0], *want[r[0]]) for r in docs.rows)
    assert substrings.digest(empty).count() == 0


@pytest.mark.parametrize("crowd", [0, 2])
def test_crowded_strings_meet_one_by_one(docs, monkeypatch, crowd):
    monkeypatch.setattr(substrings, "CROWD", crowd)
    rows = [r for r in docs.rows if r[1] is None or len(r[1]) < 5000]
    df = docs.df.where("text IS NULL OR length(text) < 5000")
    want = brute.repeats([(r[0], r[1]) for r in rows])
    parts = list(substrings.anchored([(r[0], r[1].encode()) for r in rows if r[1] and len(r[1]) >= 50]))
    marks = list(substrings._sent_anchors(parts, 4, 4))
    assert any(kind == substrings.CROWDED for _, kind, _ in marks)
    assert {r.doc_id: tuple(r[1:]) for r in substrings.digest(df).collect()} == want


def test_anchors_use_all_buckets():
    rng = random.Random(6)
    (part,) = substrings.anchored([(1, prose(rng, 3000).encode())])
    homes = {bucket for bucket, kind, _ in substrings._sent_anchors([part], 12, 12) if kind == substrings.ANCHORS}
    assert homes == set(range(12))


def test_memory_of_a_bucket(monkeypatch):
    """A bucket is solved in shares: beside the arrays themselves, little memory is needed, and none stays."""
    import tracemalloc

    import numpy as np

    rng, n = np.random.default_rng(2), 60_000
    one = lambda kind: np.ones(n, kind)
    grams = np.repeat(rng.integers(1, 1 << 48, n // 2, dtype=np.uint64), 2)  # two contexts each, from two documents
    doc, start = np.arange(n) % 2, np.arange(n, dtype=np.int32)
    text = np.repeat(rng.integers(97, 123, (n // 2, 50), dtype=np.uint8), 2, axis=0)
    cases = {
        substrings._met_contexts: [doc, start, one(np.int16), 0 * one(np.int8), grams, text.reshape(-1)],
        substrings._met_anchors: [grams, grams + doc.astype(np.uint64), doc, start, one(np.int16), 0 * one(np.int8), 0 * one(np.int8)],
    }
    monkeypatch.setattr(substrings, "BLOCK", 1 << 13, raising=False)
    for solve, arrays in cases.items():
        for name in ("_powers", "_inverse"):
            monkeypatch.setattr(substrings.PrefixHashes, name, np.ones(1, np.uint64))
        tracemalloc.start()
        found = sum(len(substrings.unpack(data)[0]) for _, _, data in solve([arrays], 4))
        kept, most = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert found == (n // 2 if solve is substrings._met_contexts else n)
        assert most < 6 * sum(a.nbytes for a in arrays) and kept < 4_000_000


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(5)
    text = prose(rng, 3000).encode()
    whole = [set(zip(*[x.tolist() for x in part], strict=True)) for part in substrings.anchored([(1, text)])]
    monkeypatch.setattr(substrings, "CHUNK", 1000)
    cut = [set(zip(*[x.tolist() for x in part], strict=True)) for part in substrings.anchored([(1, text)])]
    assert set().union(*cut) == set().union(*whole) and len(cut) > 10


def test_other_text_under_one_id_stays_whole(spark):
    rng = random.Random(8)
    a, b = prose(rng, 40), prose(rng, 40)
    rows = [(1, a), (2, a), (2, b), (3, b), (None, a)]
    found = {(r.doc_id, r.n_removed) for r in substrings.cut(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (1, 0) in found and (None, 0) in found and len([f for f in found if f[0] == 2]) >= 1


def test_suffix_sort():
    import numpy as np

    from marketflow.llm.suffixes import Text

    rng = random.Random(1)
    data = "".join(rng.choice("ab") for _ in range(300)).encode()
    start = np.array([rng.randrange(299) for _ in range(120)])
    end = np.minimum(start + 40, 300)
    order = Text(np.frombuffer(data, np.uint8)).sort(start, end)
    got = [data[start[i] : end[i]] for i in order]
    assert got == sorted(got) and sorted(order.tolist()) == list(range(120))


ITEMS = [(1, None), (2, ""), (3, "kaban loder"), (4, "kaban loder"), (10, prose(random.Random(11), 40)), (10, prose(random.Random(11), 40))]


@pytest.mark.parametrize("block_bytes", [1 << 25, 1000])
def test_contamination(spark, docs, empty, block_bytes):
    planted = ITEMS[4][1].split()
    rows = [*docs.rows, (999, " ".join(planted[5:25]).upper().replace("Ü", "ü") + "!", "en", None, 3), (1000, "X." + " ".join(planted[:12]), None, None, 1)]
    df = spark.createDataFrame([(*r, "kept") for r in rows], SCHEMA + ", n_words string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    scanned = decontaminate.scan(df, bench, block_bytes=block_bytes)
    found = decontaminate.digest(scanned).collect()
    texts = {r[0]: r[1] for r in rows}
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in rows)
    for r in found:
        assert tuple(r[1:]) == brute.contamination(texts[r.doc_id], ITEMS)
    [span] = scanned.where("doc_id = 999").first().spans
    assert texts[999][span.start : span.end] == texts[999][:-1]
    assert decontaminate.scan(empty, bench).count() == 0
    none = decontaminate.scan(df, bench.where("false"))
    assert none.where("contaminated OR n_hit > 0").count() == 0
    kept = decontaminate.clean(spark.createDataFrame(rows, SCHEMA), bench)
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert 999 not in {r.doc_id for r in kept.collect()}


@pytest.mark.parametrize("small", [16, 1])
def test_near_duplicates(docs, small):
    found = minhash.near_duplicates(docs.df, small).collect()
    want = brute.near_duplicates(list(docs.by_id.items()))
    assert len(found) == len(docs.rows)
    for r in found:
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)


def test_pairs_are_verified_once_and_only_if_the_bitmaps_allow(spark, monkeypatch):
    """In a group of copies on both sides of the threshold, as the reviewer's hot table has it."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(100)]
    texts = []
    for k in range(60):
        words = base.copy()
        for at in rng.sample(range(100), rng.choice([0, 1, 2, 3, 4, 5])):
            words[at] = f"x{k}y{at}"
        texts.append(" ".join(words))
    asked, real = [], minhash.verified

    def counted(pairs, found):
        asked.append({(r.a, r.b) for r in pairs.collect()})
        return real(pairs, found)

    monkeypatch.setattr(minhash, "verified", counted)
    found = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 2).collect()
    want = brute.near_duplicates(list(enumerate(texts)))
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in found)
    sets = [minhash.shingle_set(t.encode()) for t in texts]
    likeness = [len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for pairs in asked for a, b in pairs]
    assert sum(map(len, asked)) == len(set().union(*asked)) and min(likeness) > 0.6


def test_keep_one(spark, docs, empty):
    rows = [(None, "a b c d e f"), (None, None), (1, "a b c d e f"), (2, "a b  c\nd E f")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS kept", "'x' AS component_id")
    assert sorted(str(r.doc_id) for r in minhash.keep_one(df).collect()) == ["1", "None", "None"]
    assert minhash.near_duplicates(empty).count() == 0


def test_pruning_keeps_what_may_be_alike():
    fewest = minhash.needed_matches()
    assert fewest == sorted(fewest) and fewest[-1] < 0.75 * 128 and fewest[-1] > 40


def test_language(spark, empty):
    rng = random.Random(2)
    said = {"en": "the and of with that this", "de": "der die und nicht schön für", "fr": "le la les été où avec"}
    rows = []
    for i in range(240):
        lang = ["en", "de", "fr"][i % 3]
        rows.append((i, " ".join(rng.choice(said[lang].split()) for _ in range(30)), lang, None, None))
    rows += [(900, None, "en", None, None), (901, "", None, None, None), (902, "12 34 !?", "en", None, None), (903, "the", None, None, None)]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], SCHEMA + ", score double")
    found = {r.doc_id: r for r in language.predictions(df).collect()}
    assert len(found) == len(rows)
    assert all(found[r[0]].lang_pred == r[2] for r in rows[:240])
    assert {found[i].lang_pred for i in (900, 901, 902)} == {"und"} and found[903].lang_pred == "en"
    kept = language.accepted(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {r[0] for r in rows[:240]}
    assert not {900, 901, 902} & {r.doc_id for r in kept.collect()}
    assert language.predictions(empty).count() == 0 and language.accepted(empty).count() == 0
    unlabelled = language.predictions(df.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang"))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_toxicity(spark, empty):
    rng = random.Random(4)
    rows, marks = [], []
    for i in range(400):
        bad = i % 5 == 0
        rows.append((i, prose(rng, 40) + (" YOU fool " if bad else " you "), None, None, None))
        marks.append((i, int(bad)))
    rows += [(900, None, None, None, None), (901, "", None, None, None)]
    marks += [(900, None), (5, 0), (7, 3), (None, 1)]
    df, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(marks, "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.predictions(df, labels).collect()}
    assert len(found) == len(rows)
    held = [i for i in range(400) if found[i].held_out]
    assert held and all(found[i].predicted == int(i % 5 == 0) for i in held)
    assert found[900].score == found[901].score and all(0 <= r.score <= 1 for r in found.values())
    assert toxicity.predictions(empty, labels).count() == 0
    assert {r.score for r in toxicity.predictions(df, labels.where("false")).collect()} == {0.0}


def test_pairs_that_weights_miss():
    import numpy as np

    rng = np.random.default_rng(1)
    x, y = [], []
    for _ in range(4000):  # toxic only if both terms stand there
        a, b = rng.random(2) < 0.5
        others = set(rng.integers(10, 60, 5).tolist())
        x.append(np.array(sorted([1] * int(a) + [2] * int(b) + list(others)), np.int32))
        y.append(float(a and b))
    machine = toxicity.fit(x, np.array(y))
    score = machine.score(x)
    both = np.array([1 in t and 2 in t for t in x])
    assert score[both].min() > score[~both].max()
    i, j = np.searchsorted(machine.kept, [1, 2])
    assert machine.factor[i] @ machine.factor[j] > 0


def test_lines(docs, empty):
    got = {tuple(r) for r in lines.removed_lines(docs.df).collect()}
    want = brute.repeated_lines(list(docs.by_id.items()))
    assert got == want and len(got) > 10
    out = lines.deduplicated(docs.df.selectExpr("*", "1 AS __gone")).collect()
    for r in out:
        text = docs.by_id[r.doc_id]
        if text is None:
            assert r.text is None
        else:
            kept = [x for i, x in enumerate(text.split("\n")) if (r.doc_id, i) not in want]
            assert r.text == "\n".join(kept)
    assert lines.removed_lines(empty).count() == 0 and lines.digest(docs.df).count() == len(docs.rows)


def _varied_lines() -> list[tuple[int, str]]:
    """One group of variants on both sides of the threshold that share their rarest words, by which they meet."""
    rng = random.Random(31)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(60):
        words = base.copy()
        for at in rng.sample(range(30, 60), rng.choice([0, 1, 3, 6, 9, 12])):
            words[at] = f"x{k % 7}y{at}"
        rows.append((k, " ".join(words)))
    return rows


def test_lines_are_compared_only_if_their_bitmaps_allow(spark, monkeypatch):
    rows, asked, real = _varied_lines(), [], lines._verified

    def counted(pairs, texts):
        asked.extend((r.x.doc_id, r.y.doc_id) for r in pairs.collect())
        return real(pairs, texts)

    monkeypatch.setattr(lines, "_verified", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in lines.removed_lines(df).collect()} == brute.repeated_lines(rows)
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(56)} for d, t in rows}
    assert asked and min(len(sets[x] & sets[y]) / len(sets[x] | sets[y]) for x, y in asked) > 0.6


def test_plans_of_lines_are_short(spark):
    """The driver keeps a description of every plan; the ranks of the words stand in it."""
    df = spark.createDataFrame([(k, f"{t} " * 50) for k, t in _varied_lines()], "doc_id long, text string")
    plan = lines.classes(df, lines.word_ranks(df))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 80_000


def test_texts_become_python_objects_a_few_at_a_time(spark):
    sizes = lambda texts: {"n": [len(texts)] * len(texts)}
    df = spark.range(3000, numPartitions=1).selectExpr("id AS doc_id", "'a b' AS text")
    found = common.with_columns(df, {"n": pa.int64()}, {"n": "long"}, lambda: sizes)
    assert found.count() == 3000 and found.agg({"n": "max"}).first()[0] <= 256
    assert common.where_text(df, lambda: lambda texts: [len(texts) <= 256] * len(texts)).count() == 3000



def test_lines_that_the_earliest_does_not_settle(spark):
    """A line like a middle one but not like the earliest that shares its rare words."""
    w = [f"w{i}" for i in range(60)]
    a, b, c = w[:40], w[6:46], w[12:52]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c)), (4, " ".join(w[13:53]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in lines.removed_lines(df).collect()} == brute.repeated_lines(rows)


def test_lines_that_share_rare_shingles_are_settled_at_once(spark, monkeypatch):
    """Shingles of a few lines: no further rounds over the tables, also where the earliest is no likeness."""
    rows = [(k, " ".join(f"w{i}" for i in range(6 * k, 6 * k + 40))) for k in range(12)]
    rows += [(20 + k, " ".join(f"w{i}" for i in range(6 * k + 1, 6 * k + 41))) for k in range(12)]
    df, rounds, real = spark.createDataFrame(rows, "doc_id long, text string"), [], lines._drawn
    monkeypatch.setattr(lines, "_drawn", lambda *tables: rounds.append(1) or real(*tables))
    want = brute.repeated_lines(rows)
    assert {tuple(r) for r in lines.removed_lines(df).collect()} == want and len(want) == 12 and not rounds


@pytest.mark.parametrize("few", [1, 3])
def test_lines_of_many_classes_are_settled_by_rounds(docs, monkeypatch, few):
    monkeypatch.setattr(lines, "FEW", few)
    for rows in (list(docs.by_id.items()), _varied_lines()):
        df = docs.df.sparkSession.createDataFrame(rows, "doc_id long, text string")
        assert {tuple(r) for r in lines.removed_lines(df).collect()} == brute.repeated_lines(rows)


def test_native_operators_stay_out_of_python(spark, docs, capsys):
    messages = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    for df in (lines.digest(docs.df), quotes.conversations(messages)):
        df.explain()
        plan = capsys.readouterr().out
        assert not [x for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop") if x in plan]


def test_conversations(spark):
    rows = [
        (1, 0, "user", "Shall we meet on Monday?\n\nOr rather later?"),
        (1, 1, "assistant", "> Shall we meet on monday\nYes, gladly."),
        (1, 2, "user", ">> Or rather later?\n> Yes, gladly!\nGood."),
        (1, 3, "user", "> or rather LATER\n> \nAlso good."),
        (1, 4, "user", "> said by nobody\nHm."),
        (2, 0, "user", "> Yes, gladly.\nAnother conversation."),
        (2, 1, "user", "Another conversation."),
        (2, 2, "user", ">Another conversation."),
        (2, 2, "user", ">Another conversation."),
        (None, 1, "user", "> a\nb"), (3, None, None, None), (3, 1, "user", None), (3, 2, "user", ""),
    ]
    df = spark.createDataFrame([(*r, "p") for r in rows], "conv_id long, turn long, role string, text string, path string")
    found = quotes.conversations(df)
    assert found.count() == len(rows)
    by = {(r.conv_id, r.turn): r for r in found.collect()}
    assert by[1, 1].text == "Yes, gladly." and by[1, 1].parent == 0 and by[1, 1].path == [0, 1]
    assert by[1, 2].parent == 1 and by[1, 2].path == [0, 1, 2] and by[1, 2].n_linked == 2 and by[1, 2].text == "Good."
    assert by[1, 3].parent == 0 and by[1, 3].path == [0, 3]
    assert by[1, 4].parent is None and by[1, 4].n_quotes == 1 and by[1, 4].n_linked == 0 and by[1, 4].text == "Hm."
    assert by[2, 0].parent is None and by[2, 2].parent == 1
    assert by[None, 1].text == "b" and by[3, 1].text is None and by[3, 2].text == ""
    reading = [r.turn for r in sorted((r for r in by.values() if r.conv_id == 1), key=lambda r: r.path)]
    assert reading == [0, 1, 2, 3, 4]
    assert quotes.conversations(df.where("false")).count() == 0


def test_long_threads(spark):
    rows = [(1, 0, "u", "line 0 of the talk")] + [(1, i, "u", f"> line {i - 1} of the talk\nline {i} of the talk") for i in range(1, 20)]
    found = quotes.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.turn: r.path for r in found.collect()} == {i: list(range(i + 1)) for i in range(20)}


def test_mixture(docs, empty):
    found = mixing.mix(docs.df).collect()
    assert len(found) == len(docs.rows)
    total = sum(r["size"] for r in found)
    assert sum(r.taken for r in found) == total
    sizes = {}
    for r in found:
        assert 0 <= r.taken <= 3 * r["size"] and r["size"] == len(brute.words(docs.by_id[r.doc_id], brute.BLANK))
        sizes[r.target, r.source_size] = sizes.get((r.target, r.source_size), 0) + r.taken
    longest = max(r["size"] for r in found)
    assert all(abs(taken - target) <= longest and target <= 3 * size for (target, size), taken in sizes.items())
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.mix(docs.df.repartition(3)).collect()))
    assert mixing.mix(empty).count() == 0 and mixing.mixture(empty).count() == 0
    mixed = mixing.mixture(docs.df)
    assert sum(r.taken for r in mixed.collect()) == total and mixed.columns == [*docs.df.columns, "taken"]


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 50), ("d", 0)], "skey string, source_size long")
    got = {r.skey: r.target for r in mixing.targets(sizes).collect()}
    # a and c stop at three times their size, d has nothing, b takes the rest
    assert got == {"a": 30.0, "b": 880.0, "c": 150.0, "d": 0.0}


def test_dropped_tables_leave_the_input(spark, tmp_path):
    from marketflow.llm.common import dropped, stored

    source = str(tmp_path / "source")
    spark.range(5).write.parquet(source)
    kept, copy = spark.read.parquet(source), stored(spark.range(5))
    files = [f.removeprefix("file://") for f in copy.inputFiles()]
    assert files and all(Path(f).exists() for f in files)
    dropped(copy)
    dropped(kept)
    assert not any(Path(f).exists() for f in files) and spark.read.parquet(source).count() == 5

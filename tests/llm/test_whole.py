"""Whole results: short lines, partial quotes and pairs of uncommon terms."""

import random

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from marketflow.llm import lines, quotes, toxicity
from tests.conftest import SMALL
from tests.llm import brute


def test_short_lines_go_too(spark):
    rows = [
        (1, "Share this\nles.\n\n \t\none two three four five six seven"),
        (2, "share  THIS\r\nthis share\nles.\n\n \t\nShare this now\none two three four"),
        (3, "Share this now\nles. les.\nles.\none two three four\none two three four five six seven\n\r"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in lines.removed_lines(df).collect()}
    assert got == {(2, 0), (2, 2), (3, 0), (3, 2), (3, 3), (3, 4)} == brute.repeated_lines(rows)


def test_texts_that_share_a_doc_id(spark):
    """The lines of each text are judged for themselves; equal rows are treated alike."""
    menu, alone = "menu and footer of this site here", "a line that stands only here in the corpus"
    rows = [(1, menu), (2, f"{menu}\nx"), (2, f"{alone}\ny"), (2, f"{alone}\ny"), (None, menu)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clash = lines.deduplicated(df.withColumns({"__key": F.lit(1), "__gone": F.lit(2), "__TEXT_": F.lit(3)})).collect()
    assert {(r["__key"], r["__gone"], r["__TEXT_"]) for r in clash} == {(1, 2, 3)}
    out = sorted((r.doc_id or 0, r.text) for r in clash)
    assert out == sorted([(0, menu), (1, menu), (2, "x"), (2, f"{alone}\ny"), (2, f"{alone}\ny")])
    assert sorted((r.n_removed for r in lines.digest(df).collect())) == [0, 0, 0, 0, 1]


def test_op10_with_short_lines(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    gone = brute.repeated_lines(list(texts.items()))
    assert any(len(texts[d].split("\n")[i].split()) < 5 for d, i in gone)
    for r in entry.queries()["op10_lines"](spark, SMALL).collect():
        every = texts[r.doc_id].split("\n")
        kept = [x for i, x in enumerate(every) if (r.doc_id, i) not in gone]
        assert (r.n_lines, r.n_removed, r.text) == (len(every), len(every) - len(kept), "\n".join(kept))


def test_stage_lines_with_short_lines(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)["lines"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    gone = brute.repeated_lines(list(texts.items()))
    left = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in texts.items()}
    found = {r.doc_id: r.text for r in stage(spark, docs, SMALL).collect()}
    assert found == {d: t for d, t in left.items() if t.strip() or t == texts[d]}


CHAT = "conv_id long, turn long, role string, text string"


def test_partial_quotes(spark):
    rows = [
        (0, "One is red.\nTwo is green and blue.\nThree is grey.\n\nFour stands apart.\n\nFive ends it."),
        (1, "Nothing of that."),
        (2, "> Four stands apart.\n>\n> Five ends it.\nTwo paragraphs."),
        (3, "> One is red.\n> Two is green\n> and blue.\nTwo lines, wrapped."),
        (4, "> green and\nPart of a line."),
        (5, "> One is red.\n> [...]\n> Five ends it.\nWith words left out."),
        (6, "> Nothing of that.\nFirst answer,\nin two lines.\n> Two lines, wrapped.\nSecond answer,\nalso in two."),
        (7, "> First answer,\n> in two lines.\nTo the first."),
        (8, "> is red Two\n> nobody said this\nHm."),
        (9, "> reen and\nNo words."),
    ]
    df = spark.createDataFrame([(1, t, "u", x) for t, x in rows], CHAT)
    by = {r.turn: r for r in quotes.conversations(df).collect()}
    assert {t: r.parent for t, r in by.items()} == {0: None, 1: None, 2: 0, 3: 0, 4: 0, 5: 0, 6: 3, 7: 6, 8: 0, 9: None}
    assert by[7].path == [0, 3, 6, 7] and by[5].n_linked == 1 and by[9].n_quotes == 1 and by[9].n_linked == 0


def test_quotes_against_the_plain_version(spark):
    rng = random.Random(6)
    chats = {}
    for conv in range(12):
        chat = []
        for turn in range(12):
            lines_of = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 5))]
            text = "\n".join(x + "\n" * (rng.random() < 0.3) for x in lines_of)
            for _ in range(rng.randint(0, 2) if turn else 0):
                source = rng.choice(chat)[1].split("\n")
                picked = [x for x in source if x and rng.random() < 0.7]
                text = "\n".join("> " + x[rng.choice([0, 0, 2]) :] for x in picked) + "\n" + text
            chat.append((turn, "> z z\n\n" + text if rng.random() < 0.2 else text))
        chats[conv] = chat
    df = spark.createDataFrame([(c, t, "u", x) for c, chat in chats.items() for t, x in chat], CHAT)
    want = {(c, t, n, brute.sha(w)): s for c, chat in chats.items() for (t, n, w), s in brute.quote_sources(chat).items()}
    got = {(r.conv_id, r.turn, r.level, r.key): r.source_turn for r in quotes.links(df).select("conv_id", "turn", "level", F.col("key"), "source_turn").collect()}
    assert got == want and len(want) > 50 and None in want.values()


def test_pairs_of_uncommon_terms():
    """Terms 1 and 2 stand in a twentieth of the texts each and tell nothing alone; together they are toxic."""
    rng = np.random.default_rng(1)
    x, y = [], []
    for _ in range(8000):
        u = rng.random()
        both, a, b = u < 0.01, u < 0.05, u < 0.01 or 0.05 <= u < 0.09
        y.append(float(both or (not (a or b) and rng.random() < 0.2)))
        x.append(np.array(sorted([1] * a + [2] * b + list(set(rng.integers(10, 60, 5).tolist()))), np.int32))
    machine = toxicity.fit(x, np.array(y))
    score = machine.score(x)
    first, second = (np.array([k in t for t in x]) for k in (1, 2))
    assert np.quantile(score[first & second], 0.1) > 0.6 > 0.3 > np.quantile(score[first ^ second], 0.9)
    i, j = np.searchsorted(machine.kept, [1, 2])
    assert machine.factor[i] @ machine.factor[j] > 0

"""Packing: ids against the whole tokenizer, places against the rules of a sequence, fill against the least possible."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from marketflow.llm import packing
from tests.conftest import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = list("abzAZ ..,,;:!?'\n\t09éÉüßÿÞ×÷àñ…“”-_") + [
    "'s", "'t", "'LL", "́", "ﬁ", "İ", "Σ", "ς", "ſ", "K", "\xa0", " ", "\x1c", "\x85", "\x00", "한",
    "<|endoftext|>", "🙂", "é", "ǅ", "½", "﻿", "‍", "\xad",
]


WHOLE = Tokenizer.from_file(PATH)


def whole(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [1]


def checked(rows, texts, length=4096):
    """Every piece of every text, each sequence gapless and short enough; the number of sequences."""
    want = []
    for doc_id, text in texts:
        ids = np.array(whole(text), "<u4")
        for piece, start in enumerate(range(0, len(ids), length)):
            cut = ids[start : start + length]
            want.append((doc_id, piece, start, len(cut), zlib.crc32(cut.tobytes())))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        end = 0
        for offset, size in sorted(spans):
            assert offset == end
            end += size
        assert end <= length
    return len(places)


def test_chunks_give_the_ids_of_whole_texts():
    rng = random.Random(5)
    encode = packing.Encoder(PATH)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    for text, ids in zip(texts, encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == whole(text)


def test_a_full_memory_of_chunks_is_emptied(monkeypatch):
    monkeypatch.setattr(packing, "CHUNKS", 3)
    encode, texts = packing.Encoder(PATH), ["one two three", "four five six", "one two", "x" * 500 + " one"] * 3
    assert [x.tolist() for x in encode([t.encode() for t in texts])] == [whole(t) for t in texts]


def test_query(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = entry.queries()["op11_packing"](spark, SMALL).collect()
    made = checked(rows, texts)
    assert made <= -(-sum(r.length for r in rows) // 4096) + 1


def test_tight_bins():
    bins = packing.Bins(10, 2)
    assert [bins.place(s) for s in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]  # 3 goes where it fits best
    assert bins.open == 0
    assert [bins.place(s) for s in (5, 8, 9)] == [(2, 0), (3, 0), (4, 0)]  # the fullest, 3, closes for 4
    assert bins.place(2) == (2, 5) and bins.place(1) == (4, 9)


@pytest.mark.parametrize("open_bins", [1, 8, 2048])
def test_fill(spark, open_bins):
    """Sizes of a long tail; many tasks and few open bins lose little."""
    rng = np.random.default_rng(2)
    sizes = np.clip(np.exp(rng.normal(6, 1, 20000)).astype(int), 1, 4096).tolist()
    cut = spark.createDataFrame([(i, 0, 0, s, i) for i, s in enumerate(sizes)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.packed(cut, open_bins=open_bins, per_task=5000).collect()
    ends, seen = defaultdict(int), defaultdict(int)
    for r in rows:
        ends[r.sequence_id] = max(ends[r.sequence_id], r.offset + r.length)
        seen[r.sequence_id] += r.length
    assert ends == seen and max(ends.values()) <= 4096 and len(rows) == len(sizes)
    if open_bins > 1000:
        assert len(ends) <= 1.003 * sum(sizes) / 4096 + 4
    again = packing.packed(cut.repartition(7), open_bins=open_bins, per_task=5000).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_odd_rows(spark):
    """Nulls, empty and very long texts, repeated rows, clashing columns, an empty table."""
    texts = [(1, "a b c"), (1, "a b c"), (1, "other"), (None, "no id"), (None, None), (2, None), (3, ""), (4, " \n"), (5, "word, " * 30000), (6, "y" * 20000)]
    df = spark.createDataFrame([(*t, 7, 8) for t in texts], "doc_id long, text string, piece int, sequence_id string")
    rows = packing.pack(df, PATH).collect()
    checked(rows, texts)
    assert packing.pack(df.where("false"), PATH).count() == 0
    short = packing.pack(df, PATH, length=64, with_ids=True)
    checked(short.collect(), texts, 64)
    out = {r.sequence_id: r.ids for r in packing.sequences(short).collect()}
    for r in short.collect():
        assert out[r.sequence_id][r.offset : r.offset + r.length] == r.ids and len(out[r.sequence_id]) <= 64

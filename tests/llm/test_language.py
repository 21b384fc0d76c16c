"""Rejection of unseen languages, the sample per language, long texts, and the forward pass from the definition."""

import random
import tracemalloc

import numpy as np
import pytest

from marketflow.llm import language

SYLLABLES = {"aa": "ban der fis gor hul jam".split(), "bb": "öst ührt ägn chl pft sch".split(), "cc": "ción ñar ll que rro ijo".split(), "dd": "zzyx qwv kxj vvt hqz xgk".split()}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def rows_of(rng, langs, n):
    out = []
    for i in range(n):
        lang = langs[i % len(langs)]
        counts = language.subwords(text_of(rng, lang, rng.randint(10, 200)).encode())
        buckets = np.flatnonzero(counts)
        out.append((buckets.astype(np.int32), counts[buckets].astype(np.int32), lang))
    return out


@pytest.fixture(scope="module")
def model():
    return language.fit(rows_of(random.Random(1), ["aa", "bb", "cc"], 600))


def test_unseen_languages_are_rejected(model):
    rng = random.Random(2)
    new = [model.predict(text_of(rng, "dd", 60).encode())[2] for _ in range(200)]
    known = [model.predict(text_of(rng, lang, n).encode()) for lang in ("aa", "bb", "cc") for n in (5, 30, 300) for _ in range(60)]
    assert np.mean(new) >= 0.9 and np.mean([r[2] for r in known]) <= 0.01
    assert [r[0] for r in known] == [lang for lang in ("aa", "bb", "cc") for _ in range(180)]


def plain_counts(text):
    """Buckets of all runs of 2, 3 and 4 bytes, one at a time."""
    low = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text)
    data, out = b" " + b" ".join(low.split()) + b" ", np.zeros(language.BUCKETS, np.int64)
    for n in (2, 3, 4):
        for i in range(len(data) - n + 1):
            out[((int.from_bytes(data[i : i + n], "little") + n) * 2654435761 % 2**32) >> 18] += 1
    return out


def test_forward_pass_from_the_definition(model, monkeypatch):
    rng = random.Random(3)
    for slab in (1 << 20, 7):
        monkeypatch.setattr(language, "SLAB", slab)
        for lang in ("aa", "bb", "cc"):
            text = (text_of(rng, lang, 20) + " 12, THE x.").encode()
            counts = plain_counts(text)
            assert (language.subwords(text) == counts).all()
            z = (sum(c * model.table[b] for b, c in enumerate(counts) if c) / counts.sum() + model.bias) / model.temperature
            p = np.exp(z) / np.exp(z).sum()
            found = model.predict(text)
            assert found[0] == model.languages[int(p.argmax())] and found[1] == pytest.approx(p.max(), rel=1e-6)


def test_long_texts_take_little_memory(model):
    text = (text_of(random.Random(4), "aa", 1000) * 2500).encode()
    assert len(text) > 15_000_000
    tracemalloc.start()
    found = model.predict(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[0] == "aa" and not found[2] and peak < 25 * len(text)


def test_every_language_is_sampled(spark):
    rows = [(i, "text", "rare" if i % 3000 == 7 else "mid" if i % 50 == 1 else "big") for i in range(9000)]
    rows += [(0, "other", "big"), (None, "text", "big")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").where("doc_id IS NOT NULL").repartition(5)
    found = language.sample_of(df, per_language=100).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in found} == {"rare": 3, "mid": 100, "big": 100}
    few = language.sample_of(df, per_language=100, size=30).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in few} == {"rare": 3, "mid": 10, "big": 10}
    assert {r.lang for r in language.sample_of(df, languages=2).select("lang").distinct().collect()} == {"big", "mid"}

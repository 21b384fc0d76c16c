"""Language ID: averaged hashed subword embeddings under a linear softmax, trained by stochastic gradient descent.

A text is lower-cased (A-Z) and every other ASCII character becomes a blank; its subwords are all runs of 2, 3 and 4
bytes, hashed into BUCKETS rows of an embedding table. The text's vector is the mean of its subwords' embeddings, and
a linear softmax over the vector gives a probability for each language. Texts of any length are read whole, SLAB bytes
at a time, into one count per bucket.

The model is trained with numpy on a documented bounded sample: at most PER_LANGUAGE documents of each language, those
whose doc_id hashes lowest, of the LANGUAGES most frequent languages, SAMPLE in all. A fifth is kept apart for
calibration. It gives a temperature for the probabilities, the confidence under which a prediction is rejected (the
lowest at which at most `ERROR` of the accepted ones are wrong), and the surprise over which it is: a softmax is sure of
texts in a language that it has never seen, so the mean surprise of a text's subwords under the frequencies of its
language is held against that of held-out texts, in standard deviations for its length; more than all but `ERROR` of
these, and more than `FAR`, is too much.

Null texts and texts without a letter are `und` with score 0 and rejected, as is everything if there is nothing to
learn from. Ties go to the language that sorts first. Repeated rows get equal predictions; of rows that repeat a doc_id
the smallest (lang, text) is learned from.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.common import where_text, with_columns
from marketflow.llm.learning import remainder

BUCKETS = 1 << 14
DIM = 16
SAMPLE = 8_000
PER_LANGUAGE = 400
LANGUAGES = 400
EPOCHS = 10
ERROR = 0.005
FAR = 8.0
SLAB = 1 << 20
UNKNOWN = "und"

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text) or _LETTER.search(text.decode("utf-8", "replace")))


def subwords(text: bytes) -> np.ndarray:
    """How often each bucket is hit by the subwords of a text."""
    data = np.frombuffer(b" " + b" ".join(text.translate(_LETTERS).split()) + b" ", np.uint8)
    found = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(data), SLAB):
        part = data[at : at + SLAB + 3].astype(np.uint32)
        code = part
        for n in (2, 3, 4):
            if len(part) < n:
                break
            code = code[:-1] + (part[n - 1 :] << np.uint32(8 * (n - 1)))
            bucket = (code[:SLAB] + np.uint32(n)) * np.uint32(2654435761) >> np.uint32(18)
            found += np.bincount(bucket, minlength=BUCKETS)
    return found


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # logits of one subword each: embeddings times weights
    bias: np.ndarray
    temperature: float
    threshold: float
    surprise: np.ndarray  # of a subword, under each language
    usual: np.ndarray  # mean surprise of the texts of each language
    spread: tuple[float, float]  # its variance between texts, and the variance of one subword
    far: float

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, rejected."""
        if not self.languages or text is None or not has_letter(text):
            return UNKNOWN, 0.0, True
        counts = subwords(text)
        n = counts.sum()
        share = counts / n
        logits = (share @ self.table + self.bias) / self.temperature
        p = np.exp(logits - logits.max())
        p /= p.sum()
        best = int(p.argmax())
        strange = self.strangeness(float(share @ self.surprise[:, best]), best, n)
        return self.languages[best], float(p[best]), bool(p[best] < self.threshold or strange > self.far)

    def strangeness(self, surprise: float, language: int, n: int) -> float:
        """Standard deviations by which the surprise of a text of n subwords exceeds that of its language."""
        between, within = self.spread
        return (surprise - self.usual[language]) / float(np.sqrt(between + within / n + 1e-9))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, str]], epochs: int = EPOCHS, error: float = ERROR) -> Model:
    """Train on (buckets, counts, language) of each document; every fifth is for calibration. Rows stay sparse; a batch
    of 64 is dense at a time."""
    languages = sorted({r[2] for r in rows})
    if not languages:
        none = np.zeros((BUCKETS, 0))
        return Model([], none, np.zeros(0), 1.0, 1.0, none, np.zeros(0), (0.0, 0.0), 0.0)

    def dense(part) -> np.ndarray:
        x = np.zeros((len(part), BUCKETS), np.float32)
        for i, k in enumerate(part):
            x[i, rows[k][0]] = rows[k][1] / rows[k][1].sum()
        return x

    y = np.array([languages.index(r[2]) for r in rows])
    apart = np.arange(len(rows)) % 5 == 4
    train = np.flatnonzero(~apart)
    rng = np.random.default_rng(7)
    embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    weight = rng.normal(0, 0.1, (DIM, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    seen = [np.full_like(a, 1e-8) for a in (embed, weight, bias)]
    for _ in range(epochs):
        rng.shuffle(train)
        for at in range(0, len(train), 64):
            part = train[at : at + 64]
            x = dense(part)
            mean = x @ embed
            slope = softmax(mean @ weight + bias)
            slope[np.arange(len(part)), y[part]] -= 1
            slope /= len(part)
            for a, s, g in zip((embed, weight, bias), seen, (x.T @ (slope @ weight.T), mean.T @ slope, slope.sum(axis=0)), strict=True):
                s += g * g
                a -= 0.1 * g / np.sqrt(s)
    held = np.flatnonzero(apart) if apart.any() else np.arange(len(rows))
    table = (embed @ weight).astype(np.float64)
    logits = np.concatenate([dense(held[at : at + 64]) @ embed @ weight for at in range(0, len(held), 64)]) + bias
    right = y[held]

    def loss(t: float) -> float:
        return -np.log(softmax(logits / t)[np.arange(len(held)), right] + 1e-12).mean()

    temperature = min(np.geomspace(0.05, 20, 60), key=loss)
    p = softmax(logits / temperature)
    top, wrong = p.max(axis=1), p.argmax(axis=1) != right
    order = np.argsort(-top)
    fine = np.flatnonzero(np.cumsum(wrong[order]) <= np.maximum(1, error * np.arange(1, len(held) + 1)))
    # Rejection starts at the first confidence at which the accepted ones err too often, and at 1 / (languages) at least.
    # A single wrong document of a small sample says nothing, so one is allowed.
    threshold = 0.0 if len(fine) and fine[-1] == len(held) - 1 else float(top[order[fine[-1]]]) if len(fine) else 1.0
    surprise, usual, spread = _surprises(rows, y, train, held, len(languages))
    model = Model(
        languages, table, bias.astype(np.float64), float(temperature), max(threshold, 1.0 / len(languages)), surprise, usual, spread, FAR
    )
    best = p.argmax(axis=1)
    strange = [
        model.strangeness(float(rows[k][1] @ surprise[rows[k][0], c] / rows[k][1].sum()), c, rows[k][1].sum())
        for k, c in zip(held.tolist(), best.tolist(), strict=True)
    ]
    model.far = max(FAR, float(np.quantile(strange, 1 - error)))
    return model


def _surprises(rows: list, y: np.ndarray, train: np.ndarray, held: np.ndarray, languages: int) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Surprise of each bucket under each language (from documents for training), the mean of the held-out texts of each
    language, and the variances of texts and of subwords."""
    total = np.ones((BUCKETS, languages))
    for k in train.tolist():
        total[rows[k][0], y[k]] += rows[k][1]
    surprise = -np.log(total / total.sum(axis=0))
    mean, within, size = (np.zeros(len(held)) for _ in range(3))
    for i, k in enumerate(held.tolist()):
        buckets, counts, _ = rows[k]
        each, size[i] = surprise[buckets, y[k]], counts.sum()
        mean[i] = counts @ each / size[i]
        within[i] = counts @ (each - mean[i]) ** 2 / size[i]
    known = y[held]
    pooled = float(mean.mean())
    usual = np.array([mean[known == c].mean() if (known == c).any() else pooled for c in range(languages)])
    # Subwords overlap and repeat within a text: one counts as a third of an independent one.
    one = 3 * float(within.mean())
    between = float(((mean - usual[known]) ** 2 - one / size).mean())
    return surprise, usual, (max(between, 0.01), one)


def sample_of(rows: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES, size: int = SAMPLE) -> DataFrame:
    """(doc_id, text, lang) of the documents to learn from; ids are ranked without their texts, and Spark cuts each
    language in every task before they meet."""
    often = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    chosen = [r.lang for r in often.collect()]
    quota = min(per_language, max(1, size // max(1, len(chosen))))
    key = F.xxhash64(F.col("doc_id").cast("string"))
    ranked = F.row_number().over(Window.partitionBy("lang").orderBy("k", "doc_id"))
    ids = rows.where(F.col("lang").isin(chosen)).select("lang", "doc_id", key.alias("k")).withColumn("rank", ranked)
    ids = ids.where(F.col("rank") <= quota).select("doc_id").distinct()
    picked = rows.join(F.broadcast(ids), "doc_id", "left_semi")  # at most `size` ids
    return picked.groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("s")).select("doc_id", "s.text", "s.lang")


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on a bounded sample of (doc_id, text, lang); texts become bucket counts before they reach the driver."""
    usable = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    sample = sample_of(usable.select("doc_id", "text", "lang"), per_language)

    def make():
        def run(texts):
            out = {"buckets": [], "counts": []}
            for text in texts:
                counts = subwords(text) if has_letter(text) else np.zeros(0, np.int64)
                buckets = np.flatnonzero(counts)
                out["buckets"].append(buckets.astype(np.int32))
                out["counts"].append(counts[buckets].astype(np.int32))
            return out

        return run

    rows = with_columns(
        sample,
        {"buckets": pa.list_(pa.int32()), "counts": pa.list_(pa.int32())},
        {"buckets": "array<int>", "counts": "array<int>"},
        make,
        ["doc_id", "lang"],
    ).select("doc_id", "buckets", "counts", "lang").toArrow()
    order = sorted(range(rows.num_rows), key=rows.column("doc_id").to_pylist().__getitem__)
    buckets, counts = rows.column("buckets"), rows.column("counts")
    found = [(buckets[i].values.to_numpy(), counts[i].values.to_numpy(), rows.column("lang")[i].as_py()) for i in order if len(buckets[i])]
    return fit(found)


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns in `keep`) with lang_pred, score and rejected."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def run(texts):
            found = [held.value.predict(t) for t in texts]
            return {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found], "rejected": [f[2] for f in found]}

        return run

    return with_columns(
        docs,
        {"lang_pred": pa.string(), "score": pa.float64(), "rejected": pa.bool_()},
        {"lang_pred": "string", "score": "double", "rejected": "boolean"},
        make,
        keep,
    )


def predictions(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per document; learned from the rows whose crc32(doc_id) mod 3 is not 1."""
    model = train(docs.where(remainder(F.col("doc_id"), 3) != 1), per_language)
    found = identify(docs, model, ["doc_id"])
    held = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def accepted(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The documents whose language is recognised, with their own columns."""
    model = train(docs.where(remainder(F.col("doc_id"), 3) != 1), per_language)
    held = docs.sparkSession.sparkContext.broadcast(model)
    return where_text(docs, lambda: lambda texts: [not held.value.predict(t)[2] for t in texts])

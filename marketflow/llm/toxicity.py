"""Toxicity: a factorization machine over hashed terms.

A text is the set of its words (letters and digits, A-Z in lower case), hashed into BUCKETS terms. The machine keeps
every term that stands in at least SEEN documents of the sample. It is trained in two rounds: first on the terms that
tell the labels apart by themselves (SIGMA standard deviations from the base rate) or are frequent (COMMON of the
documents), then, from there, on all terms, as pairs may tell what neither term does; in small steps, so that the many
terms that tell nothing stay near zero. The score is the
logistic function of  bias + sum of weights + sum over pairs of <factors, factors>, the last in linear time through
(sum v)^2 - sum v^2. Pairs are what an additive model misses, such as an insult next to the mention of a group.
Training is minibatch gradient descent with numpy on at most SAMPLE labelled documents (a documented bound); a fifth
of them is kept apart to stop at the best epoch and to calibrate the score (slope and offset). Scoring reads every
whole text.

Null and empty texts score as texts without terms. Labels other than 0 and 1 and null labels are not learned from;
of repeated labels of one document the largest counts. Without labels of both kinds every score is 0.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import alnum_words, with_columns
from marketflow.llm.learning import remainder, sample_of

BUCKETS = 1 << 22
SEEN, SIGMA, COMMON = 3, 5.0, 0.2
FACTORS = 4
SAMPLE = 20000
EPOCHS, STEPS = 15, 400  # passes over the sample, and updates at least
CUT = 0.3


def terms(text: bytes | None) -> np.ndarray:
    """Sorted distinct terms of a text."""
    found = {zlib.crc32(w) % BUCKETS for w in set(alnum_words(text or b""))}
    return np.array(sorted(found), np.int32)


@dataclass
class Machine:
    kept: np.ndarray  # terms with a weight, sorted
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def known(self, x: list[np.ndarray]) -> list[np.ndarray]:
        """Numbers of the kept terms of each text."""
        size = np.array([len(t) for t in x])
        every = np.concatenate(x) if len(x) else np.zeros(0, np.int32)
        at = np.minimum(np.searchsorted(self.kept, every), max(0, len(self.kept) - 1))
        hit = self.kept[at] == every if len(self.kept) else np.zeros(len(every), bool)
        row = np.repeat(np.arange(len(x)), size)
        return np.split(at[hit], np.cumsum(np.bincount(row[hit], minlength=len(x)))[:-1])

    def raw(self, x: list[np.ndarray]) -> np.ndarray:
        """Scores of texts given as numbers of kept terms, before calibration."""
        size = np.array([len(t) for t in x])
        out = np.full(len(x), self.bias)
        full = np.flatnonzero(size)
        if len(full):
            at = np.concatenate([x[i] for i in full])
            start = np.concatenate(([0], np.cumsum(size[full])[:-1]))
            v = self.factor[at]
            total = np.add.reduceat(v, start, axis=0)
            out[full] += np.add.reduceat(self.weight[at], start)
            out[full] += 0.5 * (total**2 - np.add.reduceat(v * v, start, axis=0)).sum(axis=1)
        return out

    def score(self, x: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(self.known(x)) + self.offset, -30, 30)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(y > 0, -z, z)).mean())


def _descended(
    m: Machine, x: list[np.ndarray], y: np.ndarray, train: np.ndarray, held: np.ndarray, rng: np.random.Generator,
    epochs: int, decay: float, rate: float, start: float,
) -> Machine:
    """The machine of the best epoch, `m` itself among them; `rate` of the weights, `start` of the factors' square sums."""
    n = len(m.kept)
    m = Machine(m.kept, m.bias, m.weight.copy(), m.factor.copy())
    seen_w, seen_v = np.full(n, 1e-4), np.full((n, FACTORS), start)
    best = None
    for epoch in range(epochs + 1):
        rng.shuffle(train)
        for begin in range(0, len(train) if epoch else 0, 128):
            part = [i for i in train[begin : begin + 128] if len(x[i])]
            if not part:
                continue
            rows = [x[i] for i in part]
            size = np.array([len(r) for r in rows])
            at, row = np.concatenate(rows), np.repeat(np.arange(len(rows)), size)
            g = (1 / (1 + np.exp(-np.clip(m.raw(rows), -30, 30))) - y[part]) / len(part)
            total = np.add.reduceat(m.factor[at], np.concatenate(([0], np.cumsum(size)[:-1])), axis=0)
            touched, near = np.unique(at, return_inverse=True)
            each = g[row]
            gw = np.bincount(near, each, len(touched)) + decay * m.weight[touched]
            pull = each[:, None] * (total[row] - m.factor[at])
            gv = np.stack([np.bincount(near, pull[:, k], len(touched)) for k in range(FACTORS)], axis=1)
            gv += decay * m.factor[touched]
            seen_w[touched] += gw * gw
            seen_v[touched] += gv * gv
            m.weight[touched] -= rate * gw / np.sqrt(seen_w[touched])
            m.factor[touched] -= 0.03 * gv / np.sqrt(seen_v[touched])
            m.bias -= rate * float(g.sum())
        now = _loss(m.raw([x[i] for i in held]), y[held])
        if best is None or now < best[0]:
            best = (now, Machine(m.kept, m.bias, m.weight.copy(), m.factor.copy()))
    return best[1]


def fit(x: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, decay: float = 2e-5) -> Machine | None:
    """The machine of the best epoch, calibrated; None without both labels."""
    if len(set(y.tolist())) < 2:
        return None
    apart = np.arange(len(x)) % 5 == 4
    if len(set(y[apart].tolist())) < 2 or len(set(y[~apart].tolist())) < 2:
        apart = np.zeros(len(x), bool)
    train, held = np.flatnonzero(~apart), np.flatnonzero(apart) if apart.any() else np.arange(len(x))
    rng = np.random.default_rng(9)
    share = y[train].mean()
    found, row = np.unique(np.concatenate([x[i] for i in train]), return_inverse=True)
    seen = np.bincount(row, minlength=len(found))
    toxic = np.bincount(row, np.repeat(y[train], [len(x[i]) for i in train]), len(found))
    sigma = np.abs(toxic - seen * share) / np.sqrt(np.maximum(seen, 1) * share * (1 - share))
    kept = found[seen >= SEEN]
    clear = ((sigma >= SIGMA) | (seen >= COMMON * len(train)))[seen >= SEEN]
    n = len(kept)
    m = Machine(kept, float(np.log(share / (1 - share))), np.zeros(n), rng.normal(0, 0.01, (n, FACTORS)))
    x = m.known(x)
    epochs = max(epochs, STEPS * 128 // len(train) + 1)
    m = _descended(m, [t[clear[t]] for t in x], y, train, held, rng, epochs, decay, 0.2, 1e-4)
    m = _descended(m, x, y, train, held, rng, epochs, decay, 0.01, 1e-6)
    z = m.raw([x[i] for i in held])
    a, b = 1.0, 0.0
    for _ in range(300):  # slope and offset by gradient descent on the standardised raw scores
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        scale = max(1.0, float((z * z).mean()))
        a -= 0.5 * float(((p - y[held]) * z).mean()) / scale
        b -= 0.5 * float((p - y[held]).mean())
    m.slope, m.offset = max(a, 0.05), b
    return m


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Machine | None:
    """Fit on at most `size` labelled documents; texts become terms before they reach the driver."""
    marks = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = sample_of(docs.select("doc_id", "text").join(marks, "doc_id"), size, "toxic")

    def make():
        return lambda texts: {"terms": [terms(t) for t in texts]}

    rows = with_columns(sample, {"terms": pa.list_(pa.int32())}, {"terms": "array<int>"}, make, ["doc_id", "toxic"])
    table = rows.select("doc_id", "toxic", "terms").toArrow()
    found = sorted(
        zip(table.column("doc_id").to_pylist(), table.column("toxic").to_pylist(),
            [x.values.to_numpy() for x in table.column("terms")], strict=True),
        key=lambda r: r[0],
    )
    return fit([r[2] for r in found], np.array([r[1] for r in found], np.float64))


def scored(docs: DataFrame, machine: Machine | None, cut: float = CUT, keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns in `keep`) with score and predicted."""
    held = docs.sparkSession.sparkContext.broadcast(machine)

    def make():
        def run(texts):
            if held.value is None or not texts:
                return {"score": [0.0] * len(texts), "predicted": [0] * len(texts)}
            score = held.value.score([terms(t) for t in texts])
            return {"score": score, "predicted": (score >= cut).astype(np.int32)}

        return run

    return with_columns(
        docs, {"score": pa.float64(), "predicted": pa.int32()}, {"score": "double", "predicted": "int"}, make, keep
    )


def predictions(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """One row per document; learned from labels of rows whose crc32(doc_id) mod 4 is not 2."""
    learn = remainder(F.col("doc_id"), 4) != 2
    machine = train(docs.where(learn), labels.where(learn), size)
    out = scored(docs, machine, keep=["doc_id"])
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")

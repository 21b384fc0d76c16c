"""MinHash near-duplicates with sequential Bayesian verification.

Documents are linked when 100 * intersection >= 75 * union of their sets of distinct five-word shingles. The way there:

1. One pass over the texts gives each set a 128-bit key, 64 band keys of 6 minima each, a signature of 128 bytes and a
   bitmap of its shingles. Equal sets are one node (its smallest doc_id) from here on, so copies never meet each other.
2. Nodes with equal band keys are candidates: each node against one of its bucket, and in buckets of at
   most `small` nodes also all others. The chance that a link at exactly 0.75 shares no bucket is 0.822**64 = 4e-6.
3. Larger buckets are not paired out; each node meets one node of the bucket, drawn by hash. When the nodes turn out
   to be one component, nothing is left to find in the bucket. Otherwise nodes of different components are compared
   by their bitmaps, which bound the likeness from above, and only those that may be linked and have not met go on.
4. Each candidate's signatures are compared a batch at a time. A pair is dropped as soon as the posterior probability
   of a likeness of 0.75 or more is under `miss`. Then the bitmaps drop what cannot reach 0.75.
5. Survivors are verified on the full sets of the texts themselves. Components come from the verified links.

Null and empty texts have no shingles and link with nothing. A text of one to four words is one shingle. Rows that
repeat a doc_id count as one document for the links. Rows without doc_id link with nothing and keep a null
component. Other columns pass through `keep_one`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import PrefixHashes, blank_words, free_name, scrambled, stored, with_columns
from marketflow.llm.components import components

WIDTH = 5
BANDS, ROWS = 64, 6
BATCH, BATCHES = 16, 8
MISS = 1e-6
SMALL = 16
BITS = 1024

_RNG = np.random.default_rng(6)
_FLIP = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_FACTOR = _RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BAND_SEED = _RNG.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes, width: int = WIDTH) -> set[bytes]:
    words = blank_words(text)
    if not words:
        return set()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def linked(a: set, b: set) -> bool:
    shared = len(a & b)
    return bool(a) and bool(b) and 100 * shared >= 75 * (len(a) + len(b) - shared)


def shingle_hashes(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    words = blank_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    start = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    end = start + lengths
    span = min(width, len(words))
    hashes = PrefixHashes(np.frombuffer(b" ".join(words), np.uint8))
    return np.unique(scrambled(hashes.of(start[: len(words) - span + 1], end[span - 1 :])))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each permutation over a set that is not empty."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_FLIP), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 512):
        block = (low[at : at + 512, None] ^ _FLIP) * _FACTOR
        np.minimum(least, block.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    mixed = (scrambled(least.reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)) * _BAND_SEED).sum(axis=1, dtype=np.uint64)
    return scrambled(mixed + _BAND_SEED[:, 0]).view(np.int64)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """The shingles as BITS bits in longs."""
    bits = np.zeros(BITS, np.uint8)
    bits[(shingles & np.uint64(BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, signature, bits) for each row."""

    def make():
        def run(texts):
            out = {"n_shingles": [], "set_key": [], "bands": [], "signature": [], "bits": []}
            for text in texts:
                shingles = shingle_hashes(text or b"")
                out["n_shingles"].append(len(shingles))
                if len(shingles):
                    least = minima(shingles)
                    out["set_key"].append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    out["bands"].append(band_keys(least))
                    out["signature"].append((least[: BATCH * BATCHES] * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8).tobytes())
                    out["bits"].append(bitmap(shingles))
                else:
                    for c in ("set_key", "bands", "signature", "bits"):
                        out[c].append(None)
            return out

        return run

    return with_columns(
        docs,
        {"n_shingles": pa.int64(), "set_key": pa.binary(), "bands": pa.list_(pa.int64()), "signature": pa.binary(), "bits": pa.list_(pa.int64())},
        {"n_shingles": "long", "set_key": "binary", "bands": "array<long>", "signature": "binary", "bits": "array<long>"},
        make,
        ["doc_id"],
    )


def needed_matches(threshold: float = 0.75, miss: float = MISS) -> list[int]:
    """For each batch: the fewest matching bytes so far at which P(likeness >= threshold | matches) is not under `miss`.

    Uniform prior on the likeness j; two bytes agree with probability j + (1 - j) / 256.
    """
    j = (np.arange(20000) + 0.5) / 20000
    agree = j + (1 - j) / 256
    fewest = []
    for n in range(BATCH, BATCH * BATCHES + 1, BATCH):
        for m in range(n + 1):
            logs = m * np.log(agree) + (n - m) * np.log1p(-agree)
            p = np.exp(logs - logs.max())
            if p[j >= threshold].sum() / p.sum() >= miss:
                break
        fewest.append(m)
    return fewest


def possible(n: np.ndarray, x: np.ndarray, m: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether sets of n and m shingles with bitmaps x and y may be linked.

    Each bit that only one of the two has stands for a shingle at least that the other lacks.
    """
    most = np.minimum(n - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64), m - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64))
    return (100 + 75) * most >= 75 * (n + m)


def plausible(pairs: DataFrame, nodes: DataFrame, miss: float = MISS) -> DataFrame:
    """The pairs (a, b) that survive the sequential comparison of their signatures and that of their bitmaps."""
    fewest = needed_matches(miss=miss)
    a, b = (nodes.select(F.col("node").alias(k), F.col("signature").alias(f"s{k}"), F.col("n_shingles").alias(f"n{k}"), F.col("bits").alias(f"x{k}")) for k in "ab")
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb", "na", "nb", "xa", "xb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BATCH * BATCHES)
                for c in ("sa", "sb")
            )
            alive, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
            for k, least in enumerate(fewest):
                part = slice(k * BATCH, (k + 1) * BATCH)
                matches = matches + (left[alive, part] == right[alive, part]).sum(axis=1)
                alive, matches = alive[matches >= least], matches[matches >= least]
            rest = batch.take(pa.array(alive))
            n, m = (rest.column(c).to_numpy() for c in ("na", "nb"))
            x, y = (rest.column(c).flatten().to_numpy().view(np.uint64).reshape(-1, BITS // 64) for c in ("xa", "xb"))
            yield rest.select(["a", "b"]).filter(pa.array(possible(n, x, m, y)))

    return both.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold.

    The texts are dealt out once, to both ends of every pair together; a pair then brings two rows to its number.
    """
    numbered = pairs.withColumn("pair", F.struct("a", "b"))
    ends = numbered.select(F.explode(F.array("a", "b")).alias("node"), "pair")
    sides = ends.join(texts, "node").select("pair.a", "pair.b", (F.col("node") == F.col("pair.b")).alias("second"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, first = None, []  # the pair under way and the sets of its first end (several if rows repeat a doc_id)
        for batch in batches:
            out: tuple[list, list] = ([], [])
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "second", "text")]
            for a, b, second, text in zip(*columns, strict=True):
                if pair != (a, b):
                    pair, first = (a, b), []
                shingles = shingle_set(text)
                if not second:
                    first.append(shingles)
                elif any(linked(x, shingles) for x in first):
                    out[0].append(a)
                    out[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b"])

    dealt = sides.repartition("a", "b").sortWithinPartitions("a", "b", "second")
    return dealt.select("a", "b", "second", F.col("text").cast("binary").alias("text")).mapInArrow(run, "a long, b long")


def _buckets(rows: DataFrame, small: int) -> DataFrame:
    """Rows (bucket, node) of buckets with two nodes or more, with one of them as the bucket's first.

    The first is drawn by hash, so a node that is in many large buckets meets many different ones.
    """
    draw = F.min(F.struct(F.xxhash64("bucket", "node"), "node"))["node"]
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size"), draw.alias("first")).where("size > 1")
    return rows.join(shared, "bucket").withColumn("large", F.col("size") > small)


def _candidates(shared: DataFrame) -> DataFrame:
    ends = F.least("first", "node").alias("a"), F.greatest("first", "node").alias("b")
    star = shared.where(F.col("node") != F.col("first")).select(*ends)
    few = shared.where(~F.col("large"))
    x, y = few.alias("x"), few.alias("y")
    inside = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.node") < F.col("y.node")))
    return star.union(inside.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))).distinct()


def _open(shared: DataFrame, joined: DataFrame) -> DataFrame:
    """Rows of large buckets that hold more than one component, with the component of each node."""
    rows = shared.where("large").select("bucket", "node").join(joined, "node", "left")
    rows = rows.withColumn("component", F.coalesce("component", "node"))
    several = rows.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return rows.join(several.select("bucket"), "bucket")


def _across(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of nodes of different components in one bucket whose bitmaps allow a link (as in `possible`).

    A node meets its bitmap once, with the list of its buckets.
    """
    lists = rows.groupBy("node", "component").agg(F.collect_list("bucket").alias("buckets"))
    bitmaps = nodes.select("node", F.col("n_shingles").alias("n"), "bits")
    mapped = stored(lists.join(bitmaps, "node").select(F.explode("buckets").alias("bucket"), "node", "component", "n", "bits"))
    x, y = mapped.alias("x"), mapped.alias("y")

    def lacking(a: str, b: str) -> Column:
        return sum((F.bit_count(F.col(f"{a}.bits")[i].bitwiseAND(F.bitwise_not(F.col(f"{b}.bits")[i]))) for i in range(BITS // 64)), F.lit(0))

    most = F.least(F.col("x.n") - lacking("x", "y"), F.col("y.n") - lacking("y", "x"))
    may = (100 + 75) * most >= 75 * (F.col("x.n") + F.col("y.n"))
    pairs = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.node") < F.col("y.node"))
                   & (F.col("x.component") != F.col("y.component")) & may)
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def links_of(docs: DataFrame, nodes: DataFrame, small: int = SMALL) -> tuple[DataFrame, DataFrame]:
    """Verified links between nodes, and the components they make. `nodes`: (node, n_shingles, bands, signature, bits) of
    each set."""
    shared = stored(_buckets(nodes.select(F.explode("bands").alias("bucket"), "node"), small))
    meeting = shared.select("node").distinct()
    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").alias("node"), "text")
    texts = stored(texts.join(meeting, "node"))
    sides = stored(nodes.drop("bands").join(meeting, "node", "left_semi"))
    met = stored(plausible(_candidates(shared), sides))
    links = stored(verified(met, texts))
    joined = stored(components(links))
    rest = stored(_open(shared, joined))
    if not rest.isEmpty():
        others = _across(rest, sides).join(met, ["a", "b"], "left_anti")
        pairs = stored(plausible(others, sides))
        links = stored(links.union(verified(pairs, texts)).distinct())
        joined = stored(components(links))
    return links, joined


def near_duplicates(docs: DataFrame, small: int = SMALL) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `docs`."""
    found = stored(features(docs.select(F.col("doc_id").cast("long"), "text")))
    known = found.where(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull())
    first = known.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    nodes = known.join(first, "set_key").where(F.col("doc_id") == F.col("node"))
    nodes = nodes.select("node", "n_shingles", "bands", "signature", "bits").dropDuplicates(["node"])
    _, joined = links_of(docs, nodes, small)
    home = first.join(joined, "node", "left").select("set_key", F.coalesce("component", "node").alias("component_id"))
    rows = found.select("doc_id", "n_shingles", "set_key").alias("r").join(home.alias("h"), "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """`docs` with one document of each component, the one with the smallest doc_id; its repeated rows stay."""
    name = free_name(docs, "__gone")
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")

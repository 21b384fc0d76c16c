"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows.

A window is 13 consecutive words of a benchmark item (an item of fewer words is one window). Texts are normalised to
their words with single blanks between, scanned once, and the hits are mapped back to words and to code points of
the original text. A document is contaminated if at least one word and at least a twentieth of its words are hit.

The automaton is held in memory by each task, so its input is measured first: items are split into blocks of at most
`block_bytes` of window text, each block is scanned by itself, and the hits of all blocks are merged per document. One
block is the usual case and needs no shuffle.

Null and empty texts have no words and are clean. Items without words match nothing; repeated items count once by
item_id. An empty benchmark leaves every document clean. Repeated documents are judged row by row.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import alnum_words, with_columns

WINDOW = 13
BLOCK_BYTES = 32_000_000
SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
SPANS = "array<struct<start:int,end:int>>"


def windows(text: bytes, window: int = WINDOW) -> set[bytes]:
    words = alnum_words(text)
    if not words:
        return set()
    return {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))}


def automaton(items: list[tuple[int, bytes]], window: int = WINDOW) -> ahocorasick.Automaton:
    """One automaton; each pattern is a window between blanks, its value the words of the window and the items."""
    owners: dict[bytes, set[int]] = {}
    for item, text in items:
        for w in windows(text, window):
            owners.setdefault(w, set()).add(item)
    built = ahocorasick.Automaton()
    for w, ids in owners.items():
        built.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, tuple(sorted(ids))))
    if owners:
        built.make_automaton()
    return built


def hits(built: ahocorasick.Automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
    """Merged word ranges inside any window, and the items whose windows occur."""
    if not len(built) or not words:
        return [], set()
    found = list(built.iter(f" {b' '.join(words).decode('latin-1')} "))
    if not found:
        return [], set()
    ends = np.cumsum([len(w) + 1 for w in words])  # place of the blank after each word
    last = np.searchsorted(ends, [at for at, _ in found])
    items: set[int] = set()
    spans: list[tuple[int, int]] = []
    for end, (_, (n, ids)) in zip(last.tolist(), found, strict=True):
        items.update(ids)
        start = end + 1 - n
        while spans and start <= spans[-1][1]:
            start = min(start, spans.pop()[0])
        spans.append((start, end + 1))
    return spans, items


def original_spans(text: bytes, spans: list[tuple[int, int]]) -> list[dict]:
    """Code point ranges of word ranges in the text as it was."""
    if not spans:
        return []
    at = [m.span() for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", text)]
    return [
        {"start": len(text[: at[a][0]].decode("utf-8", "replace")), "end": len(text[: at[b - 1][1]].decode("utf-8", "replace"))}
        for a, b in spans
    ]


def _scan(docs: DataFrame, items: list[tuple[int, bytes]], window: int, keep: list[str] | None) -> DataFrame:
    """Columns n_words, word_spans, spans and items of one block of benchmark items."""
    held = docs.sparkSession.sparkContext.broadcast(items)

    def make():
        built = automaton(held.value, window)

        def run(texts):
            out = {"n_words": [], "word_spans": [], "spans": [], "items": []}
            for text in texts:
                words = alnum_words(text or b"")
                spans, found = hits(built, words)
                out["n_words"].append(len(words))
                out["word_spans"].append([{"start": a, "end": b} for a, b in spans])
                out["spans"].append(original_spans(text, spans))
                out["items"].append(sorted(found))
            return out

        return run

    return with_columns(
        docs,
        {"n_words": pa.int64(), "word_spans": SPAN, "spans": SPAN, "items": pa.list_(pa.int64())},
        {"n_words": "long", "word_spans": SPANS, "spans": SPANS, "items": "array<long>"},
        make,
        keep,
    )


def _merged(spans):
    """Union of ranges given as an array of structs, as SQL."""
    ordered = F.array_sort(spans)
    return F.aggregate(
        ordered,
        F.array().cast(SPANS),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.element_at(acc, -1)["start"].alias("start"),
                        F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
         keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns in `keep`, with doc_id) with n_words, word_spans, spans (code points of the original), items, n_hit, n_items, contaminated."""
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("binary").alias("text")).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] * window
    blocks = max(1, -(-size // block_bytes))
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    parts = []
    base = docs if blocks == 1 else docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    kept = keep if keep is None or blocks == 1 else [*keep, "__row"]
    for block in range(blocks):
        rows = numbered.where(F.col("block") == block).collect()
        parts.append(_scan(base, [(r.item_id, bytes(r.text)) for r in rows], window, kept))
    if blocks == 1:
        found = parts[0]
    else:
        keys = ["doc_id", "__row"]
        slim = [p.where(F.size("items") > 0).select(*keys, "word_spans", "spans", "items") for p in parts]
        every = slim[0]
        for part in slim[1:]:
            every = every.unionByName(part)
        merged = every.distinct().groupBy(*keys).agg(
            _merged(F.flatten(F.collect_list("word_spans"))).alias("word_spans"),
            _merged(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        plain = parts[0].drop("word_spans", "spans", "items").alias("d")
        m = merged.alias("m")
        same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.__row") == F.col("m.__row"))
        found = plain.join(m, same, "left").select(
            "d.*",
            *[F.coalesce(F.col(f"m.{c}"), F.array().cast(t)).alias(c) for c, t in
              (("word_spans", SPANS), ("spans", SPANS), ("items", "array<long>"))],
        ).drop("__row")
    n_hit = F.aggregate("word_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.withColumns({"n_hit": n_hit, "n_items": F.size("items").cast("long")}).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    return scan(docs, benchmark, window).where(~F.col("contaminated")).select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(scanned: DataFrame) -> DataFrame:
    """One row per document as the registered query returns it."""
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return scanned.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(ids, 256).alias("items_sha256"), "contaminated"
    )

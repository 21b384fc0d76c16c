"""Phrase collocations: exact counts of word n-grams in weighted acyclic automata, cohesion scores, the best per language.

Every language (null: `und`) is counted for itself. A phrase is 1 to `LONGEST` words that stand together within a piece.

1. `borders`: a bounded sample of places in the texts gives the borders of key ranges, keys being (lang, word, ...) in
   byte order. Borders only deal out the work; a frequent first word is split by its next words.
2. `survey`: each task counts the words, bigrams and trigrams of its documents in a fixed number of hashed cells, each up
   to `LEAST`. Cells that reach `LEAST` over all tasks are kept as bits: no phrase of `LEAST` occurrences lies in another
   cell, so the rest need not be counted.
3. `shards`: the phrases of 1 to `LONGEST` words whose words, bigrams and trigrams all lie in kept cells are counted,
   sorted and built into count transducers, cut at the borders. The words of a language are the weight of its empty phrase.
4. `summed`: the transducers of a range are united and their weights added up, `FAN` at a time.
5. `looked_up`: a candidate needs the counts of its parts. Each range of candidates asks each range of parts once for
   each distinct part; the requests are an automaton too, composed with the count transducer of the range.
6. `collocations`: the lowest cut of each candidate counts; candidates whose words lie in a longer one of the same
   frequency go; the first `TOP` of each language stay, found in `SALTS` parts before they meet.

The work per task is bounded by `FLUSH` words and by the width of a range. What goes to the driver is the sample and the
bits (at most 3 * 2^27 / 8 bytes, both bounded); bits go to all tasks. Where the corpus outgrows the cells, more phrases
are counted, none less. Scores are exact whole numbers.

Null and empty texts have no words. Every row counts, also rows that repeat a doc_id; only text and lang are read. Ties
are settled by score, a, then the bytes of the phrase. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm import automata
from marketflow.llm.common import dropped, scrambled, shuffle_width, stored

LONGEST = 5  # words of a phrase
LEAST = 100  # occurrences of a candidate
TOP = 2000  # phrases of a language
FLUSH = 5_000_000  # words a task holds before it writes their counts
BLOCK = 20_000  # keys of a stored transducer
FAN = 64  # transducers united at a time
SALTS = 32
SAMPLE = 20_000  # places that set the borders, at most
CELL_BYTES = 256  # bytes of text for each hashed cell of an order
CELL_BITS = (16, 27)  # least and most cells of each order, as powers of two
SLICE = 1 << 16  # cells of a stored slice
SLAB = 1 << 20  # bytes of a text that are split at a time

# A-Z in lower case, piece ends as full stops, tabs as blanks
_CLASSES = bytes(b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
_U = np.uint64


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words and piece ends (b"."), a slab at a time."""
    text = text.translate(_CLASSES)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + SLAB)
        end = len(text) if end < 0 else end
        yield text[at:end].replace(b".", b" . ").split()
        at = end


class _Numbers(dict):
    """Words by number of their first sight."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Shard:
    """The words of some documents by language, as numbers; 0 ends a piece."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers({b".": 0})
        self.parts: dict[bytes, list[np.ndarray]] = {}
        self.size = 0

    def add(self, lang: bytes, text: bytes) -> None:
        parts = self.parts.setdefault(lang, [])
        for words in tokens(text):
            found = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
            parts.append(found)
            self.size += len(found)
        parts.append(np.zeros(1, np.int32))

    def ranked(self) -> tuple[list[bytes], Iterator[tuple[bytes, np.ndarray]]]:
        """The words in byte order (from 1), and for each language in order its words by rank, 0 between pieces."""
        names = list(self.numbers)
        order = sorted(range(1, len(names)), key=names.__getitem__)
        rank = np.zeros(len(names), np.int32)
        rank[order] = np.arange(1, len(names))
        return [b"", *(names[i] for i in order)], ((lang, rank[np.concatenate(self.parts[lang])]) for lang in sorted(self.parts))


def hashes(names: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))


ORDERS = 3  # words, bigrams and trigrams have cells


def cells_of(h: np.ndarray, t: np.ndarray, lang: bytes, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For words, bigrams and trigrams at every place: whether they lie within a piece, and their cell."""
    word = h[t]
    value, ok = scrambled(word ^ _U(xxhash.xxh3_64_intdigest(lang))), t > 0
    for k in range(ORDERS):
        if k:
            n = max(0, len(t) - k)
            value = scrambled(value[:n] * _U(0x9E3779B97F4A7C15) + word[k : k + n])
            ok = ok[:n] & (t[k : k + n] > 0)
        yield ok, (value >> _U(64 - bits)).astype(np.int64)


def counts_of(t: np.ndarray, places: list[np.ndarray], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrases at the given places of each order, from one word on: rows of ranks (0: no more words) in byte order, and
    how often each stands there. The places of an order are among those of the order before."""
    rows, counts = [], []
    group = np.zeros(len(t), np.int64)  # the number of the phrase of one word less at each place
    for k, at in enumerate(places):
        distinct, first, inverse, n = np.unique(
            group[at] * (words + 1) + t[at + k], return_index=True, return_inverse=True, return_counts=True
        )
        group[at] = inverse
        row = np.zeros((len(distinct), len(places)), np.int64)
        row[:, : k + 1] = t[at[first][:, None] + np.arange(k + 1)]
        rows.append(row)
        counts.append(n)
    rows, counts = np.concatenate(rows), np.concatenate(counts)
    order = np.lexsort(rows.T[::-1])
    return rows[order], counts[order]


def blocks(items: list[tuple[automata.Key, int]], limits: list[automata.Key]) -> Iterator[tuple[int, automata.Transducer]]:
    """Sorted keys as transducers of at most BLOCK keys, each within one range."""
    keys = [k for k, _ in items]
    edges = [0, *(bisect_left(keys, b) for b in limits), len(keys)]
    for part in range(len(edges) - 1):
        for at in range(edges[part], edges[part + 1], BLOCK):
            yield part, automata.built(items[at : min(at + BLOCK, edges[part + 1])])


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary")
    return docs.select(lang.alias("lang"), F.col("text").cast("binary").alias("text")).where("text IS NOT NULL")


def _in_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """The texts of a task, `FLUSH` words at a time."""
    shard = Shard()
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            shard.add(lang, text)
            if shard.size >= FLUSH:
                yield shard
                shard.clear()
    yield shard


def borders(docs: DataFrame, parts: int) -> tuple[list[automata.Key], int]:
    """Keys that part the ranges, and the bytes of all texts. The sample is one place of each distinct text whose hash is
    low enough that about 64 for each range, and SAMPLE in all, come to the driver."""
    found = docs.where("text IS NOT NULL").agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("n")).first()
    share = min(1.0, min(SAMPLE, 64 * parts) / max(1, found.n))
    text, h = F.col("text").cast("string"), F.xxhash64("text")
    place = F.substring(text, F.pmod(h, F.greatest(F.length(text), F.lit(1))).cast("int") + 1, F.lit(160))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary")
    low = docs.where(F.col("text").isNotNull() & (h <= F.lit(int(share * 2**64) - 2**63 - 1)))
    drawn = low.select(F.struct(lang.alias("lang"), place.cast("binary").alias("at")).alias("s"), h.alias("h"))
    keys = set()
    for (r,) in drawn.groupBy("h").agg(F.min("s").alias("s")).select("s").collect():
        words = [w for part in tokens(bytes(r.at)) for w in part][1:]
        key = words[: words.index(b".")] if b"." in words else words
        if key:
            keys.add((bytes(r.lang), *key[:3]))
    ordered = sorted(keys)
    return sorted({ordered[len(ordered) * i // parts] for i in range(1, parts)}) if ordered else [], found["size"] or 0


def survey(docs: DataFrame, bits: int, least: int) -> DataFrame:
    """slot, cells: how often each cell was met in a task, up to `least`, in deflated slices; slices that were not met are left
    out, so what a task writes grows with its words and not with the number of cells."""
    kind = np.min_scalar_type(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros((ORDERS, 1 << bits), kind)
        for shard in _in_shards(batches):
            names, languages = shard.ranked()
            h = hashes(names)
            for lang, t in languages:
                for order, (fits, cells) in enumerate(cells_of(h, t, lang, bits)):
                    cell, n = np.unique(cells[fits], return_counts=True)
                    met[order, cell] = np.minimum(met[order, cell] + n, least)
        for slot, cut in enumerate(met.reshape(-1, min(SLICE, 1 << bits))):
            if cut.any():
                cells = pa.array([zlib.compress(cut.tobytes(), 1)], pa.binary())  # most cells are 0 or small
                yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), cells], ["slot", "cells"])

    return _texts(docs).mapInArrow(run, "slot int, cells binary")


def kept_cells(cells: DataFrame, bits: int, least: int) -> np.ndarray:
    """Whether each cell of each order reaches `least` over all tasks."""
    kind, width = np.min_scalar_type(least), min(SLICE, 1 << bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, total = None, np.zeros(width, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([np.packbits(total >= least).tobytes()], pa.binary())], ["slot", "bits"])

        for batch in batches:
            for number, cut in zip(batch.column("slot").to_pylist(), batch.column("cells"), strict=True):
                if number != slot:
                    if slot is not None:
                        yield out()
                    slot, total = number, np.zeros(width, np.int64)
                total += np.frombuffer(zlib.decompress(cut.as_buffer()), kind)
        if slot is not None:
            yield out()

    kept = np.zeros(((ORDERS << bits) // width, width // 8), np.uint8)
    for r in cells.repartition("slot").sortWithinPartitions("slot").mapInArrow(run, "slot int, bits binary").collect():
        kept[r.slot] = np.frombuffer(r.bits, np.uint8)
    return kept.reshape(ORDERS, -1)


def _frequent(kept: np.ndarray, t: np.ndarray, h: np.ndarray, lang: bytes, bits: int, longest: int) -> list[np.ndarray]:
    """For each order the places where a phrase begins whose words, bigrams and trigrams lie in kept cells."""
    may, places = None, []
    for row, (fits, cells) in zip(kept, cells_of(h, t, lang, bits), strict=True):
        fits = fits & (row[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1).astype(bool)
        may = fits if may is None else fits & may[: len(fits)] & may[1 : len(fits) + 1]
        places.append(np.flatnonzero(may))
    for _ in range(longest - ORDERS):
        may = may[:-1] & may[1:]
        places.append(np.flatnonzero(may))
    return places[:longest]


def shards(docs: DataFrame, limits: list[automata.Key], kept, bits: int, longest: int) -> DataFrame:
    """slot and transducers: counts of the phrases that may be frequent, and of all words. `kept` is broadcast."""

    def counted(shard: Shard) -> list[tuple[automata.Key, int]]:
        names, languages = shard.ranked()
        h, out = hashes(names), []
        for lang, t in languages:
            rows, n = counts_of(t, _frequent(kept.value, t, h, lang, bits, longest), len(names))
            out.append(((lang,), int(np.count_nonzero(t))))
            out += [((lang, *(names[w] for w in row if w)), c) for row, c in zip(rows.tolist(), n.tolist(), strict=True)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _in_shards(batches):
            for slot, found in blocks(counted(shard), limits):
                yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), *automata.columns_of([found])], ["slot", *automata.COLUMNS])

    return _texts(docs).mapInArrow(run, f"slot int, {automata.TYPES}")


def summed(found: DataFrame, least: int) -> DataFrame:
    """lang, words, n of the keys that reach `least` over all shards, and of the empty phrases."""
    parts = shuffle_width(found.sparkSession)

    def out(several: list[automata.Transducer]) -> pa.RecordBatch:
        rows = [(key[0], list(key[1:]), n) for key, n in automata.merged(t.items() for t in several) if n >= least or len(key) == 1]
        kinds = (pa.binary(), pa.list_(pa.binary()), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["lang", "words", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, several = None, []
        for batch in batches:
            for row, number in enumerate(batch.column("slot").to_pylist()):
                if number != slot:
                    if several:
                        yield out(several)
                    slot, several = number, []
                several.append(automata.from_row(batch, row))
                if len(several) == FAN:
                    several = [automata.union(several)]
        if several:
            yield out(several)

    return found.repartition(parts, "slot").sortWithinPartitions("slot").mapInArrow(run, "lang binary, words array<binary>, n long")


REQUEST = "slot int, home int, lang binary, words array<binary>, n long"


def _requests(phrases: DataFrame, limits: list[automata.Key]) -> DataFrame:
    """Counts in their range (home null), and what each range asks: each part of its candidates, once a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, asked = [], set()
            for lang, words, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "n")), strict=True):
                home = bisect_right(limits, (lang, *words))
                known.append((home, None, lang, words, n))
                for k in range(1, len(words)):
                    for part in ((lang, *words[:k]), (lang, *words[k:])):
                        asked.add((bisect_right(limits, part), home, part))
            rows = known + [(slot, home, part[0], list(part[1:]), None) for slot, home, part in sorted(asked)]
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["slot", "home", "lang", "words", "n"]
            )

    return phrases.mapInArrow(run, REQUEST)


def looked_up(phrases: DataFrame, limits: list[automata.Key]) -> DataFrame:
    """home, lang, words, n: the counts that each range of candidates asked for."""
    parts = shuffle_width(phrases.sparkSession)
    dealt = _requests(phrases, limits).repartition(parts, "slot").sortWithinPartitions("slot", "lang", "words", "home")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, counts, asked, homes = None, automata.Builder(), automata.Builder(), {}

        def answers() -> Iterator[pa.RecordBatch]:
            rows = [(h, key[0], list(key[1:]), n) for key, n in asked.done().compose(counts.done()) for h in homes[key]]
            kinds = (pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["home", "lang", "words", "n"])

        for batch in batches:
            for number, home, lang, words, n in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                if number != slot:
                    if slot is not None:
                        yield from answers()
                    slot, counts, asked, homes = number, automata.Builder(), automata.Builder(), {}
                key = (lang, *words)
                if home is None:
                    counts.add(key, n)
                else:
                    if key not in homes:
                        asked.add(key, 0)
                    homes.setdefault(key, set()).add(home)
        if slot is not None:
            yield from answers()

    return dealt.mapInArrow(run, "home int, lang binary, words array<binary>, n long")


def scored(candidates: DataFrame, answers: DataFrame, limits: list[automata.Key]) -> DataFrame:
    """lang, words, a, l, r, n, score of every candidate, by its lowest cut."""
    spark = candidates.sparkSession

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("lang").to_pylist(), batch.column("words").to_pylist(), strict=True)
            home = pa.array([bisect_right(limits, (lang, *words)) for lang, words in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([home, *batch.columns], ["home", *batch.schema.names])

    named = candidates.select("lang", "words", "a", "total").mapInArrow(homes, "home int, lang binary, words array<binary>, a long, total long")
    both = named.unionByName(answers.select("home", "lang", "words", F.col("n").alias("f")), allowMissingColumns=True)
    dealt = both.repartition(shuffle_width(spark), "home").sortWithinPartitions("home", F.col("f").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, known = None, {}
        for batch in batches:
            rows = []
            for number, lang, words, a, total, f in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                if number != home:
                    home, known = number, {}
                if f is not None:
                    known[lang, *words] = f
                    continue
                cuts = []
                for k in range(1, len(words)):
                    left, right = known[lang, *words[:k]], known[lang, *words[k:]]
                    cuts.append((1000 * a * total // (left * right), k, left, right))
                score, _, left, right = min(cuts)
                rows.append((lang, words, a, left, right, total, score))
            kinds = (pa.binary(), pa.list_(pa.binary()), *[pa.int64()] * 5)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["lang", "words", "a", "l", "r", "n", "score"]
            )

    return dealt.mapInArrow(run, "lang binary, words array<binary>, a long, l long, r long, n long, score long")


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, list[automata.Key]]:
    """Frequent phrases of every length (lang, words, n), the number of words of each language, and the borders."""
    spark = docs.sparkSession
    limits, size = borders(docs, shuffle_width(spark))
    bits = min(max((size // CELL_BYTES).bit_length(), CELL_BITS[0]), CELL_BITS[1])
    met = stored(survey(docs, bits, least))
    kept = spark.sparkContext.broadcast(kept_cells(met, bits, least))
    dropped(met)
    counted = stored(shards(docs, limits, kept, bits, longest))
    found = stored(summed(counted, least))
    dropped(counted)
    totals = found.where("size(words) = 0").groupBy("lang").agg(F.sum("n").alias("total"))
    return found.where("size(words) > 0"), totals, limits


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` candidates of every language."""
    found, totals, limits = phrases(docs, least, longest)
    candidates = found.where("size(words) > 1").withColumnRenamed("n", "a")
    # A longer phrase of the same frequency around a candidate has one of one word more around it, of that frequency too.
    inner = F.explode(F.array(F.expr("slice(words, 1, size(words) - 1)"), F.expr("slice(words, 2, size(words) - 1)")))
    around = candidates.where("size(words) > 2").select("lang", inner.alias("words"), "a").groupBy("lang", "words").agg(F.max("a").alias("longer"))
    rows = scored(candidates.join(totals, "lang"), looked_up(found, limits), limits)
    open_rows = rows.join(around, ["lang", "words"], "left").where("longer IS NULL OR 100 * longer < 100 * a")
    texts = open_rows.select(
        F.col("lang").cast("string").alias("lang"),
        F.array_join(F.transform("words", lambda w: w.cast("string")), " ").alias("phrase"), "a", "l", "r", "n", "score",
    )
    best = [F.desc("score"), F.desc("a"), "phrase"]
    part = texts.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""Spelling variants: words that are exactly one insertion, deletion or replacement apart, by pairs of trie nodes.

1. `counted`: words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z in lower case. Runs of a document
   may lose one letter first (`SLIP`): a fixed sample of slips that the corpus itself does not hold.
2. `numbered`: words are sorted by range and each task numbers the nodes of its part of the trie as the words pass, from
   the path of the word before; no trie is held. A node is numbered only down to the depth that a word shares with its
   neighbour in the order, as deeper nodes hold one word and cannot join. Prefixes that reach over the border of two
   parts get the number of the first: two words of each part go to the driver for that. The same is done with the
   reversed words, whose nodes are the suffixes.
3. `keys`: a word without its character i is the pair (node of its first i, reversed node of what follows i). Two words
   of equal length with a pair in common differ by one replacement at i. The pair (first i, all from i) of a word stands
   for all of it with nothing skipped, so it meets the words that have one character more at i. In a run of equal
   characters only the first counts as inserted, so each pair of near words meets in exactly one key.
4. `neighbours`: rows are sorted by key. At most one word of each letter shares a key; each gets the number of the
   others and the best of them from its group in one pass, so no pair is written out.

Integers stand for whole prefixes and suffixes and equal numbers mean equal texts, so nothing needs to be verified. A
word takes 2 rows for each character at most, whatever its length. `variants` adds the form of each word (the near word
of largest n, ties: smallest in code-point order, if at least `RATIO` times as frequent) and the root, the end of its
chain of forms; a chain has as many steps as n has digits, so it is followed by that many joins.

Null and empty texts have no words; a null doc_id counts as an empty one. Rows that repeat a doc_id count each. Other
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.llm.common import dropped, shuffle_width, stored

LEAST = 7  # code points of a word
TIMES = 2  # occurrences of a word
SLIP = 31  # a run of a document loses a letter if this divides its hash
RATIO = 10  # times that a form is as frequent as its word
HELD = 400_000  # distinct words that a task counts before it hands them on
KEYS_PER_TASK = 2_000_000
ROWS_OUT = 200_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def counted(docs: DataFrame, least: int = LEAST, times: int = TIMES, slip: int = SLIP) -> DataFrame:
    """word, n: the words of all texts that have `least` code points and `times` occurrences or more."""
    source = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.col("text").cast("binary").alias("text"))
    runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}")

    def out(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
                start = zlib.crc32(f"{doc}:".encode())
                for word, n in Counter(runs.findall((text or b"").translate(_LOWER).decode("utf-8", "replace"))).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % slip == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    seen[word] += n
                if len(seen) > HELD:
                    yield out(seen)
                    seen = Counter()
        yield out(seen)

    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def shared(a: str, b: str) -> int:
    """Characters that two words begin with alike."""
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def numbered(rows: DataFrame, key: str, nodes: str, parts: int) -> tuple[DataFrame, dict[int, int]]:
    """Rows with `nodes`, the numbers of the trie nodes of the prefixes of the distinct words `key`, from the root down
    to the depth shared with another word, and `part` and `place`, the order of the words.

    Also the numbers to put in place of others, for prefixes that reach over a border of parts. The rows are stored.
    """
    passed = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        made, word, path, depth, place = part << 40, None, [0], 0, 0
        held: list[pa.RecordBatch] = []  # at most the last row of the batch before, whose next word is not known yet

        def done(batch: pa.RecordBatch, lists: list[list[int]], first: int) -> pa.RecordBatch:
            columns = [batch.column(c) for c in passed]
            added = [pa.array(lists, pa.list_(pa.int64())), pa.array([part] * len(lists), pa.int64()), pa.array(range(first, first + len(lists)), pa.int64())]
            return pa.RecordBatch.from_arrays([*columns, *added], [*passed, nodes, "part", "place"])

        for batch in batches:
            if not batch.num_rows:
                continue
            lists = []
            for following in batch.column(key).to_pylist():
                if word is None:
                    common, depth = 0, len(following)  # the first word of a part keeps all its nodes
                else:
                    common = shared(word, following)
                    lists.append(path[: max(depth, common) + 1])
                    depth = common
                fresh = len(following) - common
                path = path[: common + 1] + list(range(made + 1, made + 1 + fresh))
                made += fresh
                word = following
            both = pa.concat_batches([*held, batch]) if held else batch
            yield done(both.slice(0, len(lists)), lists, place)
            place += len(lists)
            held = [both.slice(len(lists))]
        if held:
            yield done(held[0], [path], place)  # and so does the last

    added = [T.StructField(nodes, T.ArrayType(T.LongType())), T.StructField("part", T.LongType()), T.StructField("place", T.LongType())]
    out = stored(rows.repartitionByRange(parts, key).sortWithinPartitions(key).mapInArrow(run, T.StructType([*rows.schema.fields, *added])))
    ends = out.groupBy("part").agg(
        F.min(key).alias("first"), F.min_by(nodes, key).alias("first_path"), F.max(key).alias("last"), F.max_by(nodes, key).alias("last_path")
    )
    same: dict[int, int] = {}
    before = None
    for r in sorted(ends.collect(), key=lambda r: r.part):
        if before is not None:
            for i in range(1, shared(before.last, r.first) + 1):
                same[r.first_path[i]] = same.get(before.last_path[i], before.last_path[i])
        before = r
    return out, same


def keys(words: DataFrame, swap_first: dict[int, int], swap_last: dict[int, int]) -> DataFrame:
    """p, s, kind, id, n of every pair of nodes that another word may share.

    kind 0: the word without one character; 1: the same, at the first of a run of equal characters; 2: the whole word.
    """

    def flat(column: pa.ListArray, swap: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        values, ends = column.flatten().to_numpy(), column.value_lengths().to_numpy().astype(np.int64)
        if swap:
            old = np.array(sorted(swap), np.int64)
            new = np.array([swap[x] for x in old.tolist()], np.int64)
            at = np.minimum(np.searchsorted(old, values), len(old) - 1)
            values = np.where(old[at] == values, new[at], values)
        return values, np.cumsum(ends) - ends, ends - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                texts = batch.column("word").to_pylist()
                size = np.array([len(t) for t in texts], np.int64)
                letters = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
                begin = np.cumsum(size) - size
                starts_run = np.ones(len(letters), bool)
                starts_run[1:] = letters[1:] != letters[:-1]
                starts_run[begin] = True
                first, first_at, first_depth = flat(batch.column("first"), swap_first)
                last, last_at, last_depth = flat(batch.column("last"), swap_last)
                ids, ns = batch.column("id").to_numpy(), batch.column("n").to_numpy()
                for skip in (1, 0):
                    low = np.maximum(0, size - skip - last_depth)
                    many = np.maximum(0, np.minimum(size - skip, first_depth) - low + 1)
                    w = np.repeat(np.arange(len(size)), many)
                    i = np.arange(len(w)) - np.repeat(np.cumsum(many) - many, many) + low[w]
                    p = first[first_at[w] + i]
                    s = last[last_at[w] + size[w] - skip - i]
                    kind = starts_run[begin[w] + i].astype(np.int8) if skip else np.full(len(w), 2, np.int8)
                    for k in range(0, len(w), ROWS_OUT):
                        cut = slice(k, k + ROWS_OUT)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x[cut]) for x in (p, s, kind, ids[w], ns[w])], ["p", "s", "kind", "id", "n"]
                        )

    return words.select("word", "n", "id", "first", "last").mapInArrow(run, "p long, s long, kind byte, id long, n long")


def met(p: np.ndarray, s: np.ndarray, kind: np.ndarray, ids: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """id, near, best_n, best of the rows that share their key with others; the rows come sorted by key.

    The best of others is the first of the group by (largest n, smallest id), or the second for the first itself.
    """
    group = np.cumsum(np.concatenate(([0], (p[1:] != p[:-1]) | (s[1:] != s[:-1])))) if len(p) else np.zeros(0, np.int64)
    out = []

    def best_of(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The chosen rows in order of group and rank, the place of the first of each group, and the group sizes."""
        rows = np.flatnonzero(chosen)
        rows = rows[np.lexsort((ids[rows], -n[rows], group[rows]))]
        begins = np.flatnonzero(np.concatenate(([True], group[rows][1:] != group[rows][:-1]))) if len(rows) else np.zeros(0, np.int64)
        return rows, begins, np.diff(np.concatenate((begins, [len(rows)]))).astype(np.int64)

    rows, begins, sizes = best_of(kind < 2)  # replacements
    here = np.flatnonzero(np.repeat(sizes, sizes) > 1)
    begin, size = np.repeat(begins, sizes)[here], np.repeat(sizes, sizes)[here]
    out.append((rows[here], size - 1, rows[np.where(here == begin, begin + 1, begin)]))
    whole, skipped = np.flatnonzero(kind == 2), np.flatnonzero(kind == 1)  # insertions and deletions
    if len(whole) and len(skipped):
        at = np.minimum(np.searchsorted(group[whole], group[skipped]), len(whole) - 1)
        meets = group[whole][at] == group[skipped]
        out.append((skipped[meets], np.ones(int(meets.sum()), np.int64), whole[at[meets]]))
        rows, begins, sizes = best_of(kind == 1)
        at = np.minimum(np.searchsorted(group[whole], group[rows[begins]]), len(whole) - 1)
        meets = group[whole][at] == group[rows[begins]]
        out.append((whole[at[meets]], sizes[meets], rows[begins[meets]]))
    mine, near, other = (np.concatenate(x) for x in zip(*out, strict=True))
    return [ids[mine], near, n[other], ids[other]]


def neighbours(pairs: DataFrame, parts: int) -> DataFrame:
    """id, n_near, best: of every word with near words, their number and the best of them as (n, -id)."""
    names = ["p", "s", "kind", "id", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 5
        for batch in batches:
            now = [np.concatenate((h, batch.column(c).to_numpy())) for h, c in zip(held, names, strict=True)]
            p, s = now[0], now[1]
            if not len(p):
                continue
            open_key = np.flatnonzero((p != p[-1]) | (s != s[-1]))  # the last group may go on in the next batch
            cut = int(open_key[-1]) + 1 if len(open_key) else 0
            held = [x[cut:] for x in now]
            yield out([x[:cut] for x in now])
        yield out(held)

    def out(columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in met(*columns)], ["id", "near", "best_n", "best"])

    dealt = pairs.repartition(parts, "p", "s").sortWithinPartitions("p", "s")
    rows = dealt.mapInArrow(run, "id long, near long, best_n long, best long")
    return rows.groupBy("id").agg(F.sum("near").alias("n_near"), F.max(F.struct("best_n", (-F.col("best")).alias("rank"))).alias("best"))


def variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    spark = docs.sparkSession
    found = stored(counted(docs))
    size = found.agg(F.sum(F.length("word")), F.max("n")).first()
    parts = max(shuffle_width(spark), -(-2 * (size[0] or 0) // KEYS_PER_TASK))
    forward, swap_first = numbered(found, "word", "first", parts)
    dropped(found)
    ranked = forward.select("word", "n", "first", F.shiftleft("part", 40).bitwiseOR(F.col("place")).alias("id"), F.reverse("word").alias("back"))
    both, swap_last = numbered(ranked, "back", "last", parts)
    dropped(forward)
    words = both.select("id", "word", "n")
    near = neighbours(keys(both, swap_first, swap_last), parts)
    rows = stored(
        words.join(near, "id", "left").select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            *[F.when(F.col("best.best_n") >= ratio * F.col("n"), x).alias(a) for x, a in ((-F.col("best.rank"), "form_id"), (F.col("best.best_n"), "form_n"))],
        )
    )
    dropped(both)
    forms = rows.where("form_id IS NOT NULL").select("id", "form_id")
    ends = forms.withColumn("root_id", F.col("form_id"))
    for _ in range(int(math.log(max(size[1] or 1, 1), ratio))):  # each step multiplies n by the ratio or more
        step = forms.select(F.col("id").alias("root_id"), F.col("form_id").alias("next"))
        ends = ends.join(step, "root_id", "left").select("id", "form_id", F.coalesce("next", "root_id").alias("root_id"))
    name = rows.select("id", "word")
    named = (
        ends.join(name.select(F.col("id").alias("form_id"), F.col("word").alias("form")), "form_id")
        .join(name.select(F.col("id").alias("root_id"), F.col("word").alias("root")), "root_id")
        .select("id", "form", "root")
    )
    return rows.join(named, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Line dedup: an exact set-similarity join of lines, on DataFrame functions only.

A line is the set of its five-word shingles (words between blanks, lower case); a line of one to four words has all
its words as its one shingle, so that its repeats go too. Lines without words are never removed. A line is removed if an earlier line, by (doc_id, line number), has a Jaccard likeness of 0.75 or more;
this is judged on the input, not on what is left. The join:

1. Shingles are ordered by rarity. The frequencies of all words of the corpus are counted in BUCKETS hashed classes and
   told apart by quarters of a power of two; a shingle is as rare as its first word, which bounds its own frequency
   from above.
2. Lines with equal sets are one class from here on, known by its earliest line.
3. Two lines of likeness t share a shingle among the first n - ceil(t n) + 1 of their order (prefix filter). Where a
   prefix shingle has at most FEW classes, all of them are compared with each other, where it has more, each with the
   earliest of them, if their lengths and the places of the shingle in both allow the likeness (length and positional
   filter). Bitmaps of their shingles bound the likeness from above; pairs that may reach it are verified on the lines
   themselves.
4. A class without a verified earlier line is compared in the same way with the earliest of each of DRAWS parts of the
   classes that share a prefix shingle of more than FEW classes, dealt by hash: in a group of variants most meet a like
   one here.
5. A class that is still open is compared with all other earlier classes that share such a shingle. Here too only
   pairs whose bitmaps allow the likeness leave the join.

Hence no group is paired out: a group of many variants of a line is settled in steps 3 and 4, and frequent shingles are
not in prefixes. Null texts have no lines and stay null. A text is known by its
doc_id and a 64-bit hash of it: equal rows are one text, whose lines are kept or removed alike, and other texts of the
same doc_id are texts of their own, in the order of their hashes. Rows without doc_id are not compared and stay as they
are. `deduplicated` drops documents that lose all of a text that had words.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.llm.common import dropped, free_name, stored

WIDTH = 5
SHARE = 75  # percent
BUCKETS = 1 << 14
BITS = 512
FEW = 32
DRAWS = 8
KEY = ("key_a", "key_b", "n")
BLANKS = r"[\x20\x09-\x0D]+"


def _key(docs: DataFrame) -> Column:
    """What tells the texts apart; takes the place of doc_id inside this module. Only where a doc_id has several texts
    does a hash of the text go with it, as it would make every row wider."""
    texts = F.xxhash64("text")
    several = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(texts).alias("lo"), F.max(texts).alias("hi"))
    return F.col("doc_id") if several.where("lo != hi").isEmpty() else F.struct("doc_id", texts.alias("text_hash"))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) of every line."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _bound(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with `value` as a column that is computed once: the optimizer copies no expression across a generator."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _words(line: Column) -> Column:
    """Words between blanks; the pattern is only applied to lines with other blanks than single spaces."""
    low, odd = F.lower(line), F.contains(line, F.lit("  "))
    for blank in "\t\n\v\f\r":
        odd = odd | F.contains(line, F.lit(blank))
    return F.split(F.trim(F.when(odd, F.regexp_replace(low, BLANKS, " ")).otherwise(low)), " ")


def _bucket(code: Column) -> Column:
    """The class of a word, from its hash."""
    return code.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def word_ranks(docs: DataFrame) -> list[int]:
    """How frequent each class of words is over all texts, in quarters of a power of two: BUCKETS small numbers, however
    large the input. They stand in the plan and in each of its descriptions that the driver keeps, hence so short.
    Blanks other than spaces and line ends are not told from letters here: only the order of the shingles depends on it."""
    spaced = F.split(F.replace(F.lower("text"), F.lit("\n"), F.lit(" ")), " ")
    words = docs.select(F.explode(spaced).alias("w"))
    counts = {r.b: r.n for r in words.groupBy(_bucket(F.xxhash64("w")).alias("b")).agg(F.count("*").alias("n")).collect()}
    return [round(4 * math.log2(counts.get(b, 0) + 1)) for b in range(BUCKETS)]


def _tokenized(lines: DataFrame, ranks: list[int]) -> DataFrame:
    """`lines` with tokens for `line`, without lines that have no words.

    The tokens are the distinct shingles as 64-bit numbers, rarest first: rank above, 48 bits of hash. The shingle
    of a line of fewer than WIDTH words ends in nulls, which the hash leaves out.
    """
    table = F.from_json(F.lit(json.dumps(ranks, separators=(",", ":"))), "array<long>")
    passed = [c for c in lines.columns if c != "line"]
    worded = _bound(lines, "words", _words(F.col("line"))).where(F.get("words", F.lit(0)) != "")
    coded = _bound(worded.select(*passed, "words"), "codes", F.transform("words", lambda w: F.xxhash64(w))).select(*passed, "codes")

    def token(code: Column, at: Column) -> Column:
        five = F.xxhash64(code, *[F.get("codes", at + k) for k in range(1, WIDTH)])
        return F.shiftleft(F.get(table, _bucket(code)), 48).bitwiseOR(F.shiftrightunsigned(five, 16))

    begins = F.slice("codes", F.lit(1), F.greatest(F.size("codes") - (WIDTH - 1), F.lit(1)))
    made = _bound(coded, "tokens", F.sort_array(F.array_distinct(F.transform(begins, token))))
    return made.select(*passed, "tokens")


def _needed(n: Column) -> Column:
    """Length of the prefix that must share a shingle: n - ceil(n * SHARE / 100) + 1."""
    return n - F.ceil(n * SHARE / F.lit(100)).cast("int") + 1


def _possible(n: Column, at: Column, m: Column, to: Column) -> Column:
    """Length and positional filter for a common shingle at place `at` of n and `to` of m (from 0)."""
    most = F.least(at, to) + 1 + F.least(n - at - 1, m - to - 1)
    long_enough = 100 * F.least(n, m) >= SHARE * F.greatest(n, m)
    return long_enough & ((100 + SHARE) * most >= SHARE * (n + m))


def classes(docs: DataFrame, ranks: list[int]) -> DataFrame:
    """(key_a, key_b, n, doc_id, line_no, prefix) of every line with words; equal sets have equal keys, n is their size."""
    return _tokenized(_lines(docs), ranks).select(
        F.xxhash64("tokens").alias("key_a"), F.hash("tokens").alias("key_b"), F.size("tokens").alias("n"),
        "doc_id", "line_no", F.slice("tokens", F.lit(1), _needed(F.size("tokens"))).alias("prefix"),
    )


def _mates(first: DataFrame) -> DataFrame:
    """(token, line, n, place, size, earliest) of each prefix shingle that several classes share, with their number and,
    where they are more than FEW, the earliest of them."""
    index = first.select("line.doc_id", "line.line_no", "n", F.posexplode("prefix").alias("place", "token"))
    group = Window.partitionBy("token").orderBy("doc_id", "line_no")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    line = F.struct("doc_id", "line_no")
    rows = index.withColumns({"size": F.count("*").over(whole), "least": F.first(F.struct(line.alias("line"), "n", "place")).over(whole)})
    shared = rows.where(F.col("size") > 1)
    return shared.select("token", line.alias("line"), "n", "place", "size", F.when(F.col("size") > FEW, F.col("least")).alias("earliest"))


def _few(mates: DataFrame) -> DataFrame:
    """Pairs (x, y, n, m) of a line and an earlier one that share a prefix shingle of at most FEW classes and may be alike."""
    x, y = (mates.where(F.col("size") <= FEW).select("token", "line", "n", "place").alias(e) for e in "xy")
    n, m = F.col("x.n"), F.col("y.n")
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("y.line") < F.col("x.line"))
                   & _possible(n, F.col("x.place"), m, F.col("y.place")))
    return pairs.select(F.col("x.line").alias("x"), F.col("y.line").alias("y"), n.alias("n"), m.alias("m"))


def _texts_of(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(at, line) of the lines (doc_id, line_no) in `wanted`; rows that repeat a doc_id give one row for each text."""
    lists = wanted.groupBy("doc_id").agg(F.collect_set("line_no").alias("numbers"))
    found = docs.select("doc_id", "text").join(lists, "doc_id")
    lines = found.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"), "numbers")
    kept = lines.where(F.array_contains("numbers", F.col("line_no")))
    return kept.select(F.struct("doc_id", "line_no").alias("at"), "line").distinct()


def _shingles(line: Column) -> Column:
    """Distinct shingles of a line as texts; all its words for a line of fewer."""
    def of(words: Column) -> Column:
        begins = F.slice(words, F.lit(1), F.greatest(F.size(words) - (WIDTH - 1), F.lit(1)))
        after = lambda at: [F.get(words, at + k) for k in range(1, WIDTH)]  # noqa: E731  nulls at the end of fewer words
        return F.array_distinct(F.transform(begins, lambda w, at: F.concat_ws(" ", w, *after(at))))

    # the words are bound once, as the single element of an array
    return F.element_at(F.transform(F.array(_words(line)), of), 1)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (x, y) of lines, structs of doc_id and line_no, whose shingle sets reach the likeness.

    The texts are dealt out once, to both ends of every pair together.
    """
    ends = pairs.select("x", "y", F.explode(F.array("x", "y")).alias("at")).join(texts, "at")
    both = ends.groupBy("x", "y").agg(
        F.collect_set(F.when(F.col("at") == F.col("x"), F.col("line"))).alias("tx"),
        F.collect_set(F.when(F.col("at") == F.col("y"), F.col("line"))).alias("ty"),
    )  # a set of one line, unless rows repeat a key
    each = both.select("x", "y", F.explode("tx").alias("tx"), "ty").select("x", "y", "tx", F.explode("ty").alias("ty"))
    sets = _bound(_bound(each, "sx", _shingles(F.col("tx"))), "sy", _shingles(F.col("ty"))).select("x", "y", "sx", "sy")
    counted = _bound(sets, "common", F.size(F.array_intersect("sx", "sy")))
    alike = 100 * F.col("common") >= SHARE * (F.size("sx") + F.size("sy") - F.col("common"))
    return counted.where(alike).select("x", "y").distinct()


def _drawn(open_rows: DataFrame, mates: DataFrame) -> DataFrame:
    """Pairs (x, y, n, m) of an open line and the earliest line of each part of a shingle's lines, if it is earlier and may be alike."""
    met = mates.join(open_rows.select("token").distinct(), "token")
    part = F.pmod(F.xxhash64("line"), F.lit(DRAWS))
    first = met.groupBy("token", part.alias("part")).agg(F.min(F.struct("line", "n", "place")).alias("drawn")).select("token", "drawn")
    rows = open_rows.join(first, "token").where(F.col("drawn.line") < F.col("line"))
    may = rows.where(_possible(F.col("n"), F.col("place"), F.col("drawn.n"), F.col("drawn.place")) & (F.col("drawn.line") != F.col("earliest.line")))
    return may.select(F.col("line").alias("x"), F.col("drawn.line").alias("y"), "n", F.col("drawn.n").alias("m")).distinct()


def _bitmaps(texts: DataFrame, ranks: list[int]) -> DataFrame:
    """(at, b0, b1, ...): the shingles of each line as BITS bits, in longs."""
    tokens = _tokenized(texts, ranks).select("at", F.explode("tokens").alias("token"))
    bit = tokens.select("at", F.shiftright("token", 6).bitwiseAND(F.lit(BITS // 64 - 1)).alias("k"),
                        F.call_function("shiftleft", F.lit(1).cast("long"), F.col("token").bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    return bit.groupBy("at").agg(*[F.bit_or(F.when(F.col("k") == k, F.col("bit")).otherwise(F.lit(0).cast("long"))).alias(f"b{k}") for k in range(BITS // 64)])


def _bitmaps_allow(n: Column, x: str, m: Column, y: str) -> Column:
    """Whether lines of n and m shingles with the bitmaps `x` and `y` may be alike.

    Each bit that only one of the two has stands for a shingle at least that the other lacks.
    """
    def lacking(a: str, b: str) -> Column:
        return sum((F.bit_count(F.col(f"{a}b{k}").bitwiseAND(F.bitwise_not(F.col(f"{b}b{k}")))) for k in range(BITS // 64)), F.lit(0))

    return (100 + SHARE) * F.least(n - lacking(x, y), m - lacking(y, x)) >= SHARE * (n + m)


def _plausible(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The pairs (x, y) of (x, y, n, m) whose bitmaps allow the likeness, so that only their lines are compared."""
    x, y = (bitmaps.select(F.col("at").alias(e), *[F.col(f"b{k}").alias(f"{e}b{k}") for k in range(BITS // 64)]) for e in "xy")
    both = pairs.join(x, "x").join(y, "y")
    return both.where(_bitmaps_allow(F.col("n"), "x", F.col("m"), "y")).select("x", "y").distinct()


def _others(open_rows: DataFrame, mates: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Pairs (x, y) of an open line and an earlier one, not its earliest mate, whose bitmaps allow the likeness.

    Bitmaps of lines with several texts (repeated doc_id) pair each with each.
    """
    met = mates.join(open_rows.select("token").distinct(), "token").select("token", F.col("line").alias("at"), "n", "place").distinct()
    mapped = stored(met.join(bitmaps, "at"))
    x = open_rows.select("token", F.col("line").alias("at"), "earliest.line").distinct().join(mapped, ["token", "at"]).alias("x")
    y = mapped.alias("y")
    n, m = F.col("x.n"), F.col("y.n")
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("y.at") < F.col("x.at")) & (F.col("y.at") != F.col("x.line"))
                   & _possible(n, F.col("x.place"), m, F.col("y.place")) & _bitmaps_allow(n, "x.", m, "y."))
    return pairs.select(F.col("x.at").alias("x"), F.col("y.at").alias("y")).distinct()


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no) of every line that an earlier one makes superfluous, in any text of that doc_id."""
    lost = _lost(docs, _key(docs))
    doc_id = "doc_id.doc_id" if isinstance(lost.schema["doc_id"].dataType, T.StructType) else "doc_id"
    return lost.select(doc_id, "line_no").distinct()


def _lost(docs: DataFrame, key: Column) -> DataFrame:
    """(doc_id, line_no), with `key` as doc_id, of every line that an earlier one makes superfluous."""
    docs = docs.where(F.col("doc_id").isNotNull()).select(key.alias("doc_id"), "text")
    ranks = word_ranks(docs)
    every = stored(classes(docs, ranks))
    here = F.struct("doc_id", "line_no")
    members = stored(every.select(*KEY, here.alias("here")))
    # equal sets have equal prefixes
    first = stored(every.groupBy(*KEY).agg(F.min(here).alias("line"), F.first("prefix").alias("prefix")))
    dropped(every)  # the prefixes are the bulk of it and are not read again
    mates = stored(_mates(first))
    heads = stored(first.select(*KEY, "line"))
    dropped(first)
    many = mates.where(F.col("size") > FEW)
    later = many.where(F.col("line") != F.col("earliest.line"))
    near = later.where(_possible(F.col("n"), F.col("place"), F.col("earliest.n"), F.col("earliest.place")))
    begun = near.select(F.col("line").alias("x"), F.col("earliest.line").alias("y"), "n", F.col("earliest.n").alias("m"))
    pairs = _few(mates).union(begun).distinct()
    texts = stored(_texts_of(mates.select("line.doc_id", "line.line_no").distinct(), docs))
    bitmaps = stored(_bitmaps(texts, ranks))
    settled = stored(_verified(stored(_plausible(pairs, bitmaps)), texts))
    open_rows = stored(later.join(settled.select(F.col("x").alias("line")).distinct(), "line", "left_anti"))
    found = settled
    if not open_rows.isEmpty():
        again = stored(_verified(stored(_plausible(_drawn(open_rows, many), bitmaps)), texts))
        found = settled.union(again)
        open_rows = stored(open_rows.join(again.select(F.col("x").alias("line")).distinct(), "line", "left_anti"))
    if not open_rows.isEmpty():
        more = stored(_others(open_rows, many, bitmaps))
        found = found.union(stored(_verified(more, texts)))
    for table in (texts, bitmaps, mates):
        dropped(table)
    gone = found.select(F.col("x").alias("line")).distinct().withColumn("gone", F.lit(True))
    verdict = heads.join(gone, "line", "left").select(*KEY, "line", F.col("gone").isNotNull().alias("gone"))
    lost = members.join(verdict, list(KEY)).where(F.col("gone") | (F.col("here") != F.col("line")))
    return lost.select("here.doc_id", "here.line_no").distinct()


def _rebuilt(docs: DataFrame) -> tuple[DataFrame, Column, Column]:
    """`docs` with two more columns: the numbers of the removed lines, and the text without them."""
    key = _key(docs)
    own, gone_name, text_name = (free_name(docs, n) for n in ("__key", "__gone", "__text"))
    lost = stored(_lost(docs, key).groupBy(F.col("doc_id").alias(own)).agg(F.collect_list("line_no").alias(gone_name)))
    keyed = docs.withColumn(own, F.when(F.col("doc_id").isNotNull(), key))
    gone, lines = F.col(gone_name), F.split("text", "\n")
    joined = keyed.join(lost, own, "left").withColumn(gone_name, F.coalesce(gone, F.array().cast("array<int>")))
    numbered = F.transform(lines, lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    kept = F.filter(numbered, lambda s: ~F.array_contains(gone, s["i"]))
    text = F.when(F.size(gone) > 0, F.array_join(F.transform(kept, lambda s: s["line"]), "\n")).otherwise(F.col("text"))
    return joined.withColumn(text_name, text), gone, F.col(text_name)


def deduplicated(docs: DataFrame) -> DataFrame:
    """`docs` without the removed lines and with n_chars anew, without the documents of which no word is left."""
    rebuilt, gone, text = _rebuilt(docs)
    empty = (F.size(gone) > 0) & (F.trim(F.regexp_replace(text, BLANKS, " ")) == "")
    changes = {"text": text, "n_chars": F.length(text).cast("long")}
    columns = [
        F.when(F.size(gone) > 0, changes[c]).otherwise(F.col(f"`{c}`")).alias(c) if c in changes else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return rebuilt.where(~empty).select(*columns)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed and the text that is left."""
    rebuilt, gone, text = _rebuilt(docs.select("doc_id", "text"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    return rebuilt.select("doc_id", n_lines.alias("n_lines"), F.size(gone).cast("long").alias("n_removed"), text.alias("text"))

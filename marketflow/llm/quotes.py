"""Chat formatting by quotation linking, on DataFrame functions only.

A line of a message that begins with `>` is quoted; its level is the number of `>` before the first other character,
blanks aside. Consecutive lines of one level are a passage. Texts are normalised (lower case, runs of characters that
are neither letters nor digits as one blank), and a message's own words are its text without quotes. A passage is
linked to an earlier message of the conversation, in this order:

1. the latest whose whole text, paragraph (lines between blank or quoted lines) or line it is;
2. the latest that has its words as a run, wherever they begin and end: several paragraphs or lines, part of a line;
3. the one that has most of its paragraphs and lines as runs, of several the latest (quotes with words left out).

Runs meet by hash: of a message those are hashed that begin with the first word of something quoted in the
conversation and have its number of words. The message's parent is the message that most of its passages of the lowest
linked level quote; of several the latest. Conversations are built without quotes, in reply order: `path` holds the
turns from the first message of the thread to this one, and sorting by (conv_id, path) gives each answer under what it
answers.

A message without linked quotes starts a thread of its own. Quotes that match nothing are removed from the text and
counted (`n_quotes`, `n_linked`). Rows that repeat (conv_id, turn) are one message for the links and all stay. Rows
with a null conv_id or turn cannot be linked; their quotes are removed. Null texts stay null. An empty table gives no
rows. Parents come before their answers, so there are no cycles; paths double their length in each round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.common import stored

QUOTE = r"^[ \t]*>[> \t]*"


def _level(line: Column) -> Column:
    marks = F.regexp_extract(line, QUOTE, 0)
    return F.length(F.regexp_replace(marks, "[^>]", ""))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _parsed(messages: DataFrame) -> DataFrame:
    """Add __own (text without quotes), __broken (with empty lines in their place) and __passages (level, text), in order."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(_level(line).alias("level"), F.regexp_replace(line, QUOTE, "").alias("body"), line.alias("line")),
    )
    none = F.array().cast("array<struct<level:int,text:string>>")

    def grown(runs: Column, s: Column) -> Column:
        last = F.element_at(runs, -1)
        joined = F.struct(s["level"].alias("level"), F.concat_ws("\n", last["text"], s["body"]).alias("text"))
        begun = F.struct(s["level"].alias("level"), s["body"].alias("text"))
        follows = (F.size(runs) > 0) & (last["level"] == s["level"])
        return F.when(follows, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(joined))).otherwise(F.concat(runs, F.array(begun)))

    quoted = F.instr("text", ">") > 0  # most messages need no parsing
    runs = F.aggregate(lines, none, grown)
    own = F.array_join(F.transform(F.filter(lines, lambda s: s["level"] == 0), lambda s: s["line"]), "\n")
    broken = F.array_join(F.transform(lines, lambda s: F.when(s["level"] == 0, s["line"]).otherwise("")), "\n")
    return messages.withColumns({
        "__passages": F.when(quoted, F.filter(runs, lambda r: r["level"] > 0)).otherwise(none),
        "__own": F.when(quoted, F.regexp_replace(own, r"^\s*\n|\n\s*$", "")).otherwise(F.col("text")),
        "__broken": F.when(quoted, broken).otherwise(F.col("text")),
    })


def _said(parsed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(conv_id, key, said, unit) of each run of a message's own words whose hash is in `wanted`; unit: it is the whole
    text, a paragraph or a line."""
    heads = wanted.groupBy("conv_id").agg(F.collect_set(F.struct("n", "first")).alias("heads"))
    # Only conversations that quote need an index of what was said.
    own = parsed.where(F.col("__own").isNotNull()).join(heads, "conv_id")
    parts = F.concat(F.array("__own"), F.split("__broken", r"\n\s*\n"), F.split("__own", "\n"))
    own = own.select("conv_id", "turn", "heads", F.transform(parts, normalised).alias("units"), F.explode(F.array(F.split(normalised(F.col("__own")), " "))).alias("words"))

    def runs(head: Column) -> Column:
        starts = F.when(F.size("words") >= head["n"], F.sequence(F.lit(1), F.size("words") - head["n"] + 1)).otherwise(F.array().cast("array<int>"))
        begun = F.filter(starts, lambda i: F.element_at("words", i) == head["first"])
        return F.transform(begun, lambda i: F.array_join(F.slice("words", i, head["n"]), " "))

    found = own.select("conv_id", "turn", "units", F.explode(F.array_distinct(F.flatten(F.transform("heads", runs)))).alias("run"))
    found = found.select("conv_id", F.sha2("run", 256).alias("key"), F.col("turn").cast("long").alias("said"), F.array_contains("units", F.col("run")).alias("unit"))
    return found.join(wanted, ["conv_id", "key"], "left_semi")


def links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, source_turn) for each quoted passage of each message; source_turn null if none matches."""
    known = messages.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    parsed = _parsed(known.select("conv_id", "turn", "text"))
    passages = parsed.select("conv_id", "turn", F.explode("__passages").alias("p"))
    pieces = F.transform(F.concat(F.split("p.text", r"\n\s*\n"), F.split("p.text", "\n")), normalised)
    passages = passages.select("conv_id", "turn", F.col("p.level").alias("level"), normalised(F.col("p.text")).alias("words"), pieces.alias("pieces"))
    passages = passages.where("words != ''").groupBy("conv_id", "turn", "level", "words").agg(F.array_distinct(F.flatten(F.collect_set("pieces"))).alias("pieces"))
    passages = stored(passages.select(
        "conv_id", "turn", "level", F.sha2("words", 256).alias("key"), "words",
        F.array_except("pieces", F.array(F.lit(""), F.col("words"))).alias("pieces"),
    ))
    quoted = passages.select("conv_id", F.explode(F.concat(F.array("words"), F.col("pieces"))).alias("words"))
    split = F.split("words", " ")
    wanted = quoted.select("conv_id", F.sha2("words", 256).alias("key"), F.size(split).alias("n"), F.get(split, F.lit(0)).alias("first")).distinct()
    said = stored(_said(parsed, wanted))
    # Both in turn order, what a turn quotes before what it says: the last thing said is the one quoted.
    both = passages.select("conv_id", "key", "turn", "level", "pieces").unionByName(
        said.select("conv_id", "key", F.col("said").alias("turn"), "said", "unit"), allowMissingColumns=True
    )
    so_far = Window.partitionBy("conv_id", "key").orderBy("turn", F.col("said").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True).over(so_far)
    whole = both.withColumn("whole", F.coalesce(last(F.when(F.col("unit"), F.col("said"))), last(F.col("said")))).where(F.col("level").isNotNull())
    whole = stored(whole.select("conv_id", "turn", "level", "key", "pieces", "whole"))
    # Passages that stand nowhere as a whole are linked by their pieces.
    cut = whole.where(F.col("whole").isNull()).select("conv_id", "turn", "level", F.col("key").alias("passage"), F.explode("pieces").alias("piece"))
    cut = cut.select("conv_id", "turn", "level", "passage", F.sha2("piece", 256).alias("key"))
    met = cut.join(said.select("conv_id", "key", "said").distinct(), ["conv_id", "key"]).where(F.col("said") < F.col("turn"))
    counted = met.groupBy("conv_id", "turn", "level", "passage", "said").agg(F.count("*").alias("n"))
    most = counted.groupBy("conv_id", "turn", "level", F.col("passage").alias("key")).agg(F.max(F.struct("n", "said"))["said"].alias("part"))
    found = whole.join(most, ["conv_id", "turn", "level", "key"], "left")
    return found.select("conv_id", "turn", "level", "key", F.coalesce("whole", "part").alias("source_turn"))


def reply_paths(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, path) of the messages that answer another, from (conv_id, turn, parent)."""
    open_paths = stored(parents.select("conv_id", "turn", F.col("parent").alias("top"), F.array("parent", "turn").alias("path")))
    while True:
        above = open_paths.select("conv_id", F.col("turn").alias("top"), F.col("top").alias("next"), F.col("path").alias("upper"))
        joined = open_paths.join(above, ["conv_id", "top"], "left")
        if joined.where(F.col("next").isNotNull()).isEmpty():
            return open_paths.select("conv_id", "turn", "path")
        open_paths = stored(joined.select(
            "conv_id", "turn", F.coalesce("next", "top").alias("top"),
            F.when(F.col("next").isNull(), F.col("path"))
            .otherwise(F.concat("upper", F.slice("path", F.lit(2), F.greatest(F.size("path") - 1, F.lit(0))))).alias("path"),
        ))


def conversations(messages: DataFrame) -> DataFrame:
    """`messages` without quotes, with parent, path, depth, n_quotes and n_linked; sort by (conv_id, path) to read."""
    added = ["parent", "path", "depth", "n_quotes", "n_linked"]
    base = messages.drop(*[c for c in added if c in messages.columns])
    linked = stored(links(base))
    counted = linked.groupBy("conv_id", "turn", "level", "source_turn").agg(F.count("*").alias("n"))
    linking = F.col("source_turn").isNotNull()
    lowest = F.min(F.when(linking, F.struct("level", (-F.col("n")).alias("fewer"), (-F.col("source_turn")).alias("minus"))))
    quoting = stored(counted.groupBy("conv_id", "turn").agg(
        F.sum("n").alias("n_quotes"), F.coalesce(F.sum(F.when(linking, F.col("n"))), F.lit(0).cast("long")).alias("n_linked"),
        (-lowest["minus"]).alias("parent"),
    ))
    paths = reply_paths(quoting.where(F.col("parent").isNotNull()))
    notes = quoting.join(paths, ["conv_id", "turn"], "left")
    rows = _parsed(base).join(notes, ["conv_id", "turn"], "left")
    path = F.coalesce("path", F.array("turn"))
    columns = [F.col("__own").alias("text") if c == "text" else F.col(f"`{c}`") for c in base.columns]
    return rows.select(
        *columns, "parent", path.alias("path"), F.size(path).cast("long").alias("depth"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
    )

"""Substring search over texts by an index of three-letter pieces.

`postings` lists every distinct run of three characters of each lower-cased text. A pattern's own runs, those between its
wildcards, must all stand in a text that it matches: their lists are intersected, and only texts that have all of them
are read and compared with the pattern. Runs with characters outside ASCII are left out of the intersection, because
their lower case depends on the language runtime; the comparison decides there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 3


def postings(texts: DataFrame, keys: list[str], column: str) -> DataFrame:
    """`gram` and `keys` for each distinct run of three characters of `column`; texts that are null or shorter have none."""
    low = F.lower(F.col(column))
    starts = F.sequence(F.lit(1), F.length(low) - (GRAM - 1))
    grams = F.when(F.length(low) >= GRAM, F.array_distinct(F.transform(starts, lambda i: F.substring(low, i, F.lit(GRAM)))))
    return texts.select(F.explode(grams).alias("gram"), *keys)


def pieces(pattern: str) -> list[str]:
    """The literal texts between the wildcards of a LIKE pattern with backslash as escape."""
    found, escaped = [""], False
    for c in pattern:
        if escaped or c not in "\\%_":
            found[-1] += c
            escaped = False
        elif c == "\\":
            escaped = True
        else:
            found.append("")
    return [p for p in found if p]


def needed(pattern: str) -> list[str]:
    """The runs of three ASCII characters that every match has, at most one for each character of the pattern."""
    runs = {p[i : i + GRAM].lower() for p in pieces(pattern) for i in range(len(p) - GRAM + 1)}
    return sorted(r for r in runs if r.isascii())


def find(texts: DataFrame, index: DataFrame, keys: list[str], column: str, text: str) -> DataFrame:
    """Rows whose `column` contains `text` in any case; `%` and `_` keep their pattern meaning.

    `texts` has one row per `keys`, none of them null, and `index` holds its postings. Equal to the scan with ILIKE, also
    for patterns without a run of three characters, which read all rows.
    """
    runs = needed(text)
    if runs:
        lists = index.filter(F.col("gram").isin(runs))
        both = lists.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(runs))
        texts = texts.join(both.select(*keys), keys, "left_semi")
    return texts.filter(F.col(column).ilike(f"%{text}%"))

"""Row-level joins of large tables to a dimension, and the in-snapshot band operator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.session import pinned

BROADCAST_LIMIT = 64 * 1024 * 1024
SALTS = 64
HOT_SHARE = 1 / 500  # share of the facts from which a key is hot
HOT_TRACKED = 8192  # items the sketch tracks in each task


def measured_bytes(df: DataFrame) -> int:
    """Size of a DataFrame of flat columns, measured by one aggregation that returns one number."""
    parts = [
        F.coalesce(F.octet_length(f.name), F.lit(0)) + 24 if isinstance(f.dataType, T.StringType) else F.lit(16)
        for f in df.schema.fields
    ]
    return df.agg(F.sum(reduce(lambda a, b: a + b, parts).cast("long"))).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    return measured_bytes(df) <= limit


def hot_keys(facts: DataFrame, on: list[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold at least `share` of the facts, from one pass of a mergeable frequent-items sketch.

    The sketch never misses a key above 1/HOT_TRACKED of the rows by more than its error, which is far below `share`; a
    key that is taken for hot without being so is merely salted too. At most 1/share keys come back.
    """
    row = facts.select(F.xxhash64(*on).alias("h")).agg(
        F.expr(f"approx_top_k(h, {int(1 / share)}, {HOT_TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    return sorted(item["item"] for item in row.top or [] if item["item"] is not None and item["count"] >= share * row.n)


def salted(facts: DataFrame, dim: DataFrame, on: list[str], hot: list[int], salts: int = SALTS) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with `_salt`: a fact row of a hot key takes one of `salts` values from a hash of its own
    content (the same after a task retry), a dimension row of a hot key is repeated once for each; all others have 0."""
    none = F.lit(0).cast("long")
    # The keys of both sides hash alike only if they have the types of the facts.
    is_hot = F.xxhash64(*[F.col(c).cast(facts.schema[c].dataType) for c in on]).isin(hot) if hot else F.lit(False)
    hashable = [f.name for f in facts.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    spread = facts.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*hashable), F.lit(salts))).otherwise(none))
    every = F.sequence(none, F.lit(salts - 1).cast("long"))
    return spread, dim.withColumn("_salt", F.explode(F.when(is_hot, every).otherwise(F.array(none))))


def attach(
    facts: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "left",
    small: bool | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join rows to a dimension that has one row per key ('left' or 'inner').

    The dimension is written to the checkpoint folder and measured there, so that it is computed once; `small`
    gives the answer for one that is already written and measured. Within the limit it is broadcast. A larger
    one is joined by shuffle on the key and a salt. Only hot keys are salted (`hot_keys`), so that a key with a third of
    the facts is spread over `salts` groups and only the hot rows of the dimension are repeated.
    """
    if small is None:
        dim = pinned(dim)
        small = fits_broadcast(dim)
    if small:
        return facts.join(F.broadcast(dim), on, how)
    spread, repeated = salted(facts, dim, on, hot_keys(facts, on), salts)
    return spread.join(repeated, [*on, "_salt"], how).drop("_salt")


def within_band(
    levels: DataFrame, band: float = 0.10, snapshot: tuple = ("condition_id", "token_id", "exchange_ts")
) -> DataFrame:
    """Per snapshot: sum of ask sizes priced from the touch (level-1 ask) up to `band` above it, as `depth`.

    Where a snapshot has several level-1 rows, each counts, as a join of the levels to their touches would
    have it. No pairs are made: levels are first summed per price, then one range frame per price sums the
    sizes in [price, price + band], and the prices that are touches are added up.
    """
    keys = ", ".join(snapshot)
    per_price = (
        levels.filter(F.col("ask_px").isNotNull())
        .groupBy(*snapshot, F.col("ask_px").cast("double").alias("ask_px"))
        .agg(F.sum("ask_sz").alias("_sz"), F.count_if(F.col("level") == 1).alias("_touches"))
    )
    summed = per_price.withColumn(
        "_depth",
        F.expr(
            f"sum(_sz) OVER (PARTITION BY {keys} ORDER BY ask_px "
            f"RANGE BETWEEN CURRENT ROW AND {float(band)!r}D FOLLOWING)"
        ),
    )
    return (
        summed.filter(F.col("_touches") > 0)
        .groupBy(*snapshot)
        .agg(F.sum(F.col("_depth") * F.col("_touches")).cast("double").alias("depth"))
    )

"""Running totals and positions that never bring a whole key into one task.

`cumulative` is the RANGE frame: rows of equal time share one value. It sums rows per key and time first
(partial aggregation before the shuffle), runs a window inside each (key, minute), and adds the total of all
earlier minutes, which a second window takes from one row per (key, minute).

`running_rows` and `positions` are the ROWS frame: rows are split by range over the full order, the running
value is taken inside each (range part, key), and the totals of earlier parts are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from marketflow.session import pinned

REPEAT_CHUNK = 10_000
NO_TIME = "0001-01-01"  # the bucket of rows without a time, which come first


def _repeat(df: DataFrame, times: str) -> DataFrame:
    """Each row `times` times; two steps keep every generated array short."""
    n = F.col(times)
    out = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / REPEAT_CHUNK).cast("long"))))
    left = F.least(F.lit(REPEAT_CHUNK).cast("long"), n - F.col("_chunk") * REPEAT_CHUNK)
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), left))).drop("_chunk", "_copy")


def _filled(df: DataFrame, keys: list[str]) -> DataFrame:
    """Null keys as a value and a flag, so that parts of a null key meet in joins like those of any other key."""
    flags = {f"_null_{k}": F.col(k).isNull() for k in keys}
    kinds = {k: df.schema[k].dataType for k in keys}
    values = {
        k: F.coalesce(k, F.lit("1970-01-01" if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "0").cast(t))
        for k, t in kinds.items()
        if not isinstance(t, T.BooleanType)
    }
    values |= {k: F.coalesce(k, F.lit(False)) for k, t in kinds.items() if isinstance(t, T.BooleanType)}
    return df.withColumns(flags).withColumns(values)


def _restored(keys: list[str]) -> list[Column]:
    return [F.when(~F.col(f"_null_{k}"), F.col(k)).alias(k) for k in keys]


def _plus_earlier(local: DataFrame, values: dict[str, Column]) -> list[Column]:
    """Running value inside a part plus the total of the earlier parts."""
    zero = {name: F.lit(0).cast(local.schema[name].dataType) for name in values}
    return [
        (F.col(name) + F.coalesce(F.col(f"_before_{name}"), zero[name])).cast("double").alias(name) for name in values
    ]


def cumulative(
    df: DataFrame,
    values: dict[str, Column],
    keys: list[str],
    order: str = "exchange_ts",
    bucket: str = "minute",
    per_row: bool = True,
) -> DataFrame:
    """Running sums by time with equal times sharing one value: keys, `order`, one column per entry of `values`.

    Null keys are a key of their own, and rows without a time come before all others. One output row per input row, or per distinct time with `per_row=False`. A minute holds at most 60 million
    distinct microseconds and a year 525,600 minutes, so both windows stay bounded however many rows a key has.
    """
    named, keys = keys, [*keys, *[f"_null_{k}" for k in keys]]
    points = (
        _filled(df.select(*named, order, *[v.alias(name) for name, v in values.items()]), named)
        .groupBy(*keys, order)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(name).alias(name) for name in values])
        .withColumn("_bucket", F.coalesce(F.date_trunc(bucket, order), F.lit(NO_TIME).cast("timestamp")))
        .filter(F.col("_bucket").isNotNull())
    )
    totals = points.groupBy(*keys, "_bucket").agg(
        F.sum("_n").alias("_rows"), *[F.sum(name).alias(name) for name in values]
    )
    earlier = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    # `_rows > 0` always holds. With it, and with the null filter above and equal column order, both uses of
    # `points` need the same columns under the same filters, so that Spark runs its shuffle once and reuses it.
    offsets = totals.filter(F.col("_rows") > 0).select(
        *keys, "_bucket", *[F.sum(name).over(earlier).alias(f"_before_{name}") for name in values]
    )
    inside = W.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = points.select(*keys, "_bucket", order, "_n", *values).withColumns(
        {name: F.sum(name).over(inside) for name in values}
    )
    out = local.join(offsets, [*keys, "_bucket"]).select(*_restored(named), order, "_n", *_plus_earlier(local, values))
    return (_repeat(out, "_n") if per_row else out).drop("_n")


def running_rows(
    df: DataFrame, values: dict[str, Column], keys: list[str], order: list[str], parts: int | None = None
) -> DataFrame:
    """Running sums one row at a time; `order` must be unique within a key. All columns of `df` are kept.

    The split is written to the checkpoint folder: the part number of a row must not change between the two
    uses, nor when a lost executor's work is done again.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named, keys = keys, [*keys, *[f"_null_{k}" for k in keys]]
    split = pinned(
        _filled(df.select("*", *[v.alias(name) for name, v in values.items()]), named)
        .repartitionByRange(parts, *keys, *order)
        .withColumn("_part", F.spark_partition_id())
    )
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        split.groupBy(*keys, "_part")
        .agg(*[F.sum(name).alias(name) for name in values])
        .select(*keys, "_part", *[F.sum(name).over(earlier).alias(f"_before_{name}") for name in values])
    )
    inside = W.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    flags = [f"_null_{k}" for k in named]
    local = split.select(*df.columns, *flags, "_part", *[F.sum(name).over(inside).alias(name) for name in values])
    joined = local.join(offsets, [*keys, "_part"])
    back = dict(zip(named, _restored(named), strict=True))
    return joined.select(*[back.get(c, F.col(c)) for c in df.columns], *_plus_earlier(local, values))


def positions(df: DataFrame, keys: list[str], order: list[str], name: str = "position") -> DataFrame:
    """1-based position of each row of a key in `order`, numbered across all tasks."""
    numbered = running_rows(df, {name: F.lit(1).cast("long")}, keys, order)
    return numbered.withColumn(name, F.col(name).cast("long"))

"""Histograms and heat-map cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions.metrics import bucket
from marketflow.operators.joins import attach


def histogram(df: DataFrame, col: str, bins: int = 50, keys: tuple = ("condition_id",)) -> DataFrame:
    """Equal-width bins between each key's smallest and greatest value; the last bin includes its upper edge.

    Two passes over the column, each with a small shuffle: the bounds are one row per key, and with them at hand
    every task counts its own rows per bin.
    """
    values = df.filter(F.col(col).isNotNull()).select(*keys, F.col(col).cast("double").alias("_x"))
    bounds = values.groupBy(*keys).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    # A single value gets a range of width one around it.
    flat = F.col("_lo") == F.col("_hi")
    bounds = bounds.select(
        *keys,
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("hi"),
    )
    place = F.floor((F.col("_x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))
    return (
        attach(values, bounds, list(keys), how="inner")
        .groupBy(*keys, F.least(place, F.lit(bins - 1)).cast("int").alias("bin"), "lo", "hi")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def heatmap(
    df: DataFrame, every: str, cell: Column, cell_name: str, measure: Column, name: str, keys: tuple = ("condition_id", "token_id")
) -> DataFrame:
    """Cells of (time bucket, `cell`) with one aggregate."""
    return df.groupBy(*keys, bucket("exchange_ts", every).alias("time"), cell.alias(cell_name)).agg(measure.alias(name))

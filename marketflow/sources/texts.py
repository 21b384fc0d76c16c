"""Small text inputs: the category map, and title files with their batching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from marketflow.operators.running import positions


def read_category_map(spark: SparkSession, path: str) -> DataFrame:
    """(market_id, category) from one JSON object; a missing file is an empty map."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "market_id string, category string")
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("market_id", "category"))


def parse_titles(lines: DataFrame) -> DataFrame:
    """`id: title` lines → (title_id, title); other lines are headers and drop out. `file` is kept where present."""
    pattern = r"^(\d+): (.*)$"
    found = lines.filter(F.col("value").rlike(pattern))
    kept = ["file"] if "file" in lines.columns else []
    return found.select(
        *kept,
        F.regexp_extract("value", pattern, 1).cast("long").alias("title_id"),
        F.regexp_extract("value", pattern, 2).alias("title"),
    )


def read_title_corpus(spark: SparkSession, glob: str) -> DataFrame:
    return parse_titles(spark.read.text(glob).withColumn("file", F.input_file_name()))


def pack_titles(titles: DataFrame, n: int = 500) -> DataFrame:
    """Batches of `n` titles in id order, each as one text block. A batch is `n` lines, so a group is bounded."""
    numbered = positions(titles.select("title_id", "title"), [], ["title_id", "title"])
    line = F.concat_ws(": ", F.col("title_id").cast("string"), "title")
    batches = numbered.groupBy(F.floor((F.col("position") - 1) / n).cast("long").alias("batch")).agg(
        F.count(F.lit(1)).alias("titles"), F.array_sort(F.collect_list(F.struct("position", line.alias("line")))).alias("_l")
    )
    return batches.select("batch", "titles", F.array_join(F.transform("_l", lambda e: e["line"]), "\n").alias("text"))

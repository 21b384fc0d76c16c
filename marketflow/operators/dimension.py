"""The market dimension: newest versions, token maps, enrichment, categories."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.operators.filters import optional_eq
from marketflow.operators.joins import attach

# A question that contains one of these (any case) is a sports market.
SPORTS_KEYWORDS = [
    " vs ",
    " vs. ",
    " v ",
    " v. ",
    "league",
    "cup",
    "tournament",
    "championship",
    "nba",
    "nfl",
    "premier league",
    "champions league",
    "ufc",
    "f1",
    "grand prix",
]

# Up to so many parts a task writes its rows straight to their files (spark.shuffle.sort.bypassMergeThreshold); for more
# it gathers them in memory first.
PARTS = 200


def latest(df: DataFrame, keys: list[str], columns: list[str], order: str = "updated_at") -> DataFrame:
    """Newest version per key; all columns come from one version, and ties are settled by the columns' values."""
    newest = F.max(F.struct(order, *[c for c in columns if c != order])).alias("_newest")
    # The maximum needs sorted rows. One task may read a large file whole, so the versions are dealt out first, by all of
    # their content: no task sorts more than a part, and a key of many versions is cut down in many tasks.
    used = dict.fromkeys([*keys, order, *columns])
    wide = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) > PARTS
    dealt = df.select(*used).repartition(*[PARTS] * wide, *used)
    return dealt.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_newest.{c}").alias(c) for c in columns])


def latest_markets(markets: DataFrame) -> DataFrame:
    """Newest version of every market."""
    keys = ["condition_id", "market_id"]
    return latest(markets, keys, [c for c in markets.columns if c not in keys])


def latest_by_condition(markets: DataFrame, *columns: str) -> DataFrame:
    """Newest version per condition, so that a join to it cannot multiply rows."""
    return latest(markets, ["condition_id"], list(columns))


def listed_tokens(markets: DataFrame) -> DataFrame:
    """token_id, updated_at, market_id, condition_id of every token that a version lists."""
    return markets.select(F.explode("clob_token_ids").alias("token_id"), "updated_at", "market_id", "condition_id")


def latest_tokens(listed: DataFrame) -> DataFrame:
    """The newest listing of every token; ties are settled by market, then condition."""
    return latest(listed, ["token_id"], ["updated_at", "market_id", "condition_id"])


def token_map(markets: DataFrame) -> DataFrame:
    """Token → condition and market, from the newest version that lists the token; older tokens are not forgotten."""
    return latest_tokens(listed_tokens(markets)).select("token_id", "condition_id", "market_id")


def enrich(rows: DataFrame, tokens: DataFrame, small: bool | None = None) -> DataFrame:
    """Set condition_id from the token; set market_id where it is empty, null or repeats that condition_id.

    Rows of unknown tokens pass unchanged.
    """
    known = tokens.filter((F.col("token_id") != "") & (F.col("condition_id") != "")).select(
        "token_id", F.col("condition_id").alias("_condition"), F.coalesce("market_id", F.lit("")).alias("_market")
    )
    joined = attach(rows, known, ["token_id"], small=small)
    unset = (
        F.col("market_id").isNull() | (F.col("market_id") == "") | (F.col("market_id") == F.col("_condition"))
    )
    market = F.when(F.col("_condition").isNotNull() & unset, F.col("_market")).otherwise(F.col("market_id"))
    condition = F.coalesce("_condition", "condition_id")
    replaced = {"market_id": market, "condition_id": condition}
    return joined.select(*[replaced.get(c, F.col(c)).alias(c) for c in rows.columns])


def is_sports(question: Column) -> Column:
    pattern = "|".join(re.escape(word) for word in SPORTS_KEYWORDS)
    return F.lower(question).rlike(pattern)


def computed_category(markets: DataFrame, category_map: DataFrame) -> DataFrame:
    """Add computed_category: the map's value, else Sports by category or keyword, else the API category, else Other."""
    mapped = attach(markets, category_map.select("market_id", F.col("category").alias("_mapped")), ["market_id"])
    by_rule = F.when((F.col("category") == "Sports") | is_sports(F.col("question")), "Sports").otherwise(F.col("category"))
    chosen = F.coalesce(F.nullif("_mapped", F.lit("")), F.nullif(by_rule, F.lit("")), F.lit("Other"))
    kept = [c for c in markets.columns if c != "computed_category"]
    return mapped.select(*kept, chosen.alias("computed_category"))


def new_tokens(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Tokens of this sync that the previous one did not have."""
    return current.select("token_id").distinct().join(previous.select("token_id"), "token_id", "left_anti")


def tokens_for_category(markets: DataFrame, category: str | None = None) -> DataFrame:
    """(condition_id, market_id, token_id) of one category, or of every category with the category in front."""
    chosen = optional_eq(latest_markets(markets), "computed_category", category)
    lead = [] if category is not None else ["computed_category"]
    return (
        chosen.filter(F.size("clob_token_ids") > 0)
        .select(*lead, "condition_id", "market_id", F.explode("clob_token_ids").alias("token_id"))
        .filter(F.col("token_id") != "")
    )


def with_market(per_condition: DataFrame, markets: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """Join rows that are already one per condition to the newest market version.

    A left join fills the text columns of unmatched rows with '', as the stored tables do. Callers aggregate
    the facts per condition first, so both sides have one row per condition and no hint is needed.
    """
    joined = per_condition.join(latest_by_condition(markets, *columns), "condition_id", how)
    if how == "left":
        joined = joined.withColumns({c: F.coalesce(c, F.lit("")) for c in columns if c != "updated_at"})
    return joined


def with_yes_no(levels: DataFrame, markets: DataFrame) -> DataFrame:
    """Add yes_token and no_token, the first and second token of the row's market."""
    sides = latest_by_condition(markets, "clob_token_ids").select(
        "condition_id",
        F.try_element_at("clob_token_ids", F.lit(1)).alias("yes_token"),
        F.try_element_at("clob_token_ids", F.lit(2)).alias("no_token"),
    )
    return attach(levels, sides, ["condition_id"])

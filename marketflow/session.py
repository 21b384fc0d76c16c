"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Shuffle width is left to the cluster and to adaptive execution.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # A message that repeats a key counts with the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "marketflow", **conf) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by spark.checkpoint.dir; on a local master without one, make a private folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="marketflow-checkpoint-")
    context.setCheckpointDir(folder)


def pinned(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder, so that every later use reads the same rows in the same partitions."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

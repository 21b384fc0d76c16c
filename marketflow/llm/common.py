"""Words, hashes and storage shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.session import ensure_checkpoint_dir

# Words of letters and digits: A-Z in lower case, every other ASCII character but 0-9 and a-z is a gap.
# In UTF-8 all bytes of a non-ASCII character are 0x80 or more, so bytes and code points give the same words.
_ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
U = np.uint64
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)


def alnum_words(text: bytes) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z."""
    return text.translate(_ALNUM).split()


def blank_words(text: bytes) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ after lower-casing A-Z."""
    return text.lower().split()


def scrambled(h: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit values."""
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


class PrefixHashes:
    """Prefix sums of a polynomial over the bytes of a text; any slice hashes in constant time, modulo 2**64."""

    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        cls = PrefixHashes
        if len(cls._powers) <= n:
            size = max(1 << 16, 2 * n)
            with np.errstate(over="ignore"):
                cls._powers = np.cumprod(np.concatenate(([U(1)], np.full(size, BASE, np.uint64))), dtype=np.uint64)
                cls._inverse = np.cumprod(
                    np.concatenate(([U(1)], np.full(size, BASE_INVERSE, np.uint64))), dtype=np.uint64
                )
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * cls._powers[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the slices [start, end), the same wherever a slice stands."""
        return (self.sums[end] - self.sums[start]) * PrefixHashes._inverse[start]

    def every(self, length: int) -> np.ndarray:
        """Hashes of all slices of one length."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * PrefixHashes._inverse[:n]


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that spark.checkpoint.dir names."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back; lost executors cannot lose it.

    The shuffle files of the write are removed at its end, as nothing reads them again.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table that `stored` wrote and nothing reads any more; files elsewhere are left alone."""
    context = df.sparkSession.sparkContext
    path_of = context._jvm.org.apache.hadoop.fs.Path
    shared = path_of(context.getCheckpointDir()).toUri().getPath() + "/"
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = path_of(folder)
        if path.toUri().getPath().startswith(shared):
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or a longer name that no column of `df` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_columns(
    docs: DataFrame, added: dict[str, pa.DataType], types: dict[str, str], make: Callable[[], Callable], keep: list[str] | None = None
) -> DataFrame:
    """Add columns computed from the text of each row, without a shuffle.

    `make()` runs once in each task and returns a function from a list of texts (bytes; null: None) to a dict of
    columns. An added column replaces one of the same name; the other columns, or those in `keep`, pass through.
    """
    passed = [c for c in (docs.columns if keep is None else keep) if c not in added]
    text = free_name(docs, "__text")
    source = docs.select(*[F.col(f"`{c}`") for c in passed], F.col("text").cast("binary").alias(text))
    schema = docs.select(*[F.col(f"`{c}`") for c in passed], *[F.lit(None).cast(t).alias(c) for c, t in types.items()]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in slices(batches):
            out = fn(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in passed] + [pa.array(out[c], t) for c, t in added.items()],
                [*passed, *added],
            )

    return source.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in short pieces, so that only a few texts at a time become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def where_text(docs: DataFrame, make: Callable[[], Callable]) -> DataFrame:
    """The rows whose text passes, with their own columns; `make()` returns a function from texts to booleans."""
    text = free_name(docs, "__text")
    source = docs.withColumn(text, F.col("text").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in slices(batches):
            passes = pa.array(fn(batch.column(text).to_pylist()), pa.bool_())
            yield batch.select(docs_columns).filter(passes)

    docs_columns = docs.columns
    return source.mapInArrow(run, docs.schema)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

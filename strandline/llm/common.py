"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words in every word-based operator.
SPACES = "[\\x20\\x09-\\x0D]+"
#: Bytes after which a batch of rows for Python ends (a longer row stands alone), and of a row group of a table of the operators' own.
BATCH_BYTES, GROUP_BYTES = 8 << 20, 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words(text: Column) -> Column:
    """Words of an already folded text, as an array without empty entries."""
    return F.array_remove(F.split(text, SPACES), "")


def in_batches(df: DataFrame, function, schema: str, rows: int = 2500) -> DataFrame:
    """``df.mapInArrow`` in batches of at most ``rows`` texts, small enough for two workers of an executor.

    Spark's own batches of 10,000 rows are meant for numbers; they are cut here, without a copy,
    so that no setting of the session changes.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first in range(0, b.num_rows, rows):
                yield b.slice(first, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(cut(batches))
        # a worker serves the next stage, too: what this one has freed goes back to the system
        gc.collect()
        pa.default_memory_pool().release_unused()
        libc = ctypes.CDLL(None)
        if hasattr(libc, "malloc_trim"):
            libc.malloc_trim(0)

    return df.mapInArrow(run, schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where that setting is absent is a temporary folder used, and only in local mode.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2500) -> Iterator[None]:
    """Within it, tables are read and written in batches of texts and not of numbers, where the session has Spark's own sizes; afterwards all is as before."""
    sizes = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", rows),
        "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", BATCH_BYTES),
        "spark.sql.parquet.columnarReaderBatchSize": ("4096", max(1, rows // 4)),
    }
    own = {name: spark.conf.get(name) for name in sizes}
    changed = [name for name, (usual, _) in sizes.items() if own[name] == usual]
    for name in changed:
        spark.conf.set(name, str(sizes[name][1]))
    try:
        yield
    finally:
        for name in changed:
            spark.conf.set(name, own[name])


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, what a query has shuffled is deleted as soon as the query has ended; afterwards all is as before."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, own)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The result has no lineage, so a lost executor costs a re-read and no recomputation. Its row
    groups are small: a writer holds one at a time, and several tasks can read one file.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.option("parquet.block.size", str(GROUP_BYTES)).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`stored` that no later plan reads."""
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._stored_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def scale_of(df: DataFrame, rows_per_part: int) -> int:
    """A number of parts for ``df``: one for each ``rows_per_part`` rows."""
    return max(1, -(-df.count() // rows_per_part))

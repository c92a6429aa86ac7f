"""Structured Streaming twins of episodes and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def sessions(stream: DataFrame, key: str, start: str, stop: str, hours: int = 12, late: str = "1 day") -> DataFrame:
    """Episodes by running latest stop: session windows whose gap is the event's length and ``hours``.

    A gap of exactly ``hours`` splits, as in the batch operator. Works on streams and on tables.
    """
    seconds = F.greatest(F.unix_micros(stop) - F.unix_micros(start), F.lit(0)) + F.lit(hours * 3_600_000_000 - 1)
    gap = F.concat((seconds).cast("string"), F.lit(" microseconds"))
    if stream.isStreaming:
        stream = stream.withWatermark(start, late)
    grouped = stream.groupBy(key, F.session_window(start, gap).alias("w"))
    return grouped.agg(F.min(start).alias("stay_start"), F.max(stop).alias("stay_stop"), F.count("*").alias("members")).drop("w")


def run_available(stream: DataFrame, path: str, state: str, query: str) -> DataFrame:
    """Append all input there is to a Parquet sink, and read it back; a later run goes on from ``state``."""
    spark = stream.sparkSession
    stream.writeStream.format("parquet").option("checkpointLocation", state).option("path", path).trigger(availableNow=True).outputMode("append").queryName(query).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def current(spark: SparkSession, root: str, schema: StructType, key: str) -> DataFrame:
    """The table under ``root``: each key's row of the last batch that has changed it."""
    rows = spark.read.schema(StructType([*schema, StructField("batch", LongType())])).parquet(root)
    return rows.groupBy(key).agg(F.max_by(F.struct(*schema.names), "batch").alias("r")).select("r.*")


def upsert_stream(stream: DataFrame, key: str, order: str, root: str, state: str) -> DataFrame:
    """Keep the latest row of each key in a table under ``root``.

    The latest rows are the stream's own state, in the state store of ``state``; a micro-batch
    writes the rows of its keys only, under its number, so its bytes grow with the batch and not
    with the table. All there is to know lies in the folders: a restart goes on from them, and a
    batch that runs twice overwrites what it wrote. :func:`compact` makes one part of many batches.
    """
    spark, schema = stream.sparkSession, stream.schema
    latest = stream.groupBy(key).agg(F.max_by(F.struct(*schema.names), order).alias("r")).select("r.*")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch={number}")

    latest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return current(spark, root, schema, key)


def compact(spark: SparkSession, root: str, schema: StructType, key: str, upto: int) -> int:
    """Replace the parts of the batches up to number ``upto`` by one part; returns how many went.

    The new part is written beside the table and moved in under the number -1 - ``upto`` first,
    while all old ones are there: a reader sees a key's newest row at any moment, since a compacted
    row is older than any later batch and equal to what it replaces. No stream needs the old parts.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [x.getPath() for x in fs.listStatus(hadoop.Path(root)) if x.isDirectory() and x.getPath().getName().startswith("batch=")]
    old = [x for x in parts if int(x.getName().partition("=")[2]) <= upto]
    if not old:
        return 0
    rows = current(spark, root, schema, key) if len(old) == len(parts) else None
    if rows is None:
        some = spark.read.schema(StructType([*schema, StructField("batch", LongType())])).option("basePath", root).parquet(*[str(x) for x in old])
        rows = some.groupBy(key).agg(F.max_by(F.struct(*schema.names), "batch").alias("r")).select("r.*")
    beside = f"{root}-compacted-{upto}"
    rows.write.mode("overwrite").parquet(beside)
    fs.rename(hadoop.Path(beside), hadoop.Path(f"{root}/batch={-1 - upto}"))
    for x in old:
        fs.delete(x, True)
    return len(old)

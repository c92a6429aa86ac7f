"""Reading and writing tables, period partitions, and control rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONCEPT = (
    "conceptId string, active boolean, inferredDescendants bigint, descriptions array<struct<term:string>>, "
    "relationships array<struct<active:boolean, type:struct<conceptId:string>, target:struct<conceptId:string>>>"
)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder serves in local mode; on a cluster, where executors
    do not share one, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


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
    """Write ``df`` in the shared folder and read it back, without lineage; what was shuffled for it is deleted."""
    path = scratch(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`stored` that no later plan reads."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV files with a header, by a declared schema."""
    return spark.read.schema(schema).option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV files with a header."""
    df.write.mode(mode).option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def read_csv_folder(spark: SparkSession, folder: str, schemas: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """One table for each declared name, from ``folder/name``; a missing one raises."""
    return {n: read_csv(spark, f"{folder}/{n}", s) for n, s in schemas.items()}


def read_concepts(spark: SparkSession, path: str) -> DataFrame:
    """One JSON concept a file; unusable files (such as the literal ``false``) give no row."""
    return spark.read.schema(CONCEPT).option("multiLine", True).option("mode", "PERMISSIVE").json(path).where("conceptId is not null")


def month_end(c: Column | str) -> Column:
    """Last day of a date's month, which names its period."""
    return F.last_day(F.col(c) if isinstance(c, str) else c)


def write_periods(df: DataFrame, at: str, path: str, rows_per_task: int = 2_000_000) -> None:
    """Partition by month end, so that a period is read alone.

    A period is written by one task for each ``rows_per_task`` of its rows.
    """
    rows = df.withColumn("period_end", month_end(at))
    shares = rows.groupBy(F.col("period_end").alias("_end")).agg(F.ceil(F.count("*") / rows_per_task).alias("_shares"))  # a row a month
    dealt = rows.join(F.broadcast(shares), F.col("period_end").eqNullSafe(F.col("_end"))).drop("_end")
    dealt = dealt.withColumn("_share", F.pmod(F.xxhash64(*[c for c in df.columns]), F.col("_shares")))
    dealt.repartition("period_end", "_share").drop("_share", "_shares").write.mode("overwrite").partitionBy("period_end").parquet(path)


def read_month(spark: SparkSession, root: str, names: list[str], period: str) -> dict[str, DataFrame]:
    """The tables ``root/name`` of one month; a table without that period raises."""
    found = {}
    for n in names:
        rows = spark.read.parquet(f"{root}/{n}").where(F.col("period_end") == F.lit(period).cast("date"))
        if rows.isEmpty():
            raise FileNotFoundError(f"{n} has no period {period}")
        found[n] = rows
    return found


def fetched(spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """The table at ``path``; ``build`` is run and written only where there is none, or with ``force``."""
    if not force:
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            pass
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def save_clustered(df: DataFrame, name: str, by: str, buckets: int = 16) -> DataFrame:
    """Save as a table in ``buckets`` by a key, sorted; joins and groups by that key then shuffle nothing."""
    spark = df.sparkSession
    df.write.mode("overwrite").bucketBy(buckets, by).sortBy(by).option("path", scratch(spark, name)).saveAsTable(name)
    return spark.table(name)


def write_control(cursor: DataFrame, path: str, number: int) -> None:
    """Write the control row as version ``number``."""
    cursor.write.mode("overwrite").parquet(f"{path}/version={number}")


def read_control(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The control row of the highest version, and its number."""
    rows = spark.read.parquet(path)
    number = rows.agg(F.max("version")).first()[0]
    return rows.where(F.col("version") == number).drop("version"), number


def read_periods(spark: SparkSession, path: str, condition: Column) -> DataFrame:
    """The periods that meet a condition on ``period_end``; other partitions are not read."""
    return spark.read.parquet(path).where(condition)


def append_new(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``old`` and those rows of ``new`` whose key is not there yet."""
    return old.unionByName(new.join(old.select(*key).distinct(), key, "left_anti"))


def write_snapshot(df: DataFrame, path: str, period: str) -> None:
    """Write rows partitioned by ``period``, replacing only the periods they hold: reruns add nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(path)


def window_of(df: DataFrame, at: str, months: int) -> DataFrame:
    """sim_start (first day of the month ``months`` - 1 before the last) and cutoff, the day before."""
    last = df.agg(F.max(F.to_date(at)).alias("last"))
    start = F.to_date(F.add_months(F.trunc("last", "MM"), -(months - 1)))
    return last.select(start.alias("sim_start"), F.date_sub(start, 1).alias("cutoff"))


def month_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Month ends from ``first`` to ``last``."""
    months = F.sequence(F.trunc(F.lit(first).cast("date"), "MM"), F.lit(last).cast("date"), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("m")).select(F.last_day("m").alias("period_end"))


def advance(cursor: DataFrame) -> DataFrame:
    """The cursor (last_processed, next_end, final_end) after its next period; refuses a null one."""
    row = cursor.first()
    if row is None or row["next_end"] is None:
        raise ValueError("the cursor has no next period")
    return cursor.select(F.col("next_end").alias("last_processed"), F.last_day(F.add_months("next_end", 1)).alias("next_end"), "final_end")

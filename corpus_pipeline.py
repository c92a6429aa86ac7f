"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm import best_fit_packing, decontamination, language_id, near_dedup, quality
from strandline.llm.common import read, shared_dir, stored
from strandline.llm.token_counts import vocabulary_path

#: Languages that stay, and the share of a document's words that must be in the one it is kept for.
LANGUAGES, SHARE = ("de", "en", "es", "fr"), 0.3
#: Keys of a stage's decision up to which they are broadcast to the documents.
BROADCAST_ROWS = 1_000_000


def _free(docs: DataFrame) -> str:
    """A name that no column of ``docs`` has, whatever its case."""
    name, taken = "_row", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row's own, and the key's name.

    That is doc_id where it is never null and never repeated. Else the rows are numbered and
    written, so that every later plan reads the same numbers; a stage then takes the documents'
    size once more on disk.
    """
    row = _free(docs)
    ids = docs.groupBy("doc_id").count()
    if ids.where("count > 1 or doc_id is null").isEmpty():
        return docs.withColumn(row, F.col("doc_id")), row
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def _without(docs: DataFrame, row: str, rejected: DataFrame) -> DataFrame:
    """``docs`` without the rows whose key is in the only column of ``rejected``."""
    keys = stored(rejected.toDF(row).distinct(), "rejected")
    return docs.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, row, "left_anti").drop(row)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose perplexity under trusted text is within their language's limit."""
    docs, row = _keyed(docs)
    judged = quality.quality(docs, read(spark, sf_dir, "labels"), carry=(row,))
    return _without(docs, row, judged.where(~F.col("keep")).select(row))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are, by their own words, mostly in a wanted language."""
    model = language_id.train(docs)
    docs, row = _keyed(docs)
    found = language_id.language_id(docs.select(row, "text"), model, key=row)
    return _without(docs, row, found.where(~F.col("lang_pred").isin(*LANGUAGES) | (F.col("score") < SHARE)).select(found.columns[0]))


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, whatever their ids, and one of equal id and text.

    Texts without words are linked with nothing; of those only rows of equal id and text are
    made one, and rows without an id stay.
    """
    docs, row = _keyed(docs)
    found = near_dedup.near_dedup(docs, key=row)
    copies = found.where(~F.col("kept")).select("doc_id")
    wordless = docs.join(found.where("n_shingles = 0").select(F.col("doc_id").alias(row)), row, "left_semi").where("doc_id is not null").select(row, "doc_id", "text")
    n = F.row_number().over(Window.partitionBy("doc_id", "text").orderBy(row))
    again = wordless.select(row, n.alias("_n")).where("_n > 1").select(row)
    return _without(docs, row, copies.union(again))


def drop_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without benchmark items."""
    docs, row = _keyed(docs)
    return _without(docs, row, decontamination.decontamination(docs, read(spark, sf_dir, "benchmark"), key=row).select("doc_id"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' token pieces in sequences of 4096 tokens."""
    return best_fit_packing.best_fit_packing(docs, vocabulary_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("language", keep_languages),
    ("near-dedup", keep_first_copies),
    ("decontamination", drop_benchmarks),
    ("packing", pack),
]

#: The quality model, the language model and the packing plan are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet and read again.

    A stage judges every row by itself: a null doc_id protects no row, and a repeated one drops
    only the rows that are rejected. Null and empty texts have no language and go with the second
    stage; a null lang is a language of its own; very long texts are judged and packed whole;
    further columns of documents stay up to the last stage. An empty table, and one that a stage
    has emptied, gives an empty result.
    """
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/stage-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

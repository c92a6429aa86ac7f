"""Operator 1: token counts by rank-synchronous array merging."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import word_bpe
from strandline.llm.common import in_batches, read
from strandline.llm.shingling import text_parts


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary file ``name`` lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """Count the tokens of every whole text.

    Returns key, n_bytes, n_tokens, over_limit (more than ``limit`` tokens), one row for each
    input row. A null or empty text has 0 bytes and 0 tokens; a null key stays null; repeated
    rows are counted each; an empty table gives an empty result; other columns are ignored,
    whatever their names. A very long text is counted whole; one text is in a worker's memory at
    a time with those of about 2 MB around it. The work is one map over the scan, without a shuffle.
    """
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    kind = docs.schema[key].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe.load(path)
        for b in batches:
            tokens = [n for _, part in text_parts(b.column(1)) for n in bpe.count_texts(part)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(tokens, pa.int64())], names=["k", "n_bytes", "n_tokens"])

    counted = in_batches(source, count, f"k {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts(read(spark, sf_dir, "documents"), vocabulary_path())


QUERIES = {"op1_token_counts": op1_token_counts}
ORACLE: dict[str, str] = {}

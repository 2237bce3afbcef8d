"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import uuid
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import checkpoint_dir

#: Rows of one Arrow batch. Documents can be long, so a batch of Spark's
#: default 10,000 rows could hold gigabytes of text.
BATCH_ROWS = 512

#: Characters that separate words everywhere in this subpackage.
WORD_BREAKS = " \t\n\v\f\r"


def documents(spark: SparkSession, base_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{table}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; every machine has the files at the
    same place."""
    import public_tokenizers
    return os.fspath(public_tokenizers.path(name))


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch unless the session already does."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read
    it back: cuts the lineage, and a lost executor only re-reads files."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have."""
    while base.lower() in (c.lower() for c in df.columns):
        base += "_"
    return base


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts (null: none)."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def parts_for(n_bytes: int, per_part: int, at_least: int) -> int:
    return max(at_least, ceil(n_bytes / per_part))


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, as UTF-8 (null: none).
    ``bytes.split`` breaks at exactly these six ASCII characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def sampled_texts(docs: DataFrame, at_most: int, seed: str) -> DataFrame:
    """``doc_id, text`` of at most ``at_most`` documents drawn by a hash of
    their id (of several texts with one id the first in order). For fitting
    classifiers only."""
    ids = (docs.select("doc_id").filter("doc_id is not null").distinct()
           .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(at_most))
    return (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most ``at_most`` rows
            .groupBy("doc_id").agg(F.min("text").alias("text")))

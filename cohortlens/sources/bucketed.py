"""Feature tables bucketed by entity: later joins on it need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.session import checkpoint_dir

#: Buckets where the caller names none, and files of each bucket.
BUCKETS, SPREAD = 16, 4


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int = BUCKETS, spread_by: str | None = None,
                   path: str | None = None, spread: int = SPREAD) -> DataFrame:
    """Keep ``df`` as Parquet table ``name`` with ``buckets`` buckets of
    ``key``, sorted by it, in ``path`` (default: a folder of that name in
    the shared checkpoint folder), and read it back. Tables with equal
    buckets of a key join on it without an exchange.

    Rows are dealt by bucket before they are written, so a bucket has few
    files. ``spread_by`` (the row id) divides each bucket among ``spread``
    tasks, so that a key with a large share of the rows is not written by
    one of them. Reading a bucket back is one task, however hot its key."""
    spark = df.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    bucket = F.pmod(F.hash(key), F.lit(buckets))  # as Spark numbers buckets
    dealt = df.repartition(buckets, bucket) if spread_by is None else df.repartition(
        buckets * spread, bucket, F.pmod(F.xxhash64(spread_by), F.lit(spread)))
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name)

"""Outcome rates by a cut, maintained incrementally.

The batch operators in ``operators.profile`` answer "rate by X" over a
table; here the same aggregate is kept up to date while event files
arrive: a file stream of the events table is joined to the static
customer and nation tables (stream-static joins need no state), projected
into the appointments layout, and aggregated with Structured Streaming.
The running state is one row per key (count, positives), so it stays as
small as the key domain; ``complete`` output mode re-emits the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import as_flag, rounded
from cohortlens.sources import appointments
from cohortlens.sources.tables import read_table


def appointment_stream(spark: SparkSession, base_dir: str, events_path: str | None = None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming appointments frame: events read as a parquet file stream
    (``events_path``, a folder, defaults to the table's own path)."""
    path = events_path or f"{base_dir.rstrip('/')}/events.parquet"
    schema = read_table(spark, base_dir, "events").schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return appointments(spark, base_dir, events=reader.parquet(path))


def streaming_rate_by(stream: DataFrame, key, label: str = "no_show") -> DataFrame:
    """Running ``(key, count, rate)`` over a streaming frame."""
    agg = stream.groupBy(key).agg(F.count(F.lit(1)).alias("count"),
                                  F.sum(as_flag(label)).alias("pos"))
    return agg.select(*[c for c in agg.columns if c not in ("count", "pos")], "count",
                      rounded(F.col("pos") / F.col("count")).alias("ratio"))

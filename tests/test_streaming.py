"""The streaming rate equals the batch rate once all files are processed."""

from pyspark.sql import functions as F

from cohortlens.functions import days_between
from cohortlens.operators import profile as P
from cohortlens.sources import appointments
from cohortlens.streaming import appointment_stream, streaming_rate_by
from tests.conftest import SF001


def test_streaming_rate_matches_batch(spark, tmp_path):
    # Split the events table into several files to arrive one per trigger.
    src = tmp_path / "events"
    spark.read.parquet(f"{SF001}/events.parquet").repartition(4).write.parquet(str(src))
    stream = appointment_stream(spark, SF001, events_path=str(src), max_files_per_trigger=1)
    agg = streaming_rate_by(stream, days_between("appointment_day", "scheduled_ts").alias("days_between"))
    q = (agg.writeStream.outputMode("complete").format("memory").queryName("rates_stream")
         .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    got = {r.days_between: (r["count"], r.ratio) for r in spark.sql("SELECT * FROM rates_stream").collect()}
    batch = P.rate_by(appointments(spark, SF001),
                      days_between("appointment_day", "scheduled_ts").alias("days_between"),
                      with_count=True)
    want = {r.days_between: (r["count"], r.ratio) for r in batch.collect()}
    assert got == want

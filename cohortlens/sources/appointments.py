"""The appointments view: one row per booking, derived from the
``events``, ``customer`` and ``nation`` tables.

Columns (snake_case of the raw file's 14 columns):

    patient_id bigint, appointment_id bigint, gender boolean,
    scheduled_ts timestamp_ntz, appointment_day timestamp_ntz, age int,
    neighbourhood string, scholarship / hipertension / diabetes /
    alcoholism boolean, handcap int, sms_received boolean, no_show boolean

The derivation is a plain scan-join-project: ``events`` joins ``customer``
on its key (a shuffle join or broadcast, whichever AQE finds cheaper) and
the 25-row ``nation`` table is broadcast (its size is fixed by definition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.sources.tables import read_table

APPOINTMENT_COLUMNS = [
    "patient_id", "appointment_id", "gender", "scheduled_ts", "appointment_day",
    "age", "neighbourhood", "scholarship", "hipertension", "diabetes",
    "alcoholism", "handcap", "sms_received", "no_show",
]

# Fixed values of the fixture definition: market segment -> flag column.
SEGMENT_FLAGS = {
    "scholarship": "BUILDING",
    "hipertension": "HOUSEHOLD",
    "diabetes": "MACHINERY",
    "alcoholism": "FURNITURE",
}


def appointments(spark: SparkSession, base_dir: str, events: DataFrame | None = None) -> DataFrame:
    """The view over ``base_dir``'s tables; ``events`` may replace the
    events table (e.g. a streaming source with the same schema)."""
    ev = (events if events is not None else read_table(spark, base_dir, "events")).select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.regexp_extract("props", r"([0-9]+)", 1).cast("int").alias("k"))
    cust = read_table(spark, base_dir, "customer").select(
        "c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    nation = read_table(spark, base_dir, "nation").select("n_nationkey", "n_name")

    j = (ev.join(cust, ev.user_id == cust.c_custkey)
           .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")))
    patient_id = (F.col("user_id") * 100 + F.col("k")).cast("bigint")
    gap = ((F.col("k") + F.col("event_id")) % 12 - 1).cast("int")
    j = j.select("*", patient_id.alias("patient_id"), gap.alias("gap"))

    age = (F.floor(F.col("c_acctbal") / 100).cast("int")
           + F.when(F.dayofmonth("ts") > 1 + F.col("patient_id") % 120, 1).otherwise(0))
    cols = [
        F.col("patient_id"),
        F.col("event_id").alias("appointment_id"),
        (F.col("c_custkey") % 3 != 0).alias("gender"),
        F.col("ts").alias("scheduled_ts"),
        F.date_add(F.to_date("ts"), F.col("gap")).cast("timestamp_ntz").alias("appointment_day"),
        age.cast("int").alias("age"),
        F.concat(F.col("n_name"), F.lit("/"), F.col("c_mktsegment")).alias("neighbourhood"),
    ]
    cols += [(F.col("c_mktsegment") == seg).alias(name) for name, seg in SEGMENT_FLAGS.items()]
    cols += [
        (F.col("c_nationkey") % 5).cast("int").alias("handcap"),
        ((F.col("gap") >= 3) & (F.col("value") >= 15)).alias("sms_received"),
        ((F.col("event_type") == "error")
         | ((F.col("event_type") == "view") & (F.col("gap") >= 7))).alias("no_show"),
    ]
    return j.select(*cols)

"""Typed reading of the raw appointments CSV and its recode.

The raw file has 14 columns with the original names (one of them,
``No-show``, is not a legal identifier). The reader never infers types:
it takes ``RAW_SCHEMA``; cells that do not parse become NULL
(``PERMISSIVE``), or fail the job with ``mode="FAILFAST"``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw column names and types of the source file.
RAW_SCHEMA = T.StructType([
    T.StructField("PatientId", T.DoubleType()),
    T.StructField("AppointmentID", T.DoubleType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("ScheduledDay", T.TimestampNTZType()),
    T.StructField("AppointmentDay", T.TimestampNTZType()),
    T.StructField("Age", T.DoubleType()),
    T.StructField("Neighbourhood", T.StringType()),
    T.StructField("Scholarship", T.IntegerType()),
    T.StructField("Hipertension", T.IntegerType()),
    T.StructField("Diabetes", T.IntegerType()),
    T.StructField("Alcoholism", T.IntegerType()),
    T.StructField("Handcap", T.DoubleType()),
    T.StructField("SMS_received", T.IntegerType()),
    T.StructField("No-show", T.StringType()),
])

# ISO text with an optional fraction and a literal Z, as in the source file.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]'Z'"
TS_WRITE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

_FLAGS = ["Scholarship", "Hipertension", "Diabetes", "Alcoholism", "SMS_received"]


def read_raw_csv(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    return (spark.read.schema(RAW_SCHEMA)
            .option("header", True).option("sep", ",").option("mode", mode)
            .option("timestampNTZFormat", TS_FORMAT)
            .csv(path))


def recode(raw: DataFrame) -> DataFrame:
    """Raw layout -> typed snake_case layout.

    Text flags become booleans ("F" -> gender true, "Yes" -> no_show
    true), 0/1 columns booleans, numeric ids bigint, age and handicap int.
    """
    return raw.select(
        F.col("PatientId").cast("bigint").alias("patient_id"),
        F.col("AppointmentID").cast("bigint").alias("appointment_id"),
        (F.col("Gender") == "F").alias("gender"),
        F.col("ScheduledDay").alias("scheduled_ts"),
        F.col("AppointmentDay").alias("appointment_day"),
        F.col("Age").cast("int").alias("age"),
        F.col("Neighbourhood").alias("neighbourhood"),
        *[F.col(c).cast("boolean").alias(c.lower()) for c in _FLAGS[:4]],
        F.col("Handcap").cast("int").alias("handcap"),
        F.col("SMS_received").cast("boolean").alias("sms_received"),
        (F.col("`No-show`") == "Yes").alias("no_show"),
    )


def to_raw(df: DataFrame) -> DataFrame:
    """Typed layout -> raw layout (the inverse of ``recode``)."""
    return df.select(
        F.col("patient_id").cast("double").alias("PatientId"),
        F.col("appointment_id").cast("double").alias("AppointmentID"),
        F.when(F.col("gender"), "F").otherwise("M").alias("Gender"),
        F.col("scheduled_ts").alias("ScheduledDay"),
        F.col("appointment_day").alias("AppointmentDay"),
        F.col("age").cast("double").alias("Age"),
        F.col("neighbourhood").alias("Neighbourhood"),
        *[F.col(c.lower()).cast("int").alias(c) for c in _FLAGS[:4]],
        F.col("handcap").cast("double").alias("Handcap"),
        F.col("sms_received").cast("int").alias("SMS_received"),
        F.when(F.col("no_show"), "Yes").otherwise("No").alias("No-show"),
    )


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Write a typed table in the raw CSV layout (one part per partition)."""
    (to_raw(df).write.mode("overwrite")
     .option("header", True).option("timestampNTZFormat", TS_WRITE_FORMAT)
     .csv(path))

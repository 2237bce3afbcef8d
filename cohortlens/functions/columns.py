"""Reusable column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``
so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fractions are rounded so that Spark and SQL engines that sum in a
# different order agree on the printed value.
DIGITS = 6


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_flag(col) -> Column:
    """boolean -> 0/1 int (``1 * (x == TRUE)``)."""
    return _c(col).cast("int")


def rate(col) -> Column:
    """Mean of a boolean predicate (``mean(x == TRUE)``) as double.

    Nulls are skipped, as SQL ``avg`` does.
    """
    return F.avg(as_flag(col)).cast("double")


def rounded(col, digits: int = DIGITS) -> Column:
    return F.round(_c(col).cast("double"), digits)


def days_between(later, earlier) -> Column:
    """Whole days from ``earlier`` to ``later`` (calendar dates, may be negative)."""
    return F.datediff(F.to_date(_c(later)), F.to_date(_c(earlier)))


def weekday(col) -> Column:
    """Day of week, Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(_c(col))


def hour_of(col) -> Column:
    return F.hour(_c(col))


def epoch_seconds(col) -> Column:
    """Seconds since 1970-01-01 (zone-less timestamps are read as UTC)."""
    return F.unix_micros(_c(col).cast("timestamp")) / F.lit(1e6)


def hash_key(id_col, seed, purpose: str) -> Column:
    """Deterministic pseudo-random order key: md5 of ``'<id>:<seed>:<purpose>'``.

    Partition-independent (unlike ``rand``), and reproducible by any
    engine with md5, which is what makes split membership checkable. The
    purpose (test, dev, fold, ...) keeps draws with one seed independent.
    """
    return F.md5(F.concat(_c(id_col).cast("string"), F.lit(f":{seed}:{purpose}")))


def sms_status(days_col, sms_col, min_days: int = 3) -> Column:
    """Three-way SMS status: the reminder only applies for gaps >= 3 days."""
    return (F.when(_c(days_col) < min_days, F.lit("does_not_apply"))
             .when(_c(sms_col), F.lit("yes"))
             .otherwise(F.lit("no")))


def overflow_label(n_col, cap: int, overflow: str) -> Column:
    """``n`` as text, or ``overflow`` when ``n > cap``."""
    return F.when(_c(n_col) > cap, F.lit(overflow)).otherwise(_c(n_col).cast("string"))


def decade_band(age_col, top: int = 90) -> Column:
    """``10 * floor(age / 10)`` with everything from ``top`` up pooled."""
    band = (F.floor(_c(age_col) / 10) * 10).cast("int")
    return F.when(band >= top, F.lit(top)).otherwise(band)

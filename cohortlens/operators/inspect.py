"""Inspection: preview, per-column structure report, completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """First ``n`` rows by ``key`` (a distributed top-n, not a full sort)."""
    return df.orderBy(key).limit(n)


def profile_columns(df: DataFrame, distinct: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """Long structure report ``(column, type, n, n_null, n_distinct, min, max)``.

    All statistics come from ONE aggregate over the table, then the wide
    row is unpivoted with ``stack``. Exact distinct counts multiply the
    rows that are shuffled, so only the columns in ``distinct`` get them
    (``exact=False``: by HyperLogLog in fixed memory); others have NULL.
    """
    counted = F.countDistinct if exact else F.approx_count_distinct
    none = F.lit(None).cast("bigint")
    aggs, fields = [], df.schema.fields
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count(c).alias(f"nn{i}"), (F.max(none) if f.name not in distinct else counted(c)).alias(f"nd{i}"),
                 F.min(c).cast("string").alias(f"mn{i}"), F.max(c).cast("string").alias(f"mx{i}")]
    wide = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    parts = []
    for i, f in enumerate(fields):
        parts += [f"'{f.name}'", f"'{f.dataType.simpleString()}'",
                  f"n - nn{i}", f"nd{i}", f"mn{i}", f"mx{i}"]
    expr = (f"stack({len(fields)}, {', '.join(parts)}) "
            "as (column_name, data_type, n_null, n_distinct, min_value, max_value)")
    return wide.select("n", F.expr(expr)).select(
        "column_name", "data_type", "n", "n_null", "n_distinct", "min_value", "max_value")


def completeness_check(df: DataFrame) -> DataFrame:
    """Null count per column, plus a row ``*`` whose ``n_null`` is the
    number of rows with any null (``complete.cases``); ``complete`` tells
    whether the count is zero. One aggregate pass.
    """
    cols = df.columns
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(f"`{c}`").isNull()
    aggs = [F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"z{i}") for i, c in enumerate(cols)]
    aggs.append(F.sum(any_null.cast("long")).alias("zall"))
    wide = df.agg(*aggs)
    parts = [f"'{c}', coalesce(z{i}, 0L)" for i, c in enumerate(cols)] + ["'*', coalesce(zall, 0L)"]
    expr = f"stack({len(cols) + 1}, {', '.join(parts)}) as (column_name, n_null)"
    return wide.select(F.expr(expr)).select(
        "column_name", "n_null", (F.col("n_null") == 0).alias("complete"))

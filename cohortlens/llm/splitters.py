"""Sampled range splitters over a numeric key."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most ranges that are ever made: bounds the sample and every table of
#: one row per range that reaches the driver.
MAX_RANGES = 65_536

_LOW, _HIGH = float("-inf"), float("inf")


def uniform(*cols: Column | str) -> Column:
    """A number in [0, 1) that depends on the columns alone, so a task that
    runs again draws the same sample."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("splitters"), *cols), 11) / F.lit(float(1 << 53))


def sampled_splits(df: DataFrame, key: str, weight: str, row: list[str], parts: int, per_part: int = 64) -> list[float]:
    """``parts - 1`` boundaries at equal steps of summed ``weight`` along
    ``key`` (a double). A row is drawn with probability proportional to its
    weight, ``parts * per_part`` rows on average, so the sample that
    reaches the driver is bounded by the parameters. ``row`` names the
    columns that tell rows apart. Empty input: no boundary."""
    total = df.agg(F.sum(weight)).first()[0] or 0
    if not total or parts < 2:
        return []
    step = float(total) / (parts * per_part)
    drawn = df.filter(uniform(*row) < F.col(weight) / step).select(key, F.greatest(F.col(weight).cast("double"), F.lit(step)))
    points = sorted(map(tuple, drawn.collect()))
    share, seen, splits = sum(w for _, w in points) / parts, 0.0, []
    for k, w in points:
        if seen >= share * (len(splits) + 1) and (not splits or k > splits[-1]):
            splits.append(k)
        seen += w
    return splits


def with_range(df: DataFrame, key: str, splits: list[float], name: str) -> DataFrame:
    """Add the number of the range ``[split, next split)`` of ``key``, found
    by binary search."""
    inner = sorted({s for s in splits if _LOW < s < _HIGH})
    if not inner:
        return df.withColumn(name, F.lit(0))
    cut = Bucketizer(splits=[_LOW, *inner, _HIGH], inputCol=key, outputCol=name, handleInvalid="error")
    return cut.transform(df).withColumn(name, F.col(name).cast("int"))



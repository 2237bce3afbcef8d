"""Encoders fitted on one frame and applied to others.

* target encoder: per key, ``rate - base rate`` for keys with more than
  ``threshold`` rows (strict), unseen keys -> 0;
* count encoder: rows per key (one or two key columns), unseen -> 0.0;
* out-of-fold target encoder: every fold's encoding from the rows of
  the other folds, for all folds in one aggregate pass.

Fitted tables are small aggregates (one row per key). They are joined
with a plain ``join``: AQE measures the materialised table at run time
and broadcasts it only when it is below the broadcast threshold,
otherwise it stays a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import as_flag
from cohortlens.operators import roles as R


def fit_target_encoder(df: DataFrame, key: str | Sequence[str], threshold: int,
                       name: str, label: str = R.LABEL,
                       base: DataFrame | None = None) -> DataFrame:
    """``(key..., name)``: group rate minus the base rate, only for keys
    with ``count > threshold``. One aggregate with a HAVING, no per-row
    window; the base rate is summed from the same group table."""
    keys = [key] if isinstance(key, str) else list(key)
    stats = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.sum(as_flag(label)).alias("__p"),
                                  F.count(label).alias("__m"))
    if base is None:
        base = stats.agg((F.sum("__p") / F.sum("__m")).alias("base_rate"))
    rates = stats.filter(F.col("__n") > threshold)
    return rates.select(*keys, (F.col("__p") / F.col("__m") - base.select(base.columns[0]).scalar()).alias(name))


def fit_count_encoder(df: DataFrame, keys: str | Sequence[str], name: str) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def natural_keys(a: DataFrame, b: DataFrame) -> list[str]:
    keys = [c for c in a.columns if c in b.columns]
    if not keys:
        raise ValueError("natural join: the frames share no column")
    return keys


def natural_left_join(a: DataFrame, b: DataFrame, null_safe: bool = True) -> DataFrame:
    """Left join on every column name the frames share (``left_join(a, b)``
    without ``by``). NULL keys match each other, as in dplyr, unless
    ``null_safe=False``."""
    keys = natural_keys(a, b)
    if not null_safe:
        return a.join(b, keys, "left")
    bb = b.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                  *[c for c in b.columns if c not in keys])
    cond = [a[k].eqNullSafe(bb[f"__k_{k}"]) for k in keys]
    return a.join(bb, cond, "left").drop(*[f"__k_{k}" for k in keys])


def apply_encoder(df: DataFrame, enc: DataFrame, fill=0.0, as_double: bool = True,
                  null_safe: bool = False) -> DataFrame:
    """Natural left join of a fitted table, unseen keys -> ``fill``."""
    vals = [c for c in enc.columns if c not in df.columns]
    out = natural_left_join(df, enc, null_safe=null_safe)
    for v in vals:
        col = F.col(v).cast("double") if as_double else F.col(v)
        out = out.withColumn(v, F.coalesce(col, F.lit(fill)))
    return out


def oof_target_encode(df: DataFrame, key: str, threshold: int, name: str,
                      fold: str = "fold", label: str = R.LABEL) -> DataFrame:
    """Out-of-fold target encoding: a row of fold f gets the encoding fitted
    on all rows NOT in fold f (rate minus that training part's base rate,
    keys with more than ``threshold`` training rows, otherwise 0).

    One aggregate to (key, fold) sums; the totals minus the fold's own
    sums give every fold's training statistics at once, instead of k
    refits over the data.
    """
    kf = df.groupBy(key, fold).agg(F.count(F.lit(1)).alias("__n"),
                                   F.sum(as_flag(label)).alias("__p"))
    kt = kf.groupBy(key).agg(F.sum("__n").alias("__nk"), F.sum("__p").alias("__pk"))
    ff = kf.groupBy(fold).agg(F.sum("__n").alias("__fn"), F.sum("__p").alias("__fp"))
    tot = ff.agg(F.sum("__fn").alias("__L"), F.sum("__fp").alias("__PL"))
    t = tot.select(F.struct("__L", "__PL").alias("t")).scalar()
    fold_base = ff.select(
        fold, ((t.getField("__PL") - F.col("__fp"))
               / (t.getField("__L") - F.col("__fn"))).alias("__b"))
    n_out = F.col("__nk") - F.col("__n")
    enc = (kf.join(kt, key).join(F.broadcast(fold_base), fold)
             .filter(n_out > threshold)
             .select(key, fold, ((F.col("__pk") - F.col("__p")) / n_out - F.col("__b")).alias(name)))
    return df.join(enc, [key, fold], "left").withColumn(name, F.coalesce(F.col(name), F.lit(0.0)))

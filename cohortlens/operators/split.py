"""Reproducible splitting: stratified holdouts, k folds, balanced samples.

Randomness is an md5 order key of ``'<id>:<seed>:<purpose>'`` (see
``functions.hash_key``): independent of partitioning and of task retries,
so a lost executor recomputes exactly the same membership, and independent
between the test cut, the dev cut, the folds and the samples.
Exact sizes come from the keys at the cut ranks (``ordering.rank_cuts``):
a row's membership is a comparison of its own key with them, so rows are
neither joined, sorted nor copied.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import hash_key
from cohortlens.operators import roles as R
from cohortlens.operators.ordering import order_statistics, rank_cuts
from cohortlens.session import dealt, materialize

QUARTILES = (0.25, 0.5, 0.75)


def quantile_strata(rows: DataFrame, y: str = R.ROW_ID, probs=QUARTILES) -> Column:
    """Stratum of a row by the quantiles that numeric ``y`` has in ``rows``:
    intervals ``[q0, q1], (q1, q2], ...`` of the type-7 (linearly
    interpolated) quantiles, as ``cut(y, unique(quantile(y, probs)),
    include.lowest=TRUE)``.

    For a data value, ``y <= q_p`` holds exactly when ``y`` is at most the
    order statistic at 0-based rank ``floor((n - 1) p)``, which
    ``ordering.order_statistics`` finds by counting."""
    _, cuts = order_statistics(rows, y, [lambda n, p=p: math.floor((n - 1) * p) + 1 for p in probs])
    stratum = F.lit(len(probs))
    for i in reversed(range(len(probs))):
        stratum = F.when(F.col(y) <= F.lit(cuts[i]), F.lit(i)).otherwise(stratum)
    return stratum


def _at_most(key: Column, id_col: str, cut: tuple | None) -> Column:
    """(key, id) is at or before the cut in order."""
    if cut is None:
        return F.lit(False)
    return (key < F.lit(cut[0])) | ((key == F.lit(cut[0])) & (F.col(id_col) <= F.lit(cut[1])))


def _at_most_in(key: Column, id_col: str, part: str, cuts: dict) -> Column:
    """The same with the first cut of the row's partition value."""
    inside = F.lit(False)
    for value, (_, at) in cuts.items():
        inside = F.when(F.col(part).eqNullSafe(F.lit(value)), _at_most(key, id_col, at[0])).otherwise(inside)
    return inside


def _holdout_rule(rows: DataFrame, p: float, seed: int, y: str, id_col: str, purpose: str) -> tuple[Column, Column]:
    """Stratum and flag of a row, by the ids and ``y`` of ``rows``."""
    stratum, key = quantile_strata(rows, y), hash_key(id_col, seed, purpose)
    cuts = rank_cuts(rows.withColumn("stratum", stratum), key, id_col, [lambda n: F.ceil(n * F.lit(float(p)))], "stratum")
    inside = F.lit(False)
    for value, (_, at) in cuts.items():
        inside = F.when(stratum == value, _at_most(key, id_col, at[0])).otherwise(inside)
    return stratum, inside


def holdout_split(df: DataFrame, p: float = 0.1, seed: int = 1, y: str = R.ROW_ID,
                  id_col: str = R.ROW_ID, out: str = "in_holdout", purpose: str = "test") -> DataFrame:
    """Stratified holdout flag: per quartile stratum of ``y``,
    ``ceil(p * n_stratum)`` rows in md5 order are flagged.

    Returns ``df`` plus ``stratum`` and the boolean ``out``: a projection.
    The quartiles and the cut keys come from one narrow copy of the ids, so
    ``df`` is read twice: for the copy, and for the result."""
    rows = materialize(df.select(*dict.fromkeys((id_col, y))))
    stratum, inside = _holdout_rule(rows, p, seed, y, id_col, purpose)
    return df.withColumns({"stratum": stratum, out: inside})


def three_way_split(df: DataFrame, p_test: float = 0.1, p_dev: float = 0.1, seed: int = 1,
                    y: str = R.ROW_ID, id_col: str = R.ROW_ID) -> DataFrame:
    """``split`` in {test, dev, train}: a stratified test holdout, then a
    stratified dev holdout of the remaining rows with a key of its own.
    Both rules come from one narrow copy of the ids, over all cores."""
    rows = dealt(materialize(df.select(*dict.fromkeys((id_col, y)))))
    _, test = _holdout_rule(rows, p_test, seed, y, id_col, "test")
    _, dev = _holdout_rule(rows.filter(~test), p_dev, seed, y, id_col, "dev")
    return df.withColumn("split", F.when(test, "test").when(dev, "dev").otherwise("train"))


def kfold_assign(df: DataFrame, folds: int = 10, seed: int = 1, id_col: str = R.ROW_ID,
                 out: str = "fold") -> DataFrame:
    """Fold 1..``folds`` of each row: a random permutation (md5 order) cut
    into ``folds`` consecutive slices, ``floor((rn - 1) * folds / L) + 1``.
    Slice sizes differ by at most one and every row gets a fold."""
    key = hash_key(id_col, seed, "fold")
    # The last rank of fold f is ceil(f * L / folds).
    ends = [lambda n, f=f: F.ceil(F.lit(f) * n / F.lit(folds)) for f in range(1, folds)]
    _, cuts = rank_cuts(df.select(id_col), key, id_col, ends).get(0, (0, [None] * folds))
    fold = F.lit(folds)
    for f in reversed(range(1, folds)):
        fold = F.when(_at_most(key, id_col, cuts[f - 1]), F.lit(f)).otherwise(fold)
    return df.withColumn(out, fold.cast("int"))


def balanced_flag(df: DataFrame, n_per_class: int = 500, label: str = R.LABEL,
                  seed: int = 1, id_col: str = R.ROW_ID) -> Column:
    """Whether a row of ``df`` is in its class-balanced sample."""
    key = hash_key(id_col, seed, "balance")
    cuts = rank_cuts(df.select(*dict.fromkeys((id_col, label))), key, id_col,
                     [lambda n: F.least(n, F.lit(n_per_class))], label)
    return _at_most_in(key, id_col, label, cuts)


def balanced_sample(df: DataFrame, n_per_class: int = 500, label: str = R.LABEL,
                    seed: int = 1, id_col: str = R.ROW_ID) -> DataFrame:
    """Exactly ``n_per_class`` rows of each label value (all of a class
    that has fewer), chosen in md5 order: the equal down-sampling used
    for a class-balanced forest. The sample size is the feature."""
    return df.filter(balanced_flag(df, n_per_class, label, seed, id_col))


def holdout_complement(df: DataFrame, holdout: DataFrame, key: str = R.ROW_ID) -> DataFrame:
    """Rows of ``df`` whose key is not in ``holdout`` (``df[-idx, ]``) as a
    left anti join: used when the split lives in another table."""
    return df.join(holdout.select(key), key, "left_anti")


def recombine(*frames: DataFrame) -> DataFrame:
    """Append frames by column name (bag semantics, ``bind_rows``)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out

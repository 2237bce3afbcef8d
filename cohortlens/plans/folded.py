"""Encoders that leave a fold out.

``fit_folds`` counts rows and positives once, by key and fold: one scan and
one shuffle (grouping sets over all encoder keys). What a fold leaves out is
its own sums, so the statistics of "all folds but f" are totals minus f's, for
every f and every threshold at once; nothing is fitted again.

``FoldedPlan.transform(df, held_out)`` encodes every row with the statistics
of all folds but ``held_out``:

* a literal fold number: the training and validation rows of that fold of a
  cross-validation;
* the row's own fold (the default): out-of-fold encoding of training rows,
  whose label then never enters its own encoding; rows without a fold (new
  rows) get the statistics of all folds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import as_flag
from cohortlens.operators import roles as R
from cohortlens.operators.encode import natural_left_join
from cohortlens.plans.features import FittedPlan
from cohortlens.session import materialize

_SUMS = ("n", "p", "m")


def fold_sums(df: DataFrame, keys: Sequence[Sequence[str]], fold: str = "fold", label: str = R.LABEL) -> list[DataFrame]:
    """For each of ``keys`` (a list of columns, none for the base) a table
    with one row per key: rows ``n``, positives ``p`` and labelled rows
    ``m``, and ``by_fold``, a map from fold to the same three (as many
    entries as the key has folds)."""
    columns = list(dict.fromkeys(c for k in keys for c in k))
    flags = [f"__in_{i}" for i in range(len(columns))]
    sums = (F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(as_flag(label)), F.lit(0)).alias("p"), F.count(label).alias("m"))
    cells = df.groupingSets([[*k, fold] for k in keys], *columns, fold).agg(
        *sums, *[F.grouping(c).alias(f) for c, f in zip(columns, flags, strict=True)])
    cells = materialize(cells)
    out = []
    for k in keys:
        own = cells
        for c, f in zip(columns, flags, strict=True):
            own = own.filter(F.col(f) == (0 if c in k else 1))
        out.append(own.groupBy(*k).agg(
            *[F.sum(s).alias(s) for s in _SUMS],
            F.map_from_entries(F.collect_list(F.struct(fold, F.struct(*_SUMS)))).alias("by_fold")))
    return out


def _without(total: Column, by_fold: Column, held_out: Column) -> Column:
    """Sums of all folds but ``held_out`` (null: of all)."""
    own = F.try_element_at(by_fold, held_out)
    return F.struct(*[(total[s] - F.coalesce(own[s], F.lit(0))).alias(s) for s in _SUMS])


@dataclass
class FoldedPlan:
    """Fitted tables by key. ``group`` and ``entity`` are null where their
    bias is not wanted; ``thresholds`` names each bias column with the rows
    that a key must exceed: ``{"bias_per_nbh": 50}``."""
    base: DataFrame
    group: DataFrame | None
    entity: DataFrame | None
    counts: dict[str, DataFrame]
    group_bias: dict[str, int]
    entity_bias: dict[str, int]
    fold: str = "fold"
    plain: FittedPlan = None

    def transform(self, df: DataFrame, held_out: int | Column | None = None) -> DataFrame:
        if held_out is None:
            held_out = F.col(self.fold) if self.fold in df.columns else F.lit(None)
        held = (F.lit(held_out) if isinstance(held_out, int) else held_out).cast("int")
        all_rows = self.base.select(F.struct(F.struct(*_SUMS).alias("t"), "by_fold").alias("s")).scalar()
        base = _without(all_rows["t"], all_rows["by_fold"], held)
        out = self.plain.before(df)
        for table, biases in ((self.group, self.group_bias), (self.entity, self.entity_bias)):
            if table is not None:
                out = self._joined(out, table, held)
                own = F.col("__own")
                for name, threshold in biases.items():
                    bias = F.when(own["n"] > threshold, own["p"] / own["m"] - base["p"] / base["m"])
                    out = out.withColumn(name, F.coalesce(bias, F.lit(0.0)))
                out = out.drop("__own")
        for name, table in self.counts.items():
            out = self._joined(out, table, held).withColumn(name, F.coalesce(F.col("__own")["n"].cast("double"), F.lit(0.0))).drop("__own")
        return self.plain.after(out)

    def transform_each(self, df: DataFrame, folds: Sequence[int]) -> DataFrame:
        """``transform`` for several left-out folds at once, from one join:
        every encoder's column is an array with an entry for each of them."""
        each = lambda total, by_fold: F.array(*[_without(total, by_fold, F.lit(k).cast("int")) for k in folds])
        all_rows = self.base.select(F.struct(F.struct(*_SUMS).alias("t"), "by_fold").alias("s")).scalar()
        out = self.plain.before(df).withColumn("__base", each(all_rows["t"], all_rows["by_fold"]))
        tables = [(self.group, self.group_bias), (self.entity, self.entity_bias), *[(t, {c: None}) for c, t in self.counts.items()]]
        for table, columns in tables:
            if table is not None:
                out = natural_left_join(out, self._packed(table), null_safe=False).withColumn("__own", each(F.col("__t"), F.col("__f"))).drop("__t", "__f")
                for name, threshold in columns.items():
                    bias = lambda own, base: F.when(own["n"] > threshold, own["p"] / own["m"] - base["p"] / base["m"])  # noqa: B023, E731
                    value = (lambda own, base: own["n"].cast("double")) if threshold is None else bias
                    out = out.withColumn(name, F.transform(F.zip_with("__own", "__base", value), lambda x: F.coalesce(x, F.lit(0.0))))
                out = out.drop("__own")
        return self.plain.after(out.drop("__base"))

    @staticmethod
    def _packed(table: DataFrame) -> DataFrame:
        return table.withColumns({"__t": F.struct(*_SUMS), "__f": F.col("by_fold")}).drop(*_SUMS, "by_fold")

    @staticmethod
    def _joined(df: DataFrame, table: DataFrame, held: Column) -> DataFrame:
        out = natural_left_join(df, FoldedPlan._packed(table), null_safe=False)
        return out.withColumn("__own", _without(F.col("__t"), F.col("__f"), held)).drop("__t", "__f")


def fit_folds(df: DataFrame, lambda_nbh: int | Sequence[int] | None = 50, lambda_patient: int | None = None,
              counts: bool = True, date_parts: bool = True, sms_three_way: bool = False, drop_entity: bool = False,
              label: str = R.LABEL, fold: str = "fold") -> FoldedPlan:
    """Fit the encoders of ``FeaturePlan`` for every fold of ``df``. Several
    ``lambda_nbh`` give several columns, ``bias_per_nbh_<lambda>``."""
    lambdas = {"bias_per_nbh": lambda_nbh} if isinstance(lambda_nbh, int) else {f"bias_per_nbh_{x}": x for x in lambda_nbh or ()}
    keys: dict[str, list[str]] = {"base": []}
    if lambdas:
        keys["group"] = [R.GROUP]
    if lambda_patient is not None:
        keys["entity"] = [R.ENTITY]
    if counts:
        keys |= {"nbr_app_per_patient": [R.ENTITY], "nbr_app_that_day": [R.ENTITY, R.DAY]}
    distinct = {tuple(k): None for k in keys.values()}
    tables = dict(zip(distinct, fold_sums(df, list(distinct), fold, label), strict=True))
    of = {name: tables[tuple(k)] for name, k in keys.items()}
    drop = (R.GROUP, *([R.ENTITY] if drop_entity else []))
    plain = FittedPlan(None, None, None, drop, sms_three_way, date_parts)
    return FoldedPlan(of["base"], of.get("group"), of.get("entity"),
                      {c: of[c] for c in ("nbr_app_per_patient", "nbr_app_that_day") if c in of},
                      lambdas, {} if lambda_patient is None else {"bias_per_patient": lambda_patient}, fold, plain)

"""Parameter tuning over folds, and the final refit.

The grid is small (a few parameter rows); the driver loops over it,
and every fit inside is a distributed Spark ML job. Encoders are hoisted
out of the loops: all folds and lambdas from one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import forest
from cohortlens.operators import roles as R
from cohortlens.operators.metrics import confusion_at_cutoffs, roc_auc
from cohortlens.operators.models import bag_weights, fit_rf, numeric_view, poisson1_weight
from cohortlens.operators.split import kfold_assign
from cohortlens.plans.features import FeaturePlan, design_columns
from cohortlens.plans.folded import fit_folds
from cohortlens.session import fits_at_once, materialize, spread, wanted_partitions


def param_grid(tune_mtry: Sequence[int] = (2, 4, 6),
               lambda_nbh: Sequence[int] = (50, 100, 300)) -> list[dict]:
    """All combinations, the first parameter varying fastest."""
    return [{"tune_mtry": m, "lambda_nbh": lam} for lam, m in product(lambda_nbh, tune_mtry)]


_TUNED = "tune_mtry int, lambda_nbh int, k int, auc_roc double"


def _auc(scored: DataFrame) -> float | None:
    row = roc_auc(scored, "prob", "label").first()
    return None if row is None else row["auc"]


def tune_grid(spark: SparkSession, df: DataFrame, grid: list[dict] | None = None,
              folds: int = 10, seed: int = 1, num_trees: int = 500,
              max_depth: int = 10, parallel_fits: int = 8, metric=None) -> DataFrame:
    """``(tune_mtry, lambda_nbh, k, auc_roc)`` for each grid row and each of
    the ``folds`` folds, which cover all rows. ``metric`` maps the scored
    validation rows (``prob``, ``label``) to a number, by default the AUC.

    The encoders of all folds and lambdas come from one aggregate
    (``fit_folds``); a fold's frame holds a bias column for each lambda.
    Fits are independent and are submitted together from ``parallel_fits``
    driver threads at most, so the cluster runs several forests at once (each
    fit is itself distributed; seeds are fixed, so results do not depend on
    the interleaving). While the last forests of a fold are scored, the next
    fold's begin; no more than two folds' frames are kept.

    Where rows x trees of all fits exceed ``JOINT_WORK``, all forests are grown
    and scored together (``operators.forest``): rows are then prepared once,
    and passed over once a level, instead of once for each fit."""
    grid = grid or param_grid()
    lambdas = sorted({g["lambda_nbh"] for g in grid})
    data = kfold_assign(df, folds, seed)
    if df.count() * num_trees * len(grid) * folds > forest.JOINT_WORK and "string" not in dict(data.drop(R.GROUP).dtypes).values():
        return spark.createDataFrame(_tune_together(data, grid, folds, seed, num_trees, max_depth, metric), _TUNED)
    data = spread(data)
    size = data.count()
    parts = wanted_partitions(spark, size)
    plan = fit_folds(data, lambda_nbh=lambdas)

    def fold(k: int) -> list[tuple]:
        frame = plan.transform(data, k)
        # The joins' shuffles are merged to few partitions otherwise.
        frame = (frame.repartition(parts) if parts > 1 else frame).persist(StorageLevel.MEMORY_AND_DISK)

        def one(g: dict) -> tuple:
            lam = g["lambda_nbh"]
            own = frame.withColumnRenamed(f"bias_per_nbh_{lam}", "bias_per_nbh").drop(*[f"bias_per_nbh_{x}" for x in lambdas])
            tr, va = (own.filter(side).drop("fold") for side in (F.col("fold") != k, F.col("fold") == k))
            model = fit_rf(tr, design_columns(tr), num_trees=num_trees, max_depth=max_depth,
                           mtry=g["tune_mtry"], seed=seed)
            return (g["tune_mtry"], lam, k, (metric or _auc)(model.score(va)))

        done = list(fits.map(one, grid))
        frame.unpersist()
        return done

    at_once = min(max(1, parallel_fits), fits_at_once(size))
    with ThreadPoolExecutor(max_workers=at_once) as fits, ThreadPoolExecutor(max_workers=2) as pool:
        rows = [r for part in pool.map(fold, range(1, folds + 1)) for r in part]
    return spark.createDataFrame(rows, _TUNED)


def _tune_together(data: DataFrame, grid: list[dict], folds: int, seed: int, num_trees: int, max_depth: int, metric) -> list[tuple]:
    """The rows of ``tune_grid``: one join encodes the rows for all folds,
    and their forests grow together. A tree's bag is the same in all forests."""
    bags = bag_weights([poisson1_weight(R.ROW_ID, seed * 1000 + t) for t in range(num_trees)])
    data = spread(data.withColumn("__bags", bags))
    size, numbers = data.count(), list(range(1, folds + 1))
    lambdas = sorted({g["lambda_nbh"] for g in grid})
    plan = fit_folds(data, lambda_nbh=lambdas)
    frame = plan.transform_each(data, numbers)
    frame = frame.repartition(forest.partitions(data.sparkSession, size)).persist(StorageLevel.MEMORY_AND_DISK)
    columns = design_columns(frame.drop("fold", "__bags"))
    by_fold = [c for c in columns if dict(frame.dtypes)[c].startswith("array")]
    plain = [c for c in columns if c not in by_fold]
    rows, _ = numeric_view(frame, plain)
    vec = F.concat(F.array(*plain), *by_fold)
    X, fold = forest.sampled(rows, vec, R.ROW_ID, size, seed)
    # Bins of a fold's training rows, by fold and column.
    place = {c: i if c in plain else len(plain) + by_fold.index(c) * folds for i, c in enumerate(plain + by_fold)}
    bins = [(at, forest.thresholds(X[fold != k, at])) for k in numbers for at in (place[c] + (k - 1 if c in by_fold else 0) for c in columns)]
    blocks = forest.pack(rows, vec, "label", bins, "__bags")
    frame.unpersist()
    other = {x: {f"bias_per_nbh_{y}" for y in lambdas if y != x} for x in lambdas}
    fits = [(g, k) for k in numbers for g in grid]
    specs = [forest.Spec([(k - 1) * len(columns) + i for i, c in enumerate(columns) if c not in other[g["lambda_nbh"]]],
                         g["tune_mtry"], range(num_trees), k, seed) for g, k in fits]
    scored = forest.score(blocks, forest.grow(blocks, specs, max_depth))
    if metric:
        scored = materialize(scored)
        found = {i: metric(scored.filter(F.col("forest") == i).drop("forest")) for i in range(len(fits))}
    else:
        found = {r["forest"]: r["auc"] for r in roc_auc(scored, "prob", "label", ["forest"]).collect()}  # a row a fit
    return [(g["tune_mtry"], g["lambda_nbh"], k, found.get(i)) for i, (g, k) in enumerate(fits)]


def summarise_grid(results: DataFrame) -> DataFrame:
    return results.groupBy("tune_mtry", "lambda_nbh").agg(F.avg("auc_roc").alias("auc_roc"))


def best_params(summary: DataFrame) -> DataFrame:
    """The best grid row (ties: smaller mtry, then smaller lambda)."""
    return summary.orderBy(F.col("auc_roc").desc(), "tune_mtry", "lambda_nbh").limit(1)


def final_model(train: DataFrame, test: DataFrame, lambda_nbh: int = 50, tune_mtry: int = 4,
                num_trees: int = 500, max_depth: int = 10, seed: int = 1,
                cutoffs: Sequence[float] = (0.32, 0.55)) -> DataFrame:
    """Refit encoders and forest on all training rows, score the untouched
    test rows once: confusion statistics per cut-off plus the test AUC."""
    fitted = FeaturePlan(lambda_nbh=lambda_nbh).fit(train)
    tr = spread(fitted.transform(train))
    te = fitted.transform(test)
    model = fit_rf(tr, design_columns(tr), num_trees=num_trees, max_depth=max_depth,
                   mtry=tune_mtry, seed=seed)
    scored = spread(model.score(te).select("prob", "label"))
    auc = roc_auc(scored, "prob", "label")
    return confusion_at_cutoffs(scored, "prob", "label", cutoffs).withColumn("auc", auc.scalar())

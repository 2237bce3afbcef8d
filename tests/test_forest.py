"""Forests that grow together."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import forest as FO
from cohortlens.operators import models as MOD
from cohortlens.operators.metrics import roc_auc
from cohortlens.operators.split import kfold_assign
from cohortlens.plans import sweep, tune
from cohortlens.plans.catalog import train_dev
from cohortlens.plans.folded import fit_folds
from tests.conftest import SF001


def _blocks(spark, X, y, weights, fold, parts=3):
    rows = [(i, [float(v) for v in x], float(y[i]), [int(w) for w in weights[:, i]], int(fold[i])) for i, x in enumerate(X)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label double, bags array<tinyint>, fold int").repartition(parts)
    sample, folds = FO.sampled(df, F.col("v"), "id", len(X))
    assert len(sample) == len(folds) == len(X)
    bins = [(c, FO.thresholds(X[:, c])) for c in range(X.shape[1])]
    return FO.pack(df, F.col("v"), "label", bins, "bags"), np.stack([np.searchsorted(b, X[:, c]) for c, b in bins])


def _gini(y, w):
    n, p = w.sum(), (w * y).sum()
    return 2 * p * (n - p) / max(n, 1)


def test_trees_equal_brute_force(spark):
    """All predictors tried at every node: the largest gain on the bag's
    rows outside the fold, leaves with the class shares of their rows."""
    rng = np.random.default_rng(1)
    X = np.stack([rng.normal(0, 1, 700), rng.integers(0, 5, 700), rng.normal(0, 1, 700)], axis=1)
    y = (rng.random(700) < 0.2 + 0.5 * (X[:, 0] > 0.3) * (X[:, 1] > 1)).astype(int)
    weights, fold = rng.poisson(1, (2, 700)), rng.integers(1, 4, 700)
    blocks, codes = _blocks(spark, X, y, weights, fold)
    forests = FO.grow(blocks, [FO.Spec([0, 1, 2], 3, [0, 1], k) for k in (1, 2)], 3)
    assert [len(f) for f in forests] == [2, 2]
    for tree in (t for f in forests for t in f):
        w = np.where(fold == tree.fold, 0, weights[tree.bag])
        nodes, open_ = {0: np.arange(700)}, 0
        for at, share in zip(tree.levels, tree.shares, strict=True):
            after = {}
            for node, rows in nodes.items():
                gains = [_gini(y[rows], w[rows]) - sum(_gini(y[rows[s]], w[rows[s]]) for s in (codes[c, rows] <= b, codes[c, rows] > b))
                         for c in range(3) for b in range(codes[c].max())]
                right = codes[at.feature[node], rows] > at.cut[node]
                got = _gini(y[rows], w[rows]) - sum(_gini(y[rows[s]], w[rows[s]]) for s in (right, ~right))
                assert got == pytest.approx(max(gains))
                for side in (0, 1):
                    own = rows[right == side]
                    assert share[2 * node + side] == pytest.approx((w[own] * y[own]).sum() / max(1, w[own].sum()))
                    if at.to[2 * node + side] >= 0:
                        after[int(at.to[2 * node + side])] = own
            nodes, open_ = after, open_ + len(after)
        assert open_ > 2 and not nodes
    scored = FO.score(blocks, forests).collect()
    assert [sum(r.forest == i for r in scored) for i in (0, 1)] == [(fold == k).sum() for k in (1, 2)]
    out = FO.score(blocks, forests, out_of_bag=True).collect()
    assert sum(r.forest == 0 for r in out) == ((fold != 1) & (weights == 0).any(axis=0)).sum()


def test_a_node_without_a_gain_is_a_leaf_and_bad_rows_are_refused(spark):
    X, y = np.ones((40, 2)), np.arange(40) % 4 == 0
    blocks, _ = _blocks(spark, X, y, np.ones((1, 40)), np.arange(40) % 2)
    forest, = FO.grow(blocks, [FO.Spec([0, 1], 1, [0], 1)], 4)
    assert len(forest[0].levels) == 1
    assert {r.prob for r in FO.score(blocks, [forest]).collect()} == {0.5}
    with pytest.raises(Exception, match="neither 0 nor 1"):
        _blocks(spark, X, np.full(40, 2), np.ones((1, 40)), np.ones(40))
    with pytest.raises(ValueError, match="null or no number"):
        _blocks(spark, np.full((40, 1), np.nan), y, np.ones((1, 40)), np.ones(40))


def test_draws_and_results_do_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(0, 1, (500, 6))
    y, weights, fold = (X[:, 0] + rng.normal(0, 1, 500) > 0).astype(int), rng.poisson(1, (3, 500)), rng.integers(1, 3, 500)
    got = []
    for parts in (1, 4):
        blocks, _ = _blocks(spark, X, y, weights, fold, parts)
        forests = FO.grow(blocks, [FO.Spec(range(6), 2, range(3), 1, seed=5)], 4)
        got.append(sorted((r.label, round(r.prob, 12)) for r in FO.score(blocks, forests).collect()))
        tried = {int(f) for t in forests[0] for at in t.levels for f in at.feature}
    assert got[0] == got[1] and len(tried) >= 4
    assert len({t.levels[0].feature[0] for t in forests[0]} | {t.levels[0].cut[0] for t in forests[0]}) > 2


def test_like_a_forest_of_spark(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(0, 1, (3000, 4))
    y = (X[:, 0] * X[:, 1] + rng.normal(0, 0.7, 3000) > 0).astype(int)
    fold = np.where(np.arange(3000) < 2000, 2, 1)
    blocks, _ = _blocks(spark, X, y, rng.poisson(1, (20, 3000)), fold)
    own = roc_auc(FO.score(blocks, FO.grow(blocks, [FO.Spec(range(4), 2, range(20), 1)], 6)), "prob", "label").first()["auc"]
    rows = [(i, *[float(v) for v in x], bool(y[i]), int(fold[i])) for i, x in enumerate(X)]
    df = spark.createDataFrame(rows, "appointment_id long, a double, b double, c double, d double, no_show boolean, fold int")
    model = MOD.fit_rf(df.filter("fold = 2"), list("abcd"), num_trees=20, max_depth=6, mtry=2)
    theirs = roc_auc(model.score(df.filter("fold = 1")), "prob", "label").first()["auc"]
    assert theirs > 0.75 and abs(own - theirs) < 0.03


def test_one_join_encodes_for_all_folds(spark):
    data = kfold_assign(train_dev(spark, SF001)[0], 3, 1).cache()
    plan = fit_folds(data, lambda_nbh=(2, 5), lambda_patient=1)
    names = ["bias_per_nbh_2", "bias_per_nbh_5", "bias_per_patient", "nbr_app_per_patient", "nbr_app_that_day"]
    both = {r.appointment_id: r for r in plan.transform_each(data, [1, 3]).collect()}
    for i, k in enumerate((1, 3)):
        for r in plan.transform(data, k).collect():
            assert [both[r.appointment_id][c][i] for c in names] == pytest.approx([r[c] for c in names])
            assert [both[r.appointment_id][c] for c in ("wday_app", "patient_id", "no_show")] == [r[c] for c in ("wday_app", "patient_id", "no_show")]


def test_tuning_grows_all_forests_together(spark, monkeypatch):
    monkeypatch.setattr(FO, "JOINT_WORK", 0)
    monkeypatch.setattr(tune, "fit_rf", None)  # no fit of its own
    train, _ = train_dev(spark, SF001)
    grid = [{"tune_mtry": m, "lambda_nbh": x} for x in (2, 50) for m in (2, 4)]
    sizes = []
    for metric in (None, lambda s: sizes.append(s.count()) or roc_auc(s, "prob", "label").first()["auc"]):
        rows = tune.tune_grid(spark, train, grid, folds=3, num_trees=4, max_depth=3, metric=metric).collect()
        assert {(r.tune_mtry, r.lambda_nbh, r.k) for r in rows} == {(m, x, k) for m in (2, 4) for x in (2, 50) for k in (1, 2, 3)}
        assert len(rows) == 12 and all(0.3 <= r.auc_roc <= 0.9 for r in rows)
    assert sum(sizes) == 4 * train.count()  # every row is scored once for each of the grid


def test_the_sweep_grows_all_forests_together(spark, monkeypatch):
    monkeypatch.setattr(FO, "JOINT_WORK", 0)
    monkeypatch.setattr(sweep, "rf_estimator", None)
    train, dev = train_dev(spark, SF001)
    rows = sweep.model_sweep(spark, train, dev, ["GLM", "RF2", "RF10"], num_trees=8, n_bags=4, max_depth=3, n_per_class=100).collect()
    assert [r.variant for r in rows] == ["GLM", "RF2", "RF10"] and [r.n_predictors for r in rows] == [11, 10, 18]
    assert rows[0].oob_auc is None and all(0 <= r.oob_auc <= 1 for r in rows[1:]) and all(0 <= r.dev_auc <= 1 for r in rows)

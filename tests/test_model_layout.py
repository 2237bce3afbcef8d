"""How rows are laid out for model fits."""

from pyspark.sql import functions as F

from cohortlens import session
from cohortlens.operators import models as MOD
from cohortlens.plans import tune


def _rows(spark, n):
    return spark.range(0, n, 1, 1).select(
        F.col("id").alias("appointment_id"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 3 == 0).alias("no_show"))


def test_rows_in_one_partition_are_spread_over_the_cores(spark):
    big, small = session.spread(_rows(spark, 5 * session._ROWS_LEAST)), session.spread(_rows(spark, 100))
    assert big.rdd.getNumPartitions() == min(5, 2 * spark.sparkContext.defaultParallelism)
    assert small.rdd.getNumPartitions() == 1 and big.count() == 5 * session._ROWS_LEAST


def test_a_bag_weight_takes_one_md5_a_row(spark):
    df = _rows(spark, 2000).select(MOD.poisson1_weight("appointment_id", 1).alias("w"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    counts = {r.w: r["count"] for r in df.groupBy("w").count().collect()}
    assert 650 < counts[0.0] < 820 and 650 < counts[1.0] < 820 and set(counts) <= set(map(float, range(11)))


def test_out_of_bag_fits_read_written_weights(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(MOD, "spread", lambda df: plans.append(df.columns) or session.spread(df))
    out = MOD.oob_scores(_rows(spark, 300), ["x"], n_bags=3, num_trees=6, max_depth=2)
    assert plans == [["appointment_id", "label", "features", "__bags"]] and out.count() == 300
    assert out._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 0


def test_tuning_deals_a_fold_over_the_cores(spark, monkeypatch):
    """A fold's frame would else have the few partitions of its joins."""
    from cohortlens.plans.catalog import train_dev
    from tests.conftest import SF001
    seen = []
    monkeypatch.setattr(tune, "wanted_partitions", lambda spark, rows: 5)
    monkeypatch.setattr(tune, "fit_rf", lambda df, *a, **kw: seen.append(df.rdd.getNumPartitions()) or MOD.fit_rf(df, *a, **kw))
    grid = [{"tune_mtry": 2, "lambda_nbh": 50}, {"tune_mtry": 4, "lambda_nbh": 50}]
    rows = tune.tune_grid(spark, train_dev(spark, SF001)[0], grid, folds=2, num_trees=2, max_depth=2).collect()
    assert seen == [5] * 4
    assert {(r.tune_mtry, r.k) for r in rows} == {(m, k) for m in (2, 4) for k in (1, 2)} and all(0 <= r.auc_roc <= 1 for r in rows)


def test_a_large_forest_grows_in_groups_of_trees(spark, monkeypatch):
    """Its rows would else keep a weight for each of its trees, its tasks
    the statistics of all trees' nodes."""
    rows = _rows(spark, 3000).select("*", (F.col("appointment_id") % 2).alias("z"))
    rows = rows.withColumn("no_show", F.col("x") + F.col("z") > 3)
    grown = []
    plain = MOD.rf_estimator
    monkeypatch.setattr(MOD, "rf_estimator", lambda p, num_trees, **kw: grown.append(num_trees) or plain(p, num_trees=num_trees, **kw))
    one = MOD.fit_rf(rows, ["x", "z"], num_trees=24, max_depth=4, mtry=2)
    monkeypatch.setattr(MOD, "_FIT_WORK", 1000)
    many = MOD.fit_rf(rows, ["x", "z"], num_trees=24, max_depth=4, mtry=2)
    assert grown[0] == 24 and sum(grown[1:]) == 24 and max(grown[1:]) <= MOD._TREES_TOGETHER
    members = many.last.members
    assert sum(m.getNumTrees for m in members) == 24 and len({tuple(t.toDebugString for t in m.trees) for m in members}) == len(members)
    got, want = ({r.appointment_id: r.prob for r in m.score(rows).collect()} for m in (many, one))
    assert len(got) == 3000 and max(abs(got[i] - want[i]) for i in got) < 0.1
    assert many.score(rows).columns == one.score(rows).columns
    assert abs(sum(many.last.featureImportances.toArray()) - 1) < 1e-9
    assert {r.feature for r in MOD.rf_importance(spark, many).collect()} == {"x", "z"}
    balanced = MOD.Bagged([many, one])
    assert balanced.score(rows).select("prob").dropna().count() == 3000

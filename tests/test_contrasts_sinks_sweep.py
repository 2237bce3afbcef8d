"""Factor contrasts, the bucketed sink and the variant sweep."""

import pytest
from pyspark.sql import functions as F

from cohortlens.operators.contrasts import fit_contrasts
from cohortlens.operators.models import fit_logreg
from cohortlens.plans import sweep
from cohortlens.plans.catalog import feature_matrix, train_dev
from cohortlens.plans.features import VARIANTS, design_columns, variant_frame, variant_plan
from cohortlens.sources.bucketed import write_bucketed
from tests.conftest import SF001


# ------------------------------------------------------------- contrasts

def _factors(spark, rows):
    return spark.createDataFrame(rows, "id long, f string, g string, x double, y boolean")


def test_contrasts_leave_out_the_first_level(spark):
    df = _factors(spark, [(1, "b", "only", 1.0, True), (2, "a", "only", 2.0, False), (3, "c", None, 3.0, True), (4, None, "only", 4.0, False)])
    levels = fit_contrasts(df)
    out = levels.transform(df)
    assert out.columns == ["id", "f_b", "f_c", "x", "y"] and levels.columns(["f", "g", "x"]) == ["f_b", "f_c", "x"]
    assert [(r.id, r.f_b, r.f_c) for r in out.orderBy("id").collect()] == [(1, 1.0, 0.0), (2, 0.0, 0.0), (3, 0.0, 1.0), (4, 0.0, 0.0)]


def test_unseen_levels(spark):
    levels = fit_contrasts(_factors(spark, [(1, "a", "g", 0.0, True), (2, "b", "g", 0.0, True)]))
    new = _factors(spark, [(1, "never", "g", 0.0, True)])
    assert levels.transform(new).first().f_b == 0.0
    with pytest.raises(Exception, match="not fitted: never"):
        levels.transform(new, unseen="error").collect()
    with pytest.raises(ValueError):
        levels.transform(new, unseen="skip")


def test_too_many_levels_are_an_error_not_a_cut(spark):
    df = _factors(spark, [(i, f"level {i}", "g", 0.0, True) for i in range(60)])
    with pytest.raises(ValueError, match="more than 20 levels"):
        fit_contrasts(df, ["f"], max_levels=20)
    assert len(fit_contrasts(df, ["f"], max_levels=60).levels["f"]) == 60


def test_regression_learns_a_level_that_is_not_in_order(spark):
    """The middle level differs: one slope over an index can't show it."""
    rows = [(i, "abc"[i % 3], "g", float(i % 5), (i % 3 == 1) ^ (i % 7 == 0)) for i in range(420)]
    df = _factors(spark, rows)
    model = fit_logreg(df, ["f", "x"], label="y")
    probs = {r.f: r.p for r in model.score(df.withColumn("level", F.col("f"))).groupBy(F.col("level").alias("f")).agg(F.avg("prob").alias("p")).collect()}
    for level in "abc":
        own = [y for _, f, _, _, y in rows if f == level]
        assert probs[level] == pytest.approx(sum(own) / len(own), abs=1e-3)


# ------------------------------------------------------------------ sink

def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    rows = [(k % 37, k, f"v{k}") for k in range(2000)] + [(5, 3000 + k, "hot") for k in range(1000)] + [(None, 9999, "null")]
    a = write_bucketed(spark.createDataFrame(rows, "patient long, id long, v string").repartition(3), "sink_a", "patient", 8, "id", str(tmp_path / "a"))
    b = write_bucketed(spark.createDataFrame([(k, f"p{k}") for k in range(37)], "patient long, name string"), "sink_b", "patient", 8, path=str(tmp_path / "b"))
    joined = a.join(b.hint("merge"), "patient")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in a.groupBy("patient").count()._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(rows, key=repr)
    assert joined.count() == 3000
    spark.sql("DROP TABLE sink_a")
    spark.sql("DROP TABLE sink_b")


def test_both_patient_counts_take_one_shuffle_of_the_rows(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = feature_matrix(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("by_day") and plan.count("Join LeftOuter") == 2  # the group's bias, and one for the patient


# ----------------------------------------------------------------- sweep

def test_superset_holds_every_variant(spark):
    """Each variant's slice equals the frame that the variant's own plan
    fits."""
    train, dev = train_dev(spark, SF001)
    wide, = sweep.superset(train, dev)
    wide = wide.cache()
    for name in VARIANTS:
        plan, extra = variant_plan(name)
        own = variant_frame(plan.fit(train), dev, extra)
        columns = [c for c in design_columns(own) if c != "sms_received"]
        predictors = dict(sweep.variant_predictors(name))
        assert set(columns) <= set(predictors) and set(predictors) - set(columns) <= {"sms_received", "sms_received_no", "sms_received_yes"}
        numbers = [c for c in columns if not dict(own.dtypes)[c].startswith("timestamp")]
        left = {r[0]: tuple(round(float(x), 9) for x in r[1:]) for r in own.select("appointment_id", *numbers).collect()}
        right = {r[0]: tuple(round(float(x), 9) for x in r[1:]) for r in wide.select("appointment_id", *[predictors[c] for c in numbers]).collect()}
        assert left == right, name


def test_sweep_scores_every_variant(spark):
    train, dev = train_dev(spark, SF001)
    rows = sweep.model_sweep(spark, train, dev, ["GLM", "RF2", "RF10"], num_trees=8, n_bags=4, max_depth=3, n_per_class=100).collect()
    assert [r.variant for r in rows] == ["GLM", "RF2", "RF10"]
    assert [r.n_predictors for r in rows] == [11, 10, 18]
    assert rows[0].oob_auc is None and all(0 <= r.oob_auc <= 1 for r in rows[1:]) and all(0 <= r.dev_auc <= 1 for r in rows)

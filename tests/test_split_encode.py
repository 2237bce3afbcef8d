"""Splits, folds, ordering primitives and encoders."""

import math

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import encode as ENC
from cohortlens.operators import profile as P
from cohortlens.operators import split as S
from cohortlens.sources import appointments
from tests.conftest import SF001


@pytest.fixture(scope="module")
def view(spark):
    return appointments(spark, SF001).cache()


def test_draws_are_independent(spark):
    """Each fold holds its share of dev and test rows, and a balanced sample
    isn't drawn from one part."""
    df = spark.range(0, 6000).select(F.col("id").alias("appointment_id"), (F.col("id") % 5 == 0).alias("no_show"))
    s = S.kfold_assign(S.three_way_split(df), 10)
    shares = {(r.fold, r.split): r["count"] for r in s.groupBy("fold", "split").count().collect()}
    for f in range(1, 11):
        assert 0.05 < shares[f, "test"] / 600 < 0.15 and 0.05 < shares[f, "dev"] / 600 < 0.13
    drawn = {r.split: r["count"] for r in S.balanced_sample(s, 500).groupBy("split").count().collect()}
    assert 700 < drawn["train"] < 900


def test_holdout_is_a_partition_with_ceil_sizes(view):
    s = S.holdout_split(view, p=0.1, seed=1)
    assert s.count() == view.count()
    sizes = {r.stratum: r["count"] for r in s.groupBy("stratum").count().collect()}
    held = s.filter("in_holdout").count()
    assert held == sum(math.ceil(0.1 * n) for n in sizes.values())
    assert s.select("appointment_id").distinct().count() == view.count()


def test_three_way_split_covers_every_row_once(view):
    s = S.three_way_split(view)
    assert s.count() == view.count()
    assert {r.split for r in s.select("split").distinct().collect()} == {"train", "dev", "test"}


def test_folds_differ_by_at_most_one(spark):
    df = spark.range(0, 1003).withColumnRenamed("id", "appointment_id")
    f = S.kfold_assign(df, folds=10)
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1 and sum(sizes) == 1003


def test_balanced_sample_sizes(view):
    b = S.balanced_sample(view, 40)
    counts = {r.no_show: r["count"] for r in b.groupBy("no_show").count().collect()}
    assert counts == {True: 40, False: 40}


def test_target_encoder_threshold_is_strict(spark):
    rows = [("a", True)] * 3 + [("a", False)] * 1 + [("b", True)] * 5 + [("c", False)] * 2
    df = spark.createDataFrame(rows, "neighbourhood string, no_show boolean")
    enc = {r.neighbourhood: r.bias for r in ENC.fit_target_encoder(df, "neighbourhood", 4, "bias").collect()}
    base = 8 / 11
    assert set(enc) == {"b"} and enc["b"] == pytest.approx(1 - base)
    enc2 = ENC.fit_target_encoder(df, "neighbourhood", 3, "bias").collect()
    assert {r.neighbourhood for r in enc2} == {"a", "b"}


def test_natural_left_join_null_keys_and_unseen(spark):
    a = spark.createDataFrame([("x", 1), (None, 2), ("z", 3)], "key string, v int")
    b = spark.createDataFrame([("x", 10.0), (None, 20.0)], "key string, w double")
    got = {r.v: r.w for r in ENC.natural_left_join(a, b).collect()}
    assert got == {1: 10.0, 2: 20.0, 3: None}
    filled = {r.v: r.w for r in ENC.apply_encoder(a, b, null_safe=True).collect()}
    assert filled[3] == 0.0
    with pytest.raises(ValueError):
        ENC.natural_left_join(a, b.withColumnRenamed("key", "other"))


def test_oof_encoding_equals_refit_per_fold(view):
    folds = S.kfold_assign(view, folds=4)
    got = {(r.appointment_id): r.b for r in
           ENC.oof_target_encode(folds, "neighbourhood", 10, "b").select("appointment_id", "b").collect()}
    for f in range(1, 5):
        train = folds.filter(F.col("fold") != f)
        enc = ENC.fit_target_encoder(train, "neighbourhood", 10, "b")
        valid = ENC.apply_encoder(folds.filter(F.col("fold") == f), enc)
        for r in valid.select("appointment_id", "b").collect():
            assert got[r.appointment_id] == pytest.approx(r.b, abs=1e-12)


def test_group_rate_extremes_small_and_large(spark):
    def groups(n):
        rows = []
        for g in range(n):
            rows += [(f"g{g:02d}", i < g % 7) for i in range(25)]
        return spark.createDataFrame(rows, "neighbourhood string, no_show boolean")
    close = spark.createDataFrame([("a", 1000000, 2000001), ("b", 1000001, 2000001)], "neighbourhood string, pos int, n int")
    rows = close.select("neighbourhood", F.explode(F.sequence(F.lit(1), "n")).alias("i"), "pos").select(
        "neighbourhood", (F.col("i") <= F.col("pos")).alias("no_show"))
    assert [r.neighbourhood for r in P.group_rate_extremes(rows, n=1).orderBy("no_show_ratio").collect()]
    top = P.group_rate_extremes(rows.filter("neighbourhood <> 'z'"), n=1).collect()
    assert {r.neighbourhood for r in top} == {"a", "b"}
    for n, expect in ((15, 15), (20, 20), (21, 20), (25, 20)):
        assert P.group_rate_extremes(groups(n)).count() == expect


def test_entity_drift_values(spark):
    rows = [(1, 10), (1, 11), (2, 5), (3, 1), (3, 2), (3, 3)]
    df = spark.createDataFrame(rows, "patient_id long, age int")
    got = sorted(r.age_diff for r in P.entity_attribute_drift(df).collect())
    assert got == [0.0, 0.5, 1.0]


def test_days_between_negative_and_weekday(spark):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 7, 23, 59), dt.datetime(2024, 1, 6)),
            (dt.datetime(2024, 1, 7, 0, 0), dt.datetime(2024, 1, 7))]
    df = spark.createDataFrame(rows, "scheduled_ts timestamp_ntz, appointment_day timestamp_ntz")
    from cohortlens.functions import days_between, weekday
    got = df.select(days_between("appointment_day", "scheduled_ts").alias("d"),
                    weekday("scheduled_ts").alias("w")).collect()
    assert [(r.d, r.w) for r in got] == [(-1, 1), (0, 1)]


def test_split_and_folds_unchanged_under_repartition(view):
    a = S.holdout_split(view).select("appointment_id", "in_holdout")
    b = S.holdout_split(view.repartition(7)).select("appointment_id", "in_holdout")
    assert sorted(a.collect()) == sorted(b.collect())
    fa = S.kfold_assign(view, 5).select("appointment_id", "fold")
    fb = S.kfold_assign(view.repartition(5), 5).select("appointment_id", "fold")
    assert sorted(fa.collect()) == sorted(fb.collect())

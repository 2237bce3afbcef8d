"""ROC / AUC / confusion statistics on hand-made scores."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from cohortlens.functions.stats import binom_ci, binom_sf_ge, chi2_sf_1df
from cohortlens.operators import metrics as M


def pairwise_auc(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def frame(spark, rows):
    return spark.createDataFrame(rows, "score double, label boolean")


def test_auc_with_ties_equals_pairwise_definition(spark):
    rows = [(0.1, False), (0.4, True), (0.4, False), (0.4, True), (0.8, True), (0.2, False),
            (0.8, False), (0.9, True), (0.1, True)]
    auc = M.roc_auc(frame(spark, rows), "score", "label").first()["auc"]
    assert auc == pytest.approx(pairwise_auc(rows), abs=1e-6)


def test_auc_random_and_symmetry(spark):
    rnd = random.Random(7)
    rows = [(float(rnd.randint(0, 30)), rnd.random() < 0.3) for _ in range(400)]
    df = frame(spark, rows)
    a = M.roc_auc(df, "score", "label").first()["auc"]
    b = M.roc_auc(df.withColumn("score", -F.col("score")), "score", "label").first()["auc"]
    assert a == pytest.approx(pairwise_auc(rows), abs=1e-6)
    assert a + b == pytest.approx(1.0, abs=1e-5)


def test_auc_one_class_is_null_and_empty_is_empty(spark):
    assert M.roc_auc(frame(spark, [(0.3, True), (0.5, True)]), "score", "label").first()["auc"] is None
    empty = M.roc_auc(frame(spark, []), "score", "label").collect()
    assert [r.auc for r in empty] == [None]


def test_rows_without_score_or_label_count_nowhere(spark):
    rows = [(0.9, True), (0.8, True), (0.2, False), (0.1, False)]
    more = rows + [(None, False)] * 4 + [(0.95, None)]
    assert M.roc_auc(frame(spark, more), "score", "label").first()["auc"] == 1.0
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(M.roc_curve(frame(spark, more), "score", "label")) == key(M.roc_curve(frame(spark, rows), "score", "label"))
    assert key(M.confusion_at_cutoffs(frame(spark, more), "score", "label", [0.5])) == key(
        M.confusion_at_cutoffs(frame(spark, rows), "score", "label", [0.5]))


def test_auc_of_many_distinct_scores(spark):
    rnd = random.Random(2)
    rows = [(rnd.random(), rnd.random() < 0.4) for _ in range(900)]
    auc = M.roc_auc(frame(spark, rows), "score", "label").first()["auc"]
    assert auc == pytest.approx(pairwise_auc(rows), abs=1e-6)


def test_auc_unchanged_under_repartition(spark):
    rnd = random.Random(3)
    rows = [(rnd.random(), rnd.random() < 0.4) for _ in range(300)]
    df = frame(spark, rows)
    a = M.roc_auc(df, "score", "label").first()["auc"]
    b = M.roc_auc(df.repartition(13), "score", "label").first()["auc"]
    assert a == b


def test_roc_curve_is_monotone_and_ends_at_one(spark):
    rnd = random.Random(11)
    rows = [(float(rnd.randint(0, 9)), rnd.random() < 0.5) for _ in range(200)]
    pts = M.roc_curve(frame(spark, rows), "score", "label").orderBy(F.col("threshold").desc()).collect()
    tprs, fprs = [p.tpr for p in pts], [p.fpr for p in pts]
    assert tprs == sorted(tprs) and fprs == sorted(fprs)
    assert tprs[-1] == 1.0 and fprs[-1] == 1.0


def test_confusion_counts_and_stats(spark):
    rows = [(0.9, True), (0.8, False), (0.6, True), (0.2, True), (0.1, False), (0.35, False)]
    r = M.confusion_at_cutoffs(frame(spark, rows), "score", "label", [0.32]).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (2, 2, 1, 1)
    assert r.sensitivity == pytest.approx(2 / 3, abs=1e-6)
    assert r.specificity == pytest.approx(1 / 3, abs=1e-6)
    assert r.ppv == pytest.approx(0.5)
    assert r.accuracy == pytest.approx(0.5)


def test_distribution_helpers():
    lo, hi = binom_ci(7, 10)
    assert lo == pytest.approx(0.3475, abs=1e-4) and hi == pytest.approx(0.9333, abs=1e-4)
    assert binom_sf_ge(8, 10, 0.5) == pytest.approx(56 / 1024, abs=1e-9)
    assert chi2_sf_1df(3.841458820694124) == pytest.approx(0.05, abs=1e-9)


def test_cutoff_search_picks_highest_threshold(spark):
    rows = [(0.9, True), (0.8, True), (0.7, False), (0.6, True), (0.5, False), (0.4, True)]
    r = {x.target: x for x in M.cutoff_search(frame(spark, rows), "score", "label", 0.5, 0.75).collect()}
    assert r["sensitivity"].threshold == 0.8
    assert r["ppv"].threshold == 0.6 and r["ppv"].tpr == 0.75

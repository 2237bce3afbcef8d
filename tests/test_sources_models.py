"""CSV source, recode, KNN ties and a model smoke test."""

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import knn as K
from cohortlens.operators import metrics as M
from cohortlens.operators import models as MOD
from cohortlens.sources.csv import read_raw_csv, recode


def test_csv_recode_bad_rows_and_nulls(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(
        "PatientId,AppointmentID,Gender,ScheduledDay,AppointmentDay,Age,Neighbourhood,Scholarship,"
        "Hipertension,Diabetes,Alcoholism,Handcap,SMS_received,No-show\n"
        "29872499824296,5642903,F,2016-04-29T18:38:08Z,2016-04-29T00:00:00Z,62,JARDIM,0,1,0,0,0,0,No\n"
        "558997776694438,5642503,M,2016-04-29T16:08:27Z,2016-04-29T00:00:00Z,56,JARDIM,0,0,0,0,0,0,Yes\n"
        "1,2,F,not-a-date,2016-04-29T00:00:00Z,,X,1,0,0,0,2,1,No\n")
    df = recode(read_raw_csv(spark, str(p))).orderBy("appointment_id").collect()
    assert len(df) == 3
    bad, a, b = df
    assert bad.scheduled_ts is None and bad.age is None and bad.handcap == 2
    assert a.no_show is True and a.gender is False and b.gender is True and b.hipertension is True
    assert str(b.scheduled_ts) == "2016-04-29 18:38:08"


def test_knn_ties_at_kth_distance_all_vote(spark):
    refs = spark.createDataFrame([(1, [0.0, 1.0], 1), (2, [1.0, 0.0], 0), (3, [0.0, -1.0], 1),
                                  (4, [5.0, 5.0], 0)], "id long, v array<double>, label int")
    q = spark.createDataFrame([(10, [0.0, 0.0])], "id long, v array<double>")
    nb = K.knn_join(q, refs, 2, label="label", block_rows=2)
    assert sorted(r.neighbour_id for r in nb.collect()) == [1, 2, 3]
    assert K.knn_vote_share(nb).first().prob == pytest.approx(2 / 3)


def test_knn_join_matches_brute_force(spark):
    import random
    rnd = random.Random(5)
    pts = [(i, [float(rnd.randint(0, 5)), float(rnd.randint(0, 5))], rnd.randint(0, 1)) for i in range(120)]
    df = spark.createDataFrame(pts, "id long, v array<double>, label int")
    got = {(r.query_id, r.neighbour_id) for r in K.knn_join(df, df, 3, exclude_self=True, block_rows=17).collect()}
    want = set()
    for i, v, _ in pts:
        d = sorted((sum((a - b) ** 2 for a, b in zip(v, w)), j) for j, w, _ in pts if j != i)
        kth = d[2][0]
        want |= {(i, j) for dd, j in d if dd <= kth}
    assert got == want


def test_forest_learns_a_planted_signal(spark):
    import random
    rnd = random.Random(1)
    rows = []
    for i in range(600):
        x = rnd.random()
        rows.append((i, x, rnd.random(), rnd.random() < (0.8 if x > 0.5 else 0.1)))
    df = spark.createDataFrame(rows, "appointment_id long, signal double, noise double, no_show boolean")
    model = MOD.fit_rf(df, ["signal", "noise"], num_trees=10, max_depth=4)
    imp = MOD.rf_importance(spark, model).orderBy("rank").first()
    assert imp.feature == "signal"
    scored = model.score(df)
    assert scored.filter((F.col("prob") < 0) | (F.col("prob") > 1)).count() == 0
    assert M.roc_auc(scored, "prob", "label").first().auc > 0.7
    oob = MOD.oob_scores(df, ["signal", "noise"], n_bags=4, num_trees=36, max_depth=4)
    assert oob.filter("oob_score is null").isEmpty()
    assert M.roc_auc(oob.filter(F.col("oob_score").isNotNull()), "oob_score", "label").first().auc > 0.65


def test_knn_join_with_group_exclusion_matches_brute_force(spark):
    import random
    rnd = random.Random(9)
    pts = [(i, [rnd.gauss(0, 1) * 3, rnd.gauss(0, 1)], rnd.randint(0, 1), i % 4) for i in range(150)]
    df = spark.createDataFrame(pts, "id long, v array<double>, label int, fold int")
    got = {(r.query_id, r.neighbour_id) for r in
           K.knn_join(df, df, 4, label="label", group="fold", block_rows=16, cells=6).collect()}
    want = set()
    for i, v, _, f in pts:
        d = sorted((round(sum((a - b) ** 2 for a, b in zip(v, w)), 9), j) for j, w, _, g in pts if g != f)
        kth = d[3][0]
        want |= {(i, j) for dd, j in d if dd <= kth}
    assert got == want


def test_balanced_bagged_forest_scores_all_rows(spark):
    import random
    rnd = random.Random(4)
    rows = []
    for i in range(800):
        x = rnd.random()
        rows.append((i, x, rnd.random() < (0.6 if x > 0.7 else 0.08)))
    df = spark.createDataFrame(rows, "appointment_id long, signal double, no_show boolean")
    model = MOD.fit_rf_balanced(df, ["signal"], n_per_class=60, n_bags=2, trees_per_bag=5, max_depth=3)
    scored = model.score(df)
    assert scored.count() == 800
    assert scored.filter(F.col("prob").isNull() | (F.col("prob") < 0) | (F.col("prob") > 1)).count() == 0
    assert M.roc_auc(scored, "prob", "label").first().auc > 0.7

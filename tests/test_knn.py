"""KNN joins against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import knn as KNN
from cohortlens.plans.catalog import KNN5_COLS, _knn_models
from cohortlens.sources import appointments
from tests.conftest import SF01, SF001


def _frame(spark, X, label=None, fold=None):
    rows = [(i, [float(x) for x in v], int(label[i]) if label is not None else None, int(fold[i]) if fold is not None else None)
            for i, v in enumerate(X)]
    return spark.createDataFrame(rows, "id long, v array<double>, label int, fold int")


def _brute(Q, R, k, digits=9, skip=None):
    """Pairs within the k-th smallest rounded distance of each query."""
    out = set()
    for i, q in enumerate(Q):
        d = np.round(((R - q) ** 2).sum(axis=1), digits)
        ok = np.ones(len(R), dtype=bool) if skip is None else ~skip(i)
        if ok.any():
            kth = np.sort(d[ok])[min(k, ok.sum()) - 1]
            out |= {(i, int(j), float(d[j])) for j in np.flatnonzero(ok & (d <= kth))}
    return out


def _pairs(df):
    return {(r.query_id, r.neighbour_id, r.distance) for r in df.collect()}


def _clustered(n, d, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 20, (40, d))
    return centre[rng.integers(40, size=n)] + rng.normal(0, 1, (n, d))


def test_exact_join_prunes_and_equals_brute_force(spark):
    """Default settings, over 64 cells; a small share of all pairs."""
    X = _clustered(5000, 6, 1)
    X[4000:4300] = np.round(X[4000:4300])  # ties
    seen = {}
    df = _frame(spark, X)
    queries = df.filter("id % 3 = 0")
    got = _pairs(KNN.knn_join(queries, df, 7, exclude_self=True, observe=seen))
    want = {(3 * i, j, d) for i, j, d in _brute(X[::3], X, 7, skip=lambda i: np.arange(len(X)) == 3 * i)}
    assert got == want
    assert seen["cells"] >= 64 and seen["pairs"] < 0.1 * len(X) * len(X[::3])


def test_exact_join_across_folds_with_large_coordinates(spark):
    rng = np.random.default_rng(2)
    X = np.concatenate([rng.integers(0, 4, (900, 3)), 1.4e9 + rng.integers(0, 10**6, (900, 1))], axis=1).astype(float)
    X[:200] = X[0]  # one value for many rows
    fold = rng.integers(0, 5, 900)
    df = _frame(spark, X, fold=fold)
    got = _pairs(KNN.knn_join(df, df, 4, group="fold", block_rows=64))
    assert got == _brute(X, X, 4, skip=lambda i: fold == fold[i])


def test_a_query_travels_once_to_a_region(spark, monkeypatch):
    """Without structure every cell is visited; a vector is then copied for
    each region (block of references), not for each of the cells."""
    X, sent, real = np.random.default_rng(6).normal(0, 1, (1200, 24)), [], KNN._meet
    monkeypatch.setattr(KNN, "_meet", lambda qv, *a: sent.append((qv.count(), qv.select(F.sum(F.size("cells"))).first()[0])) or real(qv, *a))
    df = _frame(spark, X)
    got = _pairs(KNN.knn_join(df, df, 3, exclude_self=True, block_rows=400))
    assert got == _brute(X, X, 3, skip=lambda i: np.arange(len(X)) == i)
    (_, _), (rows, cells) = sent
    assert rows <= 8 * len(X) and cells > 20 * len(X)


def test_lists_hold_the_pairs_and_vote_alike(spark):
    """One row for each query, whose region is done or not; ties, a vector
    with a null, an unknown label, an id that comes twice."""
    rng = np.random.default_rng(11)
    X, label, fold = np.round(rng.normal(0, 3, (900, 3)), 1), rng.integers(0, 2, 900), rng.integers(1, 4, 900)
    rows = [(i, [float(x) for x in v], int(y), int(f)) for i, (v, y, f) in enumerate(zip(X, label, fold, strict=True))]
    rows[5] = (5, [1.0, None, 0.0], 1, 1)
    rows[6] = (6, rows[6][1], None, rows[6][3])
    df = spark.createDataFrame(rows + [rows[7]], "id long, v array<double>, label int, fold int")
    how = dict(label="label", group="fold", block_rows=100)
    lists, pairs = (KNN.knn_join(df, df, 6, lists=x, **how).cache() for x in (True, False))
    got = {(r.query_id, j, d) for r in lists.collect() for j, d in zip(r.neighbour_ids, r.distances, strict=True)}
    assert got == _pairs(pairs) and lists.count() == lists.select("query_id").distinct().count()
    want = _brute(np.vstack([X, X[7]]), np.vstack([X, X[7]]), 6,
                  skip=lambda i: (np.append(fold, fold[7]) == np.append(fold, fold[7])[i]) | (np.arange(901) == 5))
    ids = {(i, 7 if j == 900 else j, d) for i, j, d in want if i not in (5, 7, 900)}
    assert {x for x in got if x[0] not in (5, 7)} == ids and not any(x[0] == 5 for x in got)
    for vote in (lambda nb: KNN.knn_probs_for_ks(nb, (2, 4, 6)), KNN.knn_vote_share):
        a, b = (sorted(tuple(r) for r in vote(nb).collect()) for nb in (lists, pairs))
        assert [x[:-1] for x in a] == [x[:-1] for x in b]
        np.testing.assert_allclose([x[-1] for x in a], [x[-1] for x in b])


def test_cells_stay_small_as_references_grow(spark, monkeypatch):
    """Over more references a query is compared with about as many."""
    monkeypatch.setattr(KNN, "CELL_ROWS", 32)
    X, seen = np.random.default_rng(12).uniform(0, 1, (16000, 2)), [{}, {}]
    for n, s in zip((4000, 16000), seen, strict=True):
        df = _frame(spark, X[:n])
        got = KNN.knn_join(df, df, 5, exclude_self=True, block_rows=1000, observe=s, lists=True)
        assert got.count() == n
    assert seen[1]["pairs"] / 16000 < 1.3 * seen[0]["pairs"] / 4000


@pytest.mark.parametrize("n", [1, 3])
def test_fewer_references_than_neighbours(spark, n):
    X = np.arange(2.0 * n).reshape(n, 2)
    df = _frame(spark, X)
    assert _pairs(KNN.knn_join(df, df, 5)) == _brute(X, X, 5)
    assert _pairs(KNN.knn_join(df, df, 5, exclude_self=True)) == _brute(X, X, 5, skip=lambda i: np.arange(n) == i)
    assert KNN.knn_join(df, df.filter("false"), 5).collect() == []
    assert KNN.knn_join(df.filter("false"), df, 5).collect() == []


def test_pairs_compared_for_the_knn_model(spark):
    """The columns of the KNN model: under a tenth of all pairs."""
    view = KNN.to_vector(appointments(spark, SF01), KNN5_COLS)
    seen = {}
    KNN.knn_join(view, view, 45, "appointment_id", "appointment_id", exclude_self=True, observe=seen).count()
    assert seen["cells"] >= 64 and seen["pairs"] < 0.1 * view.count() ** 2


@pytest.mark.parametrize("dir_", [SF01, "/root/testdata/sf0.1"])
def test_recall_of_the_approximate_join(spark, dir_):
    """Ids divisible by 20 against all rows, vectors without structure."""
    e = spark.read.parquet(f"{dir_}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    rows = e.orderBy("vec_id").collect()
    X, ids = np.array([r.v for r in rows]), np.array([r.vec_id for r in rows])
    seen = {}
    got = _pairs(KNN.approx_knn_join(e.filter("vec_id % 20 = 0"), e, 5, "vec_id", "vec_id", exclude_self=True, observe=seen))
    true = {(int(ids[i]), int(ids[j]), d) for i in np.flatnonzero(ids % 20 == 0)
            for _, j, d in _brute(X[i:i + 1], X, 5, skip=lambda _, i=i: ids == ids[i])}
    assert len(got & true) / len(true) >= 0.9


def test_approximate_join_of_near_vectors_visits_few(spark):
    """Five near copies of each vector: few probes are needed."""
    rng = np.random.default_rng(5)
    X = np.repeat(rng.normal(0, 1, (800, 16)), 5, axis=0) + rng.normal(0, 0.01, (4000, 16))
    df, seen = _frame(spark, X), {}
    got = _pairs(KNN.approx_knn_join(df.filter("id % 20 = 0"), df, 4, exclude_self=True, bucket_rows=32, observe=seen))
    true = {(20 * i, j, d) for i, j, d in _brute(X[::20], X, 4, skip=lambda i: np.arange(len(X)) == 20 * i)}
    assert len(got & true) / len(true) >= 0.9 and seen["pairs"] < 0.25 * len(X) * len(X[::20])
    assert KNN.approx_knn_join(df, df.filter("false"), 5).collect() == []


def test_scaler_of_all_rows_and_of_other_folds(spark):
    rng = np.random.default_rng(3)
    X = np.stack([1.7e9 + rng.normal(0, 1e4, 300), rng.integers(0, 2, 300), np.full(300, 7.0)], axis=1)
    fold = rng.integers(1, 4, 300)
    df = _frame(spark, X, fold=fold)
    whole = KNN.fit_scaler(df, 3).first()
    np.testing.assert_allclose(whole["mean"], X.mean(axis=0), rtol=1e-12)
    np.testing.assert_allclose(whole["deviation"], [*X.std(axis=0, ddof=1)[:2], 1.0], rtol=1e-9)
    for r in KNN.fit_scaler(df, 3, "fold").collect():
        rest = X[fold != r["fold"]]
        np.testing.assert_allclose(r["mean"], rest.mean(axis=0), rtol=1e-12)
        np.testing.assert_allclose(r["deviation"], [*rest.std(axis=0, ddof=1)[:2], 1.0], rtol=1e-9)


def test_standardized_cross_validation_equals_one_join_a_fold(spark):
    rng = np.random.default_rng(4)
    X = np.stack([rng.normal(0, 1000, 200), rng.normal(0, 1, 200), rng.integers(0, 2, 200)], axis=1)
    fold = rng.integers(1, 4, 200)
    df = _frame(spark, X, label=rng.integers(0, 2, 200), fold=fold)
    got = _pairs(KNN.cv_knn_join(df, 3, "id", "label", standardize=True, digits=6))
    want = set()
    for f in (1, 2, 3):
        mean, spread = X[fold != f].mean(axis=0), X[fold != f].std(axis=0, ddof=1)
        Z = (X - mean) / spread
        own = np.flatnonzero(fold == f)
        want |= {(int(own[i]), j, d) for i, j, d in _brute(Z[own], Z, 3, 6, skip=lambda _, f=f: fold == f)}
    assert {(i, j) for i, j, _ in got} == {(i, j) for i, j, _ in want}


def test_a_row_is_a_standardized_reference_once(spark, monkeypatch):
    """Folds share the cells, though their units differ by far."""
    rng, seen, real = np.random.default_rng(9), [], KNN.knn_join
    X, fold = np.stack([rng.normal(0, 50, 600), rng.normal(0, 1, 600)], axis=1), rng.integers(1, 4, 600)
    X[fold == 2] *= [1, 9]  # the units of its own fold miss these
    monkeypatch.setattr(KNN, "knn_join", lambda q, r, *a, **kw: seen.append((q.count(), r.count())) or real(q, r, *a, **kw))
    df = _frame(spark, X, label=rng.integers(0, 2, 600), fold=fold)
    got = _pairs(KNN.cv_knn_join(df, 5, "id", "label", standardize=True, digits=6, cells=40, block_rows=64))
    assert seen == [(600, 600)]
    want = set()
    for f in (1, 2, 3):
        Z = (X - X[fold != f].mean(axis=0)) / X[fold != f].std(axis=0, ddof=1)
        own = np.flatnonzero(fold == f)
        want |= {(int(own[i]), j) for i, j, _ in _brute(Z[own], Z, 5, 6, skip=lambda _, f=f: fold == f)}
    assert {(i, j) for i, j, _ in got} == want

def test_knn_models_report_the_best_k(spark):
    rows = _knn_models(spark, SF001, ("KNN5",)).collect()
    assert {(r.variant, r.k) for r in rows} == {("KNN5", k) for k in (25, 35, 45)}
    best = [r for r in rows if r.best]
    assert len(best) == 1 and best[0].cv_auc == max(r.cv_auc for r in rows) and 0 <= best[0].dev_auc <= 1
    assert all(r.dev_auc is None for r in rows if not r.best)


def _rounds(monkeypatch):
    """Every query travels in rounds of few references."""
    real, sent = KNN._meet, []
    monkeypatch.setattr(KNN, "TRAVEL_BYTES", 0)
    monkeypatch.setattr(KNN, "ROUND_BYTES", 1 << 14)
    monkeypatch.setattr(KNN, "_TOGETHER", 100)
    monkeypatch.setattr(KNN, "_meet", lambda qv, *a: sent.append(qv.count()) or real(qv, *a))
    return sent


@pytest.mark.parametrize("kind", ["double", "float"])
def test_a_query_is_not_copied_for_each_region(spark, monkeypatch, kind):
    """Without structure each query visits every region: references then go
    around in bounded rounds, and a query is shuffled once."""
    X, sent = np.random.default_rng(21).normal(0, 1, (1200, 12)).astype(np.float32).astype(float), _rounds(monkeypatch)
    X[300:340] = np.round(X[300:340])  # ties
    X[340:360] = X[340]
    df, seen = _frame(spark, X).withColumn("v", F.col("v").cast(f"array<{kind}>")), {}
    got = _pairs(KNN.knn_join(df, df, 3, exclude_self=True, block_rows=100, observe=seen))
    assert got == _brute(X, X, 3, skip=lambda i: np.arange(len(X)) == i)
    assert sent == [len(X)] and len(X) ** 2 * 0.8 < seen["pairs"] <= len(X) ** 2 * 1.1


def test_rounds_with_folds_units_repeated_ids_and_large_cells(spark, monkeypatch):
    rng, sent = np.random.default_rng(22), _rounds(monkeypatch)
    X, fold = np.stack([rng.normal(0, 2, 500), *rng.normal(0, 1, (7, 500))], axis=1), rng.integers(1, 4, 500)
    X[:100] = X[0]
    monkeypatch.setattr(KNN, "ROUND_BYTES", 1 << 12)  # the cell of these is more than a round
    df = _frame(spark, X, label=rng.integers(0, 2, 500), fold=fold)
    for standardize in (False, True):
        got = _pairs(KNN.cv_knn_join(df, 4, "id", "label", standardize=standardize, digits=6, cells=12, block_rows=40))
        want = set()
        for f in (1, 2, 3):
            rest, own = X[fold != f], np.flatnonzero(fold == f)
            Z = (X - rest.mean(axis=0)) / rest.std(axis=0, ddof=1) if standardize else X
            want |= {(int(own[i]), j) for i, j, _ in _brute(Z[own], Z, 4, 6, skip=lambda _, f=f: fold == f)}
        assert {(i, j) for i, j, _ in got} == want
    assert sent == [sent[0], sent[1]] and max(sent) < 800  # no copies for regions
    twice = df.filter("id < 3 or id >= 490").unionByName(df.filter("id >= 490").withColumn("v", F.transform("v", lambda x: x + 1)))
    with monkeypatch.context() as m:
        m.setattr(KNN, "TRAVEL_BYTES", 1 << 40)
        want = sorted(map(tuple, KNN.knn_join(twice, df, 4, label="label", cells=12, block_rows=40).collect()))
    assert sorted(map(tuple, KNN.knn_join(twice, df, 4, label="label", cells=12, block_rows=40).collect())) == want


@pytest.mark.parametrize("rounds", [False, True])
def test_votes_without_lists(spark, monkeypatch, rounds):
    """The same as from the lists, ties and unknown labels included."""
    rng = np.random.default_rng(23)
    X, label, fold = np.round(rng.normal(0, 3, (800, 4)), 1), rng.integers(0, 2, 800), rng.integers(1, 4, 800)
    rows = [(i, [float(x) for x in v], None if i % 9 == 0 else int(y), int(f)) for i, (v, y, f) in enumerate(zip(X, label, fold, strict=True))]
    df = spark.createDataFrame(rows + [rows[7]], "id long, v array<double>, label int, fold int")
    how = dict(label="label", group="fold", block_rows=100)
    want = KNN.knn_probs_for_ks(KNN.knn_join(df, df, 6, lists=True, **how), (1, 4, 6)).collect()
    if rounds:
        _rounds(monkeypatch)
    votes = KNN.knn_join(df, df, 6, ks=(1, 4, 6), **how)
    assert [c for c, _ in votes.dtypes] == ["query_id", "k", "prob"]
    assert sorted(map(tuple, votes.collect()), key=str) == sorted(map(tuple, want), key=str)
    none = KNN.knn_join(df, df.withColumn("label", F.lit(None).cast("int")), 6, ks=(2,), label="label").collect()
    assert len(none) == 800 and all(r.prob is None for r in none)


def test_what_a_variant_wrote_is_removed(spark, tmp_path, monkeypatch):
    from cohortlens import session
    monkeypatch.setattr(session, "checkpoint_dir", lambda spark: spark.sparkContext.setCheckpointDir(str(tmp_path)) or str(tmp_path))
    assert _knn_models(spark, SF001, ("KNN5",)).count() == 3
    assert [p for p in tmp_path.rglob("*") if p.is_file()] == []
    df = session.materialize(spark.range(10))
    with session.scratch(spark):
        inner = session.materialize(df.filter("id > 3"))
        assert inner.count() == 6 and list(tmp_path.glob("rows-*"))
    assert df.count() == 10 and not list(tmp_path.glob("rows-*"))
    session.discard(df)
    assert [p for p in tmp_path.rglob("part-*")] == []

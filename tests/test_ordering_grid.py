"""Rank selection primitives and the parameter grid."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlens.functions import hash_key
from cohortlens.operators import ordering as O
from cohortlens.plans.tune import param_grid


def test_buckets_follow_the_row_count():
    assert O.buckets_for(10_000) == O.LEAST_BUCKETS
    assert O.buckets_for(10 ** 12) > 900_000


def test_rank_cuts_equal_full_ranking(spark):
    df = spark.range(0, 2000).withColumn("g", (F.col("id") % 3).cast("int"))
    key = hash_key("id", 3, "x")
    ranks = [lambda n: F.lit(1), lambda n: F.floor(n * 0.3), lambda n: n, lambda n: n + 1]
    cuts = O.rank_cuts(df, key, "id", ranks, "g")
    got = {g: (n, *[c and c[1] for c in at]) for g, (n, at) in cuts.items()}
    w = Window.partitionBy("g").orderBy(key, "id")
    full = df.withColumn("rn", F.row_number().over(w)).collect()
    for g, (n, first, part, last, none) in got.items():
        at = {r.rn: r.id for r in full if r.g == g}
        assert (n, first, part, last, none) == (len(at), at[1], at[int(len(at) * 0.3)], at[len(at)], None)


@pytest.mark.parametrize("values", [
    [(k * 7919) % 1001 for k in range(1001)],
    [-2**63, 2**63 - 1, 0, 5, 5, 5, -7, 2**60, 2**60 + 1, 2**60 + 2],
    [3] * 500 + [1, 2, 4],
    [1e-300, 1e300, 0.0, -1e300, 1.5, 1.5000000000000002, 2.5, -0.25],
    [7],
    [],
])
def test_order_statistics_equal_a_full_sort(spark, values):
    kind = "double" if any(isinstance(v, float) for v in values) else "long"
    df = spark.createDataFrame([(v,) for v in [*values, None]], f"y {kind}").repartition(3)
    ranks = [lambda n: 0, lambda n: 1, lambda n: (n + 1) // 2, lambda n: n - 1, lambda n: n, lambda n: n + 1]
    n, found = O.order_statistics(df, "y", ranks)
    at = sorted(values)
    assert n == len(values) and found == [at[r(n) - 1] if 1 <= r(n) <= n else None for r in ranks]


def test_a_split_reads_its_rows_twice(spark, monkeypatch):
    """Once for the narrow copy of the ids, once for the result."""
    from cohortlens.operators import split
    copies = []
    real = split.materialize
    monkeypatch.setattr(split, "materialize", lambda df: copies.append(df.columns) or real(df))
    out = split.three_way_split(spark.range(0, 400).withColumnRenamed("id", "appointment_id").withColumn("wide", F.lit("x")))
    assert copies == [["appointment_id"]]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {"test": 40, "dev": 36, "train": 324}


def test_param_grid_first_factor_fastest():
    g = param_grid((2, 4, 6), (50, 100, 300))
    assert [(x["tune_mtry"], x["lambda_nbh"]) for x in g[:4]] == [(2, 50), (4, 50), (6, 50), (2, 100)]
    assert len(g) == 9

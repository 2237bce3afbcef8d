"""Exact ranks and running sums over a total order, without a global window.

``Window.orderBy(...)`` with no partition moves every row into ONE task.
These helpers give the same exact numbers with bounded tasks:

1. every row gets an integer *bucket* that is monotone in the order
   (md5 prefix for hash orders, approximate-quantile cut points for
   numeric orders);
2. per-(partition, bucket) totals are aggregated (map-side combine, so
   one row per bucket and task is shuffled);
3. bucket offsets are a running sum over the small totals table, whose
   size is the bucket count, a parameter, not the data size;
4. rows get ``offset + running value inside their bucket``; the window is
   partitioned by bucket, so each task holds rows / buckets rows.

A hot partition value (say a third of all rows in one class) is spread
over all of its buckets, so it is never gathered in one task either.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows that one value bucket should hold, and the least number of buckets.
ROWS_PER_BUCKET, LEAST_BUCKETS = 1 << 20, 64


def buckets_for(n_rows: int) -> int:
    return max(LEAST_BUCKETS, -(-n_rows // ROWS_PER_BUCKET))


def quantile_buckets(df: DataFrame, col: str, out: str, n_buckets: int | None = None,
                     rel_err: float | None = None, descending: bool = False) -> DataFrame:
    """Add an integer bucket column monotone in ``col`` (ascending, or
    descending with ``descending=True``). Cut points are approximate
    quantiles: only the bucket SIZES are approximate, never the order.
    The number of buckets follows the row count, and about as many doubles
    reach the driver (a million rows a bucket: 8 MB for 10**12 rows).
    """
    n_buckets = n_buckets or buckets_for(df.count())
    rel_err = rel_err or 0.1 / n_buckets
    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = sorted(set(df.approxQuantile(col, probs, rel_err))) if probs else []
    splits = [float("-inf")] + [c for c in cuts if c == c] + [float("inf")]
    if len(splits) < 3:
        return df.withColumn(out, F.lit(0).cast("long"))
    tmp = f"__{out}_src"
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    res = b.transform(df.withColumn(tmp, F.col(col).cast("double"))).drop(tmp)
    sign = -1 if descending else 1
    return res.withColumn(out, (F.col(out) * sign).cast("long"))


def running_sums(df: DataFrame, bucket: str, order: Sequence[Column],
                 values: dict[str, Column], partition: Sequence[str] = (),
                 inclusive: bool = True) -> DataFrame:
    """Running sums of ``values`` within ``partition`` in ``order``.

    ``bucket`` names a column monotone in ``order``. With
    ``inclusive=False`` a row's sum covers only the rows strictly
    before it.
    """
    part = list(partition)
    src = df.select("*", *[v.alias(f"__v_{k}") for k, v in values.items()])
    totals = src.groupBy(*part, bucket).agg(
        *[F.sum(f"__v_{k}").alias(f"__t_{k}") for k in values])
    before = Window.partitionBy(*part).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(*part, bucket, *[
        F.coalesce(F.sum(f"__t_{k}").over(before), F.lit(0)).alias(f"__o_{k}") for k in values])
    inner = Window.partitionBy(*part, bucket).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    out = src.join(offsets, [*part, bucket])
    return out.select(
        *[c for c in df.columns],
        *[(F.col(f"__o_{k}") + F.coalesce(F.sum(f"__v_{k}").over(inner), F.lit(0))).alias(k)
          for k in values])


# ------------------------------------------------------- rank selection
#
# Splits, folds and samples only need the order keys at a few ranks. Counts
# per key prefix tell which prefix holds a rank, and only its rows are
# looked at closer: by the next characters of the key, then by row numbers.
# The flag of a row is then a comparison with the cut keys, so rows are
# neither joined, sorted nor copied.

_PREFIX = 4


def rank_cuts(df: DataFrame, key: Column, tie: str, ranks,
              partition: str | None = None) -> dict:
    """The order keys at given ranks: ``{partition value: (n, cuts)}`` where
    ``cuts[i]`` is the (key, tie) of the row at rank ``ranks[i](n)`` of the
    ``n`` rows of the partition, or None if there is none.

    ``key`` is hexadecimal text spread evenly (md5). Two rounds of prefix
    counts leave the rows that share eight characters with a cut key, about
    one in four billion, to be numbered. One row per partition value (a
    stratum, a class) reaches the driver, so that membership becomes a
    comparison with literals.
    """
    part = F.col(partition) if partition else F.lit(0)
    src = df.select(part.alias("__p"), key.alias("__k"), F.col(tie).alias("__t"))
    src = src.withColumns({"__b1": F.substring("__k", 1, _PREFIX), "__b2": F.substring("__k", _PREFIX + 1, _PREFIX)})

    def straddling(counts: DataFrame, within: list[str], bucket: str, first: bool) -> DataFrame:
        """Buckets that hold a rank, with the rank range (__lo, __hi]."""
        before = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
        lo = F.coalesce(F.sum("__c").over(before), F.lit(0)) + (F.lit(0) if first else F.col("__lo"))
        n = F.sum("__c").over(Window.partitionBy("__p")) if first else F.col("__n")
        st = counts.select(*within, bucket, lo.alias("__lo"), (lo + F.col("__c")).alias("__hi"), n.alias("__n"))
        hit = F.lit(False)
        for r in ranks:
            hit = hit | ((F.col("__lo") < r(F.col("__n"))) & (r(F.col("__n")) <= F.col("__hi")))
        return st.filter(hit).drop("__hi")

    one = straddling(src.groupBy("__p", "__b1").agg(F.count(F.lit(1)).alias("__c")), ["__p"], "__b1", True)
    two = src.join(one, ["__p", "__b1"]).groupBy("__p", "__b1", "__b2").agg(
        F.count(F.lit(1)).alias("__c"), F.first("__lo").alias("__lo"), F.first("__n").alias("__n"))
    two = straddling(two, ["__p", "__b1"], "__b2", False)
    inner = Window.partitionBy("__p", "__b1", "__b2").orderBy("__k", "__t")
    rows = src.join(two, ["__p", "__b1", "__b2"]).withColumn("__r", F.col("__lo") + F.row_number().over(inner))
    at = [F.max(F.when(F.col("__r") == r(F.col("__n")), F.struct("__k", "__t"))).alias(f"c{i}") for i, r in enumerate(ranks)]
    cuts = rows.groupBy("__p").agg(F.first("__n").alias("n"), *at).collect()
    return {r["__p"]: (r["n"], [r[f"c{i}"] and tuple(r[f"c{i}"]) for i in range(len(ranks))]) for r in cuts}


#: Cells into which a round of ``order_statistics`` divides a range.
CELLS = 4096


def order_statistics(df: DataFrame, value: str, ranks: Sequence[Callable[[int], int]]) -> tuple[int, list]:
    """``n`` and the values of numeric column ``value`` at exact ranks:
    ``ranks[i](n)`` of the ``n`` rows that have a value (from 1; None if
    there is no such rank).

    A round counts the rows of ``CELLS`` equal parts of a range of values,
    with the least and the largest value in each; the part that holds a rank
    is the next round's range, until it holds one value. So a round is one
    pass that returns at most ``CELLS`` rows a rank, whatever the data: no
    value is sampled, sorted or sent anywhere, and a value that a third of
    the rows share ends its search at once. Evenly spread values of 10^12
    rows take four rounds."""
    rows = df.select(F.col(value).alias("__y")).filter("__y is not null")
    n, low, high = rows.agg(F.count(F.lit(1)), F.min("__y"), F.max("__y")).first()
    wanted = [r(n) for r in ranks]
    found: list = [None] * len(wanted)
    # Open ranges of values: the rows before it, and the ranks it holds.
    spans = {(low, high): (0, [i for i, r in enumerate(wanted) if 1 <= r <= n])} if n else {}
    while spans := {k: v for k, v in spans.items() if v[1]}:
        for (lo, hi), (_, held) in spans.items():
            for i in held if lo == hi else ():
                found[i] = lo
        spans = {k: v for k, v in spans.items() if k[0] != k[1]}
        if not spans:
            break
        span, cell = F.lit(None).cast("int"), F.lit(None).cast("long")
        for k, (lo, hi) in enumerate(spans):
            wide = isinstance(lo, int) and hi - lo >= 1 << 62
            y, at, width = (F.col("__y").cast("double"), float(lo), float(hi) - float(lo)) if wide else (F.col("__y"), lo, hi - lo)
            inside = F.col("__y").between(lo, hi)
            part = F.least(F.floor((y - F.lit(at)).cast("double") / F.lit(float(width)) * CELLS), F.lit(CELLS - 1))
            span, cell = F.when(inside, k).otherwise(span), F.when(inside, part).otherwise(cell)
        counts = rows.select("__y", span.alias("s"), cell.alias("c")).filter("s is not null").groupBy("s", "c").agg(
            F.count(F.lit(1)).alias("rows"), F.min("__y").alias("lo"), F.max("__y").alias("hi")).collect()
        after: dict = {}
        for k, (before, held) in enumerate(spans.values()):
            for r in sorted((r for r in counts if r["s"] == k), key=lambda r: r["c"]):
                own = [i for i in held if before < wanted[i] <= before + r["rows"]]
                if own:
                    after[(r["lo"], r["hi"])] = (before, own)
                before += r["rows"]
        spans = after
    return n, found

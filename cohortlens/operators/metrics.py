"""Evaluation: exact ROC curve and AUC, confusion statistics, cut-offs.

The ROC is built aggregate-first: one row per distinct score (tied
scores share a point), then descending running sums from
``operators.ordering`` (bucketed, never a single-task window). The AUC is
the trapezoid rule written without ``lag``:

    AUC = sum_i neg_i * (tp_before_i + pos_i / 2) / (P * N)

which is the area under the step/trapezoid curve through the points
(fp, tp) in descending score order, and equals the Mann-Whitney
statistic with ties counted one half.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import as_flag, rounded
from cohortlens.functions.stats import binom_ci, binom_sf_ge, chi2_sf_1df
from cohortlens.operators.ordering import quantile_buckets, running_sums
from cohortlens.session import materialize


def roc_table(scored: DataFrame, score: str, label: str,
              partition: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """``(partition..., threshold, pos, neg, tp, fp, P, N)`` per distinct score,
    with tp/fp counting rows whose score is >= threshold. Rows without a
    score or a label count nowhere, as in ``confusion_at_cutoffs``."""
    part = list(partition)
    scored = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    pts = scored.groupBy(*part, F.col(score).cast("double").alias("threshold")).agg(
        F.sum(as_flag(label)).cast("long").alias("pos"),
        F.sum(1 - as_flag(label)).cast("long").alias("neg"))
    # One row per distinct score: small next to the rows. Written once, so
    # the cut-point pass and the running sums do not both re-run the plan
    # that produced the scores.
    pts = materialize(pts)
    pts = quantile_buckets(pts, "threshold", "__b", n_buckets, descending=True)
    cum = running_sums(pts, "__b", [F.col("threshold").desc()],
                       {"tp": F.col("pos"), "fp": F.col("neg")}, part).drop("__b")
    totals = pts.groupBy(*part).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    if part:
        # one row per partition value (folds, grid cells): a bounded table
        return cum.join(F.broadcast(totals), part)
    t = totals.select(F.struct("P", "N").alias("t")).scalar()
    return cum.withColumns({"P": t.getField("P"), "N": t.getField("N")})


def roc_curve(scored: DataFrame, score: str, label: str,
              partition: Sequence[str] = ()) -> DataFrame:
    """ROC points ``(threshold, tp, fp, tpr, fpr)``: predicting positive
    when ``score >= threshold``."""
    t = roc_table(scored, score, label, partition)
    return t.select(*partition, "threshold", "tp", "fp",
                    rounded(F.col("tp") / F.col("P")).alias("tpr"),
                    rounded(F.col("fp") / F.col("N")).alias("fpr"))


def roc_auc(scored: DataFrame, score: str, label: str,
            partition: Sequence[str] = (), name: str = "auc") -> DataFrame:
    """Exact ROC AUC (ties count one half); NULL when a class is absent."""
    t = roc_table(scored, score, label, partition)
    area = F.col("neg") * ((F.col("tp") - F.col("pos")) + F.col("pos") / F.lit(2.0))
    agg = t.groupBy(*partition).agg(F.sum(area).alias("__a"), F.first("P").alias("P"),
                                    F.first("N").alias("N"))
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0),
                 F.col("__a") / (F.col("P").cast("double") * F.col("N")))
    return agg.select(*partition, rounded(auc).alias(name))


def confusion_counts(scored: DataFrame, score: str, label: str, cutoff: float,
                     partition: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn for ``predicted = score > cutoff`` (one aggregate).

    ``score > cutoff`` is the two-class rule "largest vote / cutoff wins"
    with cutoffs (1 - c, c) for a probability score."""
    pred = F.col(score) > F.lit(cutoff)
    y = F.col(label).cast("boolean")
    def n(c):
        return F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return scored.groupBy(*partition).agg(
        n(pred & y).alias("tp"), n(pred & ~y).alias("fp"),
        n(~pred & y).alias("fn"), n(~pred & ~y).alias("tn"))


def _ratio(a, b):
    return F.when(b != 0, a.cast("double") / b)


def confusion_stats_columns(tp="tp", fp="fp", fn="fn", tn="tn") -> list:
    """Statistics of a 2x2 table with the positive class as event."""
    tp, fp, fn, tn = (F.col(c) for c in (tp, fp, fn, tn))
    n = tp + fp + fn + tn
    acc = _ratio(tp + tn, n)
    pe = _ratio((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    sens, spec = _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    ppv, npv = _ratio(tp, tp + fp), _ratio(tn, tn + fn)
    f1 = F.when((ppv + sens) > 0, 2 * ppv * sens / (ppv + sens))
    mcn = F.when(fp + fn > 0, (F.abs(fp - fn) - 1) ** 2 / (fp + fn).cast("double"))
    return [
        rounded(acc).alias("accuracy"),
        rounded(F.when((tp + fn) > (fp + tn), tp + fn).otherwise(fp + tn) / n).alias("no_information_rate"),
        rounded(F.when(pe < 1, (acc - pe) / (1 - pe))).alias("kappa"),
        rounded(sens).alias("sensitivity"), rounded(spec).alias("specificity"),
        rounded(ppv).alias("ppv"), rounded(npv).alias("npv"), rounded(f1).alias("f1"),
        rounded(_ratio(tp + fn, n)).alias("prevalence"),
        rounded(_ratio(tp, n)).alias("detection_rate"),
        rounded(_ratio(tp + fp, n)).alias("detection_prevalence"),
        rounded((sens + spec) / 2).alias("balanced_accuracy"),
        rounded(mcn).alias("mcnemar_statistic"),
    ]


def confusion_at_cutoffs(scored: DataFrame, score: str, label: str,
                         cutoffs: Sequence[float], partition: Sequence[str] = ()) -> DataFrame:
    """One row per cut-off: the four counts and their statistics.

    All cut-offs come from ONE pass: the counts per cut-off are
    conditional sums in the same aggregate, then unpivoted."""
    y = F.col(label).cast("boolean")
    aggs = []
    for i, c in enumerate(cutoffs):
        pred = F.col(score) > F.lit(float(c))
        for nm, cond in (("tp", pred & y), ("fp", pred & ~y), ("fn", ~pred & y), ("tn", ~pred & ~y)):
            aggs.append(F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(f"{nm}{i}"))
    wide = scored.groupBy(*partition).agg(*aggs)
    parts = ", ".join(f"CAST({float(c)!r} AS DOUBLE), tp{i}, fp{i}, fn{i}, tn{i}"
                      for i, c in enumerate(cutoffs))
    long = wide.select(*partition, F.expr(f"stack({len(cutoffs)}, {parts}) as (cutoff, tp, fp, fn, tn)"))
    return long.select(*partition, "cutoff", "tp", "fp", "fn", "tn", *confusion_stats_columns())


def confusion_tests(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """Accuracy interval (Clopper-Pearson 95%), P[accuracy > no-information
    rate] and the McNemar p-value per row of a counts table.

    The counts table has one row per cut-off (bounded); the special
    functions run on the driver over those few rows.
    """
    rows = counts.select("cutoff", "tp", "fp", "fn", "tn").collect()
    out = []
    for r in rows:
        n = r.tp + r.fp + r.fn + r.tn
        correct = r.tp + r.tn
        lo, hi = binom_ci(correct, n) if n else (None, None)
        nir = max(r.tp + r.fn, r.fp + r.tn) / n if n else None
        p_acc = binom_sf_ge(correct, n, nir) if n else None
        b = r.fp + r.fn
        p_mc = chi2_sf_1df((abs(r.fp - r.fn) - 1) ** 2 / b) if b else None
        out.append((float(r.cutoff), r.tp, r.fp, r.fn, r.tn,
                    None if lo is None else round(lo, 6), None if hi is None else round(hi, 6),
                    None if p_acc is None else round(p_acc, 6),
                    None if p_mc is None else round(p_mc, 6)))
    schema = ("cutoff double, tp long, fp long, fn long, tn long, accuracy_lower double, "
              "accuracy_upper double, accuracy_p_value double, mcnemar_p_value double")
    return spark.createDataFrame(out, schema)


def cutoff_search(scored: DataFrame, score: str, label: str,
                  min_sensitivity: float = 0.5, min_ppv: float = 0.75) -> DataFrame:
    """Cut-offs for a target: the highest threshold reaching
    ``min_sensitivity``, and the threshold with the best sensitivity among
    those with precision >= ``min_ppv`` (ties: the higher threshold).
    Predict positive when ``score >= threshold``."""
    t = roc_table(scored, score, label).select(
        "threshold", "tp", "fp",
        (F.col("tp") / F.col("P")).alias("tpr"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("ppv"))
    a = (t.filter(F.col("tpr") >= min_sensitivity)
          .agg(F.max_by(F.struct("threshold", "tpr", "ppv"), F.col("threshold")).alias("r"))
          .select(F.lit("sensitivity").alias("target"), F.lit(float(min_sensitivity)).alias("goal"), "r.*"))
    b = (t.filter(F.col("ppv") >= min_ppv)
          .agg(F.max_by(F.struct("threshold", "tpr", "ppv"), F.struct("tpr", "threshold")).alias("r"))
          .select(F.lit("ppv").alias("target"), F.lit(float(min_ppv)).alias("goal"), "r.*"))
    return a.unionByName(b).select("target", "goal", "threshold", rounded("tpr").alias("tpr"),
                                   rounded("ppv").alias("ppv"))


def two_class_summary(scored: DataFrame, score: str, label: str,
                      partition: Sequence[str] = ("fold",)) -> DataFrame:
    """Per group: ROC AUC, and Sens / Spec at 0.5 with the NEGATIVE class
    as the event (the first factor level), as in a two-class summary:
    Sens = TN / (TN + FP), Spec = TP / (TP + FN)."""
    auc = roc_auc(scored, score, label, partition, name="roc")
    cm = confusion_counts(scored, score, label, 0.5, partition)
    cm = cm.select(*partition, rounded(_ratio(F.col("tn"), F.col("tn") + F.col("fp"))).alias("sens"),
                   rounded(_ratio(F.col("tp"), F.col("tp") + F.col("fn"))).alias("spec"))
    return auc.join(cm, list(partition))

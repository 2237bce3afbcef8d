"""The query catalogue: one callable ``(spark, base_dir) -> DataFrame`` per
operator key. Every entry reads the given tables (through the
appointments view or directly), so its work grows with them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlens.operators import inspect, profile as P
from cohortlens.session import checkpoint_dir, materialize, scratch, spread
from cohortlens.sources import appointments
from cohortlens.sources.csv import read_raw_csv, recode, to_raw, write_raw_csv
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def _on_view(fn) -> Query:
    return lambda spark, d: fn(appointments(spark, d))


def _on_valid(fn) -> Query:
    """Steps after the age filter."""
    return lambda spark, d: fn(P.valid_age(appointments(spark, d)))


def _same_day_bias(spark: SparkSession, d: str) -> DataFrame:
    """Rows after the age filter against the rate from before it."""
    view = appointments(spark, d)
    before = view.agg(F.avg(F.col("no_show").cast("int")).alias("base_rate"))
    return P.bias_by_same_day_visits(P.valid_age(view), base_rate=before)


def _scan_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Write the view in the raw CSV layout to the shared checkpoint
    folder, read it back with the fixed schema and recode it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    write_raw_csv(appointments(spark, d), path)
    return recode(read_raw_csv(spark, path))


def _recode_types(spark: SparkSession, d: str) -> DataFrame:
    typed = recode(to_raw(appointments(spark, d)))
    return typed.withColumn("no_show_label", F.when(F.col("no_show"), "Yes").otherwise("No"))


PROFILE_QUERIES: dict[str, Query] = {
    "overall_rate": _on_view(P.overall_rate),
    "distinct_counts": _on_view(P.distinct_counts),
    "corr_id_time": _on_view(P.corr_id_time),
    "time_span": _on_view(P.time_span),
    "age_range": _on_view(P.age_range),
    "appointment_timeline": _on_view(P.appointment_timeline),
    "visits_per_entity": _on_view(P.visits_per_entity),
    "visits_per_entity_day": _on_view(P.visits_per_entity_day),
    "visits_per_entity_cumulative": _on_view(P.visits_per_entity_cumulative),
    "rate_by_visit_bucket": _on_view(P.rate_by_visit_bucket),
    "distinct_profiles": _on_view(P.distinct_profiles),
    "entity_attribute_drift": _on_view(P.entity_attribute_drift),
    "latest_row_per_entity": _on_view(P.latest_row_per_entity),
    "count_by_gender": _on_view(P.count_by_gender),
    "rate_by_gender": _on_view(P.rate_by_gender),
    "rate_by_age_band": _on_view(P.rate_by_age_band),
    "rate_by_date": _on_valid(P.rate_by_date),
    "rate_by_days_between": _on_valid(P.rate_by_days_between),
    "rate_by_weekday": _on_valid(P.rate_by_weekday),
    "sms_effect": _on_valid(P.sms_effect),
    "bias_by_same_day_visits": _same_day_bias,
    "top5_groups": _on_valid(lambda df: P.top_groups(df, 5)),
    "bottom5_groups": _on_valid(lambda df: P.top_groups(df, 5, ascending=True)),
    "group_rate_extremes": _on_valid(P.group_rate_extremes),
    "hist_age_binwidth": _on_view(P.hist_age_binwidth),
    "hist_age_30bins": _on_view(P.hist_age_30bins),
    "preview": _on_view(lambda df: inspect.preview(df, "appointment_id", 10)),
    "profile_columns": _on_view(lambda df: inspect.profile_columns(df, ("gender", "neighbourhood", "handcap"))),
    "completeness_check": _on_view(inspect.completeness_check),
    "recode_types": _recode_types,
    "scan_csv_roundtrip": _scan_csv_roundtrip,
}

QUERIES: dict[str, Query] = {}
QUERIES.update(PROFILE_QUERIES)


# ------------------------------------------------------ splits / encoders

from cohortlens.functions import days_between as _days_between  # noqa: E402
from cohortlens.functions import epoch_seconds as _epoch  # noqa: E402
from cohortlens.functions import rounded as _rounded  # noqa: E402
from cohortlens.operators import encode as ENC  # noqa: E402
from cohortlens.operators import metrics as MET  # noqa: E402
from cohortlens.operators import split as SPL  # noqa: E402
from cohortlens.operators.contrasts import fit_contrasts  # noqa: E402
from cohortlens.sources.bucketed import write_bucketed  # noqa: E402
from cohortlens.plans.estimator import FeatureEncoder, FeatureEncoderModel  # noqa: E402
from cohortlens.plans.features import FeaturePlan, design_columns, variant_frame, variant_plan  # noqa: E402


def _holdout(spark, d):
    return SPL.holdout_split(appointments(spark, d), p=0.1, seed=1)


def _holdout_split(spark, d):
    return _holdout(spark, d).select("appointment_id", "stratum", "in_holdout")


def _holdout_split_anti(spark, d):
    view = appointments(spark, d)
    test = SPL.holdout_split(view).filter("in_holdout").select("appointment_id")
    return SPL.holdout_complement(view, test)


def _three_way(spark, d):
    return SPL.three_way_split(appointments(spark, d), 0.1, 0.1, seed=1)


def _recombine(spark, d):
    s = _three_way(spark, d)
    train = s.filter(F.col("split") == "train")
    dev = s.filter(F.col("split") == "dev")
    return SPL.recombine(train, dev).select("appointment_id", "split")


def _kfold(spark, d):
    return SPL.kfold_assign(appointments(spark, d), folds=10, seed=1).select("appointment_id", "fold")


def _balanced(spark, d):
    return SPL.balanced_sample(appointments(spark, d), 500, seed=1).select("appointment_id", "no_show")


def _bias_per_group(spark, d):
    enc = ENC.fit_target_encoder(appointments(spark, d), "neighbourhood", 15, "bias_per_nbh")
    return enc.select("neighbourhood", _rounded("bias_per_nbh").alias("bias_per_nbh"))


def _bias_per_entity(spark, d):
    enc = ENC.fit_target_encoder(appointments(spark, d), "patient_id", 4, "bias_per_patient")
    return enc.select("patient_id", _rounded("bias_per_patient").alias("bias_per_patient"))


def _natural_left_join(spark, d):
    view = appointments(spark, d)
    return ENC.natural_left_join(view, P.visits_per_entity_day(view))


def feature_matrix(spark, d, lambda_nbh: int = 50):
    """Encoders fitted on the training rows (not held out, valid age),
    applied to these and to all holdout rows."""
    split = _holdout(spark, d).drop("stratum").filter(F.col("in_holdout") | (F.col("age") >= 0))
    train = split.filter(~F.col("in_holdout"))
    fitted = FeaturePlan(lambda_nbh=lambda_nbh).fit(train)
    return fitted.transform(split)


def _feature_matrix(spark, d):
    fm = feature_matrix(spark, d)
    return fm.withColumn("bias_per_nbh", _rounded("bias_per_nbh"))


def _oof_split(spark, d):
    """The rows of ``feature_matrix``, its training rows with a fold."""
    split = materialize(_holdout(spark, d).drop("stratum").filter(F.col("in_holdout") | (F.col("age") >= 0)))
    train = SPL.kfold_assign(split.filter(~F.col("in_holdout")), folds=10, seed=1)
    return train, split.filter("in_holdout")


def _feature_matrix_oof(spark, d):
    """Training rows encoded by the other nine folds, holdout rows by all."""
    train, test = _oof_split(spark, d)
    fitted = FeatureEncoder(lambdaNbh=50, mode="oof").fit(train)
    fm = fitted.transform(train.unionByName(test, allowMissingColumns=True))
    return fm.withColumn("bias_per_nbh", _rounded("bias_per_nbh"))


def _feature_matrix_saved(spark, d):
    """``feature_matrix`` from an encoder that was saved and loaded."""
    split = materialize(_holdout(spark, d).drop("stratum").filter(F.col("in_holdout") | (F.col("age") >= 0)))
    path = f"{checkpoint_dir(spark).rstrip('/')}/encoder-{uuid.uuid4().hex}"
    FeatureEncoder(lambdaNbh=50).fit(split.filter(~F.col("in_holdout"))).save(path)
    fm = FeatureEncoderModel.load(path).transform(split)
    return fm.withColumn("bias_per_nbh", _rounded("bias_per_nbh"))


def _feature_sink(spark, d):
    """The feature matrix kept as a table bucketed by patient, joined with
    every patient's visits, bucketed alike: no row is shuffled for it."""
    name = f"features_{uuid.uuid4().hex}"
    features = write_bucketed(feature_matrix(spark, d), name, "patient_id", spread_by="appointment_id")
    visits = write_bucketed(P.visits_per_entity(appointments(spark, d)), f"visits_{name}", "patient_id")
    joined = features.join(visits.hint("merge"), "patient_id")
    return joined.withColumn("bias_per_nbh", _rounded("bias_per_nbh"))


def _design_matrix_contrasts(spark, d):
    """RF7 predictors as doubles, its three-level reminder status and the
    booking's weekday as 0/1 columns, levels fitted on the training rows."""
    split = materialize(_holdout(spark, d).drop("stratum").filter(F.col("in_holdout") | (F.col("age") >= 0)))
    plan, extra = variant_plan("RF7")
    weekday = F.dayofweek("scheduled_ts").cast("string")
    train = split.filter(~F.col("in_holdout"))
    fm = variant_frame(plan.fit(train), split.withColumn("weekday", weekday), extra)
    levels = fit_contrasts(fm.filter(~F.col("in_holdout")), ["sms_received", "weekday"])
    out = levels.transform(fm)
    kept = ("appointment_id", "in_holdout", "no_show")
    types = dict(out.dtypes)
    cols = [_rounded(_epoch(c) if types[c].startswith("timestamp") else F.col(c).cast("double")).alias(c) for c in out.columns if c not in kept]
    return out.select("appointment_id", *cols, F.col("no_show").cast("double").alias("label"))


def _design_matrix(spark, d):
    """RF9 predictors as doubles (timestamps as epoch seconds, flags 0/1)."""
    fm = feature_matrix(spark, d, lambda_nbh=15)
    cols = []
    for c in design_columns(fm):
        if c == "in_holdout":
            continue
        t = dict(fm.dtypes)[c]
        e = _epoch(c) if t.startswith("timestamp") else F.col(c).cast("double")
        cols.append(_rounded(e).alias(c))
    return fm.select("appointment_id", *cols, F.col("no_show").cast("double").alias("label"))


def _oof(spark, d):
    folds = SPL.kfold_assign(appointments(spark, d), folds=10, seed=1)
    enc = ENC.oof_target_encode(folds, "neighbourhood", 100, "bias_per_nbh")
    return enc.select("appointment_id", "fold", _rounded("bias_per_nbh").alias("bias_per_nbh"))


def scored_by_days(spark, d):
    """A fixed, model-free score: the outcome rate of the row's day gap."""
    view = appointments(spark, d).withColumn(
        "days_between", _days_between("appointment_day", "scheduled_ts"))
    rates = view.groupBy("days_between").agg(
        F.avg(F.col("no_show").cast("int")).alias("score"))
    return view.join(rates, "days_between")


def _roc_curve(spark, d):
    view = appointments(spark, d).withColumn(
        "days_between", _days_between("appointment_day", "scheduled_ts"))
    return MET.roc_curve(view, "days_between", "no_show")


def _roc_auc(spark, d):
    view = appointments(spark, d).withColumn(
        "days_between", _days_between("appointment_day", "scheduled_ts"))
    return MET.roc_auc(view, "days_between", "no_show")


def _confusion(spark, d):
    return MET.confusion_at_cutoffs(scored_by_days(spark, d), "score", "no_show", [0.32, 0.55])


def _confusion_stats(spark, d):
    counts = MET.confusion_at_cutoffs(scored_by_days(spark, d), "score", "no_show", [0.32, 0.55])
    return MET.confusion_tests(spark, counts)


def _cutoff_search(spark, d):
    return MET.cutoff_search(scored_by_days(spark, d), "score", "no_show", 0.5, 0.75)


def _two_class(spark, d):
    s = scored_by_days(spark, d)
    s = SPL.kfold_assign(s, folds=10, seed=1)
    return MET.two_class_summary(s, "score", "no_show", ["fold"])


MODEL_FREE_QUERIES: dict[str, Query] = {
    "holdout_split": _holdout_split,
    "holdout_split_anti": _holdout_split_anti,
    "three_way_split": lambda s, d: _three_way(s, d).select("appointment_id", "split"),
    "recombine_splits": _recombine,
    "kfold_assign": _kfold,
    "balanced_sample": _balanced,
    "bias_per_group": _bias_per_group,
    "bias_per_entity": _bias_per_entity,
    "natural_left_join": _natural_left_join,
    "feature_matrix": _feature_matrix,
    "feature_matrix_oof": _feature_matrix_oof,
    "feature_matrix_saved": _feature_matrix_saved,
    "feature_sink_bucketed": _feature_sink,
    "design_matrix_contrasts": _design_matrix_contrasts,
    "design_matrix": _design_matrix,
    "oof_target_encode": _oof,
    "roc_curve": _roc_curve,
    "roc_auc": _roc_auc,
    "confusion_at_cutoff": _confusion,
    "confusion_stats": _confusion_stats,
    "cutoff_search": _cutoff_search,
    "two_class_summary": _two_class,
}
QUERIES.update(MODEL_FREE_QUERIES)


# ----------------------------------------------------------------- models

from cohortlens.operators import knn as KNN  # noqa: E402
from cohortlens.operators import models as MOD  # noqa: E402
from cohortlens.plans import tune as TUNE  # noqa: E402
from cohortlens.sources import read_table  # noqa: E402


def train_dev(spark, d):
    """The three-way split's train rows with a valid age and all its dev
    rows (test is never touched)."""
    s = spread(_three_way(spark, d))
    train = P.valid_age(s.filter(F.col("split") == "train").drop("split"))
    dev = s.filter(F.col("split") == "dev").drop("split")
    return train, dev


# Trees of the registered forest queries. The operators default to the
# original's 500; one such fit takes minutes on a single machine, and the
# tuning query alone makes ninety.
TREES, TREES_TUNE, TREES_OOB, TREES_BAG, TREES_SWEEP = 100, 20, 150, 20, 150


def _variant(spark, d, name, **plan_kw):
    train, dev = train_dev(spark, d)
    plan, extra = variant_plan(name, **plan_kw)
    fitted = plan.fit(train)
    # Model fits pass over their input several times (split search,
    # bagging, levels): keep the joined feature rows instead of re-joining.
    tr = spread(variant_frame(fitted, train, extra))
    dv = materialize(variant_frame(fitted, dev, extra))
    return tr, dv, design_columns(tr)


def _model_logreg(spark, d):
    tr, dv, cols = _variant(spark, d, "GLM")
    model = MOD.fit_logreg(tr, cols)
    return MET.roc_auc(model.score(dv), "prob", "label").select(F.lit("GLM").alias("model"), "auc")


def _model_rf(spark, d):
    tr, dv, cols = _variant(spark, d, "RF9")
    model = MOD.fit_rf(tr, cols, num_trees=TREES, seed=1)
    return MET.roc_auc(model.score(dv), "prob", "label").select(F.lit("RF9").alias("model"), "auc")


def _model_rf_balanced(spark, d):
    tr, dv, cols = _variant(spark, d, "RF10")
    model = MOD.fit_rf_balanced(tr, cols, n_per_class=500, trees_per_bag=TREES_BAG)
    return MET.roc_auc(model.score(dv), "prob", "label").select(F.lit("RF10").alias("model"), "auc")


def _oob(spark, d):
    tr, _, cols = _variant(spark, d, "RF2")
    return MOD.oob_scores(tr, cols, num_trees=TREES_OOB)


def _importance(spark, d):
    tr, _, cols = _variant(spark, d, "RF9")
    model = MOD.fit_rf(tr, cols, num_trees=TREES, seed=1)
    return MOD.rf_importance(spark, model)


def _non_test(spark, d):
    """Rows to learn from (valid age) and the untouched, unfiltered test rows."""
    s = spread(_three_way(spark, d))
    rest = P.valid_age(s.filter(F.col("split") != "test").drop("split"))
    return rest, s.filter(F.col("split") == "test").drop("split")


def _tune_grid(spark, d):
    rest, _ = _non_test(spark, d)
    return TUNE.summarise_grid(TUNE.tune_grid(spark, rest, folds=10, num_trees=TREES_TUNE, max_depth=8))


def _tune_grid_best(spark, d):
    return TUNE.best_params(_tune_grid(spark, d))


def _final_model(spark, d):
    rest, test = _non_test(spark, d)
    return TUNE.final_model(rest, test, lambda_nbh=50, tune_mtry=4, num_trees=TREES)


def _embeddings(spark, d):
    return read_table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").alias("v"))


def _knn_join(spark, d):
    e = _embeddings(spark, d)
    nb = KNN.knn_join(e, e, 5, "vec_id", "vec_id", label="label", exclude_self=True)
    return nb.select("query_id", "neighbour_id", "distance")


def _knn_classify(spark, d):
    e = _embeddings(spark, d)
    nb = KNN.knn_join(e, e, 5, "vec_id", "vec_id", label="label", exclude_self=True)
    return KNN.knn_majority(nb)


KNN5_COLS = ["gender", "scheduled_ts", "appointment_day", "age", "scholarship", "hipertension",
             "diabetes", "alcoholism", "handcap", "sms_received"]


def _knn_join_approx(spark, d):
    """Every row whose id is divisible by 20 against all rows."""
    e = _embeddings(spark, d)
    nb = KNN.approx_knn_join(e.filter("vec_id % 20 = 0"), e, 5, "vec_id", "vec_id", label="label", exclude_self=True)
    return nb.select("query_id", "neighbour_id", "distance")


def _cv_auc(data, ks, **kw):
    """10 folds, neighbours from the other folds, all k from one neighbour
    list; mean fold AUC per k."""
    probs = KNN.cv_knn_join(data, max(ks), "appointment_id", "no_show", digits=6, ks=ks, **kw)
    lab = data.select(F.col("appointment_id").alias("query_id"), "fold", "no_show")
    scored = probs.join(lab, "query_id")
    per_fold = MET.roc_auc(scored, "prob", "no_show", partition=["k", "fold"], name="roc")
    return per_fold.groupBy("k").agg(_rounded(F.avg("roc")).alias("roc"))


def _knn_cv(spark, d, ks=(25, 35, 45)):
    """KNN5 columns, 10 folds over the non-test rows: on the columns as they
    are, and standardised by each fold's training rows."""
    rest, _ = _non_test(spark, d)
    data = materialize(KNN.to_vector(SPL.kfold_assign(rest, 10, seed=1), KNN5_COLS).select("appointment_id", "no_show", "fold", "v"))
    both = [_cv_auc(data, ks, standardize=s).withColumn("standardized", F.lit(s)) for s in (False, True)]
    return both[0].unionByName(both[1])


# The numbers of neighbours tried for each KNN variant.
KNN_KS = {"KNN1": (35,), "KNN2": (35,), "KNN3": (35,), "KNN4": (25, 35, 45), "KNN5": (25, 35, 45)}


def _knn_models(spark, d, variants=tuple(KNN_KS)):
    """Each KNN variant: mean fold AUC per k on the training rows, the best
    k (ties: the smaller) and the AUC of the dev rows with it."""
    rows = []
    with scratch(spark):
        train, dev = train_dev(spark, d)
        for name in variants:
            ks = KNN_KS[name]
            plan, extra = variant_plan(name)
            with scratch(spark):  # a variant leaves a few numbers
                fitted = plan.fit(train)
                tr, dv = variant_frame(fitted, train, extra), variant_frame(fitted, dev, extra)
                cols = design_columns(tr)
                tr, dv = (materialize(KNN.to_vector(x, cols).select("appointment_id", "no_show", "v")) for x in (tr, dv))
                with scratch(spark):
                    cv = {r["k"]: r["roc"] for r in _cv_auc(SPL.kfold_assign(tr, 10, seed=1), ks).collect()}  # a row for each k
                best = min(cv, key=lambda k: (cv[k] is None, -(cv[k] or 0.0), k))
                probs = KNN.knn_join(dv, tr, best, "appointment_id", "appointment_id", label="no_show", digits=6, ks=(best,))
                scored = probs.join(dv.select(F.col("appointment_id").alias("query_id"), "no_show"), "query_id")
                auc = MET.roc_auc(scored, "prob", "no_show").first()["auc"]
            rows += [(name, k, cv[k], k == best, auc if k == best else None) for k in sorted(cv)]
    return spark.createDataFrame(rows, "variant string, k int, cv_auc double, best boolean, dev_auc double")


MODEL_QUERIES: dict[str, Query] = {
    "model_logreg": _model_logreg,
    "model_rf": _model_rf,
    "model_rf_balanced": _model_rf_balanced,
    "oob_scores": _oob,
    "rf_importance": _importance,
    "tune_grid": _tune_grid,
    "tune_grid_best": _tune_grid_best,
    "final_model": _final_model,
    "knn_join": _knn_join,
    "knn_classify": _knn_classify,
    "knn_join_approx": _knn_join_approx,
    "knn_cv": _knn_cv,
    "knn_models": _knn_models,
}
QUERIES.update(MODEL_QUERIES)


# ------------------------------------------- the same operators, other tables
#
# The operators take column roles, so they run unchanged on the largest
# table (lineitem, joined to its orders: entity = customer, booking = order
# date, event day = ship date, outcome = returned line) and on documents
# with their quality / toxicity labels (an imbalanced second label).

def shipments(spark, d):
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_shipdate")
    od = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
              .select("l_orderkey", "l_suppkey", "o_custkey", "o_orderdate", "l_shipdate",
                      (F.col("l_returnflag") == "R").alias("returned")))


def labelled_documents(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = read_table(spark, d, "labels")
    return docs.join(labels, "doc_id").select(
        "doc_id", "lang", "source", "n_chars",
        (F.col("quality") == 1).alias("quality"), (F.col("toxic") == 1).alias("toxic"))


def _ship_days(spark, d):
    return P.rate_by_days_between(shipments(spark, d), booked="o_orderdate", day="l_shipdate",
                                  label="returned")


def _ship_same_day(spark, d):
    return P.bias_by_same_day_visits(shipments(spark, d), entity="o_custkey", day="l_shipdate",
                                     label="returned")


def _ship_extremes(spark, d):
    return P.group_rate_extremes(shipments(spark, d), group="l_suppkey", label="returned")


def _ship_cumulative(spark, d):
    return P.visits_per_entity_cumulative(shipments(spark, d), entity="o_custkey")


def _ship_auc(spark, d):
    s = shipments(spark, d).withColumn("days_between", _days_between("l_shipdate", "o_orderdate"))
    return MET.roc_auc(s, "days_between", "returned")


def _doc_rates(spark, d):
    return P.rate_by(labelled_documents(spark, d), ["lang", "source"], label="quality",
                     with_count=True)


def _doc_quality_auc(spark, d):
    return MET.roc_auc(labelled_documents(spark, d), "n_chars", "quality")


def _doc_toxic_confusion(spark, d):
    docs = labelled_documents(spark, d)
    rates = docs.groupBy("lang", "source").agg(F.avg(F.col("toxic").cast("int")).alias("score"))
    return MET.confusion_at_cutoffs(docs.join(rates, ["lang", "source"]), "score", "toxic",
                                    [0.05, 0.1])


OTHER_TABLE_QUERIES: dict[str, Query] = {
    "ship_rate_by_days_between": _ship_days,
    "ship_bias_by_same_day": _ship_same_day,
    "ship_group_rate_extremes": _ship_extremes,
    "ship_visits_cumulative": _ship_cumulative,
    "ship_roc_auc": _ship_auc,
    "doc_quality_rate_by_group": _doc_rates,
    "doc_quality_roc_auc": _doc_quality_auc,
    "doc_toxic_confusion": _doc_toxic_confusion,
}
QUERIES.update(OTHER_TABLE_QUERIES)


def _feature_variants(spark, d):
    """Every feature-set variant on the train split: its predictors in
    order, with their means over the training rows."""
    train, _ = train_dev(spark, d)
    return SWEEP.variant_means(train)


def _model_sweep(spark, d):
    """Out-of-bag and dev AUC of the logistic regression and of every
    forest variant."""
    train, dev = train_dev(spark, d)
    return SWEEP.model_sweep(spark, train, dev, ["GLM", *[f"RF{k}" for k in range(1, 11)]], num_trees=TREES_SWEEP)


from cohortlens.plans import sweep as SWEEP  # noqa: E402

QUERIES["feature_variants"] = _feature_variants
QUERIES["model_sweep"] = _model_sweep

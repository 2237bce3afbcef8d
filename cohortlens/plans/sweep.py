"""All feature-set variants from one superset of columns.

The encoders of every variant are fitted in one scan (``folded.fit_folds``
with all training rows in one fold, so nothing is left out of new rows), and
each row gets one vector of all columns. A variant is a slice of it
(``VectorSlicer``): no variant fits, joins or assembles anything again.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import days_between, epoch_seconds, rounded, sms_status
from cohortlens.operators import forest
from cohortlens.operators import roles as R
from cohortlens.operators.contrasts import Contrasts, contrast_name
from cohortlens.operators.metrics import roc_auc
from cohortlens.operators.models import bag_weight, bag_weights, mtry_default, poisson1_weight, rf_estimator
from cohortlens.operators.split import balanced_flag
from cohortlens.plans.features import VARIANTS
from cohortlens.plans.folded import fit_folds
from cohortlens.session import fits_at_once, materialize, spread

# Predictors of the table itself, in order, and the levels of
# the reminder status.
RAW = ("patient_id", "gender", "scheduled_ts", "appointment_day", "age", "scholarship", "hipertension", "diabetes",
       "alcoholism", "handcap", "sms_received")
SMS_LEVELS = ("does_not_apply", "no", "yes")
DATE_PARTS = ("days_between", "wday_sched", "wday_app", "hour_sched")
COUNTS = ("nbr_app_per_patient", "nbr_app_that_day")
_STATUS = [contrast_name(R.SMS, x) for x in SMS_LEVELS[1:]]


def variant_predictors(name: str) -> list[tuple[str, str]]:
    """``(predictor, superset column)`` of a variant, in order."""
    plan, extra = VARIANTS[name]
    plan = {"lambda_nbh": 50, "lambda_patient": None, "counts": True, "date_parts": True, "sms_three_way": False, "drop_entity": False} | plan
    out = [(c, c) for c in RAW if not (c == R.ENTITY and plan["drop_entity"])]
    if plan["sms_three_way"]:
        at = out.index((R.SMS, R.SMS))
        out[at:at + 1] = [(c, c) for c in _STATUS]
    if plan["lambda_nbh"] is not None:
        out.append(("bias_per_nbh", f"bias_per_nbh_{plan['lambda_nbh']}"))
    if plan["lambda_patient"] is not None:
        out.append(("bias_per_patient", "bias_per_patient"))
    if plan["date_parts"]:
        out += [(c, c) for c in DATE_PARTS]
    if plan["counts"]:
        out += [(c, c) for c in COUNTS]
    out += [(e[1:], e[1:]) for e in extra if e.startswith("+")]
    return [p for p in out if p[0] not in extra]


def superset_columns(variants: Sequence[str] = tuple(VARIANTS)) -> list[str]:
    return list(dict.fromkeys(c for v in variants for _, c in variant_predictors(v)))


def superset(train: DataFrame, *frames: DataFrame, variants: Sequence[str] = tuple(VARIANTS)) -> list[DataFrame]:
    """``frames`` with every superset column as a double, encoded by the
    rows of ``train``: row id, label, columns."""
    plans = [VARIANTS[v][0] for v in variants]
    lambdas = sorted({p.get("lambda_nbh", 50) for p in plans} - {None})
    patient = {p.get("lambda_patient") for p in plans} - {None}
    if len(patient) > 1:
        raise ValueError("variants differ in lambda_patient")
    fitted = fit_folds(train.withColumn("fold", F.lit(0)), lambda_nbh=lambdas, lambda_patient=next(iter(patient), None))
    columns = superset_columns(variants)
    out = []
    for df in frames:
        enc = fitted.transform(df).withColumn("__status", sms_status(days_between(R.DAY, R.BOOKED), F.col(R.SMS)))
        enc = Contrasts({"__status": list(SMS_LEVELS)}).transform(enc).withColumnsRenamed(
            {contrast_name("__status", x): contrast_name(R.SMS, x) for x in SMS_LEVELS[1:]})
        types = dict(enc.dtypes)
        number = lambda c: epoch_seconds(c) if types[c].startswith("timestamp") else F.col(c).cast("double")  # noqa: B023, E731
        out.append(enc.select(R.ROW_ID, R.LABEL, *[number(c).alias(c) for c in columns]))
    return out


def variant_means(train: DataFrame) -> DataFrame:
    """``variant, ordinal, column_name, mean``: every variant's predictors
    with their means over the training rows, all from one aggregate."""
    frame, = superset(train, train)
    columns = superset_columns()
    # Seconds since 1970 leave fewer digits of a mean.
    digits = {R.BOOKED: 2, R.DAY: 2}
    means = frame.agg(*[rounded(F.avg(c), digits.get(c, 6)).alias(f"m{i}") for i, c in enumerate(columns)])
    rows = [f"'{v}', {k + 1}, '{p}', m{columns.index(c)}" for v in VARIANTS for k, (p, c) in enumerate(variant_predictors(v))]
    return means.select(F.expr(f"stack({len(rows)}, {', '.join(rows)}) as (variant, ordinal, column_name, mean)"))


# ------------------------------------------------------------------ models

def _bags(train: DataFrame, name: str, n_bags: int, n_per_class: int, seed: int) -> list[Column]:
    """A weight for each bag: bootstrap multiplicities, or membership in
    class-balanced samples."""
    if name == "RF10":
        with ThreadPoolExecutor(max_workers=4) as pool:  # each finds its cuts by small jobs
            return list(pool.map(lambda b: balanced_flag(train, n_per_class, seed=seed * 1000 + b).cast("double"), range(n_bags)))
    return [poisson1_weight(R.ROW_ID, seed * 1000 + b) for b in range(n_bags)]


def _scored(df: DataFrame, models: list, weights: list[Column] | None) -> DataFrame:
    """Mean class-1 probability of all models, or with ``weights`` of those
    whose bag a row is out of: one narrow pass."""
    for b, model in enumerate(models):
        p = vector_to_array("probability")[1]
        df = model.transform(df).withColumn(f"__p{b}", p if weights is None else F.when(weights[b] == 0, p)).drop(
            "rawPrediction", "probability", "prediction")
    probs = F.filter(F.array(*[F.col(f"__p{b}") for b in range(len(models))]), lambda x: x.isNotNull())
    mean = F.aggregate(probs, F.lit(0.0), lambda a, x: a + x) / F.size(probs)
    return df.select(R.ROW_ID, "label", F.when(F.size(probs) > 0, mean).alias("prob"))


def model_sweep(spark: SparkSession, train: DataFrame, dev: DataFrame, variants: Sequence[str], num_trees: int = 500,
                n_bags: int = 10, max_depth: int = 10, n_per_class: int = 500, seed: int = 1, parallel_fits: int = 8) -> DataFrame:
    """``variant, n_predictors, oob_auc, dev_auc``.

    A forest is grown in bags that share its trees: a row's out-of-bag score
    comes from the bags it is out of (a row that is in every bag has none
    and counts in no AUC), a dev row's from all. ``GLM`` is a
    logistic regression (no out-of-bag score); ``RF10`` draws its bags as
    class-balanced samples. Fits are independent and submitted together,
    ``parallel_fits`` at most; the weights of all bags are written with the
    rows once. Where rows x trees of all fits exceed ``JOINT_WORK``, the
    forests of all variants are grown and scored together (``operators.forest``)."""
    columns = superset_columns(variants)
    vector = VectorAssembler(inputCols=columns, outputCol="all", handleInvalid="error")
    kinds = list(dict.fromkeys("RF10" if v == "RF10" else "bootstrap" for v in variants if v != "GLM"))
    bags = [bag_weights(_bags(train, kind, n_bags, n_per_class, seed)).alias(f"__{kind}") for kind in kinds]
    rows = [vector.transform(x).select(R.ROW_ID, R.LABEL, F.col(R.LABEL).cast("double").alias("label"), "all")
            for x in superset(train, train, dev, variants=variants)]
    tr, dv = spread(rows[0].select("*", *bags)), materialize(rows[1])
    n_rows, forests = tr.count(), [v for v in variants if v != "GLM"]
    at_once = min(max(1, parallel_fits), fits_at_once(n_rows))
    together = n_rows * num_trees * len(forests) > forest.JOINT_WORK

    def one(name: str) -> tuple:
        slicer = VectorSlicer(inputCol="all", outputCol="features", indices=[columns.index(c) for _, c in variant_predictors(name)])
        width = len(slicer.getIndices())
        own, other = slicer.transform(tr), slicer.transform(dv)
        oob = None
        if name == "GLM":
            models = [LogisticRegression(featuresCol="features", labelCol="label", regParam=0.0, maxIter=100).fit(own)]
        else:
            weights = [bag_weight("__RF10" if name == "RF10" else "__bootstrap", b) for b in range(n_bags)]
            trees = -(-num_trees // n_bags)

            def grow(b: int):
                rf = rf_estimator(width, num_trees=trees, max_depth=max_depth, mtry=mtry_default(width), seed=seed + b,
                                  weight_col="__w", bootstrap=False)
                return rf.fit(own.withColumn("__w", weights[b]).filter("__w > 0"))

            models = list(fits.map(grow, range(n_bags)))
            oob = roc_auc(_scored(own, models, weights), "prob", "label").first()["auc"]
        return name, width, oob, roc_auc(_scored(other, models, None), "prob", "label").first()["auc"]

    # A second variant's fits fill the cores while one is scored.
    with ThreadPoolExecutor(max_workers=at_once) as fits, ThreadPoolExecutor(max_workers=2) as pool:
        each = [pool.submit(one, v) for v in variants if not (together and v in forests)]
        joint = _forests_together(tr, dv, n_rows, forests, kinds, columns, num_trees, n_bags, max_depth, seed) if together else {}
        alone = iter(each)
        rows = [joint[v] if v in joint else next(alone).result() for v in variants]
    return spark.createDataFrame(rows, "variant string, n_predictors int, oob_auc double, dev_auc double")


def _forests_together(tr: DataFrame, dv: DataFrame, n_rows: int, variants: Sequence[str], kinds: Sequence[str], columns: list[str],
                      num_trees: int, n_bags: int, max_depth: int, seed: int) -> dict[str, tuple]:
    """The rows of ``model_sweep`` for forest variants."""
    vec = vector_to_array("all")
    learnt = tr.withColumn("fold", F.lit(0)).repartition(forest.partitions(tr.sparkSession, n_rows))
    X, _ = forest.sampled(learnt, vec, R.ROW_ID, n_rows, seed)
    bins = [(i, forest.thresholds(x)) for i, x in enumerate(X.T)]
    train = forest.pack(learnt.withColumn("__bags", F.concat(*[f"__{kind}" for kind in kinds])), vec, "label", bins, "__bags")
    dev = forest.pack(dv.withColumn("fold", F.lit(1)), vec, "label", bins)
    trees, specs = -(-num_trees // n_bags), []
    for name in variants:
        own = [columns.index(c) for _, c in variant_predictors(name)]
        first = kinds.index("RF10" if name == "RF10" else "bootstrap") * n_bags
        specs.append(forest.Spec(own, mtry_default(len(own)), [first + b for b in range(n_bags) for _ in range(trees)], 1, seed))
    grown = forest.grow(train, specs, max_depth)
    oob, ahead = ({r["forest"]: r["auc"] for r in roc_auc(s, "prob", "label", ["forest"]).collect()}  # a row a variant
                  for s in (forest.score(train, grown, out_of_bag=True), forest.score(dev, grown)))
    return {v: (v, len(s.columns), oob.get(i), ahead.get(i)) for i, (v, s) in enumerate(zip(variants, specs, strict=True))}

"""Classifiers through ``pyspark.ml``: logistic regression, random forest,
out-of-bag scoring and class-balanced bagging.

Fitting is distributed by Spark ML (one job per tree level group); the
driver only holds model parameters. Rows reach a model as one vector
column built by ``assemble`` (``label ~ .``: all predictor columns,
timestamps as epoch seconds, flags as 0/1, text as an alphabetical index in
forests and as contrasts in the regression).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import epoch_seconds, hash_key
from cohortlens.operators import roles as R
from cohortlens.operators.contrasts import Contrasts, fit_contrasts
from cohortlens.operators.split import balanced_sample
from cohortlens.session import fits_at_once, materialize, spread


def numeric_view(df: DataFrame, cols: Sequence[str], label: str = R.LABEL) -> tuple[DataFrame, list[str]]:
    """Predictors as doubles (text columns kept for indexing) plus a 0/1 label."""
    types = dict(df.dtypes)
    exprs, text = [], []
    for c in cols:
        t = types[c]
        if t.startswith("timestamp"):
            exprs.append(epoch_seconds(c).alias(c))
        elif t == "string":
            exprs.append(F.col(c))
            text.append(c)
        else:
            exprs.append(F.col(c).cast("double").alias(c))
    keep = [c for c in df.columns if c not in cols and c != label]
    return df.select(*keep, *exprs, F.col(label).cast("double").alias("label")), text


def _stages(cols: Sequence[str], text: Sequence[str]) -> list:
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", stringOrderType="alphabetAsc",
                            handleInvalid="keep") for c in text]
    inputs = [f"{c}__idx" if c in text else c for c in cols]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
    return stages


@dataclass
class Fitted:
    """A fitted pipeline plus the predictor names it was fitted on."""
    model: PipelineModel
    cols: list[str]
    label: str = R.LABEL
    levels: Contrasts | None = None

    def score(self, df: DataFrame, out: str = "prob") -> DataFrame:
        """Rows of ``df`` plus ``out`` = P(label = 1) and the 0/1 ``label``."""
        num, _ = numeric_view(self.levels.transform(df) if self.levels else df, self.cols, self.label)
        scored = self.model.transform(num)
        return scored.withColumn(out, vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability", "prediction",
            *[c for c in scored.columns if c.endswith("__idx")])

    @property
    def last(self):
        return self.model.stages[-1]


def fit_logreg(train: DataFrame, cols: Sequence[str], label: str = R.LABEL,
               max_iter: int = 100) -> Fitted:
    """Unpenalised logistic regression (``glm`` with a binomial family).
    Text columns become 0/1 columns, one for each level but the first."""
    levels = fit_contrasts(train, [c for c, t in train.dtypes if t == "string" and c in cols])
    train, cols = levels.transform(train), levels.columns(cols)
    num, text = numeric_view(train, cols, label)
    lr = LogisticRegression(featuresCol="features", labelCol="label", regParam=0.0,
                            standardization=True, maxIter=max_iter)
    return Fitted(Pipeline(stages=_stages(cols, text) + [lr]).fit(num), list(cols), label, levels)


def mtry_default(p: int) -> int:
    """Features tried per split for classification: floor(sqrt(p))."""
    return max(1, int(math.floor(math.sqrt(p))))


def rf_estimator(n_predictors: int, num_trees: int = 500, max_depth: int = 10,
                 mtry: int | None = None, seed: int = 1, max_bins: int = 32,
                 weight_col: str | None = None, bootstrap: bool = True) -> RandomForestClassifier:
    m = mtry if mtry is not None else mtry_default(n_predictors)
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=num_trees,
                                maxDepth=max_depth, featureSubsetStrategy=str(int(m)),
                                seed=seed, maxBins=max_bins, bootstrap=bootstrap)
    if weight_col:
        rf = rf.setWeightCol(weight_col)
    return rf


#: Rows x trees up to which a forest is one fit, the trees that a larger
#: one fits together, and the rows up to which two such fits run at once.
_FIT_WORK, _TREES_TOGETHER, _ROWS_TWICE = 1 << 24, 10, 1 << 24


class Forests(Transformer):
    """Forests grown on the same rows as one: class chances and importances
    are the means over all trees, as within a forest."""

    def __init__(self, members: Sequence):
        super().__init__()
        self.members = list(members)
        trees = [m.getNumTrees for m in self.members]
        self.shares = [t / sum(trees) for t in trees]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cur, own = dataset, [f"__forest{i}" for i in range(len(self.members))]
        for m, c in zip(self.members, own, strict=True):
            cur = m.transform(cur).withColumn(c, vector_to_array("probability")).drop("rawPrediction", "probability", "prediction")
        mean = [sum(F.col(c)[k] * s for c, s in zip(own, self.shares, strict=True)) for k in range(self.members[0].numClasses)]
        return cur.withColumn("probability", array_to_vector(F.array(*mean))).drop(*own)

    @property
    def featureImportances(self) -> DenseVector:
        imp = sum(m.featureImportances.toArray() * s for m, s in zip(self.members, self.shares, strict=True))
        return DenseVector(imp / (imp.sum() or 1.0))


def _grow_in_groups(num: DataFrame, stages: list, n_predictors: int, rows: int, num_trees: int,
                    seed: int, **rf_kw) -> PipelineModel:
    """A forest of many rows, few trees at a time. All trees together keep
    a weight for each tree with every row, and statistics of all nodes of a
    level in every task: 100 trees ask for some 500 bytes a row and 150 MB a
    task, which no processor cache and, at tens of millions of rows, no memory
    holds. Rows are assembled and written once for all groups; rows keep the
    node that they reached, instead of walking down every tree at each level."""
    prepared = Pipeline(stages=stages).fit(num)
    features = spread(prepared.transform(num).select("label", "features"))
    sizes = [len(range(i, num_trees, -(-num_trees // _TREES_TOGETHER))) for i in range(-(-num_trees // _TREES_TOGETHER))]

    def grow(i: int):
        rf = rf_estimator(n_predictors, num_trees=sizes[i], seed=seed + 1_000_003 * i, **rf_kw)  # seeds of partitions are neighbours
        return rf.setCacheNodeIds(True).setCheckpointInterval(-1).fit(features)

    with ThreadPoolExecutor(max_workers=2 if rows <= _ROWS_TWICE else 1) as pool:
        return PipelineModel(stages=[*prepared.stages, Forests(list(pool.map(grow, range(len(sizes)))))])


def fit_rf(train: DataFrame, cols: Sequence[str], label: str = R.LABEL, num_trees: int = 500,
           seed: int = 1, **kw) -> Fitted:
    num, text = numeric_view(train, cols, label)
    stages = _stages(cols, text)
    rows = num.count() if num_trees > 2 * _TREES_TOGETHER and kw.get("bootstrap", True) and not kw.get("weight_col") else 0
    if rows * num_trees > _FIT_WORK:
        return Fitted(_grow_in_groups(num, stages, len(cols), rows, num_trees, seed, **kw), list(cols), label)
    rf = rf_estimator(len(cols), num_trees=num_trees, seed=seed, **kw)
    return Fitted(Pipeline(stages=stages + [rf]).fit(num), list(cols), label)


def rf_importance(spark: SparkSession, fitted: Fitted) -> DataFrame:
    """Impurity importance per predictor (normalised to sum 1), ranked.
    One row per predictor: the table is as small as the model."""
    imp = fitted.last.featureImportances.toArray().tolist()
    rows = [(c, float(v)) for c, v in zip(fitted.cols, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    from pyspark.sql import Window
    return df.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("importance").desc(), F.col("feature"))))


# Poisson(1) cumulative probabilities P[X <= k], k = 0..9 (fixed values).
_POISSON1_CDF = [math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1)) for k in range(10)]


def poisson1_weight(id_col: str, bag: int) -> F.Column:
    """Bootstrap multiplicity of a row in bag ``bag``: a Poisson(1) draw by
    inverse CDF of a uniform taken from md5(id:bag:bag), topped at 10 (about one
    row in 10**8 has more). Deterministic, so
    a retried task draws the same bag."""
    u = F.conv(F.substring(hash_key(id_col, bag, "bag"), 1, 12), 16, 10).cast("double") / float(16 ** 12)

    def inverse(u: F.Column) -> F.Column:
        w = F.lit(len(_POISSON1_CDF))
        for k in reversed(range(len(_POISSON1_CDF))):
            w = F.when(u < _POISSON1_CDF[k], F.lit(k)).otherwise(w)
        return w.cast("double")

    return F.transform(F.array(u), inverse)[0]  # as a variable: one md5 a row, not one a step


def bag_weights(weights: Sequence[F.Column]) -> F.Column:
    """Whole weights of all bags as one column, to be written with the rows:
    the passes of every fit then read them."""
    return F.array(*[w.cast("tinyint") for w in weights])


def bag_weight(column: str, bag: int) -> F.Column:
    return F.col(column)[bag].cast("double")


def oob_scores(train: DataFrame, cols: Sequence[str], label: str = R.LABEL,
               id_col: str = R.ROW_ID, n_bags: int = 30, num_trees: int = 500,
               seed: int = 1, **rf_kw) -> DataFrame:
    """Out-of-bag class-1 probability per training row.

    Spark's forest does not expose bag membership, so bags are explicit:
    bag b weights each row by a Poisson(1) draw; a forest fitted without
    further bootstrapping on the rows with weight > 0 scores the rows with
    weight 0. A row's OOB score is the mean over the bags it was out of. From
    ``n_bags`` on, bags are added until every row is out of one; the
    ``num_trees`` trees are shared between them. ``(id, oob_score, label)``.
    """
    num, text = numeric_view(train, cols, label)
    weight = lambda b: poisson1_weight(id_col, seed * 1000 + b)
    while not num.filter(reduce(and_, [weight(b) > 0 for b in range(n_bags)])).isEmpty():
        n_bags += 10
    stages = _stages(cols, text)
    if not text:  # nothing to fit for a bag alone: rows are assembled once
        num, stages = stages[-1].transform(num).select(id_col, "label", "features"), []
    num = spread(num.withColumn("__bags", bag_weights([weight(b) for b in range(n_bags)])))
    weights = [bag_weight("__bags", b) for b in range(n_bags)]
    trees_per_bag = -(-num_trees // n_bags)

    def grow(b: int) -> PipelineModel:
        bagged = num.withColumn("__w", weights[b]).filter("__w > 0")
        rf = rf_estimator(len(cols), num_trees=trees_per_bag, seed=seed + b,
                          weight_col="__w", bootstrap=False, **rf_kw)
        return Pipeline(stages=stages + [rf]).fit(bagged)

    # Bags are independent and their seeds fixed: submitted together.
    with ThreadPoolExecutor(max_workers=fits_at_once(num.count())) as pool:
        models = list(pool.map(grow, range(n_bags)))
    # Score every row with every bag's forest in one narrow pass (no
    # shuffle), keeping a bag's probability only where the row was out.
    cur = num
    for b, model in enumerate(models):
        cur = _chain(cur, model, f"__p{b}", keep=() if text else ("features",)).withColumn(
            f"__p{b}", F.when(weights[b] == 0, F.col(f"__p{b}")))
    probs = F.array(*[F.col(f"__p{b}") for b in range(n_bags)])
    present = F.filter(probs, lambda x: x.isNotNull())
    oob = F.when(F.size(present) > 0,
                 F.aggregate(present, F.lit(0.0), lambda a, x: a + x) / F.size(present))
    # Written: a filter on the score would be planned over all bags' models again.
    return materialize(cur.select(id_col, "label", oob.alias("oob_score")))


def _chain(df: DataFrame, model: PipelineModel, out: str, keep: Sequence[str] = ()) -> DataFrame:
    """Apply one fitted pipeline and keep only its class-1 probability."""
    scored = model.transform(df)
    made = ["features", "rawPrediction", "probability", "prediction", *[c for c in scored.columns if c.endswith("__idx")]]
    return scored.withColumn(out, vector_to_array("probability")[1]).drop(*[c for c in made if c not in keep])


@dataclass
class Bagged:
    """Average of several fitted models' class-1 probabilities."""
    members: list
    id_col: str = R.ROW_ID

    def score(self, df: DataFrame, out: str = "prob") -> DataFrame:
        first = self.members[0]
        cur, _ = numeric_view(df, first.cols, first.label)
        for i, m in enumerate(self.members):
            cur = _chain(cur, m.model, f"__p{i}")
        mean = sum(F.col(f"__p{i}") for i in range(len(self.members))) / len(self.members)
        return cur.withColumn(out, mean).drop(*[f"__p{i}" for i in range(len(self.members))])


def fit_rf_balanced(train: DataFrame, cols: Sequence[str], label: str = R.LABEL,
                    n_per_class: int = 500, n_bags: int = 10, trees_per_bag: int = 500,
                    id_col: str = R.ROW_ID, seed: int = 1, **rf_kw) -> Bagged:
    """Class-balanced forest: each bag is an exact ``n_per_class`` per
    class sample (a different md5 seed per bag), each bag grows its own
    trees, and their probabilities are averaged."""
    members = []
    for b in range(n_bags):
        sample = balanced_sample(train, n_per_class, label, seed=seed * 1000 + b, id_col=id_col)
        members.append(fit_rf(sample, cols, label, num_trees=trees_per_bag, seed=seed + b, **rf_kw))
    return Bagged(members, id_col)

"""Encoders that leave a fold out, and the feature plan as ML stages."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from cohortlens.operators.split import kfold_assign
from cohortlens.plans.estimator import DesignVector, FeatureEncoder, FeatureEncoderModel
from cohortlens.plans.features import FeaturePlan
from cohortlens.plans.folded import fit_folds
from cohortlens.sources import appointments
from tests.conftest import SF001

ENCODED = ("bias_per_nbh", "bias_per_patient", "nbr_app_per_patient", "nbr_app_that_day")


@pytest.fixture(scope="module")
def folded(spark):
    return kfold_assign(appointments(spark, SF001), folds=4, seed=1).cache()


def _values(df, names=ENCODED):
    return {r["appointment_id"]: tuple(round(r[c], 9) for c in names) for r in df.collect()}


def test_each_fold_equals_a_refit(folded):
    plan = fit_folds(folded, lambda_nbh=10, lambda_patient=1)
    for k in range(1, 5):
        train = folded.filter(F.col("fold") != k)
        refit = FeaturePlan(lambda_nbh=10, lambda_patient=1).fit(train).transform(folded)
        assert _values(plan.transform(folded, k)) == _values(refit)


def test_rows_with_a_fold_leave_it_out_and_new_rows_do_not(folded):
    plan = fit_folds(folded, lambda_nbh=10, lambda_patient=1)
    got = _values(plan.transform(folded))
    for k in range(1, 5):
        refit = FeaturePlan(lambda_nbh=10, lambda_patient=1).fit(folded.filter(F.col("fold") != k)).transform(folded.filter(F.col("fold") == k))
        want = _values(refit)
        assert {i: got[i] for i in want} == want
    new = folded.drop("fold")
    assert _values(plan.transform(new)) == _values(FeaturePlan(lambda_nbh=10, lambda_patient=1).fit(new).transform(new))


def test_several_thresholds_from_one_fit(folded):
    plan = fit_folds(folded, lambda_nbh=[5, 12, 10**6], counts=False)
    out = plan.transform(folded, 2)
    for x in (5, 12, 10**6):
        one = fit_folds(folded, lambda_nbh=x, counts=False).transform(folded, 2)
        assert _values(out, [f"bias_per_nbh_{x}"]) == _values(one, ["bias_per_nbh"])
    assert {v for v in _values(out, ["bias_per_nbh_1000000"]).values()} == {(0.0,)}


def test_a_single_scan_counts_every_key(folded):
    """All encoder keys of all folds: one aggregate over the rows."""
    from cohortlens.plans import folded as module
    seen = []
    real = module.materialize
    module.materialize = lambda df: seen.append(df) or real(df)
    try:
        fit_folds(folded, lambda_nbh=10, lambda_patient=1)
    finally:
        module.materialize = real
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert len(seen) == 1 and plan.count("InMemoryRelation") == 1 and plan.count("Aggregate") == 1


def test_null_keys_and_labels_of_a_folded_fit(spark):
    rows = [(1, None, "a", True, 1), (2, None, "a", None, 2), (3, "x", None, False, 1), (4, "x", "a", True, 2)]
    df = spark.createDataFrame(rows, "appointment_id long, patient_id string, neighbourhood string, no_show boolean, fold int")
    df = df.withColumns({"appointment_day": F.lit("2020-01-01").cast("timestamp"), "scheduled_ts": F.lit("2020-01-01").cast("timestamp")})
    for k in (1, 2):
        plain = FeaturePlan(lambda_nbh=0).fit(df.filter(F.col("fold") != k)).transform(df)
        names = ["bias_per_nbh", "nbr_app_per_patient", "nbr_app_that_day"]
        assert _values(fit_folds(df, lambda_nbh=0).transform(df, k), names) == _values(plain, names)


def test_encoder_is_saved_and_loaded(spark, folded, tmp_path):
    for mode in ("plain", "oof"):
        model = FeatureEncoder(lambdaNbh=10, lambdaPatient=1, mode=mode).fit(folded)
        model.save(str(tmp_path / mode))
        loaded = FeatureEncoderModel.load(str(tmp_path / mode))
        assert loaded.uid == model.uid and loaded.getOrDefault("mode") == mode and loaded.getOrDefault("lambdaNbh") == 10
        assert _values(loaded.transform(folded)) == _values(model.transform(folded))
    again = FeatureEncoder(lambdaNbh=7, dateParts=False)
    again.save(str(tmp_path / "estimator"))
    assert FeatureEncoder.load(str(tmp_path / "estimator")).extractParamMap() == again.extractParamMap()


def test_pipeline_is_tuned_saved_and_scored(spark, folded, tmp_path):
    encoder = FeatureEncoder(lambdaNbh=10, dropEntity=True)
    pipeline = Pipeline(stages=[encoder, DesignVector(), LogisticRegression(maxIter=5)])
    grid = ParamGridBuilder().addGrid(encoder.lambdaNbh, [10, 10**6]).build()
    data = folded.drop("fold")
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=2, seed=1)
    best = cv.fit(data).bestModel
    scores = lambda m: {r["appointment_id"]: tuple(r["p"]) for r in m.transform(data).select("appointment_id", vector_to_array("probability").alias("p")).collect()}
    best.save(str(tmp_path / "model"))
    assert scores(PipelineModel.load(str(tmp_path / "model"))) == scores(best)


def test_cross_validator_refits_the_encoder(spark, folded):
    """A group's bias depends on the rows that were fitted."""
    encoder = FeatureEncoder(lambdaNbh=0, counts=False, dateParts=False)
    a, b = encoder.fit(folded.filter("fold < 3")), encoder.fit(folded, {encoder.lambdaNbh: 10**6})
    assert b.getOrDefault("lambdaNbh") == 10**6 and set(_values(b.transform(folded), ["bias_per_nbh"]).values()) == {(0.0,)}
    assert _values(a.transform(folded), ["bias_per_nbh"]) == _values(FeaturePlan(lambda_nbh=0, counts=False).fit(folded.filter("fold < 3")).transform(folded), ["bias_per_nbh"])


def test_wrong_mode_is_an_error(folded):
    with pytest.raises(ValueError):
        FeatureEncoder(mode="other").fit(folded)

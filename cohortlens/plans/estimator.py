"""The feature plan as ``pyspark.ml`` stages.

``FeatureEncoder`` is an ``Estimator`` whose fitted ``FeatureEncoderModel``
holds the encoder tables as DataFrames, and ``DesignVector`` a ``Transformer``
that turns the predictors into one vector, so a whole model is a ``Pipeline``:

    Pipeline(stages=[FeatureEncoder(lambdaNbh=50), DesignVector(), forest])

A ``CrossValidator`` over it refits the encoders on every fold's training
rows, for every parameter map. A fitted pipeline is saved with its tables (as
Parquet) and loaded anywhere; no table ever passes through the driver.

With ``mode="oof"`` the encoder expects a fold column (``foldCol``) in the
training rows: a row that carries a fold is encoded by the other folds, a row
without one (new rows) by all.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import epoch_seconds
from cohortlens.operators import roles as R
from cohortlens.plans.features import NOT_PREDICTORS, FeaturePlan, FittedPlan
from cohortlens.plans.folded import FoldedPlan, fit_folds

_NONE = -1


class _EncoderParams(Params):
    lambdaNbh = Param(Params._dummy(), "lambdaNbh", "rows that a group must exceed for its bias; -1: no bias", TypeConverters.toInt)
    lambdaPatient = Param(Params._dummy(), "lambdaPatient", "rows that an entity must exceed for its bias; -1: no bias", TypeConverters.toInt)
    counts = Param(Params._dummy(), "counts", "count rows per entity and per entity and day", TypeConverters.toBoolean)
    dateParts = Param(Params._dummy(), "dateParts", "day gap, weekdays and hour", TypeConverters.toBoolean)
    smsThreeWay = Param(Params._dummy(), "smsThreeWay", "reminder status in three levels", TypeConverters.toBoolean)
    dropEntity = Param(Params._dummy(), "dropEntity", "drop the entity id after its encoders", TypeConverters.toBoolean)
    labelCol = Param(Params._dummy(), "labelCol", "outcome column", TypeConverters.toString)
    mode = Param(Params._dummy(), "mode", "plain: all training rows encode a row; oof: those of the other folds", TypeConverters.toString)
    foldCol = Param(Params._dummy(), "foldCol", "fold number of a training row (mode oof)", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(lambdaNbh=50, lambdaPatient=_NONE, counts=True, dateParts=True, smsThreeWay=False, dropEntity=False,
                         labelCol=R.LABEL, mode="plain", foldCol="fold")

    def _plan_arguments(self) -> dict:
        get = self.getOrDefault
        some = lambda p: None if get(p) == _NONE else get(p)
        return {"lambda_nbh": some("lambdaNbh"), "lambda_patient": some("lambdaPatient"), "counts": get("counts"),
                "date_parts": get("dateParts"), "sms_three_way": get("smsThreeWay"), "drop_entity": get("dropEntity"), "label": get("labelCol")}


class FeatureEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the encoders of ``FeaturePlan`` on the rows it is given."""

    @keyword_only
    def __init__(self, *, lambdaNbh=50, lambdaPatient=_NONE, counts=True, dateParts=True, smsThreeWay=False, dropEntity=False,
                 labelCol=R.LABEL, mode="plain", foldCol="fold"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FeatureEncoderModel:
        plan = self._plan_arguments()
        if self.getOrDefault("mode") == "oof":
            fitted = fit_folds(dataset, fold=self.getOrDefault("foldCol"), **plan)
            tables = {"base": fitted.base, "group": fitted.group, "entity": fitted.entity, **fitted.counts}
        elif self.getOrDefault("mode") == "plain":
            fitted = FeaturePlan(**plan).fit(dataset)
            tables = {c: getattr(fitted, c) for c in ("bias_per_nbh", "bias_per_patient", "entity_counts")}
        else:
            raise ValueError("mode is plain or oof")
        return self._copyValues(FeatureEncoderModel({k: t for k, t in tables.items() if t is not None}))


class FeatureEncoderModel(Model, _EncoderParams, MLReadable, MLWritable):
    """Fitted encoder tables by name; adds their columns to any rows."""

    def __init__(self, tables: dict[str, DataFrame] | None = None):
        super().__init__()
        self.tables = tables or {}

    def plan(self) -> FittedPlan | FoldedPlan:
        a, t = self._plan_arguments(), self.tables
        drop = (R.GROUP, *([R.ENTITY] if a["drop_entity"] else []))
        bias = ("bias_per_nbh", "bias_per_patient")
        counts = ("nbr_app_per_patient", "nbr_app_that_day")
        if self.getOrDefault("mode") == "plain":
            return FittedPlan(*[t.get(c) for c in (*bias, "entity_counts")], drop, a["sms_three_way"], a["date_parts"])
        plain = FittedPlan(None, None, None, drop, a["sms_three_way"], a["date_parts"])
        limits = [{} if a[k] is None else {c: a[k]} for c, k in zip(bias, ("lambda_nbh", "lambda_patient"), strict=True)]
        return FoldedPlan(t["base"], t.get("group"), t.get("entity"), {c: t[c] for c in counts if c in t}, *limits,
                          self.getOrDefault("foldCol"), plain)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.plan().transform(dataset)

    def write(self) -> MLWriter:
        return _TablesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TablesReader(cls)


class _TablesWriter(MLWriter):
    """Parameters as other stages keep them, and a Parquet folder a table."""

    def __init__(self, model: FeatureEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"tables": sorted(self.model.tables)})
        for name, table in self.model.tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class _TablesReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> FeatureEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls({name: self.sparkSession.read.parquet(f"{path}/tables/{name}") for name in metadata["tables"]})
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class DesignVector(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """All predictors as one vector (timestamps as seconds since 1970, flags
    as 0/1), and the label as a number. ``exclude`` names columns that are
    no predictors beside the row id, the label and the group."""

    exclude = Param(Params._dummy(), "exclude", "columns that are no predictors", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "outcome column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, exclude=("fold",), labelCol=R.LABEL, outputCol="features"):
        super().__init__()
        self._setDefault(exclude=["fold"], labelCol=R.LABEL, outputCol="features")
        self._set(**{**self._input_kwargs, "exclude": list(self._input_kwargs.get("exclude", exclude))})

    def predictors(self, df: DataFrame) -> list[str]:
        left = NOT_PREDICTORS | {self.getOrDefault("labelCol"), "label", *self.getOrDefault("exclude")}
        return [c for c in df.columns if c not in left]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        types = dict(dataset.dtypes)
        columns = self.predictors(dataset)
        number = {c: (epoch_seconds(c) if types[c].startswith("timestamp") else F.col(c).cast("double")) for c in columns}
        out = dataset.withColumns({f"__x_{c}": e for c, e in number.items()} | {"label": F.col(self.getOrDefault("labelCol")).cast("double")})
        names = [f"__x_{c}" for c in columns]
        vector = VectorAssembler(inputCols=names, outputCol=self.getOrDefault("outputCol"), handleInvalid="error")
        return vector.transform(out).drop(*names)

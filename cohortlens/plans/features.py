"""The feature plan: fit encoders on training rows, apply them anywhere.

``FeaturePlan(...).fit(train)`` returns a ``FittedPlan`` whose
``transform(df)`` adds, in one pass of projections and joins,

* ``bias_per_nbh``  group rate - base rate (groups with > lambda rows), 0 if unseen
* ``days_between``  appointment day - booking day
* ``wday_sched``, ``wday_app``, ``hour_sched``  date parts (Sunday = 1)
* ``nbr_app_per_patient``, ``nbr_app_that_day``  training-row counts, 0.0 if unseen

and drops the group column. The row id is carried along but is not a
predictor (``design_columns`` lists the predictors of each variant).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import days_between, hour_of, sms_status, weekday
from cohortlens.operators import roles as R
from cohortlens.operators.encode import (
    apply_encoder, fit_count_encoder, fit_target_encoder,
)


def fit_entity_counts(train: DataFrame) -> DataFrame:
    """``(entity, nbr_app_per_patient, by_day)``: training rows of each
    entity, in all and on each of its days (a map with as many entries as
    the entity has days). One table for both counts, so that rows meet it in
    one join on the entity instead of two shuffles."""
    days = fit_count_encoder(train, [R.ENTITY, R.DAY], "__n")
    entry = F.when(F.col(R.DAY).isNotNull(), F.struct(R.DAY, "__n"))
    return days.groupBy(R.ENTITY).agg(F.sum("__n").alias("nbr_app_per_patient"),
                                      F.map_from_entries(F.collect_list(entry)).alias("by_day"))


def apply_entity_counts(df: DataFrame, counts: DataFrame) -> DataFrame:
    """``nbr_app_per_patient`` and ``nbr_app_that_day`` of each row (0.0
    for an entity or a day that was not fitted)."""
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    out = df.join(counts, R.ENTITY, "left")
    return out.withColumns({"nbr_app_per_patient": number(F.col("nbr_app_per_patient")),
                            "nbr_app_that_day": number(F.try_element_at("by_day", F.col(R.DAY)))}).drop("by_day")


@dataclass
class FittedPlan:
    bias_per_nbh: DataFrame | None
    bias_per_patient: DataFrame | None
    entity_counts: DataFrame | None
    drop: tuple = (R.GROUP,)
    sms_three_way: bool = False
    date_parts: bool = True

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        if self.bias_per_nbh is not None:
            out = apply_encoder(out, self.bias_per_nbh)
        if self.bias_per_patient is not None:
            out = apply_encoder(out, self.bias_per_patient)
        out = self.before(out)
        if self.entity_counts is not None:
            out = apply_entity_counts(out, self.entity_counts)
        return self.after(out)

    def before(self, df: DataFrame) -> DataFrame:
        """Columns of a row alone: day gap, SMS status, date parts."""
        out = df
        if self.date_parts:
            out = out.withColumn("days_between", days_between(R.DAY, R.BOOKED))
        if self.sms_three_way and "days_between" in out.columns:
            out = out.withColumn(R.SMS, sms_status("days_between", F.col(R.SMS)))
        if self.date_parts:
            out = out.withColumns({"wday_sched": weekday(R.BOOKED),
                                   "wday_app": weekday(R.DAY),
                                   "hour_sched": hour_of(R.BOOKED)})
        return out

    def after(self, df: DataFrame) -> DataFrame:
        # dropped last: the entity column is a join key of the encoders
        return df.drop(*self.drop)


@dataclass
class FeaturePlan:
    """Which encoders to fit. Defaults are the final model's (RF9, lambda 50).
    ``folded.fit_folds`` fits the same encoders for every fold at once."""
    lambda_nbh: int | None = 50
    lambda_patient: int | None = None
    counts: bool = True
    date_parts: bool = True
    sms_three_way: bool = False
    drop_entity: bool = False
    label: str = R.LABEL

    def fit(self, train: DataFrame, base: DataFrame | None = None) -> FittedPlan:
        nbh = pat = counts = None
        if self.lambda_nbh is not None:
            nbh = fit_target_encoder(train, R.GROUP, self.lambda_nbh, "bias_per_nbh", self.label, base)
        if self.lambda_patient is not None:
            pat = fit_target_encoder(train, R.ENTITY, self.lambda_patient, "bias_per_patient", self.label, base)
        if self.counts:
            counts = fit_entity_counts(train)
        drop = (R.GROUP,) + ((R.ENTITY,) if self.drop_entity else ())
        return FittedPlan(nbh, pat, counts, drop, self.sms_three_way, self.date_parts)


# The feature-set variants, as (plan arguments, extra drops).
# Every variant also drops the group column and never uses the row id.
VARIANTS = {
    "GLM": (dict(lambda_nbh=None, counts=False, date_parts=False), []),
    "RF1": (dict(lambda_nbh=None, counts=False, date_parts=False), []),
    "RF2": (dict(lambda_nbh=None, counts=False, date_parts=False, drop_entity=True), []),
    "RF3": (dict(lambda_nbh=None, lambda_patient=4, counts=False, date_parts=False,
                 drop_entity=True), []),
    "RF4": (dict(lambda_nbh=None, lambda_patient=4, counts=False, date_parts=False), []),
    "RF5": (dict(lambda_nbh=15, counts=False, date_parts=False), []),
    "RF6": (dict(lambda_nbh=15, counts=False, date_parts=False), ["+days_between"]),
    "RF7": (dict(lambda_nbh=15, counts=False, date_parts=False, sms_three_way=True),
            ["+days_between"]),
    "RF8": (dict(lambda_nbh=15, counts=False), []),
    "RF9": (dict(lambda_nbh=15), []),
    "RF10": (dict(lambda_nbh=15), []),
    "FINAL": (dict(lambda_nbh=50), []),
    "KNN1": (dict(lambda_nbh=15), []),
    "KNN2": (dict(lambda_nbh=15, drop_entity=True), []),
    "KNN3": (dict(lambda_nbh=15, drop_entity=True),
             ["nbr_app_per_patient", "nbr_app_that_day", "days_between", "wday_sched",
              "wday_app", "hour_sched"]),
    "KNN4": (dict(lambda_nbh=15, drop_entity=True),
             ["nbr_app_per_patient", "nbr_app_that_day", "days_between", "wday_sched",
              "wday_app", "hour_sched", "diabetes", "alcoholism", "hipertension", "handcap"]),
    "KNN5": (dict(lambda_nbh=None, counts=False, date_parts=False, drop_entity=True), []),
}

NOT_PREDICTORS = {R.ROW_ID, R.LABEL, R.GROUP}


def variant_plan(name: str, **overrides) -> tuple[FeaturePlan, list[str]]:
    args, extra = VARIANTS[name]
    args = {**args, **overrides}
    return FeaturePlan(**args), extra


def variant_frame(fitted: FittedPlan, df: DataFrame, extra: list[str]) -> DataFrame:
    """Apply a fitted plan and the variant's extra column edits."""
    out = fitted.transform(df)
    adds = [e[1:] for e in extra if e.startswith("+")]
    drops = [e for e in extra if not e.startswith("+")]
    if "days_between" in adds and "days_between" not in out.columns:
        out = out.withColumn("days_between", days_between(R.DAY, R.BOOKED))
        if fitted.sms_three_way:
            out = out.withColumn(R.SMS, sms_status("days_between", F.col(R.SMS)))
    return out.drop(*drops)


def design_columns(df: DataFrame) -> list[str]:
    """All columns but the label and the row id (``label ~ .``)."""
    return [c for c in df.columns if c not in NOT_PREDICTORS]

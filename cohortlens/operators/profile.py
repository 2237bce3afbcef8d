"""Cohort profiling: counts, rates and distributions by any cut.

Each function maps the event table to a small result table. All of them
are aggregate-first: Spark runs a partial (map-side) aggregate, shuffles
only one row per key and partition, and finishes the aggregate; windows
run only on those aggregated rows, whose count is bounded by the key
domain, never on the raw rows. Global scalars (the overall rate) stay in
the plan as scalar subqueries rather than being collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions import (
    as_flag, days_between, decade_band, epoch_seconds, overflow_label, rate,
    rounded, sms_status, weekday,
)
from cohortlens.operators import roles as R


def valid_age(df: DataFrame, age: str = R.AGE) -> DataFrame:
    """Rows with an age of zero or more: the training-side filter that all
    steps after the age profile work on."""
    return df.filter(F.col(age) >= 0)


# --------------------------------------------------------------- scalars

def overall_rate(df: DataFrame, label: str = R.LABEL) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  rounded(rate(label)).alias("no_show_rate"))


def distinct_counts(df: DataFrame, row_id: str = R.ROW_ID, entity: str = R.ENTITY,
                    group: str = R.GROUP) -> DataFrame:
    """Distinct ids, entities and groups (``unique() %>% length()``)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.countDistinct(row_id).alias("n_appointments"),
                  F.countDistinct(entity).alias("n_patients"),
                  F.countDistinct(group).alias("n_neighbourhoods"))


def corr_id_time(df: DataFrame, ts: str = R.BOOKED, row_id: str = R.ROW_ID) -> DataFrame:
    """Pearson correlation of booking time (epoch seconds) with the row id."""
    return df.agg(rounded(F.corr(epoch_seconds(ts), F.col(row_id).cast("double")))
                  .alias("corr_id_time"))


def time_span(df: DataFrame, day: str = R.DAY) -> DataFrame:
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def age_range(df: DataFrame, age: str = R.AGE) -> DataFrame:
    return df.agg(F.max(age).alias("max_age"), F.min(age).alias("min_age"))


def appointment_timeline(df: DataFrame, ts: str = R.BOOKED, row_id: str = R.ROW_ID) -> DataFrame:
    """(booking time, id) pairs in time order: the line behind the plot.

    A global sort: Spark range-partitions on the key, so it scales out.
    """
    return df.select(ts, row_id).orderBy(ts, row_id)


# --------------------------------------------------------- entity counts

def visits_per_entity(df: DataFrame, entity: str = R.ENTITY) -> DataFrame:
    return df.groupBy(entity).agg(F.count(F.lit(1)).alias("n_visits"))


def visits_per_entity_day(df: DataFrame, entity: str = R.ENTITY, day: str = R.DAY) -> DataFrame:
    return df.groupBy(entity, day).agg(F.count(F.lit(1)).alias("nbr_app_that_day"))


def visits_per_entity_cumulative(df: DataFrame, entity: str = R.ENTITY,
                                 cap: int = 9, overflow: str = "ten_or_more") -> DataFrame:
    """Cumulative share of rows by visits per entity, ``> cap`` pooled.

    Labels sort as text ("1" .. "9" then the overflow label). The running
    total is a window over at most ``cap + 1`` rows.
    """
    per_entity = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n"))
    buckets = (per_entity
               .groupBy(overflow_label("n", cap, overflow).alias("app_number_per_patient"))
               .agg(F.sum("n").alias("app_number")))
    running = Window.orderBy("app_number_per_patient").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    total = Window.partitionBy()
    return buckets.select(
        "app_number_per_patient", "app_number",
        rounded(F.lit(100.0) * F.sum("app_number").over(running)
                / F.sum("app_number").over(total)).alias("cumulated_percentage"))


def rate_by_visit_bucket(df: DataFrame, entity: str = R.ENTITY, label: str = R.LABEL,
                         cap: int = 5, overflow: str = "more than 5") -> DataFrame:
    """Outcome rate by visits per entity, ``> cap`` pooled.

    The per-row entity count (a window in the original) becomes one
    per-entity aggregate carrying both the count and the positives; the
    bucket rate is then sum(positives) / sum(rows).
    """
    per_entity = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n"),
                                        F.sum(as_flag(label)).alias("pos"))
    return (per_entity
            .groupBy(overflow_label("n", cap, overflow).alias("app_per_patient"))
            .agg(rounded(F.sum("pos") / F.sum("n")).alias("no_show_ratio")))


def distinct_profiles(df: DataFrame, entity: str = R.ENTITY,
                      with_age=tuple(R.PROFILE_WITH_AGE),
                      without_age=tuple(R.PROFILE_WITHOUT_AGE)) -> DataFrame:
    """Distinct attribute combinations with and without the age column.

    If the entity's attributes never change the second count equals the
    number of entities. One pass: the three distinct counts are one
    aggregate; a struct is never NULL, so combinations containing NULLs
    count as values, as ``unique()`` does.
    """
    return df.agg(F.countDistinct(F.struct(*with_age)).alias("n_profiles_with_age"),
                  F.countDistinct(F.struct(*without_age)).alias("n_profiles_without_age"),
                  F.countDistinct(entity).alias("n_patients"))


def entity_attribute_drift(df: DataFrame, entity: str = R.ENTITY, attr: str = R.AGE) -> DataFrame:
    """Distinct |value - mean of the entity's distinct values| for entities
    with more than one distinct value.

    One shuffle on the entity: the set of distinct values per entity is
    gathered with a map-side combine. Its size is bounded by the
    attribute's domain (an age takes at most ~130 values), not by the
    number of rows of the entity.
    """
    sets = (df.groupBy(entity).agg(F.collect_set(attr).alias("vals"))
              .filter(F.size("vals") > 1))
    mean = F.aggregate("vals", F.lit(0.0), lambda acc, x: acc + x) / F.size("vals")
    diffs = sets.select(F.explode(F.transform("vals", lambda x: F.abs(x - mean))).alias("d"))
    return diffs.select(rounded("d").alias("age_diff")).distinct()


def latest_row_per_entity(df: DataFrame, entity: str = R.ENTITY, by: str = R.AGE,
                          tie: str = R.ROW_ID) -> DataFrame:
    """The row with the highest ``by`` per entity (ties: smallest ``tie``).

    ``max_by`` over a struct is an ordinary aggregate with partial
    aggregation, so a hot entity never gathers its rows in one buffer.
    """
    others = [c for c in df.columns if c != entity]
    best = F.max_by(F.struct(*others), F.struct(F.col(by), -F.col(tie)))
    return df.groupBy(entity).agg(best.alias("r")).select(entity, "r.*").select(*df.columns)


# ------------------------------------------------------------- by group

def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_by_gender(df: DataFrame, gender: str = R.GENDER) -> DataFrame:
    return count_by(df, gender)


def rate_by(df: DataFrame, key, label: str = R.LABEL, name: str = "ratio",
            with_count: bool = False) -> DataFrame:
    """Outcome rate per value of ``key`` (a column name or an aliased expression)."""
    aggs = [rounded(rate(label)).alias(name)]
    if with_count:
        aggs = [F.count(F.lit(1)).alias("count")] + aggs
    keys = key if isinstance(key, (list, tuple)) else [key]
    return df.groupBy(*keys).agg(*aggs)


def rate_by_gender(df: DataFrame, gender: str = R.GENDER, label: str = R.LABEL) -> DataFrame:
    """Share of each outcome within each gender (the facetted bar chart)."""
    counts = df.groupBy(gender, label).agg(F.count(F.lit(1)).alias("count"))
    within = Window.partitionBy(gender)
    return counts.select(gender, label, "count",
                         rounded(F.col("count") / F.sum("count").over(within)).alias("ratio"))


def rate_by_age_band(df: DataFrame, age: str = R.AGE, label: str = R.LABEL) -> DataFrame:
    """Rate by decade of age (90+ pooled), over rows with a valid age."""
    banded = (valid_age(df, age)
                .select(decade_band(age).alias("rounded_age"), label)
                .filter(F.col("rounded_age") >= 0))
    return rate_by(banded, "rounded_age", label)


def rate_by_date(df: DataFrame, day: str = R.DAY, label: str = R.LABEL) -> DataFrame:
    return rate_by(df, F.to_date(day).alias("app_date"), label, name="no_show_rate")


def rate_by_days_between(df: DataFrame, booked: str = R.BOOKED, day: str = R.DAY,
                         label: str = R.LABEL) -> DataFrame:
    return rate_by(df, days_between(day, booked).alias("days_between"), label)


def rate_by_weekday(df: DataFrame, day: str = R.DAY, label: str = R.LABEL) -> DataFrame:
    return rate_by(df, weekday(day).alias("weekday"), label, name="no_show_mean")


def sms_effect(df: DataFrame, booked: str = R.BOOKED, day: str = R.DAY,
               sms: str = R.SMS, label: str = R.LABEL) -> DataFrame:
    """Count and rate by three-way SMS status (gap < 3 days: does not apply)."""
    status = sms_status(days_between(day, booked), F.col(sms)).alias("sms_received")
    return rate_by(df, status, label, name="no_show_rate", with_count=True)


def bias_by_same_day_visits(df: DataFrame, entity: str = R.ENTITY, day: str = R.DAY,
                            label: str = R.LABEL, base_rate: DataFrame | None = None) -> DataFrame:
    """Rate minus the global rate by visits of the entity that day; the
    row count is scaled back to entity-days (``count / nbr``).

    ``base_rate`` (one row, column ``base_rate``) may be given to use a
    rate computed on another frame (the original used the rate from
    before its age filter); by default it is the rate of ``df``, summed
    from the per-count table instead of a second pass.
    """
    per_day = df.groupBy(entity, day).agg(F.count(F.lit(1)).alias("nbr"),
                                          F.sum(as_flag(label)).alias("pos"))
    by_n = per_day.groupBy(F.col("nbr").alias("nbr_app_that_day")).agg(
        F.sum("nbr").alias("rows"), F.sum("pos").alias("pos"))
    base = base_rate if base_rate is not None else by_n.agg((F.sum("pos") / F.sum("rows")).alias("base_rate"))
    return (by_n
            .select("nbr_app_that_day",
                    rounded(F.col("pos") / F.col("rows") - base.select("base_rate").scalar()).alias("bias"),
                    (F.col("rows") / F.col("nbr_app_that_day")).cast("double").alias("count")))


# ----------------------------------------------------------- group ranks

def top_groups(df: DataFrame, n: int = 5, group: str = R.GROUP, ascending: bool = False) -> DataFrame:
    """Busiest (or quietest) ``n`` groups; ties go by group name.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each partition
    keeps its own top n, so only n rows per partition reach the merge.
    """
    counts = count_by(df, group)
    order = F.col("count").asc() if ascending else F.col("count").desc()
    return counts.orderBy(order, F.col(group).asc()).limit(n)


def group_rate_extremes(df: DataFrame, n: int = 10, min_rows: int = 20,
                        group: str = R.GROUP, label: str = R.LABEL) -> DataFrame:
    """The ``n`` highest and ``n`` lowest group rates among groups with at
    least ``min_rows`` rows (all groups when there are ``2n`` or fewer).

    Order is the unrounded rate descending, then group name; the lowest ``n`` are the
    last ``n`` of that order. Two distributed top-n's and a union, so the
    number of groups never has to fit one task.
    """
    stats = (df.groupBy(group)
               .agg(rate(label).alias("__rate"), F.count(F.lit(1)).alias("count"))
               .filter(F.col("count") >= min_rows))
    top = stats.orderBy(F.col("__rate").desc(), F.col(group).asc()).limit(n)
    bottom = stats.orderBy(F.col("__rate").asc(), F.col(group).desc()).limit(n)
    both = top.unionByName(bottom).dropDuplicates([group])
    return both.select(group, rounded("__rate").alias("no_show_ratio"), "count")


# ------------------------------------------------------------ histograms

def hist_binwidth(df: DataFrame, col: str = R.AGE, width: int = 5,
                  out: str = "age_bin") -> DataFrame:
    """Fixed-width histogram with bins centred on multiples of ``width``,
    closed on the right: ``(c - w/2, c + w/2]``. Empty bins inside the
    range are reported with count 0.

    The dense bin list is generated from the one-row min/max aggregate;
    its length is (max - min) / width, bounded by the column's range.
    """
    binned = df.select(F.ceil((F.col(col) - F.lit(width / 2.0)) / width).cast("long").alias("b"))
    counts = binned.groupBy("b").agg(F.count(F.lit(1)).alias("count"))
    dense = (binned.agg(F.min("b").alias("lo"), F.max("b").alias("hi"))
                   .select(F.explode(F.sequence("lo", "hi")).alias("b")))
    return (dense.join(counts, "b", "left")
                 .select((F.col("b") * width).cast("int").alias(out),
                         F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def hist_bins(df: DataFrame, col: str = R.AGE, bins: int = 30) -> DataFrame:
    """Histogram with a fixed number of bins over [min, max]: width
    ``(max - min) / (bins - 1)``, bins centred on ``min + i * width``,
    closed on the right. Exact integer arithmetic decides the bin so
    that values on an edge land the same way in every engine.
    """
    stats = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    st = stats.select(F.struct("lo", "hi").alias("s")).scalar()
    lo, hi = st.getField("lo"), st.getField("hi")
    x = df.select(F.col(col).alias("x"))
    rng = hi - lo
    k = 2 * (bins - 1)
    b = F.when(rng == 0, F.lit(0)).otherwise(
        F.ceil((F.lit(k) * (F.col("x") - lo) - rng) / (F.lit(2) * rng)))
    counts = x.groupBy(b.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    dense = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    centre = lo + F.col("bin") * (hi - lo) / F.lit(float(bins - 1))
    return (dense.join(counts, "bin", "left")
                 .select(F.col("bin").cast("int").alias("bin"), rounded(centre).alias("x"),
                         F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def hist_age_binwidth(df: DataFrame, age: str = R.AGE) -> DataFrame:
    """Appointments by age in 5-year bins, over rows with a valid age."""
    return hist_binwidth(valid_age(df, age), age, 5)


def hist_age_30bins(df: DataFrame, entity: str = R.ENTITY, age: str = R.AGE) -> DataFrame:
    """Entities by their highest age, 30 bins, over rows with a valid age."""
    per_entity = valid_age(df, age).groupBy(entity).agg(F.max(age).alias(age))
    return hist_bins(per_entity, age, 30)

"""DuckDB oracle SQL for the correctness gate.

Only the base tables are registered in the oracle, so every statement
inlines the ``appointments`` view as a CTE (``with_view``).
"""

from __future__ import annotations

# Fixed fixture definition (same derivation as cohortlens.sources.appointments).
APPOINTMENTS_CTE = """
e AS (SELECT event_id, ts, user_id, event_type, value,
        CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events),
j AS (SELECT e.*, c.c_custkey, c.c_acctbal, c.c_mktsegment, c.c_nationkey, n.n_name,
        CAST(e.user_id * 100 + e.k AS BIGINT) AS patient_id,
        CAST((e.k + e.event_id) % 12 - 1 AS INT) AS gap
      FROM e JOIN customer c ON e.user_id = c.c_custkey
             JOIN nation n ON c.c_nationkey = n.n_nationkey),
appointments AS (
  SELECT patient_id, event_id AS appointment_id,
    (c_custkey % 3) <> 0 AS gender, ts AS scheduled_ts,
    CAST(CAST(ts AS DATE) + gap AS TIMESTAMP) AS appointment_day,
    CAST(floor(c_acctbal / 100) AS INT)
      + CASE WHEN extract(day FROM ts) > 1 + patient_id % 120 THEN 1 ELSE 0 END AS age,
    concat(n_name, '/', c_mktsegment) AS neighbourhood,
    c_mktsegment = 'BUILDING' AS scholarship, c_mktsegment = 'HOUSEHOLD' AS hipertension,
    c_mktsegment = 'MACHINERY' AS diabetes, c_mktsegment = 'FURNITURE' AS alcoholism,
    CAST(c_nationkey % 5 AS INT) AS handcap,
    gap >= 3 AND value >= 15 AS sms_received,
    event_type = 'error' OR (event_type = 'view' AND gap >= 7) AS no_show
  FROM j)"""

APPOINTMENT_COLUMNS = [
    "patient_id", "appointment_id", "gender", "scheduled_ts", "appointment_day",
    "age", "neighbourhood", "scholarship", "hipertension", "diabetes",
    "alcoholism", "handcap", "sms_received", "no_show",
]
COLUMN_TYPES = {
    "patient_id": "bigint", "appointment_id": "bigint", "gender": "boolean",
    "scheduled_ts": "timestamp_ntz", "appointment_day": "timestamp_ntz", "age": "int",
    "neighbourhood": "string", "scholarship": "boolean", "hipertension": "boolean",
    "diabetes": "boolean", "alcoholism": "boolean", "handcap": "int",
    "sms_received": "boolean", "no_show": "boolean",
}

RATE = "round(avg(CAST(no_show AS INT)), 6)"
GAP = "CAST(date_diff('day', CAST(scheduled_ts AS DATE), CAST(appointment_day AS DATE)) AS INT)"


VALID = "valid AS (SELECT * FROM appointments WHERE age >= 0)"


def with_view(*ctes: str, body: str) -> str:
    """``WITH <appointments>, <ctes...> <body>``."""
    parts = [APPOINTMENTS_CTE.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


PROFILED = ("gender", "neighbourhood", "handcap")


def _profile_columns() -> str:
    parts = []
    for c in APPOINTMENT_COLUMNS:
        parts.append(
            f"SELECT '{c}' AS column_name, '{COLUMN_TYPES[c]}' AS data_type, count(*) AS n, "
            f"count(*) - count({c}) AS n_null, "
            f"{f'count(DISTINCT {c})' if c in PROFILED else 'CAST(NULL AS BIGINT)'} AS n_distinct, "
            f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value "
            f"FROM appointments")
    return with_view(body="\nUNION ALL\n".join(parts))


def _completeness() -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS n_null "
             f"FROM appointments" for c in APPOINTMENT_COLUMNS]
    anynull = " OR ".join(f"{c} IS NULL" for c in APPOINTMENT_COLUMNS)
    parts.append(f"SELECT '*' AS column_name, CAST(count(*) FILTER (WHERE {anynull}) AS BIGINT) "
                 f"AS n_null FROM appointments")
    return with_view(body="SELECT column_name, n_null, n_null = 0 AS complete FROM (\n"
                          + "\nUNION ALL\n".join(parts) + ")")


PROFILE = {
    "overall_rate": with_view(body=f"SELECT count(*) AS n_rows, {RATE} AS no_show_rate FROM appointments"),
    "distinct_counts": with_view(body=(
        "SELECT count(*) AS n_rows, count(DISTINCT appointment_id) AS n_appointments, "
        "count(DISTINCT patient_id) AS n_patients, count(DISTINCT neighbourhood) AS n_neighbourhoods "
        "FROM appointments")),
    "corr_id_time": with_view(body=(
        "SELECT round(corr(epoch_us(scheduled_ts) / 1e6, CAST(appointment_id AS DOUBLE)), 6) "
        "AS corr_id_time FROM appointments")),
    "time_span": with_view(body=(
        "SELECT min(appointment_day) AS first_day, max(appointment_day) AS last_day FROM appointments")),
    "age_range": with_view(body="SELECT max(age) AS max_age, min(age) AS min_age FROM appointments"),
    "appointment_timeline": with_view(body=(
        "SELECT scheduled_ts, appointment_id FROM appointments ORDER BY scheduled_ts, appointment_id")),
    "visits_per_entity": with_view(body=(
        "SELECT patient_id, count(*) AS n_visits FROM appointments GROUP BY patient_id")),
    "visits_per_entity_day": with_view(body=(
        "SELECT patient_id, appointment_day, count(*) AS nbr_app_that_day FROM appointments "
        "GROUP BY patient_id, appointment_day")),
    "visits_per_entity_cumulative": with_view(
        "p AS (SELECT patient_id, count(*) AS n FROM appointments GROUP BY patient_id)",
        "b AS (SELECT CASE WHEN n > 9 THEN 'ten_or_more' ELSE CAST(n AS VARCHAR) END "
        "AS app_number_per_patient, CAST(sum(n) AS BIGINT) AS app_number FROM p GROUP BY 1)",
        body=("SELECT app_number_per_patient, app_number, round(100.0::DOUBLE * sum(app_number) OVER "
              "(ORDER BY app_number_per_patient ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
              "/ sum(app_number) OVER (), 6) AS cumulated_percentage FROM b")),
    "rate_by_visit_bucket": with_view(
        "p AS (SELECT patient_id, count(*) AS n, sum(CAST(no_show AS INT)) AS pos "
        "FROM appointments GROUP BY patient_id)",
        body=("SELECT CASE WHEN n > 5 THEN 'more than 5' ELSE CAST(n AS VARCHAR) END AS app_per_patient, "
              "round(CAST(sum(pos) AS DOUBLE) / sum(n), 6) AS no_show_ratio FROM p GROUP BY 1")),
    "distinct_profiles": with_view(
        "a AS (SELECT count(*) AS n_profiles_with_age FROM (SELECT DISTINCT patient_id, gender, age, "
        "scholarship, hipertension, diabetes, alcoholism, handcap FROM appointments))",
        "b AS (SELECT count(*) AS n_profiles_without_age FROM (SELECT DISTINCT patient_id, gender, "
        "neighbourhood, scholarship, hipertension, diabetes, alcoholism, handcap FROM appointments))",
        "c AS (SELECT count(DISTINCT patient_id) AS n_patients FROM appointments)",
        body="SELECT * FROM a, b, c"),
    "entity_attribute_drift": with_view(
        "d AS (SELECT DISTINCT patient_id, age FROM appointments)",
        "s AS (SELECT patient_id, avg(age) AS a FROM d GROUP BY patient_id HAVING count(*) > 1)",
        body="SELECT DISTINCT round(abs(d.age - s.a), 6) AS age_diff FROM d JOIN s USING (patient_id)"),
    "latest_row_per_entity": with_view(body=(
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY patient_id "
        "ORDER BY age DESC, appointment_id ASC) AS rn FROM appointments) WHERE rn = 1")),
    "count_by_gender": with_view(body="SELECT gender, count(*) AS count FROM appointments GROUP BY gender"),
    "rate_by_gender": with_view(
        "c AS (SELECT gender, no_show, count(*) AS count FROM appointments GROUP BY gender, no_show)",
        body=("SELECT gender, no_show, count, round(count / sum(count) OVER (PARTITION BY gender), 6) "
              "AS ratio FROM c")),
    "rate_by_age_band": with_view(
        "a AS (SELECT CAST(floor(age / 10) * 10 AS INT) AS r, no_show FROM appointments WHERE age >= 0)",
        "b AS (SELECT CASE WHEN r >= 90 THEN 90 ELSE r END AS rounded_age, no_show FROM a)",
        body=f"SELECT rounded_age, {RATE} AS ratio FROM b WHERE rounded_age >= 0 GROUP BY rounded_age"),
    "rate_by_date": with_view(VALID, body=(
        f"SELECT CAST(appointment_day AS DATE) AS app_date, {RATE} AS no_show_rate "
        "FROM valid GROUP BY 1")),
    "rate_by_days_between": with_view(VALID, body=(
        f"SELECT {GAP} AS days_between, {RATE} AS ratio FROM valid GROUP BY 1")),
    "rate_by_weekday": with_view(VALID, body=(
        f"SELECT CAST(dayofweek(appointment_day) + 1 AS INT) AS weekday, {RATE} AS no_show_mean "
        "FROM valid GROUP BY 1")),
    "sms_effect": with_view(VALID, body=(
        f"SELECT CASE WHEN {GAP} < 3 THEN 'does_not_apply' WHEN sms_received THEN 'yes' ELSE 'no' END "
        f"AS sms_received, count(*) AS count, {RATE} AS no_show_rate FROM valid GROUP BY 1")),
    "bias_by_same_day_visits": with_view(
        VALID,
        "d AS (SELECT patient_id, appointment_day, count(*) AS nbr, sum(CAST(no_show AS INT)) AS pos "
        "FROM valid GROUP BY 1, 2)",
        "n AS (SELECT nbr AS nbr_app_that_day, sum(nbr) AS rows_, sum(pos) AS pos FROM d GROUP BY 1)",
        "g AS (SELECT avg(CAST(no_show AS INT)) AS base_rate FROM appointments)",
        body=("SELECT nbr_app_that_day, round(CAST(pos AS DOUBLE) / rows_ - base_rate, 6) AS bias, "
              "CAST(rows_ / nbr_app_that_day AS DOUBLE) AS count FROM n, g")),
    "top5_groups": with_view(VALID, body=(
        "SELECT neighbourhood, count(*) AS count FROM valid GROUP BY neighbourhood "
        "ORDER BY count DESC, neighbourhood ASC LIMIT 5")),
    "bottom5_groups": with_view(VALID, body=(
        "SELECT neighbourhood, count(*) AS count FROM valid GROUP BY neighbourhood "
        "ORDER BY count ASC, neighbourhood ASC LIMIT 5")),
    "group_rate_extremes": with_view(
        VALID,
        "s AS (SELECT neighbourhood, avg(CAST(no_show AS INT)) AS rate, count(*) AS count FROM valid "
        "GROUP BY neighbourhood HAVING count(*) >= 20)",
        "r AS (SELECT *, row_number() OVER (ORDER BY rate DESC, neighbourhood ASC) AS a, "
        "row_number() OVER (ORDER BY rate ASC, neighbourhood DESC) AS b FROM s)",
        body="SELECT neighbourhood, round(rate, 6) AS no_show_ratio, count FROM r WHERE a <= 10 OR b <= 10"),
    "hist_age_binwidth": with_view(
        "x AS (SELECT CAST(ceil((age - 2.5) / 5) AS BIGINT) AS b FROM appointments WHERE age >= 0)",
        "c AS (SELECT b, count(*) AS count FROM x GROUP BY b)",
        "r AS (SELECT unnest(generate_series(min(b), max(b))) AS b FROM x)",
        body=("SELECT CAST(r.b * 5 AS INT) AS age_bin, CAST(coalesce(c.count, 0) AS BIGINT) AS count "
              "FROM r LEFT JOIN c USING (b)")),
    "hist_age_30bins": with_view(
        "p AS (SELECT patient_id, max(age) AS age FROM appointments WHERE age >= 0 GROUP BY patient_id)",
        "s AS (SELECT min(age) AS lo, max(age) AS hi FROM p)",
        "c AS (SELECT CAST(CASE WHEN s.hi = s.lo THEN 0 ELSE ceil((58 * (p.age - s.lo) - (s.hi - s.lo)) "
        "/ (2 * (s.hi - s.lo))) END AS BIGINT) AS bin, count(*) AS count FROM p, s GROUP BY 1)",
        "d AS (SELECT lo, hi, unnest(generate_series(0, 29)) AS bin FROM s)",
        body=("SELECT CAST(d.bin AS INT) AS bin, round(d.lo + d.bin * (d.hi - d.lo) / CAST(29 AS DOUBLE), 6) "
              "AS x, CAST(coalesce(c.count, 0) AS BIGINT) AS count FROM d LEFT JOIN c USING (bin)")),
    "preview": with_view(body="SELECT * FROM appointments ORDER BY appointment_id LIMIT 10"),
    "profile_columns": _profile_columns(),
    "completeness_check": _completeness(),
    "recode_types": with_view(body=(
        "SELECT *, CASE WHEN no_show THEN 'Yes' ELSE 'No' END AS no_show_label FROM appointments")),
    "scan_csv_roundtrip": with_view(body="SELECT * FROM appointments"),
}

ORACLES: dict[str, str] = {}
ORACLES.update(PROFILE)


# ------------------------------------------------------ splits / encoders

def md5_order(purpose: str, id_col: str = "appointment_id", seed: int = 1) -> str:
    return f"md5(concat(CAST({id_col} AS VARCHAR), ':{seed}:{purpose}')), {id_col}"


def split_ctes(src: str, name: str, purpose: str = "test", p: float = 0.1, seed: int = 1) -> list[str]:
    """Quartile strata of appointment_id, then ceil(p * n) rows per stratum
    in md5 order -> CTE ``name`` = src columns + stratum + in_holdout."""
    return [
        f"{name}_q AS (SELECT quantile_cont(appointment_id, [0.25, 0.5, 0.75]) AS qs FROM {src})",
        f"{name}_s AS (SELECT x.*, CASE WHEN appointment_id <= qs[1] THEN 0 WHEN appointment_id <= qs[2] "
        f"THEN 1 WHEN appointment_id <= qs[3] THEN 2 ELSE 3 END AS stratum FROM {src} x, {name}_q)",
        f"{name}_h AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY {md5_order(purpose, seed=seed)}) "
        f"AS rn_, count(*) OVER (PARTITION BY stratum) AS ns_ FROM {name}_s)",
        f"{name} AS (SELECT * EXCLUDE (rn_, ns_), rn_ <= ceil({p} * ns_) AS in_holdout FROM {name}_h)",
    ]


THREE_WAY = split_ctes("appointments", "sp1") + [
    "rest AS (SELECT * EXCLUDE (stratum, in_holdout) FROM sp1 WHERE NOT in_holdout)",
] + split_ctes("rest", "sp2", "dev") + [
    "three AS (SELECT appointment_id, 'test' AS split FROM sp1 WHERE in_holdout UNION ALL "
    "SELECT appointment_id, CASE WHEN in_holdout THEN 'dev' ELSE 'train' END AS split FROM sp2)",
]

KFOLD = ("k AS (SELECT a.*, CAST(floor((row_number() OVER (ORDER BY "
         f"{md5_order('fold')}) - 1) * 10 / count(*) OVER ()) + 1 AS INT) AS fold FROM appointments a)")

DAYS_SCORED = [
    f"dv AS (SELECT *, {GAP} AS days_between FROM appointments)",
    "scored AS (SELECT *, avg(CAST(no_show AS INT)) OVER (PARTITION BY days_between) AS score FROM dv)",
]

ROC = [
    f"pts AS (SELECT CAST({GAP} AS DOUBLE) AS threshold, sum(CAST(no_show AS INT)) AS pos, "
    "sum(1 - CAST(no_show AS INT)) AS neg FROM appointments GROUP BY 1)",
    "cum AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) "
    "AS fp, sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM pts)",
]


def _confusion_sql() -> str:
    counts = " UNION ALL ".join(
        f"SELECT CAST({c} AS DOUBLE) AS cutoff, "
        f"CAST(count(*) FILTER (WHERE score > {c} AND no_show) AS BIGINT) AS tp, "
        f"CAST(count(*) FILTER (WHERE score > {c} AND NOT no_show) AS BIGINT) AS fp, "
        f"CAST(count(*) FILTER (WHERE NOT (score > {c}) AND no_show) AS BIGINT) AS fn, "
        f"CAST(count(*) FILTER (WHERE NOT (score > {c}) AND NOT no_show) AS BIGINT) AS tn FROM scored"
        for c in (0.32, 0.55))
    n = "(tp + fp + fn + tn)"
    acc = f"CAST(tp + tn AS DOUBLE) / {n}"
    pe = f"(CAST((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn) AS DOUBLE) / ({n} * {n}))"
    sens = "CASE WHEN tp + fn <> 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END"
    spec = "CASE WHEN tn + fp <> 0 THEN CAST(tn AS DOUBLE) / (tn + fp) END"
    ppv = "CASE WHEN tp + fp <> 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END"
    npv = "CASE WHEN tn + fn <> 0 THEN CAST(tn AS DOUBLE) / (tn + fn) END"
    body = (
        f"SELECT cutoff, tp, fp, fn, tn, round({acc}, 6) AS accuracy, "
        f"round(CASE WHEN tp + fn > fp + tn THEN tp + fn ELSE fp + tn END / {n}, 6) AS no_information_rate, "
        f"round(CASE WHEN {pe} < 1 THEN ({acc} - {pe}) / (1 - {pe}) END, 6) AS kappa, "
        f"round({sens}, 6) AS sensitivity, round({spec}, 6) AS specificity, round({ppv}, 6) AS ppv, "
        f"round({npv}, 6) AS npv, "
        f"round(CASE WHEN ({ppv}) + ({sens}) > 0 THEN 2 * ({ppv}) * ({sens}) / (({ppv}) + ({sens})) END, 6) AS f1, "
        f"round(CAST(tp + fn AS DOUBLE) / {n}, 6) AS prevalence, round(CAST(tp AS DOUBLE) / {n}, 6) AS detection_rate, "
        f"round(CAST(tp + fp AS DOUBLE) / {n}, 6) AS detection_prevalence, "
        f"round((({sens}) + ({spec})) / 2, 6) AS balanced_accuracy, "
        f"round(CASE WHEN fp + fn > 0 THEN power(abs(fp - fn) - 1, 2) / CAST(fp + fn AS DOUBLE) END, 6) "
        f"AS mcnemar_statistic FROM c")
    return with_view(*DAYS_SCORED, f"c AS ({counts})", body=body)


_FM_COLS = ("s.appointment_id, s.patient_id, s.gender, s.scheduled_ts, s.appointment_day, s.age, "
            "s.scholarship, s.hipertension, s.diabetes, s.alcoholism, s.handcap, s.sms_received, "
            "s.no_show, s.in_holdout")


def _feature_ctes(lam: int) -> list[str]:
    return split_ctes("appointments", "sp1") + [
        "tr AS (SELECT * FROM sp1 WHERE NOT in_holdout AND age >= 0)",
        "g AS (SELECT avg(CAST(no_show AS INT)) AS base_rate FROM tr)",
        "nb AS (SELECT neighbourhood, avg(CAST(no_show AS INT)) - (SELECT base_rate FROM g) AS bias_per_nbh "
        f"FROM tr GROUP BY neighbourhood HAVING count(*) > {lam})",
        "pp AS (SELECT patient_id, count(*) AS nbr_app_per_patient FROM tr GROUP BY patient_id)",
        "pd AS (SELECT patient_id, appointment_day, count(*) AS nbr_app_that_day FROM tr "
        "GROUP BY patient_id, appointment_day)",
        "fm AS (SELECT s.*, coalesce(nb.bias_per_nbh, 0.0) AS bias_per_nbh, "
        f"{GAP.replace('scheduled_ts', 's.scheduled_ts').replace('appointment_day', 's.appointment_day')} AS days_between, "
        "CAST(dayofweek(s.scheduled_ts) + 1 AS INT) AS wday_sched, "
        "CAST(dayofweek(s.appointment_day) + 1 AS INT) AS wday_app, CAST(hour(s.scheduled_ts) AS INT) AS hour_sched, "
        "CAST(coalesce(pp.nbr_app_per_patient, 0) AS DOUBLE) AS nbr_app_per_patient, "
        "CAST(coalesce(pd.nbr_app_that_day, 0) AS DOUBLE) AS nbr_app_that_day "
        "FROM (SELECT * FROM sp1 WHERE in_holdout OR age >= 0) s LEFT JOIN nb USING (neighbourhood) LEFT JOIN pp USING (patient_id) "
        "LEFT JOIN pd USING (patient_id, appointment_day))",
    ]


def _contrasts_sql() -> str:
    """Weekdays of booking; Sunday (1) is the baseline."""
    raw = ["patient_id", "gender", "scheduled_ts", "appointment_day", "age", "scholarship", "hipertension", "diabetes", "alcoholism", "handcap"]
    cols = [f"round({'epoch_us(' + c + ') / 1e6' if c in ('scheduled_ts', 'appointment_day') else 'CAST(' + c + ' AS DOUBLE)'}, 6) AS {c}" for c in raw]
    cols += [f"CAST(CASE WHEN days_between >= 3 AND {c} THEN 1 ELSE 0 END AS DOUBLE) AS sms_received_{v}" for v, c in (("no", "NOT sms_received"), ("yes", "sms_received"))]
    cols += [f"CAST(wday_sched = {n} AS DOUBLE) AS weekday_{n}" for n in range(2, 8)]
    return with_view(*_feature_ctes(15), body=(
        f"SELECT appointment_id, {', '.join(cols)}, round(bias_per_nbh, 6) AS bias_per_nbh, CAST(days_between AS DOUBLE) AS days_between, "
        "CAST(no_show AS DOUBLE) AS label FROM fm"))


def _oof_matrix_sql(lam: int) -> str:
    """Encoders refitted for every fold on the other folds (fold NULL: on
    all training rows)."""
    gap = GAP.replace("scheduled_ts", "s.scheduled_ts").replace("appointment_day", "s.appointment_day")
    ctes = split_ctes("appointments", "sp1") + [
        "tr AS (SELECT * EXCLUDE (stratum), CAST(floor((row_number() OVER (ORDER BY "
        f"{md5_order('fold')}) - 1) * 10 / count(*) OVER ()) + 1 AS INT) AS fold FROM sp1 WHERE NOT in_holdout AND age >= 0)",
        "fs AS (SELECT unnest([NULL, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]) AS f)",
        "o AS (SELECT f, tr.* FROM fs JOIN tr ON f IS NULL OR f <> fold)",
        "g AS (SELECT f, avg(CAST(no_show AS INT)) AS base FROM o GROUP BY f)",
        "nb AS (SELECT o.f, neighbourhood, avg(CAST(no_show AS INT)) - any_value(base) AS bias FROM o JOIN g ON o.f IS NOT DISTINCT FROM g.f "
        f"GROUP BY 1, 2 HAVING count(*) > {lam})",
        "pp AS (SELECT f, patient_id, count(*) AS n FROM o GROUP BY 1, 2)",
        "pd AS (SELECT f, patient_id, appointment_day, count(*) AS n FROM o GROUP BY 1, 2, 3)",
        "s AS (SELECT * FROM tr UNION ALL SELECT * EXCLUDE (stratum), NULL FROM sp1 WHERE in_holdout)",
    ]
    return with_view(*ctes, body=(
        f"SELECT s.* EXCLUDE (neighbourhood), {gap} AS days_between, CAST(dayofweek(s.scheduled_ts) + 1 AS INT) AS wday_sched, "
        "CAST(dayofweek(s.appointment_day) + 1 AS INT) AS wday_app, CAST(hour(s.scheduled_ts) AS INT) AS hour_sched, "
        "round(coalesce(nb.bias, 0.0), 6) AS bias_per_nbh, CAST(coalesce(pp.n, 0) AS DOUBLE) AS nbr_app_per_patient, "
        "CAST(coalesce(pd.n, 0) AS DOUBLE) AS nbr_app_that_day FROM s "
        "LEFT JOIN nb ON nb.f IS NOT DISTINCT FROM s.fold AND nb.neighbourhood = s.neighbourhood "
        "LEFT JOIN pp ON pp.f IS NOT DISTINCT FROM s.fold AND pp.patient_id = s.patient_id "
        "LEFT JOIN pd ON pd.f IS NOT DISTINCT FROM s.fold AND pd.patient_id = s.patient_id AND pd.appointment_day = s.appointment_day"))


_DESIGN = ["patient_id", "gender", "scheduled_ts", "appointment_day", "age", "scholarship",
           "hipertension", "diabetes", "alcoholism", "handcap", "sms_received", "bias_per_nbh",
           "days_between", "wday_sched", "wday_app", "hour_sched", "nbr_app_per_patient",
           "nbr_app_that_day"]


def _design_sql() -> str:
    cols = []
    for c in _DESIGN:
        e = f"epoch_us({c}) / 1e6" if c in ("scheduled_ts", "appointment_day") else f"CAST({c} AS DOUBLE)"
        cols.append(f"round({e}, 6) AS {c}")
    return with_view(*_feature_ctes(15), body=(
        f"SELECT appointment_id, {', '.join(cols)}, CAST(no_show AS DOUBLE) AS label FROM fm"))


MODEL_FREE = {
    "holdout_split": with_view(*split_ctes("appointments", "sp1"),
                               body="SELECT appointment_id, stratum, in_holdout FROM sp1"),
    "holdout_split_anti": with_view(*split_ctes("appointments", "sp1"),
                                    body="SELECT * EXCLUDE (stratum, in_holdout) FROM sp1 WHERE NOT in_holdout"),
    "three_way_split": with_view(*THREE_WAY, body="SELECT * FROM three"),
    "recombine_splits": with_view(*THREE_WAY, body="SELECT * FROM three WHERE split <> 'test'"),
    "kfold_assign": with_view(KFOLD, body="SELECT appointment_id, fold FROM k"),
    "balanced_sample": with_view(
        f"b AS (SELECT appointment_id, no_show, row_number() OVER (PARTITION BY no_show ORDER BY {md5_order('balance')}) "
        "AS rn FROM appointments)", body="SELECT appointment_id, no_show FROM b WHERE rn <= 500"),
    "bias_per_group": with_view(
        "g AS (SELECT avg(CAST(no_show AS INT)) AS base_rate FROM appointments)",
        body=("SELECT neighbourhood, round(avg(CAST(no_show AS INT)) - (SELECT base_rate FROM g), 6) "
              "AS bias_per_nbh FROM appointments GROUP BY neighbourhood HAVING count(*) > 15")),
    "bias_per_entity": with_view(
        "g AS (SELECT avg(CAST(no_show AS INT)) AS base_rate FROM appointments)",
        body=("SELECT patient_id, round(avg(CAST(no_show AS INT)) - (SELECT base_rate FROM g), 6) "
              "AS bias_per_patient FROM appointments GROUP BY patient_id HAVING count(*) > 4")),
    "natural_left_join": with_view(
        "d AS (SELECT patient_id, appointment_day, count(*) AS nbr_app_that_day FROM appointments GROUP BY 1, 2)",
        body="SELECT a.*, d.nbr_app_that_day FROM appointments a LEFT JOIN d USING (patient_id, appointment_day)"),
    "feature_matrix": with_view(*_feature_ctes(50), body=(
        f"SELECT * EXCLUDE (neighbourhood, stratum, bias_per_nbh), round(bias_per_nbh, 6) AS bias_per_nbh FROM fm")),
    "feature_matrix_saved": with_view(*_feature_ctes(50), body=(
        f"SELECT * EXCLUDE (neighbourhood, stratum, bias_per_nbh), round(bias_per_nbh, 6) AS bias_per_nbh FROM fm")),
    "feature_matrix_oof": _oof_matrix_sql(50),
    "feature_sink_bucketed": with_view(*_feature_ctes(50), "vis AS (SELECT patient_id, count(*) AS n_visits FROM appointments GROUP BY 1)", body=(
        "SELECT * EXCLUDE (neighbourhood, stratum, bias_per_nbh), round(bias_per_nbh, 6) AS bias_per_nbh FROM fm JOIN vis USING (patient_id)")),
    "design_matrix_contrasts": _contrasts_sql(),
    "design_matrix": _design_sql(),
    "oof_target_encode": with_view(
        KFOLD,
        "kf AS (SELECT neighbourhood, fold, count(*) AS n, sum(CAST(no_show AS INT)) AS p FROM k GROUP BY 1, 2)",
        "kt AS (SELECT neighbourhood, sum(n) AS nt, sum(p) AS pt FROM kf GROUP BY 1)",
        "ff AS (SELECT fold, sum(n) AS fn, sum(p) AS fp FROM kf GROUP BY 1)",
        "tot AS (SELECT sum(fn) AS l, sum(fp) AS pl FROM ff)",
        "fb AS (SELECT fold, CAST(pl - fp AS DOUBLE) / (l - fn) AS b FROM ff, tot)",
        "enc AS (SELECT kf.neighbourhood, kf.fold, CAST(kt.pt - kf.p AS DOUBLE) / (kt.nt - kf.n) - fb.b AS bias "
        "FROM kf JOIN kt USING (neighbourhood) JOIN fb USING (fold) WHERE kt.nt - kf.n > 100)",
        body=("SELECT k.appointment_id, k.fold, round(coalesce(enc.bias, 0.0), 6) AS bias_per_nbh "
              "FROM k LEFT JOIN enc USING (neighbourhood, fold)")),
    "roc_curve": with_view(*ROC, body=(
        "SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(tp / P, 6) AS tpr, "
        "round(fp / N, 6) AS fpr FROM cum")),
    "roc_auc": with_view(*ROC, body=(
        "SELECT round(sum(neg * ((tp - pos) + pos / 2.0)) / (CAST(max(P) AS DOUBLE) * max(N)), 6) AS auc FROM cum")),
    "confusion_at_cutoff": _confusion_sql(),
    "cutoff_search": with_view(
        *DAYS_SCORED,
        "pts AS (SELECT CAST(score AS DOUBLE) AS threshold, sum(CAST(no_show AS INT)) AS pos, "
        "sum(1 - CAST(no_show AS INT)) AS neg FROM scored GROUP BY 1)",
        "cum AS (SELECT threshold, sum(pos) OVER (ORDER BY threshold DESC) AS tp, "
        "sum(neg) OVER (ORDER BY threshold DESC) AS fp, sum(pos) OVER () AS P FROM pts)",
        "t AS (SELECT threshold, CAST(tp AS DOUBLE) / P AS tpr, CAST(tp AS DOUBLE) / (tp + fp) AS ppv FROM cum)",
        "a AS (SELECT * FROM t WHERE tpr >= 0.5 ORDER BY threshold DESC LIMIT 1)",
        "b AS (SELECT * FROM t WHERE ppv >= 0.75 ORDER BY tpr DESC, threshold DESC LIMIT 1)",
        body=("SELECT 'sensitivity' AS target, 0.5::DOUBLE AS goal, a.threshold, round(a.tpr, 6) AS tpr, "
              "round(a.ppv, 6) AS ppv FROM (SELECT 1) one LEFT JOIN a ON TRUE UNION ALL "
              "SELECT 'ppv', 0.75::DOUBLE, b.threshold, round(b.tpr, 6), round(b.ppv, 6) "
              "FROM (SELECT 1) one LEFT JOIN b ON TRUE")),
    "two_class_summary": with_view(
        *DAYS_SCORED,
        "k AS (SELECT s.*, CAST(floor((row_number() OVER (ORDER BY "
        f"{md5_order('fold')}) - 1) * 10 / count(*) OVER ()) + 1 AS INT) AS fold FROM scored s)",
        "pts AS (SELECT fold, score, sum(CAST(no_show AS INT)) AS pos, sum(1 - CAST(no_show AS INT)) AS neg "
        "FROM k GROUP BY 1, 2)",
        "cum AS (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY score DESC) AS tp, "
        "sum(pos) OVER (PARTITION BY fold) AS P, sum(neg) OVER (PARTITION BY fold) AS N FROM pts)",
        "auc AS (SELECT fold, round(sum(neg * ((tp - pos) + pos / 2.0)) / (CAST(max(P) AS DOUBLE) * max(N)), 6) "
        "AS roc FROM cum GROUP BY fold)",
        "cm AS (SELECT fold, count(*) FILTER (WHERE score > 0.5 AND no_show) AS tp, "
        "count(*) FILTER (WHERE score > 0.5 AND NOT no_show) AS fp, "
        "count(*) FILTER (WHERE NOT (score > 0.5) AND no_show) AS fn, "
        "count(*) FILTER (WHERE NOT (score > 0.5) AND NOT no_show) AS tn FROM k GROUP BY fold)",
        body=("SELECT auc.fold, auc.roc, round(CASE WHEN tn + fp <> 0 THEN CAST(tn AS DOUBLE) / (tn + fp) END, 6) "
              "AS sens, round(CASE WHEN tp + fn <> 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END, 6) AS spec "
              "FROM auc JOIN cm USING (fold)")),
}
ORACLES.update(MODEL_FREE)


def _confusion_tests_sql() -> str:
    """Binomial tails summed term by term, interval bounds by bisection."""
    base = _confusion_sql()
    ctes, _, _ = base.partition("\nSELECT cutoff")
    tail = ("list_sum(list_transform(range({k}, n + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) "
            "+ j * ln({p}) + (n - j) * ln(1 - {p}))))")
    mid = "((lo + hi) / 2)"
    # lower: P[X >= ok | p] = 0.025; upper: P[X >= ok + 1 | p] = 0.975.
    z = "sqrt(power(abs(fp - fn) - 1, 2) / CAST(fp + fn AS DOUBLE) / 2)"
    erf = (f"list_sum(list_transform(range(0, 80), lambda i: CASE WHEN i % 2 = 0 THEN 1 ELSE -1 END * exp((2 * i + 1) * ln({z}) - lgamma(i + 1)) "
           "/ (2 * i + 1))) * 2 / sqrt(pi())")
    return (ctes.replace("WITH e AS", "WITH RECURSIVE e AS", 1) + f""",
n AS (SELECT *, tp + fp + fn + tn AS n, tp + tn AS ok, greatest(tp + fn, fp + tn) / CAST(tp + fp + fn + tn AS DOUBLE) AS nir FROM c),
b AS (SELECT cutoff, side, n, ok + side AS k, CASE WHEN side = 0 THEN 0.025 ELSE 0.975 END AS goal, 0 AS i,
      CAST(0 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi FROM n, (VALUES (0), (1)) v(side)
      UNION ALL SELECT cutoff, side, n, k, goal, i + 1, CASE WHEN t < goal THEN {mid} ELSE lo END, CASE WHEN t < goal THEN hi ELSE {mid} END
      FROM (SELECT *, {tail.format(k='k', p=mid)} AS t FROM b WHERE i < 45))
SELECT n.cutoff, tp, fp, fn, tn, round(CASE WHEN ok = 0 THEN 0.0 ELSE l.lo END, 6) AS accuracy_lower,
       round(CASE WHEN ok = n.n THEN 1.0 ELSE u.lo END, 6) AS accuracy_upper,
       round({tail.format(k='ok', p='nir').replace('n +', 'n.n +').replace('n -', 'n.n -')}, 6) AS accuracy_p_value,
       CASE WHEN fp + fn > 0 THEN round(CASE WHEN abs(fp - fn) = 1 THEN 1.0 WHEN {z} > 4.5 THEN 0.0 ELSE 1 - {erf} END, 6) END AS mcnemar_p_value
FROM n JOIN b l ON l.cutoff = n.cutoff AND l.side = 0 AND l.i = 45 JOIN b u ON u.cutoff = n.cutoff AND u.side = 1 AND u.i = 45""")


ORACLES["confusion_stats"] = _confusion_tests_sql()


# ------------------------------------------------------ feature-set variants

def _variants_sql() -> str:
    """Means over the training rows of every variant's predictors."""
    raw = ["patient_id", "gender", "scheduled_ts", "appointment_day", "age", "scholarship", "hipertension",
           "diabetes", "alcoholism", "handcap", "sms_received"]
    status = raw[:-1] + ["sms_received_no", "sms_received_yes"]
    dates = ["days_between", "wday_sched", "wday_app", "hour_sched"]
    counts = ["nbr_app_per_patient", "nbr_app_that_day"]
    rf9 = raw + ["bias_per_nbh_15"] + dates + counts
    lists = {
        "GLM": raw, "RF1": raw, "RF2": raw[1:], "RF3": raw[1:] + ["bias_per_patient"], "RF4": raw + ["bias_per_patient"],
        "RF5": raw + ["bias_per_nbh_15"], "RF6": raw + ["bias_per_nbh_15", "days_between"],
        "RF7": status + ["bias_per_nbh_15", "days_between"], "RF8": raw + ["bias_per_nbh_15"] + dates, "RF9": rf9, "RF10": rf9,
        "FINAL": raw + ["bias_per_nbh_50"] + dates + counts, "KNN1": rf9, "KNN2": rf9[1:], "KNN3": raw[1:] + ["bias_per_nbh_15"],
        "KNN4": [c for c in raw[1:] if c not in ("diabetes", "alcoholism", "hipertension", "handcap")] + ["bias_per_nbh_15"], "KNN5": raw[1:],
    }
    number = {"scheduled_ts": "epoch_us(tr.scheduled_ts) / 1e6", "appointment_day": "epoch_us(tr.appointment_day) / 1e6",
              "days_between": "gap", "wday_sched": "dayofweek(tr.scheduled_ts) + 1", "wday_app": "dayofweek(tr.appointment_day) + 1",
              "hour_sched": "hour(tr.scheduled_ts)", "bias_per_nbh_15": "coalesce(b15.bias, 0.0)", "bias_per_nbh_50": "coalesce(b50.bias, 0.0)",
              "bias_per_patient": "coalesce(bp.bias, 0.0)", "nbr_app_per_patient": "pp.n", "nbr_app_that_day": "pd.n",
              "sms_received_no": "CASE WHEN gap >= 3 AND NOT sms_received THEN 1 ELSE 0 END",
              "sms_received_yes": "CASE WHEN gap >= 3 AND sms_received THEN 1 ELSE 0 END"}
    used = dict.fromkeys(c for cols in lists.values() for c in cols)
    means = ", ".join(f"round(avg(CAST({number.get(c, 'tr.' + c)} AS DOUBLE)), {2 if c in ('scheduled_ts', 'appointment_day') else 6}) AS {c}" for c in used)
    bias = lambda key, n: (f"(SELECT {key}, avg(CAST(no_show AS INT)) - (SELECT avg(CAST(no_show AS INT)) FROM tr) AS bias "  # noqa: E731
                           f"FROM tr GROUP BY 1 HAVING count(*) > {n})")
    rows = " UNION ALL ".join(f"SELECT '{v}' AS variant, {i + 1} AS ordinal, '{c.replace('_15', '').replace('_50', '')}' AS column_name, {c} AS mean FROM m"
                              for v, cols in lists.items() for i, c in enumerate(cols))
    ctes = THREE_WAY + [
        f"tr AS MATERIALIZED (SELECT a.*, {GAP} AS gap FROM appointments a JOIN three t USING (appointment_id) WHERE t.split = 'train' AND age >= 0)",
        f"m AS MATERIALIZED (SELECT {means} FROM tr LEFT JOIN {bias('neighbourhood', 15)} b15 USING (neighbourhood) "
        f"LEFT JOIN {bias('neighbourhood', 50)} b50 USING (neighbourhood) LEFT JOIN {bias('patient_id', 4)} bp USING (patient_id) "
        "JOIN (SELECT patient_id, count(*) AS n FROM tr GROUP BY 1) pp USING (patient_id) "
        "JOIN (SELECT patient_id, appointment_day, count(*) AS n FROM tr GROUP BY 1, 2) pd USING (patient_id, appointment_day))",
    ]
    return with_view(*ctes, body=rows)


ORACLES["feature_variants"] = _variants_sql()


# -------------------------------------------------------------------- KNN

KNN_PAIRS = (
    "p AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, b.label AS neighbour_label, "
    "round(list_sum(list_transform(list_zip(a.embedding, b.embedding), "
    "lambda s: power(CAST(s[1] AS DOUBLE) - CAST(s[2] AS DOUBLE), 2))), 9) AS distance "
    "FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)",
    "nb AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY query_id ORDER BY distance) AS rk FROM p) "
    "WHERE rk <= 5)",
)

KNN = {
    "knn_join": "WITH " + ",\n".join(KNN_PAIRS) + "\nSELECT query_id, neighbour_id, distance FROM nb",
    "knn_classify": "WITH " + ",\n".join(KNN_PAIRS + (
        "v AS (SELECT query_id, neighbour_label, count(*) AS n FROM nb GROUP BY 1, 2)",
        "t AS (SELECT query_id, count(*) AS t FROM nb GROUP BY 1)",
        "b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, "
        "neighbour_label ASC) AS r FROM v) WHERE r = 1)",
    )) + ("\nSELECT b.query_id, CAST(b.neighbour_label AS INT) AS predicted_label, "
          "round(b.n / t.t, 6) AS share FROM b JOIN t USING (query_id)"),
}


_KNN5 = ["gender", "scheduled_ts", "appointment_day", "age", "scholarship", "hipertension",
         "diabetes", "alcoholism", "handcap", "sms_received"]


def _knn_cv_sql(ks=(25, 35, 45)) -> str:
    """All pairs of rows of different folds."""
    num = lambda c: f"epoch_us({c}) / 1e6" if c in ("scheduled_ts", "appointment_day") else f"CAST({c} AS DOUBLE)"
    far = " + ".join(f"power(a.x{i} - b.x{i}, 2)" for i in range(len(_KNN5)))
    near = " + ".join(f"power((a.x{i} - b.x{i}) / s{i}, 2)" for i in range(len(_KNN5)))
    spread = ", ".join(f"CASE WHEN stddev_samp(x{i}) > 0 THEN stddev_samp(x{i}) ELSE 1 END AS s{i}" for i in range(len(_KNN5)))
    ctes = THREE_WAY + [
        "rest_rows AS (SELECT a.* FROM appointments a JOIN three t USING (appointment_id) WHERE t.split <> 'test' AND a.age >= 0)",
        "k AS MATERIALIZED (SELECT appointment_id AS id, CAST(no_show AS INT) AS y, CAST(floor((row_number() OVER (ORDER BY "
        f"{md5_order('fold')}) - 1) * 10 / count(*) OVER ()) + 1 AS INT) AS fold, "
        + ", ".join(f"{num(c)} AS x{i}" for i, c in enumerate(_KNN5)) + " FROM rest_rows)",
        f"sc AS MATERIALIZED (SELECT f, {spread} FROM (SELECT unnest(range(1, 11)) AS f) JOIN k ON f <> fold GROUP BY f)",
    ]
    for name, distance, source in (("p0", far, "k a"), ("p1", near, "(SELECT * FROM k JOIN sc ON f = fold) a")):
        ctes += [f"{name} AS (SELECT a.id, list(struct_pack(d := d, y := y) ORDER BY d) AS nb FROM (SELECT a.id, b.y, round({distance}, 6) AS d, "
                 f"rank() OVER (PARTITION BY a.id ORDER BY round({distance}, 6)) AS r FROM {source} JOIN k b ON a.fold <> b.fold "
                 f"QUALIFY r <= {max(ks)}) a GROUP BY 1)"]
    votes = " UNION ALL ".join(
        f"SELECT id, {k} AS k, {st} AS standardized, list_avg(list_transform(list_filter(nb, lambda z: z.d <= nb[{k}].d), lambda z: z.y)) AS prob FROM {p}"
        for p, st in (("p0", "false"), ("p1", "true")) for k in ks)
    ctes += [
        f"v AS (SELECT v.*, k.fold, k.y FROM ({votes}) v JOIN k USING (id))",
        "r AS (SELECT *, rank() OVER (PARTITION BY k, standardized, fold ORDER BY prob) "
        "+ (count(*) OVER (PARTITION BY k, standardized, fold, prob) - 1) / 2.0 AS r FROM v)",
        "f AS (SELECT k, standardized, fold, round((sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0) "
        "/ (CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * count(*) FILTER (WHERE y = 0)), 6) AS roc FROM r GROUP BY 1, 2, 3)",
    ]
    return with_view(*ctes, body="SELECT CAST(k AS INT) AS k, standardized, round(avg(roc), 6) AS roc FROM f GROUP BY 1, 2")


ORACLES.update(KNN)
ORACLES["knn_cv"] = _knn_cv_sql()


# ------------------------------------------- the same operators, other tables

SHIP = ("s AS (SELECT l_orderkey, l_suppkey, o_custkey, o_orderdate, l_shipdate, "
        "l_returnflag = 'R' AS returned FROM lineitem JOIN orders ON l_orderkey = o_orderkey)")
SHIP_GAP = "CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INT)"
DOCS = ("dl AS (SELECT d.doc_id, lang, source, n_chars, quality = 1 AS quality, toxic = 1 AS toxic "
        "FROM documents d JOIN labels l ON d.doc_id = l.doc_id)")


def _doc_confusion_sql() -> str:
    base = _confusion_sql()
    body = base[base.index("\nSELECT cutoff"):]
    counts = " UNION ALL ".join(
        f"SELECT CAST({c} AS DOUBLE) AS cutoff, "
        f"CAST(count(*) FILTER (WHERE score > {c} AND toxic) AS BIGINT) AS tp, "
        f"CAST(count(*) FILTER (WHERE score > {c} AND NOT toxic) AS BIGINT) AS fp, "
        f"CAST(count(*) FILTER (WHERE NOT (score > {c}) AND toxic) AS BIGINT) AS fn, "
        f"CAST(count(*) FILTER (WHERE NOT (score > {c}) AND NOT toxic) AS BIGINT) AS tn FROM scored"
        for c in (0.05, 0.1))
    return ("WITH " + DOCS + ",\nscored AS (SELECT *, avg(CAST(toxic AS INT)) OVER (PARTITION BY lang, source) "
            f"AS score FROM dl),\nc AS ({counts})" + body)


OTHER_TABLES = {
    "ship_rate_by_days_between": (
        f"WITH {SHIP} SELECT {SHIP_GAP} AS days_between, round(avg(CAST(returned AS INT)), 6) AS ratio "
        "FROM s GROUP BY 1"),
    "ship_bias_by_same_day": (
        f"WITH {SHIP}, d AS (SELECT o_custkey, l_shipdate, count(*) AS nbr, sum(CAST(returned AS INT)) AS pos "
        "FROM s GROUP BY 1, 2), n AS (SELECT nbr AS nbr_app_that_day, sum(nbr) AS rows_, sum(pos) AS pos "
        "FROM d GROUP BY 1), g AS (SELECT avg(CAST(returned AS INT)) AS base_rate FROM s) "
        "SELECT nbr_app_that_day, round(CAST(pos AS DOUBLE) / rows_ - base_rate, 6) AS bias, "
        "CAST(rows_ / nbr_app_that_day AS DOUBLE) AS count FROM n, g"),
    "ship_group_rate_extremes": (
        f"WITH {SHIP}, t AS (SELECT l_suppkey, avg(CAST(returned AS INT)) AS rate, "
        "count(*) AS count FROM s GROUP BY l_suppkey HAVING count(*) >= 20), "
        "r AS (SELECT *, row_number() OVER (ORDER BY rate DESC, l_suppkey ASC) AS a, "
        "row_number() OVER (ORDER BY rate ASC, l_suppkey DESC) AS b FROM t) "
        "SELECT l_suppkey, round(rate, 6) AS no_show_ratio, count FROM r WHERE a <= 10 OR b <= 10"),
    "ship_visits_cumulative": (
        f"WITH {SHIP}, p AS (SELECT o_custkey, count(*) AS n FROM s GROUP BY 1), "
        "b AS (SELECT CASE WHEN n > 9 THEN 'ten_or_more' ELSE CAST(n AS VARCHAR) END AS app_number_per_patient, "
        "CAST(sum(n) AS BIGINT) AS app_number FROM p GROUP BY 1) "
        "SELECT app_number_per_patient, app_number, round(100.0::DOUBLE * sum(app_number) OVER "
        "(ORDER BY app_number_per_patient ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
        "/ sum(app_number) OVER (), 6) AS cumulated_percentage FROM b"),
    "ship_roc_auc": (
        f"WITH {SHIP}, pts AS (SELECT CAST({SHIP_GAP} AS DOUBLE) AS threshold, sum(CAST(returned AS INT)) AS pos, "
        "sum(1 - CAST(returned AS INT)) AS neg FROM s GROUP BY 1), "
        "cum AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(pos) OVER () AS P, "
        "sum(neg) OVER () AS N FROM pts) "
        "SELECT round(sum(neg * ((tp - pos) + pos / 2.0)) / (CAST(max(P) AS DOUBLE) * max(N)), 6) AS auc FROM cum"),
    "doc_quality_rate_by_group": (
        f"WITH {DOCS} SELECT lang, source, count(*) AS count, round(avg(CAST(quality AS INT)), 6) AS ratio "
        "FROM dl GROUP BY lang, source"),
    "doc_quality_roc_auc": (
        f"WITH {DOCS}, pts AS (SELECT CAST(n_chars AS DOUBLE) AS threshold, sum(CAST(quality AS INT)) AS pos, "
        "sum(1 - CAST(quality AS INT)) AS neg FROM dl GROUP BY 1), "
        "cum AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(pos) OVER () AS P, "
        "sum(neg) OVER () AS N FROM pts) "
        "SELECT round(sum(neg * ((tp - pos) + pos / 2.0)) / (CAST(max(P) AS DOUBLE) * max(N)), 6) AS auc FROM cum"),
    "doc_toxic_confusion": _doc_confusion_sql(),
}
ORACLES.update(OTHER_TABLES)

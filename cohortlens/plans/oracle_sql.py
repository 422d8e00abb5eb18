"""DuckDB SQL that states, independently of the Spark code, what each
registered query must return. Tables are the driver's pre-registered views.

The stand-in profiles (``cohortlens.sources.standin``) are written out again
here from their definitions, then every operator is expressed on top of them.
"""

from __future__ import annotations

# --- fixed values: stand-in parameters (same as cohortlens.sources.standin) ---
ORDERS_AS_OF = "DATE '2001-08-02'"
ORDERS_END = "TIMESTAMP '2001-08-03 00:00:00'"
THRESHOLD = 180
EVENTS_AS_OF = "DATE '2024-01-31'"
EVENTS_END = "TIMESTAMP '2024-02-01 00:00:00'"


def _ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


# --- orders profile: the 42 base features ---------------------------------------

_ORDERS = f"o AS (SELECT * FROM orders WHERE o_orderdate < {ORDERS_END})"
_FIRST = "first_order AS (SELECT o_custkey, min(o_orderdate) AS first_ts FROM o GROUP BY o_custkey)"
_MEMBERS = f"""members AS (
  SELECT c.c_custkey AS member_id, p.p_name AS member_name, f.first_ts AS created_at,
         CAST(c.c_nationkey % 2 AS INTEGER) AS gender_encoded,
         CAST(18 + c.c_custkey % 58 AS INTEGER) AS age_years,
         CAST(140 + c.c_custkey % 56 AS DOUBLE) AS height_cm,
         CAST(45 + c.c_custkey % 106 AS DOUBLE) AS initial_weight_kg,
         CAST(c.c_custkey % 3 > 0 AS INTEGER) AS has_medical_conditions,
         CAST(c.c_custkey % 10 < 3 AS INTEGER) AS has_allergies,
         CAST(date_diff('day', CAST(f.first_ts AS DATE), {ORDERS_AS_OF}) AS INTEGER) AS enrollment_age_days,
         CAST(c.c_custkey % 20 > 0 AS INTEGER) AS is_enrolled_active,
         CAST(c.c_acctbal > 0 AS INTEGER) AS has_doctor,
         CAST(c.c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS has_nutritionist,
         CAST(c.c_nationkey % 3 = 0 AS INTEGER) AS has_fitness_coach
  FROM customer c
  LEFT JOIN part p ON p.p_partkey = c.c_custkey
  LEFT JOIN first_order f ON f.o_custkey = c.c_custkey)"""
_MEAL = f"""meal AS (
  SELECT o.o_custkey AS member_id, CAST(o.o_orderdate AS DATE) AS d,
         l.l_returnflag, l.l_extendedprice, l.l_quantity, l.l_tax, l.l_discount
  FROM o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  WHERE o.o_orderpriority = '1-URGENT')"""
_MEAL_F = f"""meal_f AS (
  SELECT member_id, count(*) AS total_meal_logs, count(DISTINCT d) AS distinct_meal_days,
         round(round(avg(l_extendedprice), 6), 1) AS avg_calories_per_meal,
         round(round(avg(l_quantity), 6), 1) AS avg_protein_g,
         round(round(avg(l_tax * 100), 6), 1) AS avg_carbs_g,
         round(round(avg(l_discount * 100), 6), 1) AS avg_fat_g,
         count(DISTINCT l_returnflag) AS distinct_meal_types,
         round(round(avg(CASE WHEN l_discount < 0.05 THEN 1.0 ELSE 0.0 END), 6), 4) AS meal_compliance_rate,
         date_diff('day', max(d), {ORDERS_AS_OF}) AS days_since_last_meal,
         count(*) FILTER (WHERE date_diff('day', d, {ORDERS_AS_OF}) BETWEEN 0 AND 7) AS meals_last_7_days,
         count(*) FILTER (WHERE date_diff('day', d, {ORDERS_AS_OF}) BETWEEN 0 AND 14) AS meals_last_14_days
  FROM meal GROUP BY member_id)"""
_WEIGHT = """weight AS (
  SELECT o_custkey AS member_id, CAST(o_orderdate AS DATE) AS d, o_orderkey AS log_id,
         o_totalprice / 4000 AS w
  FROM o WHERE o_orderpriority = '2-HIGH')"""
_WEIGHT_F = f"""weight_f AS (
  SELECT wt.member_id, count(*) AS total_weight_logs, count(DISTINCT d) AS distinct_weight_days,
         round(max(w) - min(w), 2) AS weight_range_kg,
         round(round(avg(w) / power(any_value(m.height_cm) / 100, 2), 6), 1) AS avg_bmi,
         date_diff('day', max(d), {ORDERS_AS_OF}) AS days_since_last_weight,
         round(arg_max(w, (d, log_id)) - arg_min(w, (d, log_id)), 2)
           AS weight_change_kg
  FROM weight wt JOIN members m ON m.member_id = wt.member_id
  GROUP BY wt.member_id)"""
_EXERCISE_F = f"""exercise_f AS (
  SELECT o_custkey AS member_id, count(*) AS total_exercise_logs,
         count(DISTINCT CAST(o_orderdate AS DATE)) AS distinct_exercise_days,
         CAST(sum(floor(o_totalprice / 8000)) AS BIGINT) AS total_exercise_minutes,
         round(round(avg(floor(o_totalprice / 8000)), 6), 1) AS avg_exercise_minutes,
         round(round(sum(o_totalprice / 1000), 6), 1) AS total_calories_burned,
         CAST(sum(o_orderkey % 8000) AS BIGINT) AS total_steps,
         date_diff('day', max(CAST(o_orderdate AS DATE)), {ORDERS_AS_OF}) AS days_since_last_exercise,
         count(DISTINCT o_orderstatus) AS distinct_exercise_types
  FROM o WHERE o_orderpriority = '3-MEDIUM' GROUP BY o_custkey)"""
_COLLECTION_F = f"""collection_f AS (
  SELECT o_custkey AS member_id, count(*) AS total_collection_items,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS completed_items,
         round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 4) AS collection_completion_rate,
         round(avg(CASE o_orderstatus WHEN 'F' THEN 100.0 WHEN 'P' THEN 50.0 ELSE 0.0 END), 1)
           AS avg_progress_percent,
         count(*) FILTER (WHERE o_orderstatus IN ('F', 'P')) AS unlocked_items,
         date_diff('day', max(CAST(o_orderdate AS DATE)), {ORDERS_AS_OF}) AS days_since_last_collection
  FROM o WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') GROUP BY o_custkey)"""
_FEATURES = """features AS (
  SELECT m.member_id, m.member_name, m.created_at,
         m.gender_encoded, m.age_years, m.height_cm, m.initial_weight_kg,
         m.has_medical_conditions, m.has_allergies, m.enrollment_age_days, m.is_enrolled_active,
         m.has_doctor, m.has_nutritionist, m.has_fitness_coach,
         coalesce(mf.total_meal_logs, 0) AS total_meal_logs,
         coalesce(mf.distinct_meal_days, 0) AS distinct_meal_days,
         mf.avg_calories_per_meal, mf.avg_protein_g, mf.avg_carbs_g, mf.avg_fat_g,
         coalesce(mf.distinct_meal_types, 0) AS distinct_meal_types,
         mf.meal_compliance_rate,
         coalesce(mf.days_since_last_meal, 9999) AS days_since_last_meal,
         coalesce(mf.meals_last_7_days, 0) AS meals_last_7_days,
         coalesce(mf.meals_last_14_days, 0) AS meals_last_14_days,
         coalesce(wf.total_weight_logs, 0) AS total_weight_logs,
         coalesce(wf.distinct_weight_days, 0) AS distinct_weight_days,
         wf.weight_range_kg, wf.avg_bmi,
         coalesce(wf.days_since_last_weight, 9999) AS days_since_last_weight,
         wf.weight_change_kg,
         coalesce(ef.total_exercise_logs, 0) AS total_exercise_logs,
         coalesce(ef.distinct_exercise_days, 0) AS distinct_exercise_days,
         coalesce(ef.total_exercise_minutes, 0) AS total_exercise_minutes,
         ef.avg_exercise_minutes,
         coalesce(ef.total_calories_burned, 0.0) AS total_calories_burned,
         coalesce(ef.total_steps, 0) AS total_steps,
         coalesce(ef.days_since_last_exercise, 9999) AS days_since_last_exercise,
         coalesce(ef.distinct_exercise_types, 0) AS distinct_exercise_types,
         coalesce(cf.total_collection_items, 0) AS total_collection_items,
         coalesce(cf.completed_items, 0) AS completed_items,
         coalesce(cf.collection_completion_rate, 0.0) AS collection_completion_rate,
         cf.avg_progress_percent,
         coalesce(cf.unlocked_items, 0) AS unlocked_items,
         coalesce(cf.days_since_last_collection, 9999) AS days_since_last_collection
  FROM members m
  LEFT JOIN meal_f mf ON mf.member_id = m.member_id
  LEFT JOIN weight_f wf ON wf.member_id = m.member_id
  LEFT JOIN exercise_f ef ON ef.member_id = m.member_id
  LEFT JOIN collection_f cf ON cf.member_id = m.member_id)"""

FEATURE_CTES = [_ORDERS, _FIRST, _MEMBERS, _MEAL, _MEAL_F, _WEIGHT, _WEIGHT_F,
                _EXERCISE_F, _COLLECTION_F, _FEATURES]


# --- labels, engineering, cleaning ---------------------------------------------

from cohortlens import constants as K  # noqa: E402

_REC = K.RECENCY_COLUMNS
_LABELLED = f"""labelled_raw AS (
  SELECT f.*,
         least({', '.join(f'nullif({c}, 9999)' for c in _REC)}) AS min_days_since_activity,
         {' + '.join(K.ACTIVITY_COLUMNS)} AS total_activity_count
  FROM features f),
labelled AS (
  SELECT *, CAST(coalesce(total_activity_count = 0, false) OR min_days_since_activity IS NULL
                 OR coalesce(min_days_since_activity > {THRESHOLD}, false) AS INTEGER) AS is_churned
  FROM labelled_raw)"""
_ENGINEERED = f"""maxima AS (
  SELECT {', '.join(f'greatest(max({c}), 1) AS max_{c}' for c in K.ACTIVITY_COLUMNS)}
  FROM labelled),
engineered AS (
  SELECT l.*,
         {' + '.join(f'{w} * ({c} / max_{c})' for w, c in zip(K.ENGAGEMENT_WEIGHTS, K.ACTIVITY_COLUMNS))}
           AS engagement_score,
         {', '.join(f"CASE WHEN {c} IS NOT NULL THEN exp(-0.05 * least({c}, 365)) END AS {c.replace('days_since_last_', '')}_recency_score" for c in _REC)},
         CASE WHEN enrollment_age_days > 0 THEN distinct_meal_days / enrollment_age_days ELSE 0.0 END
           AS meal_logging_rate,
         CASE WHEN enrollment_age_days > 0 THEN distinct_weight_days / enrollment_age_days ELSE 0.0 END
           AS weight_logging_rate,
         CAST(coalesce(meals_last_7_days > 0, false) AS INTEGER) AS has_recent_meals,
         has_doctor + has_nutritionist + has_fitness_coach AS provider_count
  FROM labelled l CROSS JOIN maxima)"""

LABEL_CTES = FEATURE_CTES + [_LABELLED]
ENGINEERED_CTES = LABEL_CTES + [_ENGINEERED]

# double-typed columns of the engineered table (all others are integers)
DOUBLE_COLUMNS = (
    "height_cm", "initial_weight_kg", "avg_calories_per_meal", "avg_protein_g", "avg_carbs_g",
    "avg_fat_g", "meal_compliance_rate", "weight_range_kg", "avg_bmi", "weight_change_kg",
    "avg_exercise_minutes", "total_calories_burned", "collection_completion_rate",
    "avg_progress_percent", "engagement_score", "meal_recency_score", "weight_recency_score",
    "exercise_recency_score", "collection_recency_score", "meal_logging_rate",
    "weight_logging_rate",
)
ENGINEERED_COLUMNS = ("member_id", *K.BASE_FEATURE_COLUMNS, *K.HELPER_COLUMNS, K.LABEL_COLUMN,
                      *K.ENGINEERED_COLUMNS)


def _r6(c: str, expr: str | None = None) -> str:
    e = expr or c
    return f"round({e}, 6) AS {c}" if c in DOUBLE_COLUMNS or expr else f"{e} AS {c}"


def _zero_named(c: str) -> bool:
    return any(p in c for p in K.ZERO_IMPUTE_NAME_PARTS)


# reference rule: names with count/total/days -> 0, other columns -> median;
# only double columns can hold NULL in this table
_IMPUTED = "imputed AS (SELECT " + ",\n  ".join(
    f"coalesce({c}, 0) AS {c}" if _zero_named(c) and c not in DOUBLE_COLUMNS
    else f"coalesce({c}, 0.0) AS {c}" if _zero_named(c)
    else f"coalesce({c}, (SELECT median({c}) FROM engineered)) AS {c}" if c in DOUBLE_COLUMNS
    else c
    for c in ENGINEERED_COLUMNS) + "\n  FROM engineered)"
CLIP_COLUMNS = tuple(c for c in ENGINEERED_COLUMNS
                     if c not in ("member_id", K.LABEL_COLUMN)
                     and not any(p in c for p in K.NO_CLIP_NAME_PARTS))


def _clipped(src: str) -> str:
    bounds = ", ".join(f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}"
                       for c in CLIP_COLUMNS)
    cols = []
    for c in ENGINEERED_COLUMNS:
        if c in CLIP_COLUMNS:
            cols.append(f"CASE WHEN {c} IS NOT NULL THEN greatest(lo_{c}, least(hi_{c}, "
                        f"CAST({c} AS DOUBLE))) END AS {c}")
        else:
            cols.append(c)
    return (f"bounds AS (SELECT {bounds} FROM {src}),\n"
            f"clipped AS (SELECT {', '.join(cols)} FROM {src} CROSS JOIN bounds)")


def _select(cols, src: str) -> str:
    return f"SELECT {', '.join(_r6(c) for c in cols)} FROM {src}"


ORACLE: dict[str, str] = {}

ORACLE["feature_table"] = _ctes(*FEATURE_CTES) + "\nSELECT member_id, " + ", ".join(
    K.BASE_FEATURE_COLUMNS) + " FROM features"
ORACLE["member_demographics"] = _ctes(_ORDERS, _FIRST, _MEMBERS) + (
    "\nSELECT member_id, gender_encoded, age_years, height_cm, initial_weight_kg, "
    "has_medical_conditions, has_allergies FROM members")
ORACLE["enrollment_features"] = _ctes(_ORDERS, _FIRST, _MEMBERS) + (
    "\nSELECT member_id, enrollment_age_days, is_enrolled_active FROM members")
ORACLE["provider_flags"] = _ctes(_ORDERS, _FIRST, _MEMBERS) + (
    "\nSELECT member_id, has_doctor, has_nutritionist, has_fitness_coach FROM members")
ORACLE["meal_totals"] = _ctes(_ORDERS, _MEAL, _MEAL_F) + (
    "\nSELECT member_id, total_meal_logs, distinct_meal_days, distinct_meal_types FROM meal_f")
ORACLE["meal_nutrition"] = _ctes(_ORDERS, _MEAL, _MEAL_F) + (
    "\nSELECT member_id, avg_calories_per_meal, avg_protein_g, avg_carbs_g, avg_fat_g FROM meal_f")
ORACLE["meal_compliance"] = _ctes(_ORDERS, _MEAL, _MEAL_F) + (
    "\nSELECT member_id, meal_compliance_rate FROM meal_f")
ORACLE["meal_recent_counts"] = _ctes(_ORDERS, _MEAL, _MEAL_F) + (
    "\nSELECT member_id, meals_last_7_days, meals_last_14_days FROM meal_f")
_W = _ctes(_ORDERS, _FIRST, _MEMBERS, _WEIGHT, _WEIGHT_F)
ORACLE["weight_totals"] = _W + "\nSELECT member_id, total_weight_logs, distinct_weight_days FROM weight_f"
ORACLE["weight_range_change"] = _W + "\nSELECT member_id, weight_range_kg, weight_change_kg FROM weight_f"
ORACLE["weight_bmi"] = _W + "\nSELECT member_id, avg_bmi FROM weight_f"
ORACLE["exercise_totals"] = _ctes(_ORDERS, _EXERCISE_F) + (
    "\nSELECT * EXCLUDE (days_since_last_exercise) FROM exercise_f")
ORACLE["collection_totals"] = _ctes(_ORDERS, _COLLECTION_F) + (
    "\nSELECT * EXCLUDE (days_since_last_collection) FROM collection_f")
ORACLE["channel_recency"] = _ctes(*FEATURE_CTES) + (
    f"\nSELECT member_id, {', '.join(_REC)} FROM features")
ORACLE["sentinel_to_null"] = _ctes(*FEATURE_CTES) + (
    f"\nSELECT member_id, {', '.join(f'nullif({c}, 9999) AS {c}' for c in _REC)} FROM features")
ORACLE["null_to_sentinel"] = ORACLE["channel_recency"]
ORACLE["min_recency"] = _ctes(*LABEL_CTES) + "\nSELECT member_id, min_days_since_activity FROM labelled"
ORACLE["total_activity"] = _ctes(*LABEL_CTES) + "\nSELECT member_id, total_activity_count FROM labelled"
ORACLE["churn_label"] = _ctes(*LABEL_CTES) + (
    f"\nSELECT member_id, {', '.join(_REC)}, min_days_since_activity, total_activity_count, is_churned "
    "FROM labelled")
ORACLE["label_distribution"] = _ctes(*LABEL_CTES) + (
    "\nSELECT count(*) AS n_members, count(*) FILTER (WHERE is_churned = 1) AS n_churned, "
    "count(*) FILTER (WHERE is_churned = 0) AS n_active, round(avg(is_churned), 6) AS churn_rate "
    "FROM labelled")
_RULE_POINTS = """greatest(0, least(100,
    CASE WHEN total_meal_logs < 15 THEN 25 WHEN total_meal_logs < 40 THEN 10 ELSE 0 END
  + CASE WHEN total_weight_logs < 5 THEN 10 ELSE 0 END
  + CASE WHEN total_exercise_logs < 5 THEN 10 ELSE 0 END
  + CASE WHEN days_since_last_meal > 14 THEN 20 WHEN days_since_last_meal > 7 THEN 10 ELSE 0 END
  + CASE WHEN days_since_last_weight > 14 THEN 10 ELSE 0 END
  + CASE WHEN days_since_last_exercise > 14 THEN 10 ELSE 0 END
  + CASE WHEN meal_compliance_rate < 0.3 THEN 10 ELSE 0 END
  + CASE WHEN collection_completion_rate < 0.2 THEN 5 ELSE 0 END))"""
_RULED = f"""ruled AS (
  SELECT *, {_RULE_POINTS} / 100.0 AS rule_churn_score,
         CAST({_RULE_POINTS} >= 40 AS INTEGER) AS rule_churned
  FROM engineered)"""
ORACLE["rule_churn_score"] = _ctes(*ENGINEERED_CTES, _RULED) + (
    "\nSELECT member_id, rule_churn_score, rule_churned FROM ruled")
ORACLE["group_profile"] = _ctes(*LABEL_CTES) + """
SELECT is_churned, count(*) AS n_members,
       round(avg(enrollment_age_days), 6) AS avg_enrollment_days,
       round(avg(total_meal_logs), 6) AS avg_meal_logs,
       round(avg(total_weight_logs), 6) AS avg_weight_logs,
       round(avg(total_exercise_logs), 6) AS avg_exercise_logs,
       round(avg(meal_compliance_rate), 6) AS avg_compliance,
       round(avg(days_since_last_meal), 6) AS avg_days_since_meal
FROM labelled GROUP BY is_churned"""
ORACLE["channel_maxima"] = _ctes(*LABEL_CTES, _ENGINEERED.split("),\nengineered AS")[0] + ")") + (
    "\nSELECT * FROM maxima")
ORACLE["engagement_score"] = _ctes(*ENGINEERED_CTES) + "\n" + _select(
    ["member_id", "engagement_score"], "engineered")
ORACLE["recency_decay"] = _ctes(*ENGINEERED_CTES) + "\n" + _select(
    ["member_id", "meal_recency_score", "weight_recency_score", "exercise_recency_score",
     "collection_recency_score"], "engineered")
ORACLE["logging_rates"] = _ctes(*ENGINEERED_CTES) + "\n" + _select(
    ["member_id", "meal_logging_rate", "weight_logging_rate"], "engineered")
ORACLE["has_recent_meals"] = _ctes(*ENGINEERED_CTES) + "\nSELECT member_id, has_recent_meals FROM engineered"
ORACLE["provider_count"] = _ctes(*ENGINEERED_CTES) + "\nSELECT member_id, provider_count FROM engineered"
ORACLE["engineer_features"] = _ctes(*ENGINEERED_CTES) + "\n" + _select(
    ["member_id", *K.ENGINEERED_COLUMNS], "engineered")
ORACLE["null_profile"] = _ctes(*ENGINEERED_CTES) + f"""
SELECT (SELECT count(*) FROM engineered) AS row_count, {len(ENGINEERED_COLUMNS)} AS column_count,
       column_name, missing_count
FROM (UNPIVOT (SELECT {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS {c}' for c in ENGINEERED_COLUMNS)}
               FROM engineered)
      ON COLUMNS(*) INTO NAME column_name VALUE missing_count)
WHERE missing_count > 0"""
ORACLE["impute_by_name"] = _ctes(*ENGINEERED_CTES, _IMPUTED) + "\n" + _select(ENGINEERED_COLUMNS, "imputed")
ORACLE["impute_zero"] = _ctes(*ENGINEERED_CTES) + "\nSELECT " + ", ".join(
    _r6(c, f"coalesce({c}, 0.0)") if c in DOUBLE_COLUMNS else f"coalesce({c}, 0) AS {c}"
    for c in ENGINEERED_COLUMNS) + " FROM engineered"
_CLIPPED_OUT = "\nSELECT " + ", ".join(
    f"round({c}, 6) AS {c}" if c in CLIP_COLUMNS or c in DOUBLE_COLUMNS else c
    for c in ENGINEERED_COLUMNS) + " FROM clipped"
ORACLE["clip_quantiles"] = _ctes(*ENGINEERED_CTES, _clipped("engineered")) + _CLIPPED_OUT
ORACLE["process_features"] = _ctes(*ENGINEERED_CTES, _IMPUTED, _clipped("imputed")) + _CLIPPED_OUT
ORACLE["select_features"] = _ctes(*ENGINEERED_CTES) + "\n" + _select(K.FEATURE_COLUMNS, "engineered")
ORACLE["numeric_columns"] = _ctes(*ENGINEERED_CTES) + "\n" + _select(ENGINEERED_COLUMNS, "engineered")


# --- projections, scoring, serving -----------------------------------------------

MEMBER_PROBE = 42
SEARCH_PROBE = "ring"

ORACLE["member_filter"] = _ctes(*FEATURE_CTES) + (
    "\nSELECT member_id, " + ", ".join(K.BASE_FEATURE_COLUMNS)
    + f" FROM features WHERE member_id = {MEMBER_PROBE}")
ORACLE["align_features"] = _ctes(*LABEL_CTES) + "\nSELECT member_id, " + ", ".join(
    _r6(c) if c in K.BASE_FEATURE_COLUMNS else f"CAST(0.0 AS DOUBLE) AS {c}" for c in K.FEATURE_COLUMNS) + " FROM labelled"

_PREDS = f"""preds AS (
  SELECT member_id, member_name, created_at,
         round({_RULE_POINTS} / 100.0, 4) AS churn_probability,
         CAST({_RULE_POINTS} >= 40 AS INTEGER) AS churn_prediction,
         CASE WHEN {_RULE_POINTS} / 100.0 < 0.3 THEN 'Low'
              WHEN {_RULE_POINTS} / 100.0 < 0.6 THEN 'Medium' ELSE 'High' END AS risk_label,
         {', '.join(K.KEY_FEATURES)}
  FROM engineered)"""
PRED_CTES = ENGINEERED_CTES + [_PREDS]
_RANK = "ORDER BY churn_probability DESC, created_at DESC NULLS LAST, member_id ASC"

ORACLE["risk_bucket"] = _ctes(*PRED_CTES) + "\nSELECT member_id, churn_probability, risk_label FROM preds"
ORACLE["rank_by_risk"] = _ctes(*PRED_CTES) + (
    "\nSELECT member_id, member_name, churn_probability, churn_prediction, risk_label FROM preds " + _RANK)
ORACLE["prediction_record"] = _ctes(*PRED_CTES) + """
SELECT member_id, member_name, churn_probability, churn_prediction, risk_label,
       total_meal_logs, total_weight_logs, total_exercise_logs, enrollment_age_days,
       days_since_last_meal, days_since_last_weight,
       round(meal_compliance_rate, 6) AS meal_compliance_rate,
       round(collection_completion_rate, 6) AS collection_completion_rate,
       round(engagement_score, 6) AS engagement_score
FROM preds"""
_SUMMARY = """count(*) AS {total}, count(*) FILTER (WHERE risk_label = 'High') AS high_risk,
       count(*) FILTER (WHERE risk_label = 'Medium') AS medium_risk,
       count(*) FILTER (WHERE risk_label = 'Low') AS low_risk"""
ORACLE["risk_summary"] = _ctes(*PRED_CTES) + "\nSELECT " + _SUMMARY.format(total="total_members") + " FROM preds"
ORACLE["risk_filter"] = _ctes(*PRED_CTES) + (
    "\nSELECT member_id, churn_probability, risk_label FROM preds WHERE risk_label = 'High'")
ORACLE["at_risk_top"] = _ctes(*PRED_CTES) + (
    "\nSELECT member_id, member_name, churn_probability, churn_prediction, risk_label FROM preds "
    + _RANK + " LIMIT 100")
ORACLE["at_risk_summary"] = _ctes(*PRED_CTES) + (
    "\nSELECT " + _SUMMARY.format(total="total_members")
    + " FROM (SELECT * FROM preds WHERE risk_label = 'Medium' " + _RANK + " LIMIT 100)")
_SEARCH = f"""search AS (
  SELECT member_id,
         CASE WHEN coalesce(member_name, '') = '' THEN '' ELSE split_part(member_name, ' ', 1) END AS first_name,
         CASE WHEN coalesce(member_name, '') = '' THEN ''
              WHEN strpos(member_name, ' ') = 0 THEN NULL
              ELSE substr(member_name, strpos(member_name, ' ') + 1) END AS last_name,
         strftime(created_at, '%Y-%m-%d') AS created_at
  FROM preds
  WHERE contains(lower(CAST(member_id AS VARCHAR)), '{SEARCH_PROBE}')
     OR contains(lower(coalesce(member_name, '')), '{SEARCH_PROBE}')
  {_RANK} LIMIT 20)"""
ORACLE["member_search"] = _ctes(*PRED_CTES, _SEARCH) + "\nSELECT * FROM search"
ORACLE["names_join"] = _ctes(*PRED_CTES) + (
    "\nSELECT p.member_id, coalesce(m.member_name, '') AS member_name FROM preds p "
    "LEFT JOIN members m ON m.member_id = p.member_id")
ORACLE["prediction_lookup"] = _ctes(*PRED_CTES) + (
    f"\nSELECT member_id, churn_probability, churn_prediction, risk_label FROM preds "
    f"WHERE member_id = {MEMBER_PROBE} LIMIT 1")
_KEYF = ", ".join(_r6(c, f"coalesce({c}, 0)") if c in DOUBLE_COLUMNS else f"coalesce({c}, 0) AS {c}"
                  for c in K.KEY_FEATURES)
ORACLE["key_features"] = _ctes(*PRED_CTES) + f"\nSELECT member_id, {_KEYF} FROM preds"
ORACLE["key_features_scored"] = _ctes(*ENGINEERED_CTES) + "\nSELECT member_id, " + ", ".join(
    _r6(c, f"coalesce({c}, 0)") if c in DOUBLE_COLUMNS
    else f"coalesce({c}, 9999) AS {c}" if c.startswith("days_since") else f"coalesce({c}, 0) AS {c}"
    for c in K.KEY_FEATURES) + " FROM engineered"

# --- events profile: daily timelines -----------------------------------------------------

_EV = f"ev AS (SELECT * FROM events WHERE ts < {EVENTS_END})"
_EV_MEMBERS = """ev_members AS (
  SELECT e.user_id AS member_id, any_value(p.p_name) AS member_name, min(e.ts) AS first_ts
  FROM ev e LEFT JOIN part p ON p.p_partkey = e.user_id GROUP BY e.user_id)"""
_EV_DAILY = f"""days AS (
  SELECT CAST(unnest(generate_series(CAST({EVENTS_AS_OF} - INTERVAL 30 DAY AS DATE), {EVENTS_AS_OF},
                                     INTERVAL 1 DAY)) AS DATE) AS day),
ev_counts AS (
  SELECT user_id AS member_id, CAST(ts AS DATE) AS day,
         count(*) FILTER (WHERE event_type = 'view') AS meal_count,
         count(*) FILTER (WHERE event_type = 'click') > 0 AS weight_logged,
         count(*) FILTER (WHERE event_type IN ('purchase', 'error')) AS exercise_count,
         count(*) FILTER (WHERE event_type = 'signup') AS collection_progress
  FROM ev
  WHERE CAST(ts AS DATE) BETWEEN CAST({EVENTS_AS_OF} - INTERVAL 30 DAY AS DATE) AND {EVENTS_AS_OF}
  GROUP BY 1, 2),
daily AS (
  SELECT m.member_id, d.day, coalesce(c.meal_count, 0) AS meal_count,
         coalesce(c.weight_logged, false) AS weight_logged,
         coalesce(c.exercise_count, 0) AS exercise_count,
         coalesce(c.collection_progress, 0) AS collection_progress
  FROM ev_members m CROSS JOIN days d
  LEFT JOIN ev_counts c ON c.member_id = m.member_id AND c.day = d.day),
summary AS (
  SELECT member_id, 31 AS period_days,
         count(*) FILTER (WHERE meal_count > 0 OR weight_logged OR exercise_count > 0) AS active_days,
         CAST(sum(meal_count) AS INTEGER) AS total_meals_logged,
         count(*) FILTER (WHERE weight_logged) AS weight_log_days,
         CAST(sum(exercise_count) AS INTEGER) AS total_exercises,
         round(count(*) FILTER (WHERE meal_count > 0 OR weight_logged OR exercise_count > 0) / 31.0, 4)
           AS activity_rate
  FROM daily GROUP BY member_id)"""
EVENT_CTES = [_EV, _EV_MEMBERS, _EV_DAILY]

ORACLE["daily_activity"] = _ctes(*EVENT_CTES) + (
    "\nSELECT member_id, strftime(day, '%Y-%m-%d') AS date, meal_count, weight_logged, "
    "exercise_count, collection_progress FROM daily")
ORACLE["timeline_summary"] = _ctes(*EVENT_CTES) + "\nSELECT * FROM summary"
ORACLE["enrollment_date"] = _ctes(*EVENT_CTES) + (
    f"\nSELECT member_id, strftime(CAST(first_ts AS DATE), '%Y-%m-%d') AS enrollment_date FROM ev_members")
ORACLE["member_timeline"] = _ctes(*EVENT_CTES) + """
SELECT m.member_id, coalesce(m.member_name, 'Unknown') AS member_name,
       strftime(CAST(m.first_ts AS DATE), '%Y-%m-%d') AS enrollment_date,
       strftime(d.day, '%Y-%m-%d') AS date, d.meal_count, d.weight_logged, d.exercise_count,
       d.collection_progress, s.period_days, s.active_days, s.total_meals_logged,
       s.weight_log_days, s.total_exercises, s.activity_rate
FROM ev_members m JOIN daily d ON d.member_id = m.member_id JOIN summary s ON s.member_id = m.member_id"""
ORACLE["chart_rows"] = _ctes(*EVENT_CTES) + (
    "\nSELECT member_id, strftime(day, '%m-%d') AS date, meal_count, CAST(weight_logged AS INTEGER) AS weight, "
    "exercise_count, collection_progress FROM daily")

# --- dashboard projections ----------------------------------------------------------------

ORACLE["gauge_band"] = _ctes(*PRED_CTES) + """
SELECT member_id, CAST(round(coalesce(churn_probability, 0.0) * 100) AS INTEGER) AS gauge_percent,
       CASE WHEN round(coalesce(churn_probability, 0.0) * 100) >= 60 THEN 'high'
            WHEN round(coalesce(churn_probability, 0.0) * 100) >= 30 THEN 'medium' ELSE 'low' END AS gauge_band
FROM preds"""
ORACLE["risk_table"] = _ctes(*PRED_CTES) + f"""
SELECT coalesce(member_name, '—') AS display_name,
       substr(CAST(member_id AS VARCHAR), 1, 8) || '...' AS short_id,
       printf('%.1f%%', round(churn_probability * 100, 1)) AS probability_text,
       lower(risk_label) AS risk_class
FROM (SELECT * FROM preds {_RANK} LIMIT 50)"""
ORACLE["key_indicators"] = _ctes(*PRED_CTES) + """
SELECT member_id, CAST(round(total_meal_logs) AS BIGINT) AS meals_logged,
       CAST(round(total_weight_logs) AS BIGINT) AS weight_logs,
       CAST(round(total_exercise_logs) AS BIGINT) AS exercise_logs,
       CAST(CAST(round(meal_compliance_rate * 100) AS BIGINT) AS VARCHAR) || '%' AS meal_compliance,
       CAST(CAST(round(collection_completion_rate * 100) AS BIGINT) AS VARCHAR) || '%' AS completion_rate,
       CAST(round(enrollment_age_days) AS BIGINT) AS days_enrolled
FROM preds"""
ORACLE["search_display"] = _ctes(*PRED_CTES, _SEARCH) + """
SELECT member_id,
       CASE WHEN coalesce(first_name, '') <> '' OR coalesce(last_name, '') <> ''
            THEN trim(coalesce(first_name, '') || ' ' || coalesce(last_name, ''))
            ELSE 'Unnamed Member' END AS display_name,
       substr(CAST(member_id AS VARCHAR), 1, 12) || '...' AS short_id
FROM search"""


# --- split, folds, weights, scaling, rule evaluation ---------------------------------

_SPLIT = f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY is_churned
                               ORDER BY md5('42|' || CAST(member_id AS VARCHAR)), member_id) AS rank_in_label,
         count(*) OVER (PARTITION BY is_churned) AS n_label
  FROM ruled),
split AS (SELECT *, rank_in_label <= round(0.2 * n_label) AS is_test FROM ranked),
train AS (SELECT * FROM split WHERE NOT is_test),
kfold AS (SELECT greatest(2, least(5, count(*) FILTER (WHERE is_churned = 1),
                                      count(*) FILTER (WHERE is_churned = 0))) AS k FROM train),
folds AS (SELECT t.*, CAST((rank_in_label - 1) % k AS INTEGER) AS fold FROM train t CROSS JOIN kfold),
test AS (SELECT *, rule_churned AS prediction, rule_churn_score AS score FROM split WHERE is_test),
cm AS (SELECT count(*) FILTER (WHERE is_churned = 1 AND prediction = 1) AS tp,
              count(*) FILTER (WHERE is_churned = 0 AND prediction = 1) AS fp,
              count(*) FILTER (WHERE is_churned = 1 AND prediction = 0) AS fn,
              count(*) FILTER (WHERE is_churned = 0 AND prediction = 0) AS tn FROM test)"""
SPLIT_CTES = ENGINEERED_CTES + [_RULED, _SPLIT]


def _sdiv(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) > 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE 0.0 END"


_METRICS = (f"round({_sdiv('tp + tn', 'tp + fp + fn + tn')}, 4) AS accuracy, "
            f"round({_sdiv('tp', 'tp + fp')}, 4) AS precision, "
            f"round({_sdiv('tp', 'tp + fn')}, 4) AS recall, "
            f"round({_sdiv('2 * tp', '2 * tp + fp + fn')}, 4) AS f1_score")
_AUC = """auc_scores AS (
  SELECT score, count(*) FILTER (WHERE is_churned = 1) AS pos, count(*) FILTER (WHERE is_churned = 0) AS neg
  FROM test GROUP BY score),
auc_cum AS (
  SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM auc_scores),
auc AS (
  SELECT round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                    THEN sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) ELSE 0.0 END, 4) AS roc_auc
  FROM auc_cum)"""
_CV = f"""cv_per_fold AS (
  SELECT fold, {_sdiv("2 * count(*) FILTER (WHERE is_churned = 1 AND rule_churned = 1)",
                     "2 * count(*) FILTER (WHERE is_churned = 1 AND rule_churned = 1) "
                     "+ count(*) FILTER (WHERE is_churned = 0 AND rule_churned = 1) "
                     "+ count(*) FILTER (WHERE is_churned = 1 AND rule_churned = 0)")} AS f1
  FROM folds GROUP BY fold),
cv AS (SELECT round(avg(f1), 4) AS cv_f1_mean, round(stddev_pop(f1), 4) AS cv_f1_std FROM cv_per_fold)"""

ORACLE["stratified_split"] = _ctes(*SPLIT_CTES) + (
    "\nSELECT member_id, is_churned, rank_in_label, n_label, is_test FROM split")
ORACLE["stratified_folds"] = _ctes(*SPLIT_CTES) + "\nSELECT member_id, is_churned, fold FROM folds"
ORACLE["class_weights"] = _ctes(*SPLIT_CTES) + """,
cw AS (SELECT is_churned, count(*) AS nc FROM train GROUP BY is_churned),
tot AS (SELECT sum(nc) AS n, sum(nc) FILTER (WHERE is_churned = 1) AS pos,
               sum(nc) FILTER (WHERE is_churned = 0) AS neg FROM cw)
SELECT t.member_id, t.is_churned, round(tot.n / (2.0 * cw.nc), 6) AS w_balanced,
       round(CASE WHEN t.is_churned = 1 THEN coalesce(tot.neg, 0) / CAST(greatest(coalesce(tot.pos, 0), 1) AS DOUBLE)
                  ELSE 1.0 END, 6) AS w_boost
FROM train t JOIN cw ON cw.is_churned = t.is_churned CROSS JOIN tot"""
ORACLE["classification_metrics"] = _ctes(*SPLIT_CTES) + f"\nSELECT tp, fp, fn, tn, {_METRICS} FROM cm"
ORACLE["roc_auc"] = _ctes(*SPLIT_CTES, _AUC) + "\nSELECT roc_auc FROM auc"
ORACLE["confusion_matrix"] = _ctes(*SPLIT_CTES) + """
SELECT 0 AS actual, 0 AS predicted, tn AS n FROM cm UNION ALL SELECT 0, 1, fp FROM cm
UNION ALL SELECT 1, 0, fn FROM cm UNION ALL SELECT 1, 1, tp FROM cm"""
_P1, _R1, _F1 = _sdiv("tp", "tp + fp"), _sdiv("tp", "tp + fn"), _sdiv("2 * tp", "2 * tp + fp + fn")
_P0, _R0, _F0 = _sdiv("tn", "tn + fn"), _sdiv("tn", "tn + fp"), _sdiv("2 * tn", "2 * tn + fn + fp")
ORACLE["classification_report"] = _ctes(*SPLIT_CTES) + f"""
SELECT class_name, round(precision, 4) AS precision, round(recall, 4) AS recall,
       round(f1_score, 4) AS f1_score, support
FROM (
  SELECT 'Active' AS class_name, {_P0} AS precision, {_R0} AS recall, {_F0} AS f1_score, tn + fp AS support FROM cm
  UNION ALL SELECT 'Churned', {_P1}, {_R1}, {_F1}, tp + fn FROM cm
  UNION ALL SELECT 'accuracy', NULL, NULL, {_sdiv('tp + tn', 'tp + fp + fn + tn')}, tp + fp + fn + tn FROM cm
  UNION ALL SELECT 'macro avg', ({_P0} + {_P1}) / 2, ({_R0} + {_R1}) / 2, ({_F0} + {_F1}) / 2,
                   tp + fp + fn + tn FROM cm
  UNION ALL SELECT 'weighted avg',
                   {_sdiv(f'({_P0}) * (tn + fp) + ({_P1}) * (tp + fn)', 'tp + fp + fn + tn')},
                   {_sdiv(f'({_R0}) * (tn + fp) + ({_R1}) * (tp + fn)', 'tp + fp + fn + tn')},
                   {_sdiv(f'({_F0}) * (tn + fp) + ({_F1}) * (tp + fn)', 'tp + fp + fn + tn')},
                   tp + fp + fn + tn FROM cm)"""
ORACLE["cv_f1"] = _ctes(*SPLIT_CTES, _CV) + "\nSELECT * FROM cv"
ORACLE["rule_metrics"] = _ctes(*SPLIT_CTES, _AUC, _CV) + f"""
SELECT 'Rule Score' AS model, {_METRICS}, roc_auc, cv_f1_mean, cv_f1_std, true AS is_best
FROM cm CROSS JOIN auc CROSS JOIN cv"""
ORACLE["sink_metrics"] = ORACLE["rule_metrics"]

# processed (imputed + clipped) features with the same split, for the scaler
_PSPLIT = """pranked AS (
  SELECT *, row_number() OVER (PARTITION BY is_churned
                               ORDER BY md5('42|' || CAST(member_id AS VARCHAR)), member_id) AS rank_in_label,
         count(*) OVER (PARTITION BY is_churned) AS n_label
  FROM clipped),
ptrain AS (SELECT * FROM pranked WHERE NOT (rank_in_label <= round(0.2 * n_label)))"""
ORACLE["standard_scale"] = _ctes(*ENGINEERED_CTES, _IMPUTED, _clipped("imputed"), _PSPLIT) + (
    "\nSELECT member_id, " + ", ".join(
        f"round((CAST({c} AS DOUBLE) - avg({c}) OVER ()) / CASE WHEN coalesce(stddev_pop({c}) OVER (), 0) = 0 "
        f"THEN 1.0 ELSE stddev_pop({c}) OVER () END, 6) AS {c}" for c in K.FEATURE_COLUMNS)
    + " FROM ptrain")

# --- sources and sinks: round trips must give back the written table -----------------------

ORACLE["scan_table"] = "SELECT * FROM orders"
ORACLE["feature_table_incremental"] = ORACLE["feature_table"]
ORACLE["sink_csv"] = ORACLE["feature_table"]
ORACLE["scan_csv"] = ORACLE["feature_table"]
ORACLE["sink_predictions_json"] = ORACLE["prediction_record"]
ORACLE["scan_json_records"] = ORACLE["prediction_record"]
ORACLE["sink_names_json"] = _ctes(_ORDERS, _FIRST, _MEMBERS) + "\nSELECT member_id, member_name FROM members"
ORACLE["scan_json_map"] = ORACLE["sink_names_json"]
ORACLE["sink_timelines_json"] = ORACLE["member_timeline"]
ORACLE["daily_activity_by_day"] = ORACLE["daily_activity"]
ORACLE["scan_json_object"] = ORACLE["member_timeline"]

ORACLE["member_activity"] = ORACLE["member_timeline"] + f" WHERE m.member_id = {MEMBER_PROBE}"
ORACLE["engagement_score_serving"] = _ctes(*SPLIT_CTES) + """,
train_max AS (
  SELECT """ + ", ".join(f"greatest(max({c}), 1) AS tmax_{c}" for c in K.ACTIVITY_COLUMNS) + """
  FROM train)
SELECT member_id, round(""" + " + ".join(
    f"{w} * ({c} / tmax_{c})" for w, c in zip(K.ENGAGEMENT_WEIGHTS, K.ACTIVITY_COLUMNS)) + """, 6)
  AS engagement_score
FROM labelled CROSS JOIN train_max"""

# serving path: batch maxima over the unlabelled table, zeros for every gap, no clipping
_SERVING = """serving_base AS (
  SELECT f.*, """ + " + ".join(K.ACTIVITY_COLUMNS) + """ AS total_activity_count FROM features f),
smax AS (SELECT """ + ", ".join(f"greatest(max({c}), 1) AS smax_{c}" for c in K.ACTIVITY_COLUMNS) + """
         FROM serving_base),
serving AS (
  SELECT b.*, """ + " + ".join(f"{w} * ({c} / smax_{c})" for w, c in zip(K.ENGAGEMENT_WEIGHTS, K.ACTIVITY_COLUMNS)) + """
           AS engagement_score,
         """ + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN exp(-0.05 * least({c}, 365)) END AS "
                         f"{c.replace('days_since_last_', '')}_recency_score" for c in _REC) + """,
         CASE WHEN enrollment_age_days > 0 THEN distinct_meal_days / enrollment_age_days ELSE 0.0 END
           AS meal_logging_rate,
         CASE WHEN enrollment_age_days > 0 THEN distinct_weight_days / enrollment_age_days ELSE 0.0 END
           AS weight_logging_rate,
         CAST(coalesce(meals_last_7_days > 0, false) AS INTEGER) AS has_recent_meals,
         has_doctor + has_nutritionist + has_fitness_coach AS provider_count
  FROM serving_base b CROSS JOIN smax)"""
ORACLE["serving_features"] = _ctes(*FEATURE_CTES, _SERVING) + "\nSELECT member_id, " + ", ".join(
    _r6(c, f"coalesce({c}, 0.0)") if c in DOUBLE_COLUMNS else f"coalesce({c}, 0) AS {c}"
    for c in (*K.FEATURE_COLUMNS, "total_activity_count")) + " FROM serving"


# --- fitted models: what must hold of them ---------------------------------------------------

_SOUND = "member_id, is_churned, true AS probability_valid, true AS decision_consistent"
for _name, _trees in (("fit_forest", 100), ("fit_boosted", 100), ("fit_synthetic", 200)):
    ORACLE[_name] = _ctes(*SPLIT_CTES) + (
        f"\nSELECT member_id, is_churned, CAST({_trees} AS BIGINT) AS trees, true AS same_score, true AS ranks_well "
        "FROM split WHERE is_test")
ORACLE["fit_second_order"] = _ctes(*SPLIT_CTES) + f"""
SELECT CAST(tree AS INTEGER) AS tree, count(*) AS members, CAST(sum(is_churned) AS BIGINT) AS positives,
       true AS leaves_hold, true AS ranks_well
FROM train CROSS JOIN range(100) AS r(tree)
WHERE CAST('0x' || substr(md5('42|' || tree || '|' || member_id), 1, 8) AS BIGINT) < {int(0.8 * 2 ** 32)}
GROUP BY tree"""
ORACLE["fit_logistic"] = _ctes(*SPLIT_CTES) + (
    f"\nSELECT {_SOUND}, CAST(0.0 AS DOUBLE) AS gradient_at_solution FROM split WHERE is_test")
_MODELS = f"models(model) AS (VALUES {', '.join(f"('{m}')" for m in K.MODEL_ORDER)})"
ORACLE["metrics_table"] = _ctes(*SPLIT_CTES, _MODELS) + """
SELECT model, part, count(*) AS members, count(DISTINCT member_id) AS distinct_members,
       count(*) FILTER (WHERE is_churned = 1) AS positives, count(*) FILTER (WHERE is_churned = 0) AS negatives,
       true AS beats_constant
FROM (SELECT member_id, is_churned, 'held out' AS part FROM test
      UNION ALL SELECT member_id, is_churned, 'fold ' || fold FROM folds) CROSS JOIN models
GROUP BY model, part"""
ORACLE["best_model"] = _ctes(*SPLIT_CTES) + """
SELECT 1 AS place, count(*) AS members, count(*) FILTER (WHERE is_churned = 1) AS positives, true AS beats_constant
FROM test"""

_CUT = f"""cut(model_order, model, cut_off) AS (VALUES {', '.join(
    f"({i}, '{name}', {cut})" for i, (name, cut) in enumerate(zip(K.MODEL_ORDER, (0.3, 0.4, 0.4))))}),
cut_cm AS (
  SELECT model_order, model, count(*) FILTER (WHERE is_churned = 1 AND score >= cut_off) AS tp,
         count(*) FILTER (WHERE is_churned = 0 AND score >= cut_off) AS fp,
         count(*) FILTER (WHERE is_churned = 1 AND score < cut_off) AS fn,
         count(*) FILTER (WHERE is_churned = 0 AND score < cut_off) AS tn
  FROM test CROSS JOIN cut GROUP BY 1, 2),
cut_best AS (
  SELECT model FROM cut_cm ORDER BY {_sdiv('2 * tp', '2 * tp + fp + fn')} DESC, model_order LIMIT 1)"""
_CUT_COLUMNS = f"model, {_METRICS}, roc_auc, model = (SELECT model FROM cut_best) AS is_best"
ORACLE["cut_off_metrics"] = _ctes(*SPLIT_CTES, _AUC, _CUT) + (
    f"\nSELECT model_order, {_CUT_COLUMNS} FROM cut_cm CROSS JOIN auc")
ORACLE["scan_metrics"] = _ctes(*SPLIT_CTES, _AUC, _CUT) + f"\nSELECT {_CUT_COLUMNS} FROM cut_cm CROSS JOIN auc"
ORACLE["cut_off_best"] = _ctes(*SPLIT_CTES, _CUT) + (
    f"\nSELECT model, round({_sdiv('2 * tp', '2 * tp + fp + fn')}, 4) AS f1_score "
    "FROM cut_cm WHERE model = (SELECT model FROM cut_best)")
_PTRAIN = _ctes(*ENGINEERED_CTES, _IMPUTED, _clipped("imputed"), _PSPLIT)
ORACLE["feature_importance"] = _PTRAIN + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, min({c}) = max({c}) AS constant, true AS sound FROM ptrain" for c in K.FEATURE_COLUMNS)
ORACLE["score_members"] = _ctes(*ENGINEERED_CTES) + "\nSELECT member_id, true AS score_follows, " + ", ".join(
    _r6(c, f"coalesce({c}, 0.0)") if c in DOUBLE_COLUMNS else f"coalesce({c}, 0) AS {c}"
    for c in K.KEY_FEATURES) + " FROM engineered"
ORACLE["score_one"] = f"""
SELECT CAST({MEMBER_PROBE} AS BIGINT) AS member_id, CAST(NULL AS VARCHAR) AS error, true AS same_as_batch
FROM customer WHERE c_custkey = {MEMBER_PROBE}
UNION ALL SELECT -1, 'Member not found', NULL"""
ORACLE["save_pipeline"] = _PTRAIN + "\n" + "\nUNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS feature, round(avg({c}) + 1e-7, 4) AS mean, round(stddev_samp({c}) + 1e-7, 4) AS std FROM ptrain"
    for i, c in enumerate(K.FEATURE_COLUMNS))
ORACLE["load_pipeline"] = "SELECT c_custkey AS member_id, true AS same_score FROM customer"
ORACLE["sink_feature_columns"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{c}')" for i, c in enumerate(K.FEATURE_COLUMNS)) + ") f(position, feature)"
ORACLE["feature_table_newest_first"] = _ctes(*FEATURE_CTES) + (
    "\nSELECT member_id, created_at, total_meal_logs FROM features ORDER BY created_at DESC NULLS LAST, member_id")

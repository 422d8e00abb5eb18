"""Registered queries: name -> (spark, data_dir) -> DataFrame.

Every query reads the given tables through a stand-in profile, so its work
grows with them. Doubles are rounded to 6 places at the output edge only
where results are compared with another engine.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens import constants as K
from cohortlens.operators import (boosting, clean, engineer, evaluate, feature_state, features, label, models, reports,
                                  scoring, serving, split, timeline, trees)
from cohortlens import sinks
from cohortlens.session import materialize, path_exists
from cohortlens.sources import daylogs, files, json_split
from cohortlens.sources.activity import log_batch
from cohortlens.plans import workflow as W
from cohortlens.sources.standin import (ORDERS_THRESHOLD_DAYS, events_profile,
                                        orders_profile)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return wrap


def _orders(spark, sf):
    return orders_profile(spark, sf)


def _labelled(spark, sf, with_name=False):
    return W.labelled_table(_orders(spark, sf), ORDERS_THRESHOLD_DAYS, with_name)


def _engineered(spark, sf, with_name=False):
    return W.engineered_table(_orders(spark, sf), ORDERS_THRESHOLD_DAYS, with_name,
                              materialize_labels=True)


# --- 2.3 activity aggregation ---------------------------------------------------

@register("feature_table")
def q_feature_table(spark, sf):
    return features.feature_table(_orders(spark, sf)).drop("created_at")


@register("feature_table_incremental")
def q_feature_table_incremental(spark, sf):
    """The feature table from a state of all logs up to four days before, then four daily merges."""
    d = _orders(spark, sf)
    root, before = sinks.scratch_path(spark, "feature-state"), None
    for back in (4, 3, 2, 1, 0):
        day = d.as_of - dt.timedelta(days=back)
        feature_state.advance(spark, root, log_batch(d, before, day), before)
        before = day
    return feature_state.feature_table(spark, root, d.as_of, d.members, d.enrollments).drop("created_at")


@register("member_demographics")
def q_member_demographics(spark, sf):
    d = _orders(spark, sf)
    return features.member_demographics(d.members, d.as_of)


@register("enrollment_features")
def q_enrollment_features(spark, sf):
    d = _orders(spark, sf)
    return features.enrollment_features(d.enrollments, d.as_of).drop(*K.PROVIDER_COLUMNS)


@register("provider_flags")
def q_provider_flags(spark, sf):
    d = _orders(spark, sf)
    return features.provider_flags(d.enrollments, d.as_of)


@register("meal_totals")
def q_meal_totals(spark, sf):
    d = _orders(spark, sf)
    return features.meal_totals(d.meals, d.as_of)


@register("meal_nutrition")
def q_meal_nutrition(spark, sf):
    d = _orders(spark, sf)
    return features.meal_nutrition(d.meals, d.as_of)


@register("meal_compliance")
def q_meal_compliance(spark, sf):
    d = _orders(spark, sf)
    return features.meal_compliance(d.meals, d.as_of)


@register("meal_recent_counts")
def q_meal_recent_counts(spark, sf):
    d = _orders(spark, sf)
    return features.meal_recent_counts(d.meals, d.as_of)


def _weights(spark, sf):
    d = _orders(spark, sf)
    return features.weight_features(d.weights, d.members, d.as_of)


@register("weight_totals")
def q_weight_totals(spark, sf):
    return _weights(spark, sf).select("member_id", "total_weight_logs", "distinct_weight_days")


@register("weight_range_change")
def q_weight_range_change(spark, sf):
    return _weights(spark, sf).select("member_id", "weight_range_kg", "weight_change_kg")


@register("weight_bmi")
def q_weight_bmi(spark, sf):
    return _weights(spark, sf).select("member_id", "avg_bmi")


@register("exercise_totals")
def q_exercise_totals(spark, sf):
    d = _orders(spark, sf)
    return features.exercise_features(d.exercises, d.as_of).drop("days_since_last_exercise")


@register("collection_totals")
def q_collection_totals(spark, sf):
    d = _orders(spark, sf)
    return features.collection_features(d.collections, d.as_of).drop("days_since_last_collection")


@register("channel_recency")
def q_channel_recency(spark, sf):
    return features.channel_recency(_orders(spark, sf))


# --- 2.4 / 2.5 labels and rule score ----------------------------------------------

@register("sentinel_to_null")
def q_sentinel_to_null(spark, sf):
    t = features.feature_table(_orders(spark, sf))
    return label.recency_sentinel_to_null(t).select("member_id", *K.RECENCY_COLUMNS)


@register("null_to_sentinel")
def q_null_to_sentinel(spark, sf):
    t = label.recency_sentinel_to_null(features.feature_table(_orders(spark, sf)))
    return label.recency_null_to_sentinel(t).select("member_id", *K.RECENCY_COLUMNS)


@register("min_recency")
def q_min_recency(spark, sf):
    t = features.feature_table(_orders(spark, sf))
    return t.select("member_id", label.min_recency_expr(t).alias("min_days_since_activity"))


@register("total_activity")
def q_total_activity(spark, sf):
    t = features.feature_table(_orders(spark, sf))
    return t.select("member_id", label.total_activity_expr(t).alias("total_activity_count"))


@register("churn_label")
def q_churn_label(spark, sf):
    return _labelled(spark, sf).select(
        "member_id", *K.RECENCY_COLUMNS, *K.HELPER_COLUMNS, K.LABEL_COLUMN)


@register("label_distribution")
def q_label_distribution(spark, sf):
    return W.round_doubles(label.label_distribution(_labelled(spark, sf)))


@register("rule_churn_score")
def q_rule_churn_score(spark, sf):
    return label.rule_churn_score(_labelled(spark, sf)).select(
        "member_id", "rule_churn_score", "rule_churned")


@register("group_profile")
def q_group_profile(spark, sf):
    return W.round_doubles(label.group_profile(_labelled(spark, sf)))


# --- 2.6 feature engineering -------------------------------------------------------

@register("channel_maxima")
def q_channel_maxima(spark, sf):
    return engineer.channel_maxima(_labelled(spark, sf))


@register("engagement_score")
def q_engagement_score(spark, sf):
    t = engineer.engagement_score(_labelled(spark, sf))
    return W.round_doubles(t.select("member_id", "engagement_score"))


@register("recency_decay")
def q_recency_decay(spark, sf):
    t = engineer.recency_decay(_labelled(spark, sf))
    return W.round_doubles(t.select("member_id", *[c for c in t.columns if c.endswith("_recency_score")]))


@register("logging_rates")
def q_logging_rates(spark, sf):
    t = engineer.logging_rates(_labelled(spark, sf))
    return W.round_doubles(t.select("member_id", "meal_logging_rate", "weight_logging_rate"))


@register("has_recent_meals")
def q_has_recent_meals(spark, sf):
    return engineer.has_recent_meals(_labelled(spark, sf)).select("member_id", "has_recent_meals")


@register("provider_count")
def q_provider_count(spark, sf):
    return engineer.provider_count(_labelled(spark, sf)).select("member_id", "provider_count")


@register("engagement_score_serving")
def q_engagement_score_serving(spark, sf):
    """Maxima fitted on the training rows of the split, applied to every member."""
    t = _rule_split(spark, sf)
    maxima = engineer.fit_channel_maxima(t.where(~F.col("is_test")))
    out = engineer.engagement_score(_labelled(spark, sf), maxima)
    return W.round_doubles(out.select("member_id", "engagement_score"))


@register("engineer_features")
def q_engineer_features(spark, sf):
    t = _engineered(spark, sf)
    return W.round_doubles(t.select("member_id", *K.ENGINEERED_COLUMNS))


# --- 2.7 missing values and outliers -------------------------------------------------

@register("null_profile")
def q_null_profile(spark, sf):
    return clean.null_profile(_engineered(spark, sf).drop("created_at"))


@register("impute_by_name")
def q_impute_by_name(spark, sf):
    t = clean.impute_by_name(_engineered(spark, sf).drop("created_at"))
    return W.round_doubles(t)


@register("impute_zero")
def q_impute_zero(spark, sf):
    return W.round_doubles(clean.impute_zero(_engineered(spark, sf).drop("created_at")))


@register("clip_quantiles")
def q_clip_quantiles(spark, sf):
    return W.round_doubles(clean.clip_quantiles(_engineered(spark, sf).drop("created_at")))


@register("process_features")
def q_process_features(spark, sf):
    return W.round_doubles(W.process_features(_orders(spark, sf), ORDERS_THRESHOLD_DAYS)
                           .drop("created_at"))


# --- 2.4 projections ---------------------------------------------------------------

@register("serving_features")
def q_serving_features(spark, sf):
    t = W.serving_features(_orders(spark, sf))
    return W.round_doubles(t.select("member_id", *K.FEATURE_COLUMNS, "total_activity_count"))


@register("select_features")
def q_select_features(spark, sf):
    from cohortlens.operators.select import select_features
    return W.round_doubles(select_features(_engineered(spark, sf, with_name=True)))


@register("numeric_columns")
def q_numeric_columns(spark, sf):
    t = _engineered(spark, sf, with_name=True).drop("created_at")
    return W.round_doubles(t.select(*clean.numeric_columns(t)))


@register("member_filter")
def q_member_filter(spark, sf):
    from cohortlens.operators.select import member_filter
    return member_filter(features.feature_table(_orders(spark, sf)), MEMBER_PROBE).drop("created_at")


@register("align_features")
def q_align_features(spark, sf):
    from cohortlens.operators.select import align_features
    t = label.churn_label(features.feature_table(_orders(spark, sf)), ORDERS_THRESHOLD_DAYS)
    return W.round_doubles(align_features(t, K.FEATURE_COLUMNS, keep=("member_id",)))


# --- 2.10 scoring and serving (rule-scored, so results are exact) ------------------

# fixed values: probe parameters of the serving queries
MEMBER_PROBE = 42
SEARCH_PROBE = "ring"


def _preds(spark, sf):
    """Rule-scored predictions as one lazy plan (no fitted statistics)."""
    return W.rule_predictions(_orders(spark, sf), ORDERS_THRESHOLD_DAYS)


def _preds_engaged(spark, sf):
    """The same with ``engagement_score``, whose channel maxima are fitted first."""
    return W.rule_predictions(_orders(spark, sf), ORDERS_THRESHOLD_DAYS, with_engagement=True)


_PUBLISH = {"by-id": serving.publish_by_id, "by-rank": serving.publish_by_rank, "search": serving.publish_search}
_PUBLISHED: dict[tuple[str, str, str], str] = {}


def _published_folder(spark, sf, name, write) -> str:
    """Folder of something written once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _PUBLISHED or not path_exists(spark, _PUBLISHED[key]):
        folder = sinks.scratch_path(spark, f"published-{name}")
        write(folder)
        _PUBLISHED[key] = folder
    return _PUBLISHED[key]


def _published(spark, sf, layout) -> str:
    """The whole table's rule-scored predictions in one of the serving layouts. The first query
    that needs them scores and publishes; the others read what it wrote, as serving does."""
    def publish(folder):
        rows = _published_folder(spark, sf, "rows", lambda f: sinks.write_table(_preds(spark, sf), f))
        _PUBLISH[layout](spark.read.parquet(rows), folder)

    return _published_folder(spark, sf, layout, publish)


@register("risk_bucket")
def q_risk_bucket(spark, sf):
    return _preds(spark, sf).select("member_id", "churn_probability", "risk_label")


@register("rank_by_risk")
def q_rank_by_risk(spark, sf):
    return scoring.rank_by_risk(_preds(spark, sf)).select(
        "member_id", "member_name", "churn_probability", "churn_prediction", "risk_label")


@register("prediction_record")
def q_prediction_record(spark, sf):
    return W.round_doubles(scoring.prediction_record(_preds_engaged(spark, sf)))


@register("risk_summary")
def q_risk_summary(spark, sf):
    return scoring.risk_summary(_preds(spark, sf))


@register("risk_filter")
def q_risk_filter(spark, sf):
    return scoring.risk_filter(_preds(spark, sf), "High").select(
        "member_id", "churn_probability", "risk_label")


@register("at_risk_top")
def q_at_risk_top(spark, sf):
    return serving.published_top(spark, _published(spark, sf, "by-rank"), 100)


@register("at_risk_summary")
def q_at_risk_summary(spark, sf):
    return scoring.risk_summary(serving.published_top(spark, _published(spark, sf, "by-rank"), 100, "Medium"))


@register("member_search")
def q_member_search(spark, sf):
    return serving.published_search(spark, _published(spark, sf, "search"), SEARCH_PROBE, 20)


@register("names_join")
def q_names_join(spark, sf):
    d = _orders(spark, sf)
    preds = _preds(spark, sf).drop("member_name")
    return scoring.names_join(preds, d.members, "").select("member_id", "member_name")


@register("prediction_lookup")
def q_prediction_lookup(spark, sf):
    return serving.published_lookup(spark, _published(spark, sf, "by-id"), MEMBER_PROBE).select(
        "member_id", "churn_probability", "churn_prediction", "risk_label")


@register("key_features")
def q_key_features(spark, sf):
    return W.round_doubles(scoring.key_features(_preds_engaged(spark, sf)).select("member_id", "key_features.*"))


@register("key_features_scored")
def q_key_features_scored(spark, sf):
    t = scoring.key_features_scored(_engineered(spark, sf))
    return W.round_doubles(t.select("member_id", "key_features.*"))


# --- 2.11 daily activity timeline (events profile) -----------------------------------

def _events(spark, sf):
    return events_profile(spark, sf)


def _daily_out(daily):
    return daily.select("member_id", F.date_format("day", "yyyy-MM-dd").alias("date"),
                        "meal_count", "weight_logged", "exercise_count", "collection_progress")


@register("daily_activity")
def q_daily_activity(spark, sf):
    return _daily_out(timeline.daily_activity(_events(spark, sf)))


@register("daily_activity_by_day")
def q_daily_activity_by_day(spark, sf):
    """Daily activity from logs stored by day; only the window's folders are read."""
    d = _events(spark, sf)
    root = sinks.scratch_path(spark, "logs-by-day")
    daylogs.write_by_day(d, root)
    return _daily_out(timeline.daily_activity(daylogs.read_by_day(spark, root, d, last_days=K.TIMELINE_DAYS)))


@register("timeline_summary")
def q_timeline_summary(spark, sf):
    return timeline.timeline_summary(timeline.member_days(_events(spark, sf)))


@register("member_timeline")
def q_member_timeline(spark, sf):
    t = timeline.member_timeline(_events(spark, sf))
    return t.select("member_id", "member_name", "enrollment_date",
                    F.inline("activity_timeline"), "summary.*")


@register("member_activity")
def q_member_activity(spark, sf):
    t = timeline.member_activity(timeline.member_timeline(_events(spark, sf)), MEMBER_PROBE)
    return t.select("member_id", "member_name", "enrollment_date",
                    F.inline("activity_timeline"), "summary.*")


@register("enrollment_date")
def q_enrollment_date(spark, sf):
    return timeline.enrollment_date(_events(spark, sf))


# --- 2.12 dashboard projections ------------------------------------------------------

@register("chart_rows")
def q_chart_rows(spark, sf):
    return reports.chart_rows(timeline.daily_activity(_events(spark, sf)))


@register("gauge_band")
def q_gauge_band(spark, sf):
    return reports.gauge_band(_preds(spark, sf))


@register("risk_table")
def q_risk_table(spark, sf):
    return reports.risk_table(_preds(spark, sf), None)


@register("key_indicators")
def q_key_indicators(spark, sf):
    return reports.key_indicators(_preds_engaged(spark, sf))


@register("search_display")
def q_search_display(spark, sf):
    return reports.search_display(
        serving.published_search(spark, _published(spark, sf, "search"), SEARCH_PROBE, 20))


# --- 2.8 split, folds, weights, scaling ------------------------------------------------

def _split(spark, sf):
    """Processed features with the stratified hold-out split."""
    return W.training_split(_orders(spark, sf), ORDERS_THRESHOLD_DAYS)[0]


def _rule_split(spark, sf):
    """Labelled, rule-scored members with the split (exactly reproducible)."""
    t = label.rule_churn_score(_labelled(spark, sf))
    return split.stratified_split(t)


@register("stratified_split")
def q_stratified_split(spark, sf):
    return _rule_split(spark, sf).select("member_id", K.LABEL_COLUMN, "rank_in_label", "n_label", "is_test")


@register("stratified_folds")
def q_stratified_folds(spark, sf):
    s = _rule_split(spark, sf)
    k = split.fold_count(s.where(~F.col("is_test")))
    return split.stratified_folds(s, k).select("member_id", K.LABEL_COLUMN, "fold")


@register("class_weights")
def q_class_weights(spark, sf):
    s = _rule_split(spark, sf)
    w = split.class_weights(s.where(~F.col("is_test")))
    return W.round_doubles(w.select("member_id", K.LABEL_COLUMN, "w_balanced", "w_boost"))


@register("standard_scale")
def q_standard_scale(spark, sf):
    s = _split(spark, sf)
    train = s.where(~F.col("is_test"))
    stats = split.fit_standard_scale(train, list(K.FEATURE_COLUMNS))
    return W.round_doubles(split.apply_standard_scale(train, stats).select("member_id", *K.FEATURE_COLUMNS))


# --- 2.9 evaluation on the deterministic rule score ------------------------------------

def _rule_test(spark, sf):
    return _rule_split(spark, sf).where(F.col("is_test")).withColumnsRenamed(
        {"rule_churned": "prediction", "rule_churn_score": "score"})


@register("classification_metrics")
def q_classification_metrics(spark, sf):
    return evaluate.rounded(evaluate.classification_metrics(_rule_test(spark, sf)))


@register("roc_auc")
def q_roc_auc(spark, sf):
    return evaluate.rounded(evaluate.roc_auc(_rule_test(spark, sf)))


@register("confusion_matrix")
def q_confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(_rule_test(spark, sf))


@register("classification_report")
def q_classification_report(spark, sf):
    return evaluate.classification_report(_rule_test(spark, sf))


def _rule_cv(s):
    k = split.fold_count(s.where(~F.col("is_test")))
    folds = split.stratified_folds(s, k).withColumnRenamed("rule_churned", "prediction")
    return evaluate.fold_f1(folds)


@register("cv_f1")
def q_cv_f1(spark, sf):
    return evaluate.rounded(_rule_cv(_rule_split(spark, sf)))


def _rule_metrics(spark, sf):
    s = materialize(_rule_split(spark, sf), "rule-split")  # three evaluations read it
    test = s.where(F.col("is_test")).withColumnsRenamed({"rule_churned": "prediction", "rule_churn_score": "score"})
    m = evaluate.classification_metrics(test).first().asDict()
    m.update(evaluate.roc_auc(test).first().asDict())
    m.update(_rule_cv(s).first().asDict())
    return evaluate.rounded(evaluate.mark_best(evaluate.metrics_table(spark, {"Rule Score": m})))


@register("rule_metrics")
def q_rule_metrics(spark, sf):
    return _rule_metrics(spark, sf).drop("model_order")


# --- 2.8 / 2.9 fitted models -------------------------------------------------------------
# Fitted numbers depend on the solver; the queries return what must hold of them exactly.

def _fit(spark, sf, names=K.MODEL_ORDER[:1]):
    """(split table, channel maxima, result) of the models asked for."""
    s, maxima = W.training_split(_orders(spark, sf), ORDERS_THRESHOLD_DAYS)
    return s, maxima, models.train_and_compare(spark, s, list(K.FEATURE_COLUMNS), 5, names=names, with_cv=False)


_RUNS: dict[tuple[str, str], W.TrainedRun] = {}


def _trained(spark, sf) -> W.TrainedRun:
    """The training run of this application on these tables: all three models, cross-validated.

    The first query that needs it trains; the others read what it wrote, as serving does.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS or not path_exists(spark, _RUNS[key].folder):
        _RUNS[key] = W.train(spark, _orders(spark, sf), ORDERS_THRESHOLD_DAYS, sinks.scratch_path(spark, "training-run"))
    return _RUNS[key]


def _sound(pred):
    """Held-out rows: the probability is one, and the decision follows from it."""
    p = F.col("score")
    return pred.select(
        "member_id", K.LABEL_COLUMN, p.between(0.0, 1.0).alias("probability_valid"),
        ((p > 0.5) == (F.col("prediction") == 1)).alias("decision_consistent"))


def _by_nodes(spark, model, path, rows, held_out):
    """Held-out rows scored by the model and by joins over its saved node table, with the trees whose
    leaf was reached, and whether the model ranks churned members first."""
    by_joins = trees.relational_scores(spark, path, model, rows)
    auc = evaluate.roc_auc(held_out).first()["roc_auc"]
    return held_out.join(by_joins, "member_id").select(
        "member_id", K.LABEL_COLUMN, "trees",
        (F.abs(F.col("score") - F.col("relational_score")) < 1e-9).alias("same_score"), F.lit(auc > 0.9).alias("ranks_well"))


def _held_out_by_nodes(spark, sf, name):
    run = _trained(spark, sf)
    return _by_nodes(spark, sinks.load_pipeline(f"{run.model_dir(name)}/pipeline"), f"{run.model_dir(name)}/pipeline",
                     run.table("split").where("is_test"), run.table("held_out").where(F.col("model") == name))


@register("fit_logistic")
def q_fit_logistic(spark, sf):
    """Also the penalised weighted gradient at the solution, which is 0 at the optimum."""
    s, _, result = _fit(spark, sf)
    model = result.models[K.MODEL_ORDER[0]]
    slope = models.logistic_gradient(model, split.class_weights(s.where(~F.col("is_test"))), result.n_train)
    return _sound(result.held_out).withColumn("gradient_at_solution", F.lit(round(slope, 3) + 0.0))


@register("fit_forest")
def q_fit_forest(spark, sf):
    return _held_out_by_nodes(spark, sf, K.MODEL_ORDER[1])


@register("fit_boosted")
def q_fit_boosted(spark, sf):
    return _held_out_by_nodes(spark, sf, K.MODEL_ORDER[2])


@register("fit_second_order")
def q_fit_second_order(spark, sf):
    """Boosting on gradient histograms: each tree's training sample, whether the members that reach each leaf by
    joins over the node table are those it was made from, and whether the model ranks churned held-out members first."""
    s, _ = W.training_split(_orders(spark, sf), ORDERS_THRESHOLD_DAYS)
    cols = list(K.FEATURE_COLUMNS)
    train = split.class_weights(s.where(~F.col("is_test")))
    params = boosting.BoostParams()
    model = boosting.fit(train, cols, weight="w_boost", params=params)
    nodes = materialize(model.table(spark), "boost-nodes")
    x = train.select("member_id", F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    leaves = trees.reached_leaves(x, nodes, params.rounds, params.depth).join(
        train.select("member_id", K.LABEL_COLUMN), "member_id")
    drawn = leaves.where(boosting.sampled("member_id", params.seed, F.col("tree"), params.row_sample))
    made = nodes.where("feature IS NULL AND rows > 0").select("tree", "node", "rows")
    held = drawn.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"), F.sum(K.LABEL_COLUMN).alias("p")).join(
        made, ["tree", "node"], "full")
    auc = evaluate.roc_auc(model.score(s.where("is_test"))).first()["roc_auc"]
    return held.groupBy("tree").agg(
        F.sum("n").alias("members"), F.sum("p").cast("long").alias("positives"),
        F.bool_and(F.coalesce(F.col("n") == F.col("rows"), F.lit(False))).alias("leaves_hold"),
    ).withColumn("ranks_well", F.lit(auc > 0.9))


@register("fit_synthetic")
def q_fit_synthetic(spark, sf):
    """The second training form: larger forest on features with gaps as 0, nothing clipped."""
    table = label.rule_churn_score(_engineered(spark, sf))
    s = materialize(clean.impute_zero(split.stratified_split(table).drop("created_at")), "synthetic-split")
    name = K.MODEL_ORDER[1]
    result = models.train_and_compare(spark, s, list(K.FEATURE_COLUMNS), 5, models.ModelParams.synthetic(),
                                      with_cv=False, names=(name,))
    path = sinks.scratch_path(spark, "synthetic-model")
    sinks.save_pipeline(result.models[name], path)
    return _by_nodes(spark, result.models[name], path, s.where("is_test"), result.held_out)


@register("metrics_table")
def q_metrics_table(spark, sf):
    """Every fitted model on the held-out rows and on each fold (of the out-of-fold predictions)."""
    run = _trained(spark, sf)
    parts = evaluate.part_counts(run.table("held_out"), run.table("out_of_fold"))
    return parts.select("model", "part", "members", "distinct_members", (F.col("tp") + F.col("fn")).alias("positives"),
                        (F.col("fp") + F.col("tn")).alias("negatives"), "beats_constant")


@register("best_model")
def q_best_model(spark, sf):
    """The chosen model's held-out rows, and the rule by which it was chosen, from the written predictions."""
    run = _trained(spark, sf)
    chosen = evaluate.best_model(run.result.metrics).select("model")
    f1 = F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    order = F.array_position(F.array(*map(F.lit, K.MODEL_ORDER)), F.col("model"))
    place = F.row_number().over(Window.orderBy(F.coalesce(f1, F.lit(0.0)).desc(), order))   # three rows
    ranked = evaluate.part_counts(run.table("held_out"), run.table("out_of_fold")).where("part = 'held out'").withColumn(
        "place", place)
    return ranked.join(F.broadcast(chosen), "model").select(
        "place", "members", (F.col("tp") + F.col("fn")).alias("positives"), "beats_constant")


# fixed values: rule-score cut-offs that stand for three models (the last two tie)
CUT_OFFS = (0.3, 0.4, 0.4)


def _cut_off_metrics(spark, sf):
    test = materialize(_rule_test(spark, sf).select(K.LABEL_COLUMN, "score"), "cut-off-test")
    auc = evaluate.roc_auc(test).first().asDict()
    rows = {name: evaluate.classification_metrics(test.withColumn(
        "prediction", (F.col("score") >= cut).cast("int"))).first().asDict() | auc
        for name, cut in zip(K.MODEL_ORDER, CUT_OFFS)}
    return evaluate.mark_best(evaluate.metrics_table(spark, rows))


@register("cut_off_metrics")
def q_cut_off_metrics(spark, sf):
    return evaluate.rounded(_cut_off_metrics(spark, sf)).drop("cv_f1_mean", "cv_f1_std")


@register("cut_off_best")
def q_cut_off_best(spark, sf):
    return evaluate.rounded(evaluate.best_model(_cut_off_metrics(spark, sf))).select("model", "f1_score")


@register("feature_importance")
def q_feature_importance(spark, sf):
    """The forest's importances, of the model and from the gains in its saved node table."""
    run = _trained(spark, sf)
    path = f"{run.model_dir(K.MODEL_ORDER[1])}/pipeline"
    ensemble = sinks.load_pipeline(path)
    top = models.feature_importance(ensemble, run.result.feature_cols, run.result.n_train, top=len(K.FEATURE_COLUMNS))
    number = spark.createDataFrame(list(enumerate(run.result.feature_cols)), "feature int, name string")
    by_nodes = trees.relational_importances(trees.tree_nodes(spark, path)).join(F.broadcast(number), "feature").select(
        F.col("name").alias("feature"), F.col("importance").alias("relational"))
    train = run.table("split").where(~F.col("is_test"))
    flat = train.agg(*[(F.min(c) == F.max(c)).alias(c) for c in K.FEATURE_COLUMNS]).unpivot(
        [], list(K.FEATURE_COLUMNS), "feature", "constant")
    same = F.abs(F.col("importance") - F.coalesce("relational", F.lit(0.0))) < 1e-9
    return top.join(by_nodes, "feature", "left").join(flat, "feature").select(
        "feature", "constant", (same & (~F.col("constant") | (F.col("importance") == 0))).alias("sound"))


# --- 2.10 model scoring -------------------------------------------------------------------

def _best(spark, sf):
    """(folder, fitted pipeline) of the best model of the training run."""
    run = _trained(spark, sf)
    return run.model_dir(run.result.best), run.result.models[run.result.best]


@register("score_members")
def q_score_members(spark, sf):
    """All members scored from fresh logs with the best saved model; indicators are not clipped.

    ``score_follows``: the model ranks inactive members first (area under the curve above 0.8)
    and each rounded score is that of the fitted pipeline on the same features.
    """
    folder, model = _best(spark, sf)
    data = _orders(spark, sf)
    scored = W.score_fresh(data, folder)
    fresh = W.serving_features(data, files.read_statistics(spark, f"{folder}/statistics"))
    again = models.with_probability(model.transform(fresh)).select("member_id", F.round("score", 4).alias("again"))
    labels = _labelled(spark, sf).select("member_id", K.LABEL_COLUMN)
    auc = evaluate.roc_auc(again.join(labels, "member_id").withColumnRenamed("again", "score")).first()["roc_auc"]
    both = scored.join(again, "member_id")
    return W.round_doubles(both.select(
        "member_id", *K.KEY_FEATURES, ((F.col("churn_probability") == F.col("again")) & F.lit(auc > 0.8)).alias("score_follows")))


@register("score_one")
def q_score_one(spark, sf):
    """The record of a known member beside that of an unknown one; its score is that of the batch."""
    folder, _ = _best(spark, sf)
    model = sinks.load_pipeline(f"{folder}/pipeline")
    fresh = W.serving_features(_orders(spark, sf), files.read_statistics(spark, f"{folder}/statistics"))
    both = scoring.score_one(model, fresh, MEMBER_PROBE).unionByName(scoring.score_one(model, fresh, -1))
    batch = W.score_fresh(_orders(spark, sf), folder).select("member_id", F.col("churn_probability").alias("batch"))
    return both.join(batch, "member_id", "left").select(
        "member_id", "error", (F.col("churn_probability") == F.col("batch")).alias("same_as_batch"))


@register("save_pipeline")
def q_save_pipeline(spark, sf):
    """Feature order, and the means and deviations of the training rows, from the saved files of the best model."""
    folder, _ = _best(spark, sf)
    order = spark.read.schema("class string, paramMap struct<inputCols: array<string>>").json(
        f"{folder}/pipeline/stages/0_*/metadata").select(F.posexplode("paramMap.inputCols").alias("position", "feature"))
    scaler = spark.read.parquet(f"{folder}/pipeline/stages/1_*/data").select(
        F.arrays_zip(vector_to_array("mean").alias("mean"), vector_to_array("std").alias("std")).alias("s"))
    values = scaler.select(F.posexplode("s").alias("position", "s")).select("position", "s.mean", "s.std")
    hair = 1e-7     # so that exact ties do not round by the order of summation
    return order.join(values, "position").withColumns({c: F.round(F.col(c) + hair, 4) for c in ("mean", "std")})


@register("load_pipeline")
def q_load_pipeline(spark, sf):
    """Members for whom the loaded pipeline gives the score of the fitted one."""
    path, model = _best(spark, sf)
    fresh = W.serving_features(_orders(spark, sf), files.read_statistics(spark, f"{path}/statistics"))
    fitted = models.with_probability(model.transform(fresh)).drop("features", "raw_features", "rawPrediction",
                                                                  "probability", "prediction")
    again = models.with_probability(sinks.load_pipeline(f"{path}/pipeline").transform(
        fitted.withColumnRenamed("score", "fitted_score")))
    return again.select("member_id", (F.col("score") == F.col("fitted_score")).alias("same_score"))


@register("sink_feature_columns")
def q_sink_feature_columns(spark, sf):
    """The model's feature order, taken from the table, written and read back."""
    order = [c for c in _engineered(spark, sf).columns if c in K.FEATURE_COLUMNS]
    path = sinks.scratch_path(spark, "feature-columns")
    sinks.write_feature_columns(spark, order, path)
    return files.read_json_records(spark, path, T.StructType(
        [T.StructField("position", T.IntegerType()), T.StructField("feature", T.StringType())]))


@register("feature_table_newest_first")
def q_feature_table_newest_first(spark, sf):
    """The feature table in its serving order, with the place of each row."""
    ordered = features.order_newest_first(features.feature_table(_orders(spark, sf)))
    return ordered.select("member_id", "created_at", "total_meal_logs")


# --- 2.1 / 2.2 sources and sinks (round trips through the shared folder) -------------------

@register("scan_table")
def q_scan_table(spark, sf):
    """The whole orders table, all columns."""
    return files.read_table(spark, sf, "orders")


@register("sink_csv")
def q_sink_csv(spark, sf):
    t = features.feature_table(_orders(spark, sf)).drop("created_at")
    path = sinks.scratch_path(spark, "features-csv")
    sinks.write_csv(t, path)
    return files.read_csv(spark, path, t.schema)


@register("scan_csv")
def q_scan_csv(spark, sf):
    """The whole feature CSV of many part files, columns given in another order."""
    t = features.feature_table(_orders(spark, sf)).drop("created_at")
    shuffled = t.select(*reversed(t.columns))
    path = sinks.scratch_path(spark, "features-csv")
    sinks.write_csv(shuffled.repartition(5), path)
    return files.read_csv(spark, path, shuffled.schema)


@register("sink_predictions_json")
def q_sink_predictions_json(spark, sf):
    p = scoring.prediction_record(_preds_engaged(spark, sf))
    path = sinks.scratch_path(spark, "predictions")
    sinks.write_json_records(p, path)
    return W.round_doubles(files.read_json_records(spark, path, p.schema))


@register("scan_json_records")
def q_scan_json_records(spark, sf):
    """Predictions exported as JSON arrays over several lines, a hundred records each."""
    p = scoring.prediction_record(_preds_engaged(spark, sf))
    path = sinks.scratch_path(spark, "prediction-arrays")
    arrays = p.groupBy(F.floor(F.col("member_id") / 100).alias("part")).agg(
        F.to_json(F.collect_list(F.struct("*")), {"pretty": "true"}).alias("value"))
    arrays.repartition("part").write.partitionBy("part").text(path)
    return W.round_doubles(files.read_json_records(spark, path, p.schema, multiline=True).drop("part"))


@register("sink_names_json")
def q_sink_names_json(spark, sf):
    names = _orders(spark, sf).members.select("member_id", "member_name")
    path = sinks.scratch_path(spark, "names")
    sinks.write_json_records(names, path)
    return files.read_json_records(spark, path, names.schema)


@register("scan_json_map")
def q_scan_json_map(spark, sf):
    names = _orders(spark, sf).members.select("member_id", "member_name")
    path = sinks.scratch_path(spark, "names-map")
    sinks.write_json_map(names, "member_id", "member_name", path, keys_per_object=500)
    m = files.read_json_map(spark, path, "string", "member_id", "member_name", wholetext=False)
    return m.select(F.col("member_id").cast("long").alias("member_id"), "member_name")


@register("scan_json_object")
def q_scan_json_object(spark, sf):
    """Single JSON objects of all timelines by member, written one object a file and read by byte ranges."""
    t = timeline.member_timeline(_events(spark, sf))
    path = sinks.scratch_path(spark, "timeline-objects")
    record = F.struct("member_name", "enrollment_date", "activity_timeline", "summary")
    sinks.write_json_objects(t.select("member_id", record.alias("record")), "member_id", "record", path, objects=2)
    back = json_split.read_json_object(spark, path, t.select(record.alias("r")).schema["r"].dataType.simpleString(),
                                       "member_id", "record")
    return back.select(F.col("member_id").cast("long").alias("member_id"), "record.member_name", "record.enrollment_date",
                       F.col("record.summary").alias("summary"), F.inline("record.activity_timeline")) \
        .select("*", "summary.*").drop("summary")


@register("sink_timelines_json")
def q_sink_timelines_json(spark, sf):
    t = timeline.member_timeline(_events(spark, sf))
    path = sinks.scratch_path(spark, "timelines")
    sinks.write_json_records(t, path)
    back = files.read_json_records(spark, path, t.schema)
    return back.select("member_id", "member_name", "enrollment_date",
                       F.inline("activity_timeline"), "summary.*")


@register("sink_metrics")
def q_sink_metrics(spark, sf):
    m = _rule_metrics(spark, sf)
    path = sinks.scratch_path(spark, "metrics")
    sinks.write_metrics(m, path)
    return files.read_metrics(spark, path).drop("model_order")


@register("scan_metrics")
def q_scan_metrics(spark, sf):
    """Metrics of three models, one file each, read back together."""
    path = sinks.scratch_path(spark, "metrics")
    sinks.write_metrics(evaluate.rounded(_cut_off_metrics(spark, sf)).repartition("model"), path)
    return files.read_metrics(spark, path).drop("model_order", "cv_f1_mean", "cv_f1_std")

"""Composed plans: the feature workflow and the rule-scored prediction table."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens import constants as K
from cohortlens.functions import risk_bucket
from cohortlens.operators.clean import handle_missing_and_outliers
from cohortlens.operators.engineer import engineer_features
from cohortlens.operators.features import feature_table
from cohortlens.operators import models
from cohortlens.operators.label import churn_label, rule_churn_score
from cohortlens.session import materialize, scratch_run
from cohortlens.sources.activity import ActivityData


def labelled_table(data: ActivityData, threshold_days: int, with_name: bool = False) -> DataFrame:
    return churn_label(feature_table(data, with_name=with_name), threshold_days)


def engineered_table(data: ActivityData, threshold_days: int, with_name: bool = False,
                     materialize_labels: bool = False) -> DataFrame:
    """Labelled table plus the nine derived features.

    Fitting the channel maxima is an action over the labelled table; with
    ``materialize_labels`` that table is written once to the shared folder
    first, so the activity logs are aggregated once instead of twice (for
    the maxima, then for the result).
    """
    labelled = labelled_table(data, threshold_days, with_name)
    if materialize_labels:
        labelled = materialize(labelled, "labelled")
    return engineer_features(labelled)


def process_features(data: ActivityData, threshold_days: int, with_name: bool = False,
                     materialize_input: bool = True) -> DataFrame:
    """Label, engineer, impute and clip: the training table of the reference.

    The labelled table (the only part that aggregates the activity logs) is
    written once to the shared checkpoint folder; the channel maxima, null
    counts, medians and clip quantiles are then fitted on those files, so
    the logs are aggregated exactly once.
    """
    labelled = labelled_table(data, threshold_days, with_name)
    if materialize_input:
        labelled = materialize(labelled, "labelled")
    return handle_missing_and_outliers(engineer_features(labelled), exclude=("member_id",))


def training_split(data: ActivityData, threshold_days: int, test_fraction: float = 0.2,
                   seed: int = 42) -> tuple[DataFrame, dict[str, float]]:
    """Processed members with the stratified hold-out split, written once (fold
    counting, weighting, scaling, fitting and every evaluation pass read the
    same files), and the channel maxima they were made with."""
    from cohortlens.operators.engineer import fit_channel_maxima
    from cohortlens.operators.split import stratified_split
    labelled = materialize(labelled_table(data, threshold_days, with_name=True), "labelled")
    maxima = fit_channel_maxima(labelled)
    processed = handle_missing_and_outliers(engineer_features(labelled, maxima), exclude=("member_id",))
    return materialize(stratified_split(processed, test_fraction, seed=seed), "split"), maxima


def serving_features(data: ActivityData, maxima: dict[str, float] | None = None,
                     with_name: bool = True) -> DataFrame:
    """Model input at scoring time, as the reference's serving path builds it:
    no label, the helper ``total_activity_count``, derived features, every
    numeric gap filled with 0, no clipping. ``maxima=None`` divides by the
    scored batch's own maxima (the reference's behaviour); pass the maxima
    saved at training time for scores consistent with training."""
    from cohortlens.operators.clean import impute_zero
    from cohortlens.operators.label import total_activity_expr
    table = feature_table(data, with_name=with_name)
    if maxima is None:  # fitted on this batch: aggregate the logs once
        table = materialize(table, "serving-base")
    table = table.withColumn("total_activity_count", total_activity_expr(table))
    return impute_zero(engineer_features(table, maxima))


def save_model(spark, model, maxima: dict[str, float], model_dir: str) -> None:
    """The fitted pipeline and the training statistics that serving needs beside it."""
    from cohortlens import sinks
    sinks.save_pipeline(model, f"{model_dir.rstrip('/')}/pipeline")
    sinks.write_statistics(spark, maxima, f"{model_dir.rstrip('/')}/statistics")


@dataclasses.dataclass
class TrainedRun:
    """What a training run wrote under ``folder``: ``split``, ``held_out`` and ``out_of_fold``
    tables, and a model folder per model (``model_dir``)."""

    folder: str
    result: "models.TrainingResult"

    def model_dir(self, name: str) -> str:
        return f"{self.folder}/model-{K.MODEL_ORDER.index(name)}"

    def table(self, name: str) -> DataFrame:
        return self.result.metrics.sparkSession.read.parquet(f"{self.folder}/{name}")


def train(spark, data: ActivityData, threshold_days: int, folder: str, params=None, with_cv: bool = True) -> TrainedRun:
    """Split, fit and compare the three models; every table and every model is written to ``folder``."""
    from cohortlens.operators import split
    split_df, maxima = training_split(data, threshold_days)
    k = split.fold_count(split_df.where(~F.col("is_test")))
    result = models.train_and_compare(spark, split_df, list(K.FEATURE_COLUMNS), k, params or models.ModelParams(), with_cv)
    run = TrainedRun(folder.rstrip("/"), result)
    for name, table in (("split", split_df), ("held_out", result.held_out), ("out_of_fold", result.out_of_fold)):
        if table is not None:
            table.write.mode("overwrite").parquet(f"{run.folder}/{name}")
    for name, model in result.models.items():
        save_model(spark, model, maxima, run.model_dir(name))
    return run


def score_fresh(data: ActivityData, model_dir: str, maxima: str = "saved") -> DataFrame:
    """Score members from fresh logs with a saved model, riskiest first.

    Feature table -> derived features -> gaps filled with 0 -> saved model
    order -> saved pipeline -> ranked prediction rows; nothing is clipped.
    ``maxima="saved"`` divides by the channel maxima of the training run,
    ``maxima="batch"`` by those of the scored batch.
    """
    from cohortlens import sinks
    from cohortlens.operators import scoring
    from cohortlens.operators.select import align_features
    from cohortlens.sources import files
    if maxima not in ("saved", "batch"):
        raise ValueError(f"maxima must be saved or batch, got {maxima!r}")
    spark = data.members.sparkSession
    base = model_dir.rstrip("/")
    saved = files.read_statistics(spark, f"{base}/statistics") if maxima == "saved" else None
    model = sinks.load_pipeline(f"{base}/pipeline")
    order = model.stages[0].getInputCols()
    features = serving_features(data, saved)
    aligned = align_features(features, order, keep=("member_id", "member_name", "created_at"))
    return scoring.rank_by_risk(scoring.score_members(model, aligned))


def rule_predictions(data: ActivityData, threshold_days: int, with_engagement: bool = False) -> DataFrame:
    """Prediction records scored by the deterministic rule score.

    One lazy plan over the labelled table, so filters on a member reach the
    scans. Only ``with_engagement`` adds ``engagement_score``, for which the
    labelled table is written once and its channel maxima are fitted.

    Stands in for a fitted model wherever results must be reproducible
    exactly (serving queries, evaluation checks): probability = rule score,
    prediction = score >= 0.40, risk band from the unrounded score.
    """
    table = engineered_table(data, threshold_days, with_name=True, materialize_labels=True) \
        if with_engagement else labelled_table(data, threshold_days, with_name=True)
    t = rule_churn_score(table)
    p = F.col("rule_churn_score")
    return t.select(
        "member_id", "member_name", "created_at",
        F.round(p, 4).alias("churn_probability"),
        F.col("rule_churned").alias("churn_prediction"),
        risk_bucket(p).alias("risk_label"),
        K.LABEL_COLUMN,
        *[c for c in K.KEY_FEATURES if c in t.columns],
    )


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column; used where results are compared across engines."""
    return df.withColumns({f.name: F.round(F.col(f.name), digits) for f in df.schema.fields
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def run_training(spark, data: ActivityData, timeline_data: ActivityData, out_dir: str,
                 threshold_days: int, params=None, with_cv: bool = True) -> dict[str, str]:
    """The whole batch chain in one call: features, training and comparison,
    then every artifact the serving side reads, written under ``out_dir``.

    Writes: processed features (Parquet and CSV), the best pipeline with its
    channel maxima, metrics
    (one row per model, ``is_best``), the ordered feature list, feature
    importances, ranked predictions with names and key indicators, the same
    published for lookups (by id) and for top lists and searches, the member -> name table, and nested 31-day timelines. Returns the paths.
    """
    with scratch_run(spark):
        return _run_training(spark, data, timeline_data, out_dir, threshold_days, params, with_cv)


def _run_training(spark, data, timeline_data, out_dir, threshold_days, params, with_cv) -> dict[str, str]:
    from cohortlens import sinks
    from cohortlens.operators import evaluate, scoring, serving, split, timeline

    params = params or models.ModelParams()
    split_df, maxima = training_split(data, threshold_days)
    k = split.fold_count(split_df.where(~F.col("is_test")))
    result = models.train_and_compare(spark, split_df, list(K.FEATURE_COLUMNS), k, params, with_cv)
    best = result.models[result.best]
    out = {name: f"{out_dir.rstrip('/')}/{name}" for name in (
        "features", "features_csv", "model", "metrics", "feature_columns", "feature_importance",
        "predictions", "by_id", "search", "names", "timelines")}
    features = split_df.drop("rank_in_label", "n_label", "is_test")
    sinks.write_table(features, out["features"])
    sinks.write_csv(features.drop("created_at"), out["features_csv"])
    save_model(spark, best, maxima, out["model"])
    sinks.write_metrics(evaluate.rounded(result.metrics), out["metrics"])
    sinks.write_feature_columns(spark, result.feature_cols, out["feature_columns"])
    sinks.write_table(models.feature_importance(best, result.feature_cols, result.n_train),
                      out["feature_importance"])
    scored = materialize(score_fresh(data, out["model"]), "scored")
    sinks.write_json_records(scoring.prediction_record(scored), out["predictions"])
    serving.publish_by_id(scored, out["by_id"])
    serving.publish_search(scored, out["search"])  # its table "ranked" also serves top lists
    sinks.write_json_records(data.members.select("member_id", "member_name"), out["names"])
    sinks.write_json_records(timeline.member_timeline(timeline_data), out["timelines"])
    return out

"""Parameterised queries behind the service and the dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlake.functions.calendar import iso_text
from reviewlake.functions.decision import is_negative, label_name
from reviewlake.functions.text import preview, shorten
from reviewlake.operators.explain import global_terms, local_contributions
from reviewlake.operators.features import with_countable
from reviewlake.operators.metrics import LATENCY_WINDOW, endpoint_latency
from reviewlake.operators.registry import champion
from reviewlake.operators.scoring import LinearModel, negative_probability, with_decision
from reviewlake.schemas import DEFAULT_THRESHOLD, SOURCE_NATURAL, require_columns

# Fixed request bounds.
MAX_TEXTS = 100
MAX_TEXT_CHARS = 5000
MAX_TERMS = 50
MAX_DAYS = 90


def bounded(name: str, value: int, low: int, high: int) -> int:
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}")
    return value


def _last_days(summary: DataFrame, days: int) -> DataFrame:
    latest = F.max("date").over(Window.partitionBy("app_id"))
    return summary.withColumn("latest", latest).filter(
        F.col("date") >= F.date_sub("latest", days - 1)
    )


INSIGHT_COLUMNS = (
    "app_id", "language", "date", "n_reviews", "share_negative_pred", "share_negative_true",
    "model_version",
)


def insights(summary: DataFrame, app_id: int, days: int = 7) -> DataFrame:
    """The last days of one app, counted from its own latest day; no row for an unknown app."""
    bounded("days", days, 1, MAX_DAYS)
    mine = summary.filter(F.col("app_id") == app_id)
    return _last_days(mine, days).withColumn("date", iso_text(F.col("date"))).select(*INSIGHT_COLUMNS)


def insights_all(summary: DataFrame, days: int = 7) -> DataFrame:
    """The same for every app at once. The summary has one row per app, language and day."""
    bounded("days", days, 1, MAX_DAYS)
    return _last_days(summary, days).withColumn("date", iso_text(F.col("date"))).select(*INSIGHT_COLUMNS)


def valid_request(text: Column) -> Column:
    """Texts outside the service bounds are refused, not shortened."""
    return F.coalesce(F.length(text).between(1, MAX_TEXT_CHARS), F.lit(False))


def predict_batch(texts: DataFrame, model: LinearModel) -> DataFrame:
    """``(review_id, preview, proba_negative, label, model_version, decision_threshold)``."""
    require_columns(texts, "review_id", "review_text")
    docs = with_countable(texts.withColumn("preview", preview(F.col("review_text"))), model.vectorizer)
    decided = with_decision(negative_probability(docs, model, "review_id", "preview"), model)
    return decided.select(
        "review_id",
        "preview",
        "proba_negative",
        label_name(F.col("pred_label")).alias("label"),
        "model_version",
        "decision_threshold",
    )


def predict_texts(spark, texts: list[str], model: LinearModel) -> DataFrame:
    """One service request: bounds checked before anything runs."""
    bounded("number of texts", len(texts), 1, MAX_TEXTS)
    for text in texts:
        bounded("text length", len(text), 1, MAX_TEXT_CHARS)
    rows = [(str(i), t) for i, t in enumerate(texts)]
    return predict_batch(spark.createDataFrame(rows, "review_id string, review_text string"), model)


def explanation(texts: DataFrame, model: LinearModel, n: int = 10) -> DataFrame:
    """Local terms of each text plus the global terms of each class: ``(scope, review_id, rank, term, weight)``."""
    bounded("n", n, 1, MAX_TERMS)
    local = local_contributions(texts, model, n).select(
        F.lit("local").alias("scope"), "review_id", "rank", "term", F.col("contribution").alias("weight")
    )
    ranking = Window.partitionBy("direction").orderBy(F.col("weight").desc(), "term")
    overall = global_terms(model, 10).select(
        F.concat(F.lit("global_"), "direction").alias("scope"),
        F.lit(None).cast("string").alias("review_id"),
        F.row_number().over(ranking).alias("rank"),
        "term",
        "weight",
    )
    return local.unionByName(overall)


def service_metrics(log: DataFrame, keep: int = LATENCY_WINDOW) -> DataFrame:
    return endpoint_latency(log, keep)


def service_state(versions: DataFrame, models: DataFrame, alias_log: DataFrame) -> DataFrame:
    """Version and threshold in service: champion alias, its version, the model that version names.

    ``versions`` hold (version, run_id), ``models`` (run_id, threshold); a model without a threshold
    decides at the default. Without a champion there is no row.
    """
    return (
        champion(alias_log)
        .join(versions.select("version", "run_id"), "version")
        .join(models.select("run_id", "threshold"), "run_id")
        .select("version", F.coalesce("threshold", F.lit(DEFAULT_THRESHOLD)).alias("threshold"))
    )


def dashboard_view(scored: DataFrame, app_id: int, language: str) -> DataFrame:
    """The rows behind the dashboard: natural flow, one app, one language."""
    return scored.filter(
        (F.col("sample_source") == SOURCE_NATURAL)
        & (F.col("app_id") == app_id)
        & (F.col("language") == language)
    )


def filter_values(scored: DataFrame, column: str) -> DataFrame:
    """The choices of a dashboard filter."""
    return (
        scored.filter(F.col("sample_source") == SOURCE_NATURAL).select(column).distinct().orderBy(column)
    )


def kpi_line(view: DataFrame) -> DataFrame:
    """One row of figures, zeros for an empty view; version and threshold of the oldest review."""
    first = F.min_by(
        F.struct("model_version", "decision_threshold"), F.struct("created_at", "review_id")
    )
    row = view.agg(
        F.count("*").alias("n_reviews"),
        F.avg(is_negative(F.col("pred_label")).cast("int")).alias("pred"),
        F.avg(is_negative(F.col("label")).cast("int")).alias("true"),
        first.alias("first"),
    )
    return row.select(
        "n_reviews",
        F.coalesce("pred", F.lit(0.0)).alias("share_pred_negative"),
        F.coalesce("true", F.lit(0.0)).alias("share_actual_negative"),
        F.coalesce("first.model_version", F.lit("N/A")).alias("model_version"),
        F.coalesce("first.decision_threshold", F.lit(DEFAULT_THRESHOLD)).alias("decision_threshold"),
    )


def daily_series(summary: DataFrame, app_id: int, language: str) -> DataFrame:
    """The curve of both shares in date order."""
    return (
        summary.filter((F.col("app_id") == app_id) & (F.col("language") == language))
        .select("date", "share_negative_pred", "share_negative_true")
        .orderBy("date")
    )


def top_negative(view: DataFrame, clean: DataFrame, n: int = 20) -> DataFrame:
    """The most probably negative reviews with their display columns.

    The ranking only reads scores; the texts of the ``n`` winners are then picked out of the clean
    zone by a scan that moves no text.
    """
    winners = view.orderBy(F.col("proba_negative").desc(), "review_id").limit(n)
    shown = winners.select("review_id", "proba_negative", "label", "pred_label", "created_at")
    found = clean.select("review_id", "review_text").join(F.broadcast(shown), "review_id")
    return found.select(
        "review_id",
        shorten(F.col("review_text")).alias("text"),
        "proba_negative",
        "label",
        "pred_label",
        iso_text(F.col("created_at")).alias("date"),
    ).orderBy(F.col("proba_negative").desc(), "review_id")

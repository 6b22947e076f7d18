"""Batch scoring with a linear model kept as tables, and the daily summary."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reviewlake.functions.decision import (
    effective_threshold,
    is_negative,
    logistic,
    predicted_label,
)
from reviewlake.operators.features import (
    CHAR_TERMS,
    WORDS,
    Vectorizer,
    document_terms,
    small_side,
    sublinear,
    weighted_words,
    with_countable,
    with_terms,
)
from reviewlake.schemas import (
    PREDICTIONS_SCHEMA,
    SOURCE_NATURAL,
    SUMMARY_SCHEMA,
    conform,
    require_columns,
)

CARRIED = ("review_id", "app_id", "language", "sample_source", "created_at", "label")


@dataclass(frozen=True)
class LinearModel:
    """``terms(term, idf, coef_neg)`` and ``header(version, intercept_neg, threshold)``, one row.

    Coefficients point toward the negative class, whatever order the fit used.
    """

    terms: DataFrame
    header: DataFrame
    vectorizer: Vectorizer = CHAR_TERMS

    def value(self, name: str) -> Column:
        return self.header.select(name).scalar()


def with_default_source(df: DataFrame) -> DataFrame:
    """Frames from before the second flow have no source column: they are natural."""
    if "sample_source" in df.columns:
        return df
    return df.withColumn("sample_source", F.lit(SOURCE_NATURAL))


def negative_probability(docs: DataFrame, model: LinearModel, *keep: str) -> DataFrame:
    """``(*keep, proba_negative)`` of documents that carry ``terms`` or the words of ``with_words``.

    Words are weighed where the document lies, with the broadcast model. Terms are counted in the row and joined to it;
    the two sums of a document are combined in its own task, so what is shuffled is one short row per document, never
    its text. ``keep`` starts with the document id; a document without a known term gets the intercept alone.
    """
    weighted = weighted_words(model.terms) if WORDS in docs.columns and "terms" not in docs.columns else None
    if weighted:
        parts = docs.select(*keep, _word_sums(F.col(WORDS), weighted).alias("sums")).select(*keep, "sums.*")
    else:
        coefficients = small_side(
            model.terms.select("term", "idf", "coef_neg"), model.vectorizer.max_features
        )
        raw = sublinear(F.col("tf")) * F.col("idf")
        parts = (
            document_terms(with_terms(docs, model.vectorizer), *keep)
            .join(coefficients, "term", "left")
            .withColumn("raw", raw)
            .select(
                *keep,
                (F.col("raw") * F.col("coef_neg")).alias("dot"),
                (F.col("raw") * F.col("raw")).alias("square"),
            )
        )
    sums = parts.groupBy(*keep).agg(F.sum("dot").alias("dot"), F.sum("square").alias("square"))
    margin = F.coalesce(F.col("dot") / F.nullif(F.sqrt("square"), F.lit(0.0)), F.lit(0.0))
    return sums.select(
        *keep, logistic(margin + model.value("intercept_neg")).alias("proba_negative")
    )


def _word_sums(words: Column, weighted) -> Column:
    """``struct<dot, square>`` of each text, from the function of ``weighted_words``."""

    def add_up(texts: pa.Array) -> pa.Array:
        sums = [np.empty((2, 0))]
        for rows, _, row, _, raw, push in weighted(texts):
            sums.append(np.stack([np.bincount(row, push, rows), np.bincount(row, raw * raw, rows)]))
        dot, square = np.concatenate(sums, axis=1)
        return pa.StructArray.from_arrays([pa.array(dot), pa.array(square)], ["dot", "square"])

    add_up.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(add_up, "dot double, square double")(words)


def with_decision(scored: DataFrame, model: LinearModel) -> DataFrame:
    """Add the decision and what it was taken with."""
    threshold = effective_threshold(model.value("threshold"))
    return scored.withColumn("decision_threshold", threshold).withColumns(
        {
            "pred_label": predicted_label(F.col("proba_negative"), F.col("decision_threshold")),
            "model_version": model.value("version").cast("string"),
            "scored_at": F.current_timestamp(),
        }
    )


def predictions(clean: DataFrame, model: LinearModel) -> DataFrame:
    """The predictions table: identity of the review, probability, decision, provenance. Stored words stand for the text."""
    counted = WORDS in clean.columns and model.vectorizer.single_words
    require_columns(clean, "review_id", "label", "created_at", *(() if counted else ("review_text",)))
    docs = with_countable(with_default_source(clean), model.vectorizer)
    scored = with_decision(negative_probability(docs, model, *CARRIED), model)
    return conform(scored, PREDICTIONS_SCHEMA)


def scored_reviews(clean: DataFrame, predicted: DataFrame) -> DataFrame:
    """Clean reviews plus the five scoring columns."""
    added = ("proba_negative", "pred_label", "decision_threshold", "model_version", "scored_at")
    return clean.join(predicted.select("review_id", *added), "review_id")


def daily_summary(scored: DataFrame) -> DataFrame:
    """Natural reviews per app, language and UTC day.

    ``model_version`` is the version of the first review of the day. Versions are part of the first
    grouping, so the wide pass only keeps numbers and stays a hash aggregation.
    """
    require_columns(scored, "app_id", "language", "created_at", "label", "pred_label", "model_version")
    natural = with_default_source(scored).filter(F.col("sample_source") == SOURCE_NATURAL)
    per_version = natural.groupBy(
        "app_id", "language", F.to_date("created_at").alias("date"), "model_version"
    ).agg(
        F.count("*").alias("n"),
        F.count_if(is_negative(F.col("pred_label"))).alias("pred"),
        F.count_if(is_negative(F.col("label"))).alias("true"),
        F.min("created_at").alias("first_at"),
    )
    daily = per_version.groupBy("app_id", "language", "date").agg(
        F.sum("n").alias("n_reviews"),
        (F.sum("pred") / F.sum("n")).alias("share_negative_pred"),
        (F.sum("true") / F.sum("n")).alias("share_negative_true"),
        F.min_by("model_version", F.struct("first_at", "model_version")).alias("model_version"),
    )
    return conform(daily, SUMMARY_SCHEMA)

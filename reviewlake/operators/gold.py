"""Star schema, daily mart and their blocking tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewlake.functions.calendar import iso_week, iso_weekday, utc_day
from reviewlake.functions.decision import is_negative, version_number
from reviewlake.schemas import (
    DIM_DATE_SCHEMA,
    DIM_GAME_SCHEMA,
    FACT_SCHEMA,
    LANGUAGES,
    MART_SCHEMA,
    SOURCE_NATURAL,
    SOURCES,
    STG_PREDICTIONS_SCHEMA,
    STG_REVIEWS_SCHEMA,
    conform,
    enforce,
)


def stg_reviews(silver: DataFrame) -> DataFrame:
    """Reviews without text and author, with their UTC day."""
    shaped = silver.withColumn("review_date", utc_day(F.col("created_at"))).select(
        *STG_REVIEWS_SCHEMA.fieldNames()
    )
    return enforce(shaped, STG_REVIEWS_SCHEMA, "stg_reviews")


def stg_predictions(predictions: DataFrame) -> DataFrame:
    """Only what belongs to the score."""
    shaped = predictions.select(*STG_PREDICTIONS_SCHEMA.fieldNames())
    return enforce(shaped, STG_PREDICTIONS_SCHEMA, "stg_predictions")


def dim_game(games: DataFrame) -> DataFrame:
    return conform(games, DIM_GAME_SCHEMA)


def dim_date(reviews: DataFrame) -> DataFrame:
    """The days on which a review was written. Distinct days first, attributes afterwards."""
    day = F.col("date_day")
    days = reviews.select(F.col("review_date").alias("date_day")).distinct()
    return conform(
        days.select(
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            iso_week(day).alias("iso_week"),
            iso_weekday(day).alias("day_of_week"),
        ),
        DIM_DATE_SCHEMA,
    )


def fct_review_predictions(reviews: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row per scored review."""
    return conform(reviews.join(predictions, "review_id"), FACT_SCHEMA)


def mart_sentiment_daily(fact: DataFrame, games: DataFrame) -> DataFrame:
    """Natural reviews per game, language and day.

    The fact is aggregated before it meets the game names, so the join sees one row per group.
    """
    counts = (
        fact.filter(F.col("sample_source") == SOURCE_NATURAL)
        .groupBy("app_id", "language", "review_date")
        .agg(
            F.count("*").alias("n_reviews"),
            F.count_if(is_negative(F.col("pred_label"))).alias("n_pred_negative"),
            F.count_if(is_negative(F.col("label"))).alias("n_actual_negative"),
            F.max(version_number(F.col("model_version"))).cast("string").alias("model_version"),
        )
    )
    mart = counts.join(games, "app_id").withColumns(
        {
            "share_pred_negative": F.col("n_pred_negative") / F.col("n_reviews"),
            "share_actual_negative": F.col("n_actual_negative") / F.col("n_reviews"),
        }
    )
    return conform(mart, MART_SCHEMA)


def unscored_reviews(reviews: DataFrame, predictions: DataFrame) -> DataFrame:
    """Reviews without a prediction; must be empty."""
    return reviews.select("review_id").join(predictions.select("review_id"), "review_id", "left_anti")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Key values without a parent and how many rows carry them.

    Keys are counted first, so a frequent key reaches the join as one row.
    """
    used = (
        child.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("value"))
        .agg(F.count("*").alias("n_rows"))
    )
    known = parent.select(F.col(parent_key).alias("value"))
    return used.join(known, "value", "left_anti").select(
        F.lit(name).alias("relation"), F.col("value").cast("string").alias("value"), "n_rows"
    )


def fk_orphans(
    fact: DataFrame, games: DataFrame, dates: DataFrame, predictions: DataFrame, reviews: DataFrame
) -> DataFrame:
    """The three references of the star; must be empty."""
    return (
        orphans(fact, "app_id", games, "app_id", "fact.app_id")
        .unionByName(orphans(fact, "review_date", dates, "date_day", "fact.review_date"))
        .unionByName(orphans(predictions, "review_id", reviews, "review_id", "predictions.review_id"))
    )


def mart_grain_duplicates(mart: DataFrame) -> DataFrame:
    """Groups that appear more than once; must be empty."""
    return (
        mart.groupBy("app_id", "language", "review_date")
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
        .select("app_id", "language", "review_date")
    )


def range_anomalies(mart: DataFrame, fact: DataFrame) -> DataFrame:
    """Shares and probabilities outside [0, 1]; must be empty. Each table is read once."""

    def outside(df: DataFrame, *columns: str) -> DataFrame:
        values = df.select(F.explode(F.array(*columns)).alias("value"))
        return values.filter((F.col("value") < 0) | (F.col("value") > 1)).select(
            F.col("value").cast("string").alias("anomaly")
        )

    return outside(mart, "share_pred_negative", "share_actual_negative").unionByName(
        outside(fact, "proba_negative", "decision_threshold")
    )


def star_checks(languages=LANGUAGES) -> dict[str, list]:
    """Generic tests of each model of the star."""
    from reviewlake.operators.quality import in_set, not_null, unique

    return {
        "stg_reviews": [
            unique("review_id"),
            *[not_null(c) for c in ("review_id", "app_id", "label", "review_date", "sample_source")],
            in_set("language", languages),
            in_set("label", (0, 1)),
            in_set("sample_source", SOURCES),
        ],
        "stg_predictions": [
            unique("review_id"),
            *[
                not_null(c)
                for c in (
                    "review_id",
                    "pred_label",
                    "proba_negative",
                    "decision_threshold",
                    "model_version",
                )
            ],
            in_set("pred_label", (0, 1)),
        ],
        "dim_game": [unique("app_id"), not_null("app_id"), not_null("game_name")],
        "dim_date": [unique("date_day"), not_null("date_day")],
        "fct_review_predictions": [
            unique("review_id"),
            *[not_null(c) for c in ("review_id", "app_id", "review_date")],
            in_set("pred_label", (0, 1)),
        ],
        "mart_sentiment_daily": [not_null("n_reviews")],
    }

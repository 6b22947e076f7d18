"""Schemas and fixed values of the review domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

# They decide results, so they are listed together and in plain form.
LANGUAGES = ("english", "french")
SOURCE_NATURAL = "natural"
SOURCE_BOOST = "negative_boost"
SOURCES = (SOURCE_NATURAL, SOURCE_BOOST)
LABEL_NEGATIVE = 0
LABEL_POSITIVE = 1
DEFAULT_THRESHOLD = 0.5
THRESHOLD_GRID = tuple(round(0.30 + 0.025 * step, 3) for step in range(21))
RETENTION_DAYS = 30
MIN_F1_MACRO = 0.75
SEED = 42
PERSONAL_COLUMNS = ("steamid", "personaname", "profile_url", "avatar")
NEGATIVE_SHARE_BOUNDS = (0.005, 0.95)
CHAMPION = "champion"

RAW_SCHEMA = T.StructType(
    [
        T.StructField("recommendationid", T.StringType()),
        T.StructField(
            "author",
            T.StructType(
                [
                    T.StructField("steamid", T.StringType()),
                    T.StructField("personaname", T.StringType()),
                    T.StructField("profile_url", T.StringType()),
                    T.StructField("avatar", T.StringType()),
                    T.StructField("playtime_at_review", T.LongType()),
                ]
            ),
        ),
        T.StructField("language", T.StringType()),
        T.StructField("review", T.StringType()),
        T.StructField("timestamp_created", T.LongType()),
        # Read as text: a malformed value must fall back to the creation time, not spoil the line.
        T.StructField("timestamp_updated", T.StringType()),
        T.StructField("voted_up", T.BooleanType()),
        T.StructField("votes_up", T.LongType()),
        T.StructField("weighted_vote_score", T.StringType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)


CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("app_id", T.LongType()),
        T.StructField("language", T.StringType()),
        T.StructField("review_text", T.StringType()),
        T.StructField("label", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("votes_up", T.LongType()),
        T.StructField("weighted_vote_score", T.DoubleType()),
        T.StructField("playtime_at_review_min", T.LongType()),
        T.StructField("author_pseudo", T.StringType()),
        T.StructField("text_len", T.LongType()),
        T.StructField("sample_source", T.StringType()),
    ]
)

PREDICTIONS_SCHEMA = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("app_id", T.LongType()),
        T.StructField("language", T.StringType()),
        T.StructField("sample_source", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("label", T.LongType()),
        T.StructField("proba_negative", T.DoubleType()),
        T.StructField("pred_label", T.LongType()),
        T.StructField("decision_threshold", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("scored_at", T.TimestampType()),
    ]
)

STG_REVIEWS_SCHEMA = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("app_id", T.LongType()),
        T.StructField("language", T.StringType()),
        T.StructField("label", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("review_date", T.DateType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("votes_up", T.LongType()),
        T.StructField("weighted_vote_score", T.DoubleType()),
        T.StructField("playtime_at_review_min", T.LongType()),
        T.StructField("text_len", T.LongType()),
        T.StructField("sample_source", T.StringType()),
    ]
)

STG_PREDICTIONS_SCHEMA = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("pred_label", T.LongType()),
        T.StructField("proba_negative", T.DoubleType()),
        T.StructField("decision_threshold", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("scored_at", T.TimestampType()),
    ]
)

DIM_GAME_SCHEMA = T.StructType(
    [T.StructField("app_id", T.LongType()), T.StructField("game_name", T.StringType())]
)

DIM_DATE_SCHEMA = T.StructType(
    [
        T.StructField("date_day", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("iso_week", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
    ]
)

FACT_SCHEMA = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("app_id", T.LongType()),
        T.StructField("language", T.StringType()),
        T.StructField("sample_source", T.StringType()),
        T.StructField("review_date", T.DateType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("label", T.LongType()),
        T.StructField("pred_label", T.LongType()),
        T.StructField("proba_negative", T.DoubleType()),
        T.StructField("decision_threshold", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("scored_at", T.TimestampType()),
        T.StructField("votes_up", T.LongType()),
        T.StructField("playtime_at_review_min", T.LongType()),
        T.StructField("text_len", T.LongType()),
    ]
)

MART_SCHEMA = T.StructType(
    [
        T.StructField("app_id", T.LongType()),
        T.StructField("game_name", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("review_date", T.DateType()),
        T.StructField("n_reviews", T.LongType()),
        T.StructField("n_pred_negative", T.LongType()),
        T.StructField("n_actual_negative", T.LongType()),
        T.StructField("share_pred_negative", T.DoubleType()),
        T.StructField("share_actual_negative", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
    ]
)

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("app_id", T.LongType()),
        T.StructField("language", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("n_reviews", T.LongType()),
        T.StructField("share_negative_pred", T.DoubleType()),
        T.StructField("share_negative_true", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
    ]
)


class ContractError(ValueError):
    """The columns of a frame are not the ones its contract promises."""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the contract: its columns, its order, its types."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def contract_differences(df: DataFrame, schema: T.StructType) -> list[str]:
    """What differs from the contract; types are only compared once the order is right."""
    expected = [f.name for f in schema]
    if df.columns != expected:
        return [f"columns {df.columns} are not {expected}"]
    return [
        f"{want.name} is {got.dataType.simpleString()}, not {want.dataType.simpleString()}"
        for got, want in zip(df.schema, schema)
        if got.dataType != want.dataType
    ]


def enforce(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Return the frame unchanged, or refuse it when it breaks its contract."""
    problems = contract_differences(df, schema)
    if problems:
        raise ContractError(f"{name}: " + "; ".join(problems))
    return df


def require_columns(df: DataFrame, *names: str) -> None:
    """Fail at plan time when a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {missing}")


def refuse_personal_columns(df: DataFrame) -> DataFrame:
    """Personal columns must never leave the cleaning step."""
    leaked = sorted(set(df.columns) & set(PERSONAL_COLUMNS))
    if leaked:
        raise ContractError(f"personal columns present: {leaked}")
    return df

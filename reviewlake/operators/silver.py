"""Raw reviews to clean reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from reviewlake.functions.decision import source_priority
from reviewlake.functions.pseudonym import pseudonym
from reviewlake.functions.text import clean_text
from reviewlake.schemas import CLEAN_SCHEMA, SOURCE_NATURAL, conform, refuse_personal_columns


def latest_per_review(raw: DataFrame) -> DataFrame:
    """One row per review: the natural flow first, then the latest update, missing updates last.

    Ranking with ``row_number() = 1`` lets Spark keep one row per key in every map task before
    the shuffle, so a review repeated many times does not fill one reducer. The file and the text
    settle ties.
    """
    order = Window.partitionBy("recommendationid").orderBy(
        source_priority(F.col("sample_source")),
        F.col("updated_seconds").desc_nulls_last(),
        F.col("source_file"),
        F.col("review"),
    )
    return (
        raw.withColumn(
            "updated_seconds",
            F.expr("try_cast(try_cast(timestamp_updated AS double) AS bigint)"),
        )
        .withColumn("copy_rank", F.row_number().over(order))
        .filter(F.col("copy_rank") == 1)
        .drop("copy_rank")
    )


def clean_reviews(raw: DataFrame, salt: str | bytes) -> DataFrame:
    """The clean zone: dedup first, then drop reviews whose winning text is empty."""
    if "sample_source" not in raw.columns:
        raw = raw.withColumn("sample_source", F.lit(SOURCE_NATURAL))
    if "source_file" not in raw.columns:
        raw = raw.withColumn("source_file", F.lit(""))
    winners = latest_per_review(raw)
    # a generator, as a filter on the text would clean it a second time
    kept = F.filter(F.array(clean_text(F.col("review"))), lambda text: text != "")
    cleaned = winners.withColumn("review_text", F.explode(kept))
    shaped = cleaned.select(
        F.col("recommendationid").alias("review_id"),
        "app_id",
        "language",
        "review_text",
        F.col("voted_up").cast("long").alias("label"),
        F.timestamp_seconds("timestamp_created").alias("created_at"),
        F.timestamp_seconds(F.coalesce("updated_seconds", "timestamp_created")).alias("updated_at"),
        F.coalesce("votes_up", F.lit(0)).alias("votes_up"),
        F.expr("try_cast(weighted_vote_score AS double)").alias("weighted_vote_score"),
        F.coalesce("author.playtime_at_review", F.lit(0)).alias("playtime_at_review_min"),
        pseudonym(F.col("author.steamid"), salt).alias("author_pseudo"),
        F.length("review_text").alias("text_len"),
        "sample_source",
    )
    return refuse_personal_columns(conform(shaped, CLEAN_SCHEMA))

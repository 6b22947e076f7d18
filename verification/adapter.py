"""The driver's tables seen as raw reviews, a model made of counts, and the star built on both."""

from __future__ import annotations

import csv
from functools import cached_property
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlake.operators import gold
from reviewlake.operators.features import WORDS, Vectorizer, smoothed_idf, term_statistics, with_terms, with_words, word_statistics
from reviewlake.operators.scoring import LinearModel, daily_summary, predictions
from reviewlake.operators.silver import clean_reviews
from reviewlake.schemas import DIM_GAME_SCHEMA, LABEL_NEGATIVE, LABEL_POSITIVE, SOURCE_BOOST, SOURCE_NATURAL
from reviewlake.session import in_utc, pin

SALT = "verification-salt"
CHAMPION_VERSION, EARLIER_VERSION = "10", "9"
LANGUAGES = ("english", "french", "german", "spanish")
GAMES_SEED = str(Path(__file__).resolve().parent.parent / "seeds" / "games.csv")
SINGLE_WORDS = Vectorizer(analyzer="word", ngram_range=(1, 1), min_df=2, max_features=100_000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    in_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def games(spark: SparkSession) -> DataFrame:
    with open(GAMES_SEED, encoding="utf-8", newline="") as seed:
        rows = [(int(row["app_id"]), row["game_name"]) for row in csv.DictReader(seed)]
    return gold.dim_game(spark.createDataFrame(rows, DIM_GAME_SCHEMA))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is a review dated and authored by the event of the same number.

    Labels give the vote. Reviewed-as-toxic texts form the boost flow; the other negative ones also
    appear there as a later copy, and well-rated ones have an earlier version, so that
    deduplication has work in both directions. Some texts carry tags, odd blanks, or nothing.
    """
    # keyed by the review id, so that one exchange of the texts serves the joins and the deduplication
    rid = F.col("doc_id").cast("string").alias("rid")
    docs = table(spark, sf_dir, "documents").select(rid, "text", "lang", "source")
    events = table(spark, sf_dir, "events").withColumn("rid", F.col("event_id").cast("string"))
    labels = table(spark, sf_dir, "labels").select(rid, "quality", "toxic")
    joined = docs.join(events, "rid").join(labels, "rid", "left")
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    number = F.regexp_extract("source", r"src(\d+)", 1).cast("long")
    k = F.get_json_object("props", "$.k").cast("long")
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    negative = toxic | F.coalesce(F.col("quality") == 0, F.lit(False))
    text = (
        F.when(F.col("value") < 0.5, "[i] [/i]")
        .when(F.col("event_type") == "click", F.concat(F.lit("[b]"), "text", F.lit("[/b]")))
        .when(
            F.col("event_type") == "signup",
            F.concat(F.lit("\u3000"), "text", F.lit("\u00a0\u2028!")),
        )
        .otherwise(F.col("text"))
    )
    language = (
        F.when(F.col("lang") == "en", "english")
        .when(F.col("lang") == "fr", "french")
        .when(F.col("lang") == "de", "german")
        .otherwise("spanish")
    )
    app = (
        F.when(number == 19, 4000000)
        .when(number % 3 == 0, 1086940)
        .when(number % 3 == 1, 1903340)
        .otherwise(2622380)
    )
    no_update = (F.col("event_type") == "purchase") & (F.col("value") > 100)
    # Copies: a = as received, b = later copy in the boost flow, c = earlier version.
    praised = F.coalesce(F.col("quality") == 1, F.lit(False)) & ~toxic
    copies = F.array_compact(
        F.array(F.lit("a"), F.when(negative & ~toxic, "b"), F.when(praised, "c"))
    )
    updated = seconds + 60 * k
    copy = F.col("copy")
    return joined.withColumn("copy", F.explode(copies)).select(
        F.col("rid").alias("recommendationid"),
        F.struct(
            F.when(
                ~((F.col("event_type") == "view") & (F.col("value") > 150)),
                F.col("user_id").cast("string"),
            ).alias("steamid"),
            F.when(F.col("event_type") != "error", k).alias("playtime_at_review"),
        ).alias("author"),
        language.alias("language"),
        F.when(copy == "c", F.concat(F.lit("old version "), text)).otherwise(text).alias("review"),
        seconds.alias("timestamp_created"),
        F.when(copy == "b", updated + 7200)
        .when(copy == "c", updated - 7200)
        .when(~no_update, updated)
        .cast("string")
        .alias("timestamp_updated"),
        (~negative).alias("voted_up"),
        F.floor("value").cast("long").alias("votes_up"),
        (F.col("value") / 500).cast("string").alias("weighted_vote_score"),
        app.cast("long").alias("app_id"),
        F.when(toxic | (copy == "b"), SOURCE_BOOST).otherwise(SOURCE_NATURAL).alias("sample_source"),
        copy.alias("source_file"),
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_reviews(raw_reviews(spark, sf_dir), SALT)


def count_model(clean: DataFrame, vectorizer: Vectorizer = SINGLE_WORDS) -> LinearModel:
    """Word weights from document counts per class: a linear model that SQL can rebuild exactly."""
    sizes = clean.groupBy().agg(
        F.count("*").alias("n"),
        F.count_if(F.col("label") == LABEL_NEGATIVE).alias("n_neg"),
        F.count_if(F.col("label") == LABEL_POSITIVE).alias("n_pos"),
    )
    negative = F.col("label") == LABEL_NEGATIVE
    if WORDS in clean.columns and vectorizer.single_words:
        marked = clean.withColumn("negative", negative)
        counted = word_statistics(marked, vectorizer, "negative").withColumnRenamed("df_marked", "df_neg")
    else:
        docs = with_terms(clean, vectorizer).select("label", "terms")
        counted = term_statistics(docs, vectorizer, df_neg=F.count_if(negative))
    n, n_neg, n_pos = (sizes.select(c).scalar() for c in ("n", "n_neg", "n_pos"))
    share_negative = (F.col("df_neg") + n_neg / n) / (n_neg + 1)
    share_positive = (F.col("df") - F.col("df_neg") + n_pos / n) / (n_pos + 1)
    terms = counted.select(
        "term",
        smoothed_idf(n, F.col("df")).alias("idf"),
        (F.log(share_negative) - F.log(share_positive)).alias("coef_neg"),
    )
    header = sizes.select(
        F.lit(CHAMPION_VERSION).alias("version"),
        F.lit(0.0).alias("intercept_neg"),
        F.lit(0.6).alias("threshold"),
    )
    return LinearModel(terms, header, vectorizer)


def _version_of(identifier: str) -> F.Column:
    """Odd reviews still carry the scores of the version before the champion."""
    return F.when(F.col(identifier).cast("long") % 2 == 1, EARLIER_VERSION).otherwise(CHAMPION_VERSION)


class Star:
    """Everything downstream of silver. Silver is a stored table; scores too, where read repeatedly.

    ``counted`` is silver with its words, found once for the model and all that reads it. The texts themselves, half of
    what is stored, are kept only for who reads them (``texts``).
    """

    def __init__(self, spark: SparkSession, sf_dir: str, store_scores: bool = False, texts: bool = False):
        counted = with_words(silver(spark, sf_dir))
        self.counted = pin(counted if texts else counted.drop("review_text"))
        self.silver = self.counted.drop(WORDS)
        self.model = count_model(self.counted)
        self.games = games(spark)
        self.reviews = gold.stg_reviews(self.silver)
        self.dates = gold.dim_date(self.reviews)
        self._store_scores = store_scores

    @cached_property
    def predictions(self) -> DataFrame:
        scored = predictions(self.counted, self.model).withColumn("model_version", _version_of("review_id"))
        return pin(scored) if self._store_scores else scored

    @cached_property
    def scores(self) -> DataFrame:
        return gold.stg_predictions(self.predictions)

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fct_review_predictions(self.reviews, self.scores)

    @cached_property
    def mart(self) -> DataFrame:
        return gold.mart_sentiment_daily(self.fact, self.games)

    @cached_property
    def summary(self) -> DataFrame:
        return daily_summary(self.predictions)

"""One entry per operator, each over whole tables."""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlake.functions.decision import label_name
from reviewlake.functions.pseudonym import pseudonym
from reviewlake.functions.text import analyzed_counts, clean_text
from reviewlake.operators import drift, explain, gold, metrics, quality, registry, serving, training
from reviewlake.operators.features import CHAR_TERMS, WORDS, term_statistics, with_terms, with_words, word_tfidf
from reviewlake.operators.scoring import scored_reviews
from reviewlake.operators.selection import stratified_folds, stratified_split
from reviewlake.operators.silver import latest_per_review
from reviewlake.plans import acceptance
from reviewlake.schemas import SOURCE_NATURAL
from reviewlake.session import pin, shared_folder
from reviewlake.sources.raw import scan_raw
from reviewlake.sources.raw_zone import KEYS, RawZone, new_reviews, purge_raw, retention_split
from reviewlake.sources.snapshots import SnapshotTable
from reviewlake.streaming.latency import current_latency, run_endpoint_latency
from verification.adapter import (
    LANGUAGES,
    SALT,
    SINGLE_WORDS,
    Star,
    count_model,
    games,
    raw_reviews,
    silver,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def portable(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the driver's own tables hold them."""
    zoned = [f.name for f in df.schema if f.dataType.simpleString() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


# Silver.


@query
def silver_clean(spark, sf_dir):
    return rounded(portable(silver(spark, sf_dir)), "weighted_vote_score")


@query
def silver_dedup(spark, sf_dir):
    return latest_per_review(raw_reviews(spark, sf_dir)).select(
        F.col("recommendationid").alias("review_id"),
        "sample_source",
        "source_file",
        F.col("updated_seconds").alias("updated"),
    )


@query
def pseudonymise(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", pseudonym(F.col("user_id").cast("string"), SALT).alias("pseudo"))


@query
def text_normalise(spark, sf_dir):
    raw = raw_reviews(spark, sf_dir)
    return raw.select(
        F.col("recommendationid").alias("review_id"),
        "source_file",
        F.md5(clean_text(F.col("review")).cast("binary")).alias("text_md5"),
        F.length(clean_text(F.col("review"))).cast("long").alias("text_len"),
    )


# Raw zone.


@query
def incremental_new_rows(spark, sf_dir):
    raw = raw_reviews(spark, sf_dir)
    seen = raw.filter(F.col("votes_up") >= 50).select(*KEYS)
    return new_reviews(raw, seen).select(*KEYS)


@query
def retention_partitions(spark, sf_dir):
    days = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("source"), F.to_date("ts").alias("dt"))
        .agg(F.count("*").alias("n_rows"))
    )
    today = days.agg(F.max("dt").alias("d")).scalar()
    return retention_split(days, today, 20)


@query
def flow_uniqueness(spark, sf_dir):
    return acceptance.flow_uniqueness(raw_reviews(spark, sf_dir))


# Quality.


@query
def quality_suite_silver(spark, sf_dir):
    return _silver_suites(Star(spark, sf_dir, store_scores=True, texts=True))


def _silver_suites(star: Star) -> DataFrame:
    parts = [
        quality.run_suite(star.silver, "clean_zone", quality.clean_zone_suite(LANGUAGES)),
        quality.run_suite(star.silver, "silver_reviews", quality.silver_reviews_suite()),
        quality.run_suite(star.predictions, "silver_predictions", quality.silver_predictions_suite()),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def quality_suite_gold(spark, sf_dir):
    return _gold_suites(Star(spark, sf_dir, store_scores=True))


def _gold_suites(star: Star) -> DataFrame:
    facts = quality.run_suite(star.fact, "gold_facts", quality.gold_facts_suite(LANGUAGES))
    return facts.unionByName(quality.run_suite(star.mart, "gold_mart", quality.gold_mart_suite()))


@query
def quality_verdict(spark, sf_dir):
    star = Star(spark, sf_dir, store_scores=True, texts=True)
    results = _silver_suites(star).unionByName(_gold_suites(star))
    return quality.suite_verdict(results)


@query
def quality_gate(spark, sf_dir):
    return quality.gate_results(pin(silver(spark, sf_dir)), LANGUAGES)


@query
def negative_share_gate(spark, sf_dir):
    return rounded(quality.negative_share(silver(spark, sf_dir)), "negative_share")


@query
def status_histogram(spark, sf_dir):
    results = quality_suite_gold(spark, sf_dir)
    return metrics.status_histogram(
        results.withColumn("status", F.when(F.col("success"), "pass").otherwise("fail"))
    )


# Gold.


@query
def stg_reviews(spark, sf_dir):
    return rounded(portable(gold.stg_reviews(silver(spark, sf_dir))), "weighted_vote_score")


@query
def dim_date(spark, sf_dir):
    return gold.dim_date(gold.stg_reviews(silver(spark, sf_dir)))


@query
def dim_game(spark, sf_dir):
    """Games with the number of reviews each one has."""
    counts = silver(spark, sf_dir).groupBy("app_id").agg(F.count("*").alias("n_reviews"))
    return games(spark).join(counts, "app_id", "left").withColumn(
        "n_reviews", F.coalesce("n_reviews", F.lit(0))
    )


@query
def fct_review_predictions(spark, sf_dir):
    fact = portable(Star(spark, sf_dir).fact).drop("scored_at")
    return rounded(fact, "proba_negative", "decision_threshold")


@query
def mart_sentiment_daily(spark, sf_dir):
    return rounded(Star(spark, sf_dir).mart, "share_pred_negative", "share_actual_negative")


@query
def unscored_reviews(spark, sf_dir):
    """Reviews that lack a prediction when only those with votes were scored."""
    star = Star(spark, sf_dir, store_scores=True)
    voted = star.predictions.join(
        star.silver.filter("votes_up > 0").select("review_id"), "review_id", "left_semi"
    )
    return gold.unscored_reviews(star.reviews, voted)


@query
def fk_orphans(spark, sf_dir):
    s = Star(spark, sf_dir, store_scores=True)
    return gold.fk_orphans(s.fact, s.games, s.dates, s.scores, s.reviews)


@query
def mart_grain_duplicates(spark, sf_dir):
    """The grain test on a mart loaded twice for one of its games."""
    mart = Star(spark, sf_dir, store_scores=True).mart
    return gold.mart_grain_duplicates(
        mart.unionByName(mart.filter(F.col("game_name").like("Baldur%")))
    )


@query
def range_anomalies(spark, sf_dir):
    """Shares scaled up so that some leave the allowed range; the fact is left as it is."""
    star = Star(spark, sf_dir, store_scores=True)
    scaled = star.mart.withColumns(
        {
            "share_pred_negative": F.col("share_pred_negative") * 10,
            "share_actual_negative": F.col("share_actual_negative") * -1,
        }
    )
    return gold.range_anomalies(scaled, star.fact).select(
        F.round(F.col("anomaly").cast("double"), 6).alias("anomaly")
    )


# Scores and served queries.


@query
def predict_batch(spark, sf_dir):
    star = Star(spark, sf_dir, texts=True)
    return rounded(serving.predict_batch(star.counted, star.model), "proba_negative")


@query
def valid_requests(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", serving.valid_request(F.col("text")).alias("valid"))


@query
def daily_summary(spark, sf_dir):
    return rounded(Star(spark, sf_dir).summary, "share_negative_pred", "share_negative_true")


@query
def insights_last_days(spark, sf_dir):
    return rounded(
        serving.insights_all(Star(spark, sf_dir).summary, 2), "share_negative_pred", "share_negative_true"
    )


@query
def insights_one_app(spark, sf_dir):
    return rounded(
        serving.insights(Star(spark, sf_dir).summary, 1086940, 2),
        "share_negative_pred",
        "share_negative_true",
    )


@query
def dashboard_kpis(spark, sf_dir):
    view = serving.dashboard_view(Star(spark, sf_dir).predictions, 1086940, "english")
    return rounded(
        serving.kpi_line(view), "share_pred_negative", "share_actual_negative", "decision_threshold"
    )


@query
def daily_share_series(spark, sf_dir):
    return rounded(
        serving.daily_series(Star(spark, sf_dir).summary, 1086940, "english"),
        "share_negative_pred",
        "share_negative_true",
    )


@query
def dashboard_filter_values(spark, sf_dir):
    clean = silver(spark, sf_dir)
    apps = serving.filter_values(clean, "app_id").select(
        F.lit("app_id").alias("filter"), F.col("app_id").cast("string").alias("value")
    )
    languages = serving.filter_values(clean, "language").select(
        F.lit("language").alias("filter"), F.col("language").alias("value")
    )
    return apps.unionByName(languages)


@query
def top_negative_reviews(spark, sf_dir):
    star = Star(spark, sf_dir, texts=True)
    ranked = star.predictions.withColumn("proba_negative", F.round("proba_negative", 9))
    view = serving.dashboard_view(ranked, 1086940, "english")
    return serving.top_negative(view, star.silver).drop("label", "pred_label")


@query
def scored_counts(spark, sf_dir):
    """Clean reviews joined back to their scores, counted per decision."""
    star = Star(spark, sf_dir, texts=True)
    scored = scored_reviews(star.silver, star.predictions)
    return scored.groupBy("label", "pred_label").agg(
        F.count("*").alias("n_reviews"), F.sum(F.length("review_text").cast("long")).alias("n_chars")
    )


@query
def service_state(spark, sf_dir):
    star = Star(spark, sf_dir, store_scores=True)
    runs = daily_runs(star)
    day = F.datediff("day", F.lit("2020-01-01").cast("date")).cast("long")
    versions = runs.groupBy(day.alias("version")).agg(F.min("run_id").alias("run_id"))
    models = runs.select("run_id", F.when(F.col("f1_macro") >= 0.5, F.col("f1_macro")).alias("threshold"))
    return rounded(serving.service_state(versions, models, alias_moves(star)), "threshold")


@query
def label_names(spark, sf_dir):
    named = silver(spark, sf_dir).select(label_name(F.col("label")).alias("label_name"))
    return named.groupBy("label_name").agg(F.count("*").alias("n_reviews"))


# Drift.


@query
def chrono_halves(spark, sf_dir):
    return drift.natural_halves(pin(silver(spark, sf_dir))).select("review_id", "half")


@query
def psi_numeric(spark, sf_dir):
    return rounded(drift.numeric_psi(drift.natural_halves(pin(silver(spark, sf_dir))), "text_len"), "psi")


@query
def psi_categorical(spark, sf_dir):
    halves = drift.natural_halves(pin(silver(spark, sf_dir)))
    return rounded(drift.categorical_psi(halves, drift.CATEGORICAL), "psi")


@query
def input_drift(spark, sf_dir):
    return rounded(drift.input_drift(drift.natural_halves(pin(silver(spark, sf_dir)))), "psi")


@query
def prediction_drift(spark, sf_dir):
    return rounded(drift.prediction_drift(Star(spark, sf_dir).summary, n_min=2), "ratio")


@query
def drift_verdict(spark, sf_dir):
    star = Star(spark, sf_dir)
    verdict = drift.drift_verdict(
        drift.input_drift(drift.natural_halves(star.silver)),
        drift.prediction_drift(star.summary, n_min=2),
    )
    return rounded(verdict, "psi_max", "share_out_of_bounds")


# Text features and model arithmetic.


@query
def term_stats(spark, sf_dir):
    docs = with_terms(silver(spark, sf_dir), SINGLE_WORDS)
    return term_statistics(docs, SINGLE_WORDS).select("term", "df", "cf")


@query
def frequent_terms(spark, sf_dir):
    """The cap at work: the 500 most frequent words of all."""
    capped = dataclasses.replace(SINGLE_WORDS, max_features=500)
    docs = with_terms(silver(spark, sf_dir), capped)
    return term_statistics(docs, capped).select("term", "df", "cf")


@query
def word_bigrams(spark, sf_dir):
    counts = analyzed_counts(F.col("review_text"), "word", (1, 2))
    counted = silver(spark, sf_dir).select("review_id", counts.alias("terms"))
    return counted.select(
        "review_id",
        F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + t["tf"]).alias("n_terms"),
        F.size("terms").cast("long").alias("n_distinct"),
    )


@query
def char_ngrams(spark, sf_dir):
    counted = with_terms(silver(spark, sf_dir).select("review_id", "review_text"), CHAR_TERMS)
    return counted.select(
        "review_id",
        F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + t["tf"]).alias("n_terms"),
        F.size("terms").cast("long").alias("n_distinct"),
    )


@query
def tfidf_words(spark, sf_dir):
    docs = pin(with_words(silver(spark, sf_dir)).select("review_id", "label", WORDS))
    weights = word_tfidf(docs, count_model(docs).terms, "review_id")
    return rounded(weights, "tfidf")


@query
def class_weights(spark, sf_dir):
    return rounded(metrics.class_weights(silver(spark, sf_dir)), "weight")


@query
def stratified_holdout(spark, sf_dir):
    natural = pin(silver(spark, sf_dir)).filter(F.col("sample_source") == SOURCE_NATURAL)
    return stratified_split(natural, "label", "review_id").select("review_id", "label", "split")


@query
def stratified_fold_numbers(spark, sf_dir):
    natural = pin(silver(spark, sf_dir)).filter(F.col("sample_source") == SOURCE_NATURAL)
    return stratified_folds(natural, "label", "review_id").select("review_id", "label", "fold")


@query
def threshold_curve(spark, sf_dir):
    return rounded(metrics.threshold_curve(Star(spark, sf_dir).predictions), "f1_macro")


@query
def threshold_search(spark, sf_dir):
    curve = metrics.threshold_curve(Star(spark, sf_dir).predictions)
    return rounded(metrics.best_threshold(curve), "f1_macro")


@query
def classification_metrics(spark, sf_dir):
    return rounded(
        metrics.classification_metrics(Star(spark, sf_dir).predictions),
        "f1_macro",
        "recall_negative",
        "precision_negative",
    )


@query
def metrics_per_group(spark, sf_dir):
    return rounded(
        metrics.classification_metrics(Star(spark, sf_dir).predictions, by=["app_id", "language"]),
        "f1_macro",
        "recall_negative",
        "precision_negative",
    )


@query
def roc_auc(spark, sf_dir):
    # Nine digits, so that equal texts tie on every engine.
    return rounded(metrics.roc_auc(rounded(Star(spark, sf_dir, store_scores=True).predictions, "proba_negative", digits=9)), "roc_auc")


@query
def dataset_fingerprint(spark, sf_dir):
    return portable(metrics.dataset_fingerprint(silver(spark, sf_dir), ["review_id", "label", "created_at", "review_text"]))


# Registry: each day of reviews stands for one training run.


def daily_runs(star: Star) -> DataFrame:
    scored = star.predictions.withColumn("day", F.to_date("created_at"))
    return metrics.classification_metrics(scored, by=["app_id", "day"]).select(
        F.concat(F.col("app_id").cast("string"), F.lit("-"), F.col("day").cast("string")).alias("run_id"),
        "app_id",
        "day",
        "f1_macro",
        (F.lit(1.0) - F.col("f1_macro")).alias("train_test_gap"),
    )


def alias_moves(star: Star) -> DataFrame:
    history = registry.promotion_history(daily_runs(star), "day", by="app_id", gate=0.7)
    version = F.datediff("day", F.lit("2020-01-01").cast("date")).cast("long")
    stamp = F.col("version") * 1000
    moves = history.withColumn("version", version)
    promoted = moves.filter("promoted").select(
        F.lit("champion").alias("alias"), "version", stamp.alias("ts_ms")
    )
    return promoted.unionByName(
        moves.select(F.lit("challenger").alias("alias"), "version", stamp.alias("ts_ms"))
    )


@query
def promotion_history(spark, sf_dir):
    history = registry.promotion_history(daily_runs(Star(spark, sf_dir, store_scores=True)), "day", by="app_id", gate=0.7)
    return rounded(history, "f1_macro", "train_test_gap", "champion_f1")


@query
def alias_current(spark, sf_dir):
    return registry.current_aliases(alias_moves(Star(spark, sf_dir, store_scores=True)))


@query
def versions_with_metrics(spark, sf_dir):
    star = Star(spark, sf_dir, store_scores=True)
    runs = daily_runs(star)
    days = runs.select(
        F.datediff("day", F.lit("2020-01-01").cast("date")).cast("long").alias("version"), "run_id"
    ).withColumn("created_ms", F.col("version") * 1000)
    later = days.withColumns({"version": F.col("version") + 1000, "run_id": F.lit("missing"), "created_ms": F.col("created_ms") + 5})
    return rounded(
        registry.versions_with_metrics(days.unionByName(later), runs, alias_moves(star)),
        "f1_macro",
        "train_test_gap",
    )


@query
def candidate_ranking(spark, sf_dir):
    """Candidates are the apps, folds are the days: mean, deviation, distance to an incumbent."""
    folds = daily_runs(Star(spark, sf_dir, store_scores=True)).select(
        F.col("app_id").cast("string").alias("candidate"), "f1_macro"
    )
    compared = metrics.against_incumbent(
        metrics.rank_candidates(metrics.fold_statistics(folds)), "1086940"
    )
    return rounded(compared, "f1_mean", "f1_std", "gap")


# Explanations.


@query
def local_contributions(spark, sf_dir):
    star = Star(spark, sf_dir)
    terms = explain.local_contributions(star.counted, star.model, 10)
    return rounded(terms, "contribution")


@query
def contribution_sums(spark, sf_dir):
    """All contributions of a review add up to its margin."""
    star = Star(spark, sf_dir)
    return rounded(explain.contribution_sums(star.counted, star.model), "margin")


@query
def global_terms(spark, sf_dir):
    return rounded(explain.global_terms(_stable(Star(spark, sf_dir).model), 20), "weight")


@query
def extreme_coefficients(spark, sf_dir):
    return rounded(explain.extreme_coefficients(_stable(Star(spark, sf_dir).model), 20), "coefficient")


@query
def explanation(spark, sf_dir):
    star = Star(spark, sf_dir)
    rows = serving.explanation(star.counted, _stable(star.model), 5)
    return rounded(rows, "weight")


def _stable(model):
    """Coefficients cut to nine digits, so that equal ones are equal on every engine."""
    return dataclasses.replace(
        model, terms=model.terms.withColumn("coef_neg", F.round("coef_neg", 9))
    )


# Logs and reconciliation.


def request_log(spark, sf_dir) -> DataFrame:
    return as_requests(table(spark, sf_dir, "events"))


def as_requests(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("request_id"),
        F.col("event_type").alias("path"),
        "ts",
        F.col("value").alias("duration_ms"),
    )


@query
def recent_samples(spark, sf_dir):
    return metrics.recent_samples(request_log(spark, sf_dir), keep=500).select("path", "request_id")


@query
def endpoint_latency(spark, sf_dir):
    return serving.service_metrics(request_log(spark, sf_dir))


@query
def endpoint_latency_stream(spark, sf_dir):
    """The request log as a stream of files, taken in by two runs of which the second finds nothing new."""
    schema = table(spark, sf_dir, "events").schema
    folder = f"{shared_folder(spark)}/latency-{uuid.uuid4().hex[:8]}"
    for _ in range(2):
        # a stream reads single files by pattern only
        landed = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parquet*")
        run_endpoint_latency(as_requests(landed), f"{folder}/figures", f"{folder}/offsets").awaitTermination()
    return current_latency(spark, f"{folder}/figures")


@query
def load_summary(spark, sf_dir):
    moment = F.unix_micros(F.col("ts").cast("timestamp"))
    seconds = (F.max(moment) - F.min(moment)) / 1e6
    row = metrics.load_summary(request_log(spark, sf_dir), F.col("path") != "error", seconds)
    return rounded(row, "error_rate", "throughput", "mean")


@query
def ratio_by_group(spark, sf_dir):
    return rounded(acceptance.ratio_by_group(Star(spark, sf_dir).predictions, min_negative=2), "ratio")


@query
def zone_reconciliation(spark, sf_dir):
    star = Star(spark, sf_dir, store_scores=True)
    return acceptance.zone_reconciliation(star.silver, star.predictions, star.summary, star.fact, star.mart)


@query
def version_mismatches(spark, sf_dir):
    star = Star(spark, sf_dir, store_scores=True)
    return acceptance.version_mismatches(star.predictions, star.model.value("version"))


# Not expressible in SQL: snapshots and fitted models.


def _lake(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/lake-{uuid.uuid4().hex[:8]}"


def _two_snapshots(spark, sf_dir) -> SnapshotTable:
    stored = SnapshotTable(spark, _lake(spark), "silver.reviews")
    clean = silver(spark, sf_dir)
    stored.overwrite(clean)
    stored.overwrite(clean.filter(F.col("sample_source") == SOURCE_NATURAL))
    return stored


@query
def snapshot_history(spark, sf_dir):
    stored = _two_snapshots(spark, sf_dir)
    stored.restore(1)
    return stored.history().drop("ts_ms")


@query
def time_travel(spark, sf_dir):
    stored = _two_snapshots(spark, sf_dir)
    both = portable(stored.read_at(1).unionByName(stored.read()))
    return rounded(both, "weighted_vote_score")


def _zone(spark: SparkSession) -> RawZone:
    return RawZone(spark, f"{shared_folder(spark)}/zone-{uuid.uuid4().hex[:8]}")


@query
def raw_roundtrip(spark, sf_dir):
    """Appended as JSON lines, then scanned: the latest copy of each review of each flow."""
    zone = _zone(spark)
    zone.append(raw_reviews(spark, sf_dir), "first", dt.date(2026, 9, 20))
    kept = ("recommendationid", "sample_source", "app_id", "language", "review", "voted_up", "votes_up", "timestamp_created")
    return scan_raw(spark, zone.root).good.select(*kept)


@query
def ingest_twice(spark, sf_dir):
    """What two batches with the same reviews store: all of them, then none; and the keys kept."""
    zone, raw = _zone(spark), raw_reviews(spark, sf_dir)
    counts = [zone.append(raw, name, dt.date(2026, 9, 20)) for name in ("first", "second")]
    return zone.seen().agg(F.count("*").alias("n_keys"), F.countDistinct(*KEYS).alias("n_distinct")).select(
        "n_keys", "n_distinct", *(F.lit(n).cast("long").alias(c) for n, c in zip(counts, ("n_first", "n_second")))
    )


ODD_FLOW, ODD_LANGUAGE = "other flow = 50%+", "zh-Hans"


@query
def ingest_names(spark, sf_dir):
    """Flows and languages with names that paths encode, stored in two batches: what is kept, and what the second adds."""
    zone = _zone(spark)
    raw = raw_reviews(spark, sf_dir).withColumns(
        {
            "sample_source": F.when(F.col("sample_source") == SOURCE_NATURAL, SOURCE_NATURAL).otherwise(ODD_FLOW),
            "language": F.when(F.col("language") == "spanish", ODD_LANGUAGE).otherwise(F.col("language")),
        }
    )
    zone.append(raw, "first", dt.date(2026, 9, 20))
    again = zone.append(raw, "second", dt.date(2026, 9, 21))
    kept = scan_raw(spark, zone.root).good.groupBy("sample_source", "language")
    return kept.agg(F.count("*").alias("n_rows"), F.lit(again).cast("long").alias("n_again"))


@query
def raw_quarantine(spark, sf_dir):
    """What a scan sets aside, by reason, of reviews that lack a field or lie outside the layout."""
    folder = f"{shared_folder(spark)}/quarantine-{uuid.uuid4().hex[:8]}"
    raw = raw_reviews(spark, sf_dir).drop("source_file", "sample_source")
    votes = F.col("votes_up")
    broken = raw.withColumns(
        {
            "recommendationid": F.when(votes % 7 != 0, F.col("recommendationid")),
            "timestamp_created": F.when(votes % 5 != 0, F.col("timestamp_created")),
            "voted_up": F.when(votes % 3 != 0, F.col("voted_up")),
        }
    )
    broken.filter(votes % 2 == 0).write.partitionBy("app_id", "language").json(f"{folder}/in")
    broken.filter(votes % 2 != 0).drop("language").write.partitionBy("app_id").json(f"{folder}/out")
    scan = scan_raw(spark, folder)
    return scan.quarantine.groupBy("reason").agg(F.count("*").alias("n_rows"))


@query
def purge_files(spark, sf_dir):
    """Day folders of the event log, purged beyond 20 days: files removed and days left."""
    folder = f"{shared_folder(spark)}/purge-{uuid.uuid4().hex[:8]}"
    days = table(spark, sf_dir, "events").select("event_id", F.lit(1).alias("app_id"), F.lit("english").alias("language"), F.to_date("ts").alias("dt"))
    days.repartition("dt").write.partitionBy("app_id", "language", "dt").json(folder)
    removed = purge_raw(spark, folder, days.agg(F.max("dt")).first()[0], 20)
    left = spark.read.json(folder)
    return left.agg(F.lit(removed).cast("long").alias("n_removed"), F.countDistinct("dt").alias("n_days"), F.count("*").alias("n_rows"))


@query
def logreg_train(spark, sf_dir):
    """Trained with the defaults: what the run was fed with, and whether it converged and beats chance."""
    _, row = training.train(pin(silver(spark, sf_dir)))
    told = row.select(
        "n_train", "n_test", "negative_share", "data_rows", "data_natural_rows", "data_boost_rows", "data_first_review",
        "data_last_review",
        (F.col("gradient") <= training.TOLERANCE).alias("converged"),
        ((F.col("roc_auc") > 0.6) & (F.col("f1_macro") > 0.5)).alias("beats_chance"),
    )
    return rounded(portable(told), "negative_share")


def ranked_folds(folds: DataFrame) -> DataFrame:
    """Each candidate with the folds it was measured on, and whether its mean F1 is above a floor."""
    measured = metrics.rank_candidates(metrics.fold_statistics(folds))
    return measured.select("candidate", F.col("n_folds").cast("long").alias("n_folds"), (F.col("f1_mean") > 0.45).alias("above_floor"))


@query
def hyperparameter_grid(spark, sf_dir):
    return ranked_folds(training.hyperparameter_grid(pin(silver(spark, sf_dir))))


@query
def model_bench(spark, sf_dir):
    return ranked_folds(training.model_bench(pin(silver(spark, sf_dir))))


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)

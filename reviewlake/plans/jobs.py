"""The daily and weekly jobs as plain functions; each reads and writes tables of one lake."""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from reviewlake.operators import drift, gold, quality, training
from reviewlake.operators.features import Vectorizer
from reviewlake.operators.registry import Registry, promotion
from reviewlake.operators.scoring import LinearModel, daily_summary, predictions, scored_reviews
from reviewlake.operators.silver import clean_reviews
from reviewlake.plans import acceptance
from reviewlake.schemas import (
    LANGUAGES,
    RETENTION_DAYS,
    enforce,
    refuse_personal_columns,
)
from reviewlake.session import parallelism, pin
from reviewlake.sources.games import read_games
from reviewlake.sources.raw import RawScan, scan_raw
from reviewlake.sources.raw_zone import RawZone, purge_raw
from reviewlake.sources.snapshots import SnapshotGroup, SnapshotTable


class NoChampion(RuntimeError):
    """No version has been promoted yet."""


class GoldTestError(ValueError):
    """A blocking test of the star schema failed."""


@dataclass(frozen=True)
class Lake:
    """Where the zones live."""

    spark: SparkSession
    root: str
    languages: Sequence[str] = LANGUAGES

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw(self) -> str:
        return self.path("raw")

    @property
    def registry(self) -> Registry:
        return Registry(self.spark, self.path("registry"))

    def table(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, self.path("lake"), name)

    @property
    def star(self) -> SnapshotGroup:
        return SnapshotGroup(self.spark, self.path("lake"), "gold.star")

    def clean(self) -> DataFrame:
        return self.table("silver.reviews").read()

    def scored(self) -> DataFrame:
        return self.table("scored.reviews").read()

    def summary(self) -> DataFrame:
        return self.table("scored.summary").read()


def ingest_job(lake: Lake, incoming: DataFrame | RawScan, batch: str, day: dt.date) -> int:
    """Append the reviews not seen before, and what a scan set aside; the number of new ones."""
    return RawZone(lake.spark, lake.raw).append(incoming, batch, day)


def silver_job(
    lake: Lake, salt: str, today: dt.date | None = None, keep_days: int = RETENTION_DAYS
) -> dict:
    """Scan, clean, deduplicate, pseudonymise, stage, gate, commit, purge.

    The text is written once: the staged snapshot is what the gate reads and what a commit shows.
    """
    scan = scan_raw(lake.spark, lake.raw)
    table = lake.table("silver.reviews")
    # cleaning leaves the rows hashed on the review, in as many parts as there are buckets
    clean = refuse_personal_columns(clean_reviews(scan.good, salt))
    staged = table.stage(clean, buckets=("review_id", parallelism(lake.spark)))
    quality.assert_quality(table.open(staged), lake.languages)
    written = table.commit(staged)
    lake.table("raw.quarantine").overwrite(scan.quarantine)
    purged = purge_raw(lake.spark, lake.raw, today or dt.date.today(), keep_days)
    return {**written, "purged_files": purged}


def gate_job(lake: Lake) -> DataFrame:
    """The declarative suite of the clean zone; raises when it fails."""
    results = pin(
        quality.run_suite(
            lake.clean(),
            "clean_zone",
            quality.clean_zone_suite(lake.languages),
        )
    )
    quality.assert_suites(results)
    return results


def save_model(model: LinearModel, path: str) -> None:
    model.terms.write.mode("errorifexists").parquet(f"{path}/terms")
    model.header.withColumn(
        "vectorizer", F.lit(json.dumps(dataclasses.asdict(model.vectorizer)))
    ).coalesce(1).write.mode("errorifexists").parquet(f"{path}/header")


def load_model(spark: SparkSession, path: str) -> LinearModel:
    header = spark.read.parquet(f"{path}/header")
    spec = json.loads(header.first()["vectorizer"])
    spec["ngram_range"] = tuple(spec["ngram_range"])
    return LinearModel(
        spark.read.parquet(f"{path}/terms"), header.drop("vectorizer"), Vectorizer(**spec)
    )


def champion_model(lake: Lake) -> LinearModel:
    version = lake.registry.champion_version()
    if version is None:
        raise NoChampion("no champion version")
    row = lake.registry.versions().filter(F.col("version") == version).first()
    return load_model(lake.spark, row["location"])


def score_job(lake: Lake) -> dict:
    """Score the clean zone with the champion; scored reviews, daily summary, predictions snapshot."""
    model = champion_model(lake)
    clean = lake.clean()
    buckets = ("review_id", parallelism(lake.spark))
    written = lake.table("silver.predictions").overwrite(predictions(clean, model), buckets=buckets)
    predicted = lake.table("silver.predictions").read()
    scored = refuse_personal_columns(scored_reviews(clean, predicted))
    lake.table("scored.reviews").overwrite(scored)
    lake.table("scored.summary").overwrite(daily_summary(predicted))
    return written


def drift_job(lake: Lake, commit: str = "unknown", n_min: int = 20) -> bool:
    """Measure, report, alert; whether it alerted."""
    halves = drift.natural_halves(lake.clean())
    inputs = pin(drift.input_drift(halves))
    ratios = pin(
        drift.prediction_drift(lake.summary(), n_min=n_min)
    )
    verdict = pin(drift.drift_verdict(inputs, ratios))
    drift.write_report(inputs, ratios, verdict, lake.path("scored", "drift_report"))
    drift.write_alert(verdict, lake.path("scored", "alerts"), commit)
    return bool(verdict.first()["alert"])


def gold_job(lake: Lake, games_csv: str) -> dict[str, int]:
    """Build the star and the mart, run every test, publish when all pass."""
    games = gold.dim_game(read_games(lake.spark, games_csv))
    reviews = gold.stg_reviews(lake.table("silver.reviews").read())
    scores = gold.stg_predictions(lake.table("silver.predictions").read())
    dates = pin(gold.dim_date(reviews))
    fact = pin(gold.fct_review_predictions(reviews, scores))
    mart = pin(enforce(gold.mart_sentiment_daily(fact, games), gold.MART_SCHEMA, "mart"))
    tables = {
        "stg_reviews": reviews,
        "stg_predictions": scores,
        "dim_game": games,
        "dim_date": dates,
        "fct_review_predictions": fact,
        "mart_sentiment_daily": mart,
    }
    gold_tests(tables, lake.languages)
    names = ("dim_game", "dim_date", "fct_review_predictions", "mart_sentiment_daily")
    rows = lake.star.overwrite({name: refuse_personal_columns(tables[name]) for name in names})
    for name in ("stg_reviews", "stg_predictions"):
        tables[name].createOrReplaceTempView(name)
    return {"fact": rows["fct_review_predictions"], "mart": rows["mart_sentiment_daily"]}


def gold_tests(tables: dict[str, DataFrame], languages: Sequence[str]) -> None:
    """Generic checks of every model, then the tests that must find nothing; all failures are listed."""
    problems = []
    checks = gold.star_checks(languages)
    results = None
    for name, suite in checks.items():
        part = quality.run_suite(tables[name], name, suite)
        results = part if results is None else results.unionByName(part)
    try:
        quality.assert_suites(results)
    except quality.QualityError as error:
        problems.append(str(error))
    reviews, scores = tables["stg_reviews"], tables["stg_predictions"]
    fact, mart = tables["fct_review_predictions"], tables["mart_sentiment_daily"]
    must_be_empty = {
        "reviews without prediction": gold.unscored_reviews(reviews, scores),
        "orphans": gold.fk_orphans(fact, tables["dim_game"], tables["dim_date"], scores, reviews),
        "repeated mart groups": gold.mart_grain_duplicates(mart),
        "values out of range": gold.range_anomalies(mart, fact),
    }
    problems += [name for name, rows in must_be_empty.items() if not rows.isEmpty()]
    if problems:
        raise GoldTestError("; ".join(problems))


def lake_gate_job(lake: Lake, zone: str = "all") -> DataFrame:
    """Suites of the silver tables, the gold tables, or both; raises when one fails."""
    if zone not in ("silver", "gold", "all"):
        raise ValueError(f"unknown zone {zone}")
    parts = []
    if zone in ("silver", "all"):
        parts.append(
            quality.run_suite(
                lake.table("silver.reviews").read(),
                "silver_reviews",
                quality.silver_reviews_suite(lake.languages),
            )
        )
        parts.append(
            quality.run_suite(
                lake.table("silver.predictions").read(),
                "silver_predictions",
                quality.silver_predictions_suite(),
            )
        )
    if zone in ("gold", "all"):
        parts.append(
            quality.run_suite(
                lake.star.read("fct_review_predictions"),
                "gold_facts",
                quality.gold_facts_suite(lake.languages),
            )
        )
        parts.append(
            quality.run_suite(
                lake.star.read("mart_sentiment_daily"),
                "gold_mart",
                quality.gold_mart_suite(lake.languages),
            )
        )
    results = parts[0]
    for part in parts[1:]:
        results = results.unionByName(part)
    results = pin(results)
    quality.assert_suites(results)
    return results


def train_job(lake: Lake, settings: training.FitSettings = training.FitSettings()) -> dict:
    """Train, record the run, register the version, promote it when it earns it."""
    registry = lake.registry
    clean = lake.clean()
    known = registry.versions().agg(F.max("version").alias("v")).first()["v"] or 0
    model, metrics = training.train(clean, settings, version=str(known + 1))
    row = metrics.first().asDict()
    run_id = uuid.uuid4().hex
    fields = [f.strip().split(" ")[0] for f in Registry.RUNS.split(",")]
    run = {k: row.get(k) for k in fields}
    registry.add_run({**run, "run_id": run_id, "created_ms": int(time.time() * 1000)})
    location = lake.path("registry", "models", f"version={known + 1}-{run_id[:8]}")
    save_model(model, location)
    before = registry.champion_f1()
    version = registry.add_version(run_id, location)
    earned = promotion(F.col("f1_macro"), F.lit(before).cast("double"))
    promoted = bool(metrics.select(earned).first()[0])
    if promoted:
        registry.move_champion(version)
    return {**row, "version": version, "promoted": promoted, "champion_f1_before": before}


def daily_chain(
    lake: Lake,
    incoming: DataFrame,
    batch: str,
    day: dt.date,
    salt: str,
    games_csv: str,
    settings: training.FitSettings = training.FitSettings(),
) -> dict:
    """Ingest, silver, gate, score, drift, retrain only when drift asks for it, gold, lake gate."""
    report: dict = {"new_reviews": ingest_job(lake, incoming, batch, day)}
    report["silver"] = silver_job(lake, salt, today=day)
    gate_job(lake)
    report["score"] = score_job(lake)
    drift_job(lake)
    if drift.retraining_needed(lake.spark, lake.path("scored", "drift_report")):
        report["train"] = train_job(lake, settings)
        report["score"] = score_job(lake)
    report["gold"] = gold_job(lake, games_csv)
    lake_gate_job(lake)
    return report


def weekly_chain(
    lake: Lake, games_csv: str, settings: training.FitSettings = training.FitSettings()
) -> dict:
    """Train, score, gold."""
    report = {"train": train_job(lake, settings)}
    report["score"] = score_job(lake)
    report["gold"] = gold_job(lake, games_csv)
    return report


def acceptance_job(lake: Lake, ratio_bounds: tuple[float, float] = (0.5, 2.0)) -> DataFrame:
    """Every acceptance check of a finished chain as ``(check, success)``."""
    clean = lake.clean()
    scored = lake.scored()
    summary = lake.summary()
    fact, mart = lake.star.read("fct_review_predictions"), lake.star.read("mart_sentiment_daily")
    silver = lake.table("silver.reviews")
    champion = str(lake.registry.champion_version())

    def verdict(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.coalesce(F.bool_and("success"), F.lit(True)).alias("success")).select(
            F.lit(name).alias("check"), "success"
        )

    parts = [
        verdict(acceptance.flow_uniqueness(scan_raw(lake.spark, lake.raw).good), "raw ids are distinct"),
        verdict(quality.gate_results(clean, lake.languages), "clean zone passes the gate"),
        verdict(acceptance.ratio_by_group(scored, *ratio_bounds), "predicted share is plausible"),
        verdict(
            acceptance.zone_reconciliation(clean, scored, summary, fact, mart), "zones hold the same rows"
        ),
        verdict(
            acceptance.version_mismatches(scored, champion).withColumn("success", F.col("mismatches") == 0),
            "scores come from the champion",
        ),
        verdict(acceptance.table_health(silver.read(), silver.history()), "silver table is healthy"),
        verdict(
            silver.read()
            .agg(F.count("*").alias("n"))
            .withColumn("success", F.col("n") == clean.agg(F.count("*").alias("n")).scalar()),
            "silver table equals the clean zone",
        ),
    ]
    leaked = acceptance.personal_columns_present(clean) + acceptance.personal_columns_present(scored)
    result = lake.spark.createDataFrame(
        [("no personal column", not leaked)], "check string, success boolean"
    )
    for part in parts:
        result = result.unionByName(part)
    return result

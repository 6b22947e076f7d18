import datetime as dt
import random
from pathlib import Path

import pytest

from reviewlake.operators import quality, training
from reviewlake.operators.features import Vectorizer
from reviewlake.plans import jobs
from reviewlake.sources.raw import scan_raw

GAMES = f"file://{Path(__file__).resolve().parent.parent / 'seeds' / 'games.csv'}"
DAY = dt.date(2026, 9, 20)
SETTINGS = training.FitSettings(
    vectorizer=Vectorizer("word", (1, 1), min_df=2, max_features=500), max_iter=30, folds=2
)
GOOD = "superb lovely smooth charming brilliant".split()
BAD = "broken awful boring crash refund".split()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    return jobs.Lake(spark, str(tmp_path_factory.mktemp("lake")))


def landed(spark, folder, review, write_lines):
    rng = random.Random(1)
    for app, language in ((1086940, "english"), (2622380, "french")):
        rows = []
        for i in range(60):
            up = i % 4 != 0
            text = " ".join(rng.choice(GOOD if up else BAD) for _ in range(8))
            rows.append(review(f"{app}-{i}", text, voted_up=up, created=1_789_000_000 + 3600 * i))
        write_lines(folder, f"app_id={app}/language={language}/dt=2026-09-20", rows)
    return scan_raw(spark, str(folder)).good


def test_whole_chain(spark, lake, tmp_path, review, write_lines):
    incoming = landed(spark, tmp_path, review, write_lines)
    assert jobs.ingest_job(lake, incoming, "b1", DAY) == 120
    assert jobs.ingest_job(lake, incoming, "b2", DAY) == 0
    written = jobs.silver_job(lake, "salt", today=DAY)
    assert (written["rows"], written["purged_files"]) == (120, 0)
    with pytest.raises(jobs.NoChampion):
        jobs.score_job(lake)
    report = jobs.weekly_chain(lake, GAMES, SETTINGS)
    assert report["train"]["promoted"] and report["train"]["version"] == 1
    assert report["score"]["rows"] == 120 and report["gold"]["fact"] == 120
    again = jobs.train_job(lake, SETTINGS)
    assert again["version"] == 2 and not again["promoted"]  # equal is not better
    assert lake.registry.champion_version() == 1
    results = jobs.lake_gate_job(lake).collect()
    assert len(results) == 29 and all(r["success"] for r in results)
    checks = {r["check"]: r["success"] for r in jobs.acceptance_job(lake).collect()}
    assert len(checks) == 8 and all(checks.values()), checks


def test_daily_chain_runs_in_order(spark, lake, tmp_path, review, write_lines):
    incoming = landed(spark, tmp_path, review, write_lines)
    report = jobs.daily_chain(lake, incoming, "b3", DAY, "salt", GAMES, SETTINGS)
    assert report["new_reviews"] == 0
    assert report["silver"]["snapshots"] == 2
    assert ("train" in report) == jobs.drift.retraining_needed(spark, lake.path("scored", "drift_report"))


def test_bad_rows_stop_the_silver_job(spark, tmp_path, review, write_lines):
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    write_lines(tmp_path / "lake" / "raw", "app_id=1/language=klingon/dt=2026-09-20", [review(1), review(2, voted_up=False)])
    with pytest.raises(quality.QualityError, match="language"):
        jobs.silver_job(lake, "salt", today=DAY)
    assert not (tmp_path / "lake" / "clean").exists()


def test_zone_choice(lake):
    with pytest.raises(ValueError):
        jobs.lake_gate_job(lake, "bronze")
    assert jobs.lake_gate_job(lake, "silver").count() == 15
    assert jobs.lake_gate_job(lake, "gold").count() == 14


def test_models_survive_storage(spark, lake):
    model = jobs.champion_model(lake)
    assert model.vectorizer.analyzer == "word" and model.vectorizer.ngram_range == (1, 1)
    assert model.header.first()["version"] == "1"

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reviewlake.operators import gold, quality
from reviewlake.plans.jobs import GoldTestError, gold_tests
from reviewlake.schemas import CLEAN_SCHEMA, PREDICTIONS_SCHEMA, ContractError, conform

GAMES = [
    (1086940, "Baldur's Gate 3"),
    (1903340, "Clair Obscur: Expedition 33"),
    (2622380, "ELDEN RING NIGHTREIGN"),
]


def utc(day, hour, minute=0):
    return dt.datetime(2026, 9, day, hour, minute, tzinfo=dt.timezone.utc)


def golden(spark):
    spec = [
        ("oak-1", 1903340, "english", 0, 0, 0.91, utc(5, 0, 5), "natural", "9"),
        ("oak-2", 1903340, "english", 1, 0, 0.77, utc(5, 13), "natural", "10"),
        ("oak-3", 1903340, "english", 1, 1, 0.12, utc(5, 20), "natural", "9"),
        ("elm-1", 1903340, "english", 0, 0, 0.95, utc(5, 21), "negative_boost", "10"),
        ("elm-2", 1086940, "french", 1, 1, 0.05, utc(7, 9), "natural", "9"),
    ]
    df = spark.createDataFrame(
        spec,
        "review_id string, app_id long, language string, label long, pred_label long, "
        "proba_negative double, created_at timestamp, sample_source string, model_version string",
    ).withColumns(
        {
            "review_text": F.lit("text"),
            "updated_at": F.col("created_at"),
            "votes_up": F.lit(1),
            "weighted_vote_score": F.lit(0.5),
            "playtime_at_review_min": F.lit(10),
            "author_pseudo": F.sha2("review_id", 256),
            "text_len": F.lit(4),
            "decision_threshold": F.lit(0.75),
            "scored_at": F.current_timestamp(),
        }
    )
    return conform(df, CLEAN_SCHEMA), conform(df, PREDICTIONS_SCHEMA)


def star(spark, silver, predictions):
    games = spark.createDataFrame(GAMES, "app_id long, game_name string")
    reviews, scores = gold.stg_reviews(silver), gold.stg_predictions(predictions)
    fact = gold.fct_review_predictions(reviews, scores)
    return {
        "stg_reviews": reviews,
        "stg_predictions": scores,
        "dim_game": games,
        "dim_date": gold.dim_date(reviews),
        "fct_review_predictions": fact,
        "mart_sentiment_daily": gold.mart_sentiment_daily(fact, games),
    }


def test_golden_mart(spark):
    tables = star(spark, *golden(spark))
    rows = tables["mart_sentiment_daily"].orderBy("app_id").collect()
    got = [
        (
            r["app_id"], r["review_date"], r["n_reviews"], r["n_pred_negative"], r["n_actual_negative"],
            r["share_pred_negative"], r["game_name"], r["model_version"],
        )
        for r in rows
    ]
    assert got == [
        (1086940, dt.date(2026, 9, 7), 1, 0, 0, 0.0, "Baldur's Gate 3", "9"),
        (1903340, dt.date(2026, 9, 5), 3, 2, 1, 2 / 3, "Clair Obscur: Expedition 33", "10"),
    ]
    assert tables["fct_review_predictions"].count() == 5
    for name in ("stg_reviews", "fct_review_predictions", "mart_sentiment_daily"):
        assert not {"review_text", "author_pseudo"} & set(tables[name].columns)
    gold_tests(tables, ("english", "french"))


def test_stale_scores_fail_the_build(spark):
    silver, predictions = golden(spark)
    with pytest.raises(GoldTestError, match="without prediction"):
        gold_tests(star(spark, silver, predictions.filter("review_id <> 'elm-1'")), ("english", "french"))


def test_unknown_app_fails_the_build_though_the_mart_drops_it(spark):
    silver, predictions = golden(spark)
    moved = silver.withColumn("app_id", F.when(F.col("review_id") == "elm-2", F.lit(5).cast("long")).otherwise(F.col("app_id")))
    tables = star(spark, moved, predictions)
    assert tables["mart_sentiment_daily"].count() == 1
    with pytest.raises(GoldTestError, match="orphans"):
        gold_tests(tables, ("english", "french"))


def test_schema_drift_breaks_loudly(spark):
    silver, predictions = golden(spark)
    with pytest.raises(Exception):
        gold.stg_reviews(silver.drop("text_len"))
    with pytest.raises(ContractError):
        gold.stg_predictions(predictions.withColumn("pred_label", F.col("pred_label").cast("int")))


def test_calendar(spark):
    days = [dt.date(2026, 9, 20), dt.date(2027, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "review_date date")
    got = {r["date_day"]: (r["iso_week"], r["day_of_week"]) for r in gold.dim_date(df).collect()}
    assert got == {days[0]: (38, 7), days[1]: (53, 5)}


def failures(df, suite):
    rows = quality.run_suite(df, "s", suite).filter(~F.col("success")).collect()
    return [(r["check"], r["column"], r["unexpected_count"]) for r in rows]


@pytest.mark.parametrize(
    "column, value, expected",
    [
        ("label", "7L", ("in_set", "label", 1)),
        ("language", "'klingon'", ("in_set", "language", 1)),
        ("sample_source", "'other'", ("in_set", "sample_source", 1)),
        ("text_len", "0L", ("between", "text_len", 1)),
        ("weighted_vote_score", "2.0D", ("between", "weighted_vote_score", 1)),
        ("votes_up", "-1L", ("between", "votes_up", 1)),
        ("playtime_at_review_min", "-1L", ("between", "playtime_at_review_min", 1)),
        ("author_pseudo", "'0123456789'", ("matches", "author_pseudo", 1)),
        ("review_text", "cast(null as string)", ("not_null", "review_text", 1)),
        ("review_id", "'oak-2'", ("unique", "review_id", 2)),
    ],
)
def test_each_bad_value_fails_its_own_check(spark, column, value, expected):
    silver, _ = golden(spark)
    broken = silver.withColumn(
        column, F.expr(f"CASE WHEN review_id = 'oak-1' THEN {value} ELSE {column} END")
    )
    assert failures(broken, quality.clean_zone_suite()) == [expected]


def test_good_rows_pass_and_all_checks_are_counted(spark):
    silver, predictions = golden(spark)
    results = quality.run_suite(silver, "clean_zone", quality.clean_zone_suite())
    row = quality.suite_verdict(results).first()
    assert (row["evaluated"], row["failed"], row["success"]) == (15, 0, True)
    sizes = {
        "silver_reviews": quality.silver_reviews_suite(),
        "silver_predictions": quality.silver_predictions_suite(),
        "gold_facts": quality.gold_facts_suite(),
        "gold_mart": quality.gold_mart_suite(),
    }
    assert [len(v) for v in sizes.values()] == [8, 7, 7, 7]
    assert failures(predictions, quality.silver_predictions_suite()) == []


def test_mart_and_prediction_suites_catch_impossible_shares(spark):
    silver, predictions = golden(spark)
    mart = star(spark, silver, predictions)["mart_sentiment_daily"]
    bad = mart.withColumn("share_pred_negative", F.lit(1.7))
    assert failures(bad, quality.gold_mart_suite()) == [("between", "share_pred_negative", 2)]
    assert failures(
        predictions.withColumn("proba_negative", F.lit(1.5)), quality.silver_predictions_suite()
    ) == [("between", "proba_negative", 5)]


def test_missing_column_fails_only_its_checks(spark):
    silver, _ = golden(spark)
    got = {(c, col) for c, col, _ in failures(silver.drop("text_len"), quality.clean_zone_suite())}
    assert got == {("columns_match", None), ("between", "text_len")}


def test_empty_table_fails_the_row_count(spark):
    silver, _ = golden(spark)
    assert failures(silver.limit(0), quality.clean_zone_suite()) == [("row_count", None, 1)]


def test_gate_lists_every_problem(spark):
    silver, _ = golden(spark)
    quality.assert_quality(silver)
    broken = silver.withColumns({"label": F.lit(None).cast("long"), "language": F.lit("x")})
    with pytest.raises(quality.QualityError) as error:
        quality.assert_quality(broken)
    assert "label" in str(error.value) and "language" in str(error.value)


def test_gate_needs_natural_reviews_with_a_plausible_share(spark):
    silver, _ = golden(spark)
    with pytest.raises(quality.QualityError, match="negative_share"):
        quality.assert_quality(silver.withColumn("sample_source", F.lit("negative_boost")))
    with pytest.raises(quality.QualityError, match="negative_share"):
        quality.assert_quality(
            silver.withColumn("label", F.when(F.col("sample_source") == "natural", 1).otherwise(0).cast("long"))
        )


def test_gate_refuses_other_types_and_personal_columns(spark):
    silver, _ = golden(spark)
    with pytest.raises(quality.QualityError, match="int"):
        quality.assert_quality(silver.withColumn("label", F.col("label").cast("int")))
    with pytest.raises(quality.QualityError, match="personal"):
        quality.assert_quality(silver.withColumn("avatar", F.lit("a")))


def test_repeated_groups_and_ranges_are_found(spark):
    silver, predictions = golden(spark)
    tables = star(spark, silver, predictions)
    mart, fact = tables["mart_sentiment_daily"], tables["fct_review_predictions"]
    assert gold.mart_grain_duplicates(mart).isEmpty()
    assert gold.mart_grain_duplicates(mart.unionByName(mart)).count() == 2
    assert gold.range_anomalies(mart, fact).isEmpty()
    assert gold.range_anomalies(mart, fact.withColumn("decision_threshold", F.lit(-0.5))).count() == 5

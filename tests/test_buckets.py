"""Bucketed snapshots: joined on their key without an exchange, readable from any session."""

from pyspark.sql import functions as F

from reviewlake.operators import gold
from reviewlake.schemas import CLEAN_SCHEMA, PREDICTIONS_SCHEMA
from reviewlake.sources.snapshots import SnapshotTable


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_versions_join_without_an_exchange(spark, tmp_path):
    reviews, scores = (SnapshotTable(spark, str(tmp_path), name) for name in ("silver.reviews", "silver.predictions"))
    rows = spark.range(1_000).select(F.format_string("r'%d", "id").alias("review_id"), F.col("id").alias("n"))
    written = reviews.overwrite(rows.repartition(4, "review_id"), buckets=("review_id", 4))
    assert written["rows"] == 1_000
    scored = reviews.read().select("review_id", (F.col("n") * 2).alias("score"))
    scores.overwrite(scored, buckets=("review_id", 4))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = reviews.read().join(scores.read(), "review_id")
        assert "Exchange" not in plan_of(fact)
        assert fact.filter("score = n * 2").count() == 1_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_versions_travel_and_are_found_by_another_session(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/it's", "t")
    table.overwrite(spark.range(5).withColumn("x", F.array(F.lit(1.5))), buckets=("id", 2))
    table.overwrite(spark.range(3).withColumn("x", F.array(F.lit(2))), buckets=("id", 2))
    for row in table.log().collect():
        spark.sql(f"DROP TABLE {table.open(row)._jdf.queryExecution().analyzed().collectLeaves().head().catalogTable().get().identifier().table()}")
    assert table.read().count() == 3 and table.read_at(1).count() == 5
    assert table.read().first()["x"] == [2.0]


def test_the_fact_is_built_without_an_exchange(spark, tmp_path):
    stored = []
    for name, schema in (("silver.reviews", CLEAN_SCHEMA), ("silver.predictions", PREDICTIONS_SCHEMA)):
        table = SnapshotTable(spark, str(tmp_path), name)
        table.overwrite(spark.createDataFrame([], schema), buckets=("review_id", 2))
        stored.append(table.read())
    reviews, scores = gold.stg_reviews(stored[0]), gold.stg_predictions(stored[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(gold.fct_review_predictions(reviews, scores))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan

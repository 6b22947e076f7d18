"""Acceptance checks over the whole chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reviewlake.functions.decision import is_negative
from reviewlake.schemas import PERSONAL_COLUMNS, SOURCE_NATURAL


def flow_uniqueness(raw: DataFrame) -> DataFrame:
    """Rows against distinct ids per flow. Ids are counted per flow first, so no flow is one group."""
    per_id = raw.groupBy("sample_source", "recommendationid").agg(F.count("*").alias("n"))
    return (
        per_id.groupBy("sample_source")
        .agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_ids"))
        .withColumn("success", F.col("n_rows") == F.col("n_ids"))
    )


def ratio_by_group(
    scored: DataFrame, low: float = 0.5, high: float = 2.0, min_negative: int = 20
) -> DataFrame:
    """Predicted over actual negatives per app and language, where enough real ones exist."""
    groups = (
        scored.filter(F.col("sample_source") == SOURCE_NATURAL)
        .groupBy("app_id", "language")
        .agg(
            F.count_if(is_negative(F.col("pred_label"))).alias("n_pred"),
            F.count_if(is_negative(F.col("label"))).alias("n_true"),
        )
    )
    ratio = F.col("n_pred") / F.col("n_true")
    return (
        groups.filter(F.col("n_true") >= max(min_negative, 1))
        .select("app_id", "language", ratio.alias("ratio"))
        .withColumn("success", F.col("ratio").between(low, high))
    )


def version_mismatches(scored: DataFrame, champion: Column | str) -> DataFrame:
    """Scored rows that do not carry the champion version."""
    wanted = champion if isinstance(champion, Column) else F.lit(champion)
    versions = scored.groupBy("model_version").agg(F.count("*").alias("n"))
    wrong = ~F.col("model_version").eqNullSafe(wanted)
    return versions.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(wrong, F.col("n"))), F.lit(0)).alias("mismatches"),
    )


def _sizes(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("sample_source") == SOURCE_NATURAL).alias("natural"),
    )


def zone_reconciliation(
    clean: DataFrame, scored: DataFrame, summary: DataFrame, fact: DataFrame, mart: DataFrame
) -> DataFrame:
    """Counts that must agree between zones: ``(check, left_count, right_count, success)``."""
    a, b, c = _sizes(clean), _sizes(scored), _sizes(fact)
    listed = summary.agg(F.coalesce(F.sum("n_reviews"), F.lit(0)).alias("n"))
    filled = mart.agg(F.least(F.count("*"), F.lit(1)).alias("n"))

    def line(check: str, left: Column, right: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), left.alias("left_count"), right.alias("right_count"))

    lines = F.array(
        line("clean_vs_scored", F.col("total"), b.select("total").scalar()),
        line("scored_vs_fact", b.select("total").scalar(), c.select("total").scalar()),
        line("scored_vs_fact_natural", b.select("natural").scalar(), c.select("natural").scalar()),
        line("summary_vs_natural", listed.scalar(), b.select("natural").scalar()),
        line("mart_not_empty", filled.scalar(), F.lit(1).cast("long")),
    )
    return a.select(F.inline(lines)).withColumn("success", F.col("left_count") == F.col("right_count"))


def table_health(rows: DataFrame, history: DataFrame) -> DataFrame:
    """Row count, number of snapshots, current snapshot."""
    log = history.agg(
        F.count("*").alias("n_snapshots"), F.max_by("snapshot_id", "ts_ms").alias("last_snapshot")
    )
    counted = rows.agg(F.count("*").alias("n_rows"))
    return log.withColumn("n_rows", counted.scalar()).withColumn(
        "success", (F.col("n_rows") >= 1) & (F.col("n_snapshots") >= 1)
    )


def personal_columns_present(df: DataFrame) -> list[str]:
    return sorted(set(df.columns) & set(PERSONAL_COLUMNS))

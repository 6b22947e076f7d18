"""Population drift: stability indices, prediction ratios, verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reviewlake.functions.decision import psi_band
from reviewlake.operators.selection import chronological_halves, row_quantiles
from reviewlake.schemas import SOURCE_NATURAL
from reviewlake.session import pin

# Fixed values of the drift rules.
PSI_ALERT = 0.2  # reached: alert
OUTSIDE_ALERT = 0.1  # exceeded: alert
EMPTY_SHARE = 1e-6
WATCHED = ("text_len",)
CATEGORICAL = ("language", "app_id", "sample_source")
BINS = 10


def _index(shares: DataFrame, by: Sequence[str]) -> DataFrame:
    """PSI per group of rows ``(*by, reference, current)`` of counts per class."""
    totals = shares.groupBy(*by).agg(
        F.sum("reference").alias("all_reference"), F.sum("current").alias("all_current")
    )

    def share(side: str) -> Column:
        part = F.col(side) / F.nullif(F.col(f"all_{side}"), F.lit(0))
        return F.when(part == 0, EMPTY_SHARE).otherwise(part)

    joined = shares.join(F.broadcast(totals), list(by))
    term = (F.col("p_current") - F.col("p_reference")) * F.log(F.col("p_current") / F.col("p_reference"))
    return (
        joined.withColumns({"p_reference": share("reference"), "p_current": share("current")})
        .groupBy(*by)
        .agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("psi"))
    )


def _by_side(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of both windows next to each other: the full outer alignment as one grouping."""
    return counts.groupBy(*keys).agg(
        F.sum(F.when(F.col("half") == "reference", F.col("n")).otherwise(0)).alias("reference"),
        F.sum(F.when(F.col("half") == "current", F.col("n")).otherwise(0)).alias("current"),
    )


def numeric_psi(halves: DataFrame, column: str, bins: int = BINS) -> DataFrame:
    """One row ``(column, psi)`` for a numeric column of a frame marked with ``half``.

    Classes are right-closed intervals between the distinct quantiles of the reference; a current
    value outside them leaves the denominator. The edges become literals, and one more pass counts the
    rows per class.
    """
    present = halves.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    reference = present.filter(F.col("half") == "reference")
    edges = sorted(set(row_quantiles(reference, F.col(column), [i / bins for i in range(bins + 1)])))
    limits = F.lit(edges).cast("array<double>")
    below = F.size(F.filter(limits, lambda e: e < F.col(column)))
    place = F.when(F.col(column) == F.get(limits, F.lit(0)), 1).otherwise(below)
    inside = present.select("half", place.alias("bin")).filter(F.col("bin").between(1, len(edges) - 1))
    counts = inside.groupBy("half", "bin").agg(F.count("*").alias("n"))
    # Every class takes part, also one that no value of either window falls into.
    empty = halves.sparkSession.createDataFrame(
        [("reference", i, 0) for i in range(1, len(edges))], "half string, bin int, n long"
    )
    every = counts.unionByName(empty)
    sides = _by_side(every, ["bin"]).withColumn("column", F.lit(column))
    psi = _index(sides, ["column"])
    return _one_row_per_column(psi, [column])


def _one_row_per_column(psi: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A column without a measurable index has index 0."""
    named = psi.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return named.join(F.broadcast(psi), "column", "left").select(
        "column", F.coalesce("psi", F.lit(0.0)).alias("psi")
    )


def categorical_psi(halves: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(column, psi)``; the classes are the union of both windows, nulls are a class.

    The columns are counted together in one grouping and separated afterwards.
    """
    together = halves.groupBy("half", *columns).agg(F.count("*").alias("n"))
    values = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("value"),
            )
            for c in columns
        ]
    )
    counts = (
        together.select("half", "n", F.inline(values))
        .groupBy("half", "column", "value")
        .agg(F.sum("n").alias("n"))
    )
    sides = pin(_by_side(counts, ["column", "value"]))
    totals = sides.groupBy("column").agg(
        F.sum("reference").alias("r"), F.sum("current").alias("c")
    )
    measurable = totals.filter((F.col("r") > 0) & (F.col("c") > 0)).select("column")
    psi = _index(sides.join(F.broadcast(measurable), "column"), ["column"])
    return _one_row_per_column(psi, columns)


def input_drift(
    halves: DataFrame,
    numeric: Sequence[str] = ("text_len",),
    categorical: Sequence[str] = CATEGORICAL,
) -> DataFrame:
    """``(column, psi, interpretation)``; columns the frame does not have are left out."""
    parts = [numeric_psi(halves, c) for c in numeric if c in halves.columns]
    present = [c for c in categorical if c in halves.columns]
    if present:
        parts.append(categorical_psi(halves, present))
    if not parts:
        return halves.sparkSession.createDataFrame([], "column string, psi double, interpretation string")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.withColumn("interpretation", psi_band(F.col("psi")))


def prediction_drift(
    summary: DataFrame, low: float = 0.5, high: float = 2.0, n_min: int = 20
) -> DataFrame:
    """Predicted over actual share per summary row; small or all-positive rows are not judged."""
    needed = {"app_id", "language", "date", "n_reviews", "share_negative_pred", "share_negative_true"}
    if not needed <= set(summary.columns):
        return summary.sparkSession.createDataFrame(
            [], "app_id long, language string, date date, ratio double, out_of_bounds boolean"
        )
    ratio = F.col("share_negative_pred") / F.col("share_negative_true")
    return (
        summary.filter((F.col("n_reviews") >= n_min) & (F.col("share_negative_true") != 0))
        .select("app_id", "language", "date", ratio.alias("ratio"))
        .withColumn("out_of_bounds", ~F.col("ratio").between(low, high))
    )


def drift_verdict(
    inputs: DataFrame, ratios: DataFrame, watched: Sequence[str] = WATCHED
) -> DataFrame:
    """One row: alert or not, why, and the figures behind it."""
    top = inputs.filter(F.col("column").isin(list(watched))).agg(
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("psi_max"),
        F.max_by("column", "psi").alias("psi_max_column"),
    )
    outside = ratios.agg(
        F.coalesce(F.avg(F.col("out_of_bounds").cast("int")), F.lit(0.0)).alias("share_out_of_bounds")
    )
    psi_high = F.col("psi_max") >= PSI_ALERT
    many_outside = F.col("share_out_of_bounds") > OUTSIDE_ALERT
    reasons = F.array_compact(
        F.array(
            F.when(
                psi_high,
                F.format_string("maximal PSI %.3f reaches the alert level 0.200", F.col("psi_max")),
            ),
            F.when(
                many_outside,
                F.format_string(
                    "share out of bounds %.2f%% exceeds 10.00%%", F.col("share_out_of_bounds") * 100
                ),
            ),
        )
    )
    return top.withColumn("share_out_of_bounds", outside.scalar()).select(
        (psi_high | many_outside).alias("alert"),
        F.concat_ws("; ", reasons).alias("reasons"),
        "psi_max",
        "psi_max_column",
        "share_out_of_bounds",
        F.lit(",".join(watched)).alias("watched"),
    )


def natural_halves(clean: DataFrame) -> DataFrame:
    """The natural flow in two chronological halves, dated by creation, else by update."""
    natural = (
        clean.filter(F.col("sample_source") == SOURCE_NATURAL)
        if "sample_source" in clean.columns
        else clean
    )
    moment = "created_at" if "created_at" in clean.columns else "updated_at"
    return chronological_halves(natural, moment, "review_id")


def write_alert(verdict: DataFrame, path: str, commit: str = "unknown") -> None:
    """Append the verdict, stamped, when it alerts; write nothing otherwise."""
    alerts = verdict.filter("alert").withColumns(
        {"stamped_at": F.current_timestamp(), "code_commit": F.lit(commit)}
    )
    rows = alerts.take(1)
    if rows:
        verdict.sparkSession.createDataFrame(rows, alerts.schema).coalesce(1).write.mode(
            "append"
        ).json(path)


def write_report(inputs: DataFrame, ratios: DataFrame, verdict: DataFrame, path: str) -> None:
    """The whole report, one folder per part."""
    inputs.write.mode("overwrite").json(f"{path}/inputs")
    ratios.write.mode("overwrite").json(f"{path}/predictions")
    verdict.coalesce(1).write.mode("overwrite").json(f"{path}/verdict")


def retraining_needed(spark: SparkSession, path: str) -> bool:
    """True only when the last report exists, can be read, and alerts."""
    from pyspark.errors import AnalysisException

    try:
        report = spark.read.schema("alert boolean").json(f"{path}/verdict")
        found = report.agg(F.bool_or("alert").alias("alert")).first()
    except AnalysisException:
        return False
    return bool(found["alert"])

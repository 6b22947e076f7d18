"""Aggregations: classification quality, latency, load, fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlake.operators.selection import number_cells, values_at_ranks
from reviewlake.schemas import (
    DEFAULT_THRESHOLD,
    LABEL_NEGATIVE,
    SOURCE_BOOST,
    SOURCE_NATURAL,
    THRESHOLD_GRID,
)
from reviewlake.session import parallelism

LATENCY_WINDOW = 2048  # samples kept per endpoint


def safe_ratio(top: Column, bottom: Column) -> Column:
    """0 where the denominator is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top.cast("double") / bottom)


def _confusion_columns(weight: Column | None = None) -> list[Column]:
    one = F.lit(1) if weight is None else weight
    truth_negative = F.col("label") == LABEL_NEGATIVE
    said_negative = F.col("pred_label") == LABEL_NEGATIVE

    def count(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, one).otherwise(0)), F.lit(0)).alias(name)

    return [
        count(truth_negative & said_negative, "tn_neg"),
        count(~truth_negative & said_negative, "fp_neg"),
        count(truth_negative & ~said_negative, "fn_neg"),
        count(~truth_negative & ~said_negative, "tp_pos"),
    ]


def _scores() -> dict[str, Column]:
    hit, false_alarm, miss, other = (F.col(c) for c in ("tn_neg", "fp_neg", "fn_neg", "tp_pos"))
    f1_negative = safe_ratio(2 * hit, 2 * hit + false_alarm + miss)
    f1_positive = safe_ratio(2 * other, 2 * other + false_alarm + miss)
    return {
        "f1_macro": (f1_negative + f1_positive) / 2,
        "recall_negative": safe_ratio(hit, hit + miss),
        "precision_negative": safe_ratio(hit, hit + false_alarm),
    }


def classification_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Macro F1, recall and precision of the negative class, from one pass of counts."""
    counts = scored.groupBy(*by).agg(*_confusion_columns(), F.count("*").alias("n_rows"))
    named = {k: v for k, v in _scores().items()}
    return counts.select(*by, "n_rows", *[v.alias(k) for k, v in named.items()])


def roc_auc(scored: DataFrame, score: str = "proba_negative", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve with the negative class as the event; ties count one half.

    For each score: how many positives lie below it. The count is a sum of prefix sums, one per level
    of nested cells, so no window covers more than the cells below one cell.
    """
    negative = F.col(label) == LABEL_NEGATIVE
    counted = scored.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(negative).alias("neg"), F.count_if(~negative).alias("pos")
    )
    names = ["cell_0", "cell_1", "cell_2", "cell_3"]
    placed = counted.withColumns(dict(zip(names, number_cells(F.col("score")))))
    levels = [placed.groupBy(*by, *names).agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))]
    for depth in range(len(names) - 1, 0, -1):
        finer = levels[0].groupBy(*by, *names[:depth])
        levels.insert(0, finer.agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")))
    by_coarse, won = levels[0], None
    for depth, level in enumerate(levels):
        below = (
            Window.partitionBy(*by, *names[:depth])
            .orderBy(names[depth])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        gained = F.col("neg").cast("double") * F.coalesce(F.sum("pos").over(below), F.lit(0))
        if depth == len(levels) - 1:  # one score per cell: ties
            gained = gained + F.col("neg").cast("double") * F.col("pos") / 2
        part = level.select(*by, gained.alias("won"))
        won = part if won is None else won.unionByName(part)
    won = won.groupBy(*by).agg(F.sum("won").alias("won"))
    totals = by_coarse.groupBy(*by).agg(F.sum("neg").alias("n_neg"), F.sum("pos").alias("n_pos"))
    possible = F.col("n_neg").cast("double") * F.col("n_pos")
    gains = F.col("won") if by else won.scalar()
    both = totals.join(won, by) if by else totals
    return both.select(
        *by,
        "n_neg",
        "n_pos",
        F.when(possible > 0, gains / possible).alias("roc_auc"),
    )


def threshold_curve(
    scored: DataFrame, grid: Sequence[float] = THRESHOLD_GRID, score: str = "proba_negative"
) -> DataFrame:
    """Macro F1 at every threshold of the grid, from one pass over the rows.

    Each row only says how many thresholds it reaches; the confusion counts of all thresholds
    follow from that small histogram.
    """
    limits = sorted(float(t) for t in grid)
    array = F.array(*[F.lit(t) for t in limits])
    reached = F.size(F.filter(array, lambda t: t <= F.col(score)))
    histogram = scored.groupBy("label", reached.alias("reached")).agg(F.count("*").alias("n"))
    per_threshold = histogram.select(
        "label", "reached", "n", F.posexplode(array).alias("position", "threshold")
    ).withColumn("pred_label", F.when(F.col("reached") > F.col("position"), LABEL_NEGATIVE).otherwise(1))
    counts = per_threshold.groupBy("threshold").agg(*_confusion_columns(F.col("n")))
    return counts.select("threshold", _scores()["f1_macro"].alias("f1_macro"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """Highest F1; equal within 1e-9, the one nearest the default; then the lowest."""
    return curve.orderBy(
        F.round("f1_macro", 9).desc(),
        F.round(F.abs(F.col("threshold") - DEFAULT_THRESHOLD), 9),
        F.col("threshold"),
    ).limit(1)


def recent_samples(
    log: DataFrame,
    by: str = "path",
    moment: str = "ts",
    tiebreak: str = "request_id",
    keep: int = LATENCY_WINDOW,
) -> DataFrame:
    """The latest ``keep`` requests of each endpoint.

    A busy endpoint is first thinned in many shares side by side; only the survivors of the shares
    meet in one group.
    """
    order = [F.col(moment).desc(), F.col(tiebreak).desc()]
    shares = parallelism(log.sparkSession)
    shared = log.withColumn("share", F.pmod(F.xxhash64(tiebreak), F.lit(shares)))
    for group in ([by, "share"], [by]):
        window = Window.partitionBy(*group).orderBy(*order)
        shared = (
            shared.withColumn("recency", F.row_number().over(window))
            .filter(F.col("recency") <= keep)
            .drop("recency")
        )
    return shared.drop("share")


def endpoint_latency(log: DataFrame, keep: int = LATENCY_WINDOW) -> DataFrame:
    """Per endpoint: all requests counted, percentiles over the retained ones, 3 decimals."""
    retained = recent_samples(log, keep=keep).groupBy("path").agg(
        F.count("*").alias("retained"),
        F.percentile("duration_ms", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99))).alias("p"),
        F.avg("duration_ms").alias("mean"),
        F.max("duration_ms").alias("max"),
    )
    totals = log.groupBy("path").agg(F.count("*").alias("total"))
    return totals.join(retained, "path", "left").select(
        "path",
        "total",
        F.coalesce("retained", F.lit(0)).alias("retained"),
        *[
            F.round(F.coalesce(F.get("p", F.lit(i)), F.lit(0.0)), 3).alias(name)
            for i, name in enumerate(("p50", "p95", "p99"))
        ],
        F.round(F.coalesce("mean", F.lit(0.0)), 3).alias("mean"),
        F.round(F.coalesce("max", F.lit(0.0)), 3).alias("max"),
    )


def load_summary(log: DataFrame, ok: Column, seconds: Column) -> DataFrame:
    """One row for a load campaign; percentiles are nearest-rank values that really occurred.

    ``seconds`` is an aggregate expression giving the length of the campaign. A request without a
    duration, or with NaN, counts as a request but takes no part in mean, maximum and percentiles.
    """
    measured = F.when(~F.isnan(F.col("duration_ms").cast("double")), F.col("duration_ms"))
    totals = log.agg(
        F.count("*").alias("requests"),
        F.count_if(ok).alias("succeeded"),
        F.coalesce(F.avg(measured), F.lit(0.0)).alias("mean"),
        F.coalesce(F.max(measured), F.lit(0.0)).alias("max"),
        seconds.cast("double").alias("seconds"),
    )
    # ceil(p / 100 * n) in whole numbers, so that no rounding error moves a rank
    ranks = {f"p{p}": (p / 100, lambda n, p=p: max((n * p + 99) // 100, 1)) for p in (50, 90, 99)}
    found = values_at_ranks(log, measured, ranks)
    return totals.select(
        "requests",
        "succeeded",
        (F.col("requests") - F.col("succeeded")).alias("failed"),
        safe_ratio(F.col("requests") - F.col("succeeded"), F.col("requests")).alias("error_rate"),
        F.when(F.col("seconds") > 0, F.col("requests") / F.col("seconds"))
        .otherwise(0.0)
        .alias("throughput"),
        *[F.lit(found[t].value if t in found else 0.0).cast("double").alias(t) for t in ranks],
        "mean",
        "max",
    )


def dataset_fingerprint(clean: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """What a training run was fed with.

    The content hash does not depend on row order and counts repeated rows: the sum of 60-bit digests
    over the columns named (all by default), times as microseconds.
    """
    kinds = dict(clean.dtypes)

    def told(c: str) -> Column:
        value = F.unix_micros(c) if kinds[c] == "timestamp" else F.col(c)
        return F.coalesce(value.cast("string"), F.lit("\u0000"))

    row = F.concat_ws("|", *(told(c) for c in columns or clean.columns))
    digest = F.conv(F.substring(F.sha2(row, 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return clean.agg(
        F.count("*").alias("data_rows"),
        F.min("created_at").alias("data_first_review"),
        F.max("created_at").alias("data_last_review"),
        F.count_if(F.col("sample_source") == SOURCE_NATURAL).alias("data_natural_rows"),
        F.count_if(F.col("sample_source") == SOURCE_BOOST).alias("data_boost_rows"),
        F.coalesce(F.sum(digest), F.lit(0)).cast("string").alias("data_hash"),
    )


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights ``n / (classes * n_class)``."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_rows"))
    everything = counts.agg(
        F.sum("n_rows").alias("n"), F.count("*").alias("classes")
    ).select((F.col("n") / F.col("classes")).alias("even"))
    return counts.withColumn("weight", everything.scalar() / F.col("n_rows"))


def fold_statistics(folds: DataFrame, by: str = "candidate") -> DataFrame:
    """Mean and population deviation of the fold scores; unmeasured folds are ignored."""
    score = F.when(~F.isnan("f1_macro"), F.col("f1_macro"))
    return folds.groupBy(by).agg(
        F.count(score).alias("n_folds"),
        F.avg(score).alias("f1_mean"),
        F.stddev_pop(score).alias("f1_std"),
    )


def rank_candidates(statistics: DataFrame) -> DataFrame:
    """Best mean first, unmeasured candidates last."""
    return statistics.orderBy(F.col("f1_mean").desc_nulls_last(), statistics.columns[0])


def against_incumbent(statistics: DataFrame, incumbent: str, by: str = "candidate") -> DataFrame:
    """A gap below the fold deviation of the incumbent is not significant."""
    mine = statistics.filter(F.col(by) == incumbent)
    gap = F.col("f1_mean") - mine.select("f1_mean").scalar()
    return statistics.withColumn("gap", gap).withColumn(
        "significant", F.abs("gap") >= mine.select("f1_std").scalar()
    )


def status_histogram(results: DataFrame) -> DataFrame:
    """How many results carry each status."""
    return results.groupBy("status").agg(F.count("*").alias("n"))

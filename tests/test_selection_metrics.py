import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.operators import metrics
from reviewlake.operators.selection import (
    chronological_halves,
    exact_quantiles,
    number_cells,
    row_quantiles,
    stratified_folds,
    stratified_split,
    values_at_ranks,
)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100])
def test_first_half_has_floor_of_half(spark, n):
    rows = [(str(i), 1_700_000_000 + (i % 5) * 86_400) for i in range(n)]
    df = frame(spark, rows, "id string, s long").withColumn("t", F.timestamp_seconds("s"))
    got = chronological_halves(df, "t", "id").collect()
    early = [r for r in got if r["half"] == "reference"]
    late = [r for r in got if r["half"] == "current"]
    assert len(early) == n // 2 and len(early) + len(late) == n
    if early:
        assert max(r["t"] for r in early) <= min(r["t"] for r in late)


def test_halves_with_one_moment_for_all(spark):
    df = frame(spark, [(str(i),) for i in range(11)], "id string").withColumn(
        "t", F.timestamp_seconds(F.lit(5))
    )
    assert chronological_halves(df, "t", "id").filter("half = 'reference'").count() == 5


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_equal_numpy(spark, seed):
    rng = random.Random(seed)
    values = [float(round(rng.lognormvariate(0, 3), 4)) for _ in range(501)] + [-3.0] * 40
    hist = frame(spark, [(v,) for v in values], "v double").groupBy("v").agg(F.count("*").alias("n"))
    probabilities = [i / 10 for i in range(11)]
    got = {r["position"]: r["quantile"] for r in exact_quantiles(hist, "v", "n", probabilities).collect()}
    for i, p in enumerate(probabilities):
        assert got[i] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)


def test_quantiles_of_one_value(spark):
    hist = frame(spark, [(4, 9)], "v long, n long")
    assert {r["quantile"] for r in exact_quantiles(hist, "v", "n", [0.0, 0.5, 1.0]).collect()} == {4.0}


def test_a_million_moments_in_one_day(spark):
    day = 1_700_006_400_000_000
    df = spark.range(1_000_000).select(
        "id", F.timestamp_micros(F.lit(day) + (F.col("id") * 7_919 % 1_000_000) * 86_399).alias("t")
    )
    halves = chronological_halves(df, "t", "id").groupBy("half").agg(F.count("*").alias("n"), F.min("t"), F.max("t"))
    late, early = halves.orderBy("half").collect()
    assert (early["n"], late["n"]) == (500_000, 500_000) and early["max(t)"] < late["min(t)"]


def test_a_third_of_the_rows_at_the_cut(spark):
    df = spark.range(30_000).select(
        "id", F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 500_000).otherwise(F.col("id") * 33)).alias("t")
    )
    marked = chronological_halves(df, "t", "id").withColumn("digest", F.sha2(F.col("id").cast("string"), 256))
    rows = sorted((r["t"], r["digest"], r["half"]) for r in marked.collect())
    assert [half for _, _, half in rows] == ["reference"] * 15_000 + ["current"] * 15_000


def test_rows_without_a_moment_do_not_count(spark):
    df = frame(spark, [("a", 1), ("b", 2), ("c", None), ("d", None), ("e", None)], "id string, s long")
    marked = chronological_halves(df.withColumn("t", F.timestamp_seconds("s")), "t", "id")
    assert [r["id"] for r in marked.filter("half = 'reference'").collect()] == ["a"]


@pytest.mark.parametrize("sketch", [50, 400, 20_000])
def test_bracketed_quantiles_equal_numpy(spark, sketch):
    rng = random.Random(sketch)
    values = [rng.choice([-3.5, 0.0, 7.0, rng.lognormvariate(0, 4), -rng.random()]) for _ in range(5_003)]
    rows = frame(spark, [(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    probabilities = [i / 10 for i in range(11)] + [0.999]
    got = row_quantiles(rows, F.col("v"), probabilities, sketch)
    assert got == pytest.approx([float(np.quantile(values, p)) for p in probabilities], rel=1e-12)
    assert row_quantiles(rows.filter("v > 1e300"), F.col("v"), probabilities, sketch) == []


def test_a_share_far_off_the_rank_still_finds_it(spark):
    rows = spark.range(3_000).select((F.col("id") * 2).alias("v"))
    found = values_at_ranks(rows, F.col("v"), {"low": (0.9, lambda n: 5), "none": (0.5, lambda n: n + 1)}, sketch=100)
    assert found == {"low": (8, 4, 1, 3_000)}


def test_split_is_exact_per_label_and_repeatable(spark):
    rows = [(str(i), int(i % 10 != 0)) for i in range(203)]
    df = frame(spark, rows, "id string, label long")
    split = stratified_split(df, "label", "id")
    counts = {(r["label"], r["split"]): r["count"] for r in split.groupBy("label", "split").count().collect()}
    assert counts[(0, "test")] == round(0.2 * 21) and counts[(1, "test")] == round(0.2 * 182)
    again = stratified_split(df.repartition(3), "label", "id")
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, again.collect()))


def test_folds_are_balanced_per_label(spark):
    rows = [(str(i), int(i % 10 != 0)) for i in range(203)] + [("x", 5), ("y", 5)]
    folded = stratified_folds(frame(spark, rows, "id string, label long"), "label", "id")
    per = {}
    for r in folded.groupBy("label", "fold").count().collect():
        per.setdefault(r["label"], {})[r["fold"]] = r["count"]
    for label in (0, 1):
        assert set(per[label]) == {0, 1, 2, 3, 4}
        assert max(per[label].values()) - min(per[label].values()) <= 1
    assert sum(per[5].values()) == 2 and max(per[5].values()) == 1


def auc_by_pairs(rows):
    neg = [p for label, p in rows if label == 0]
    pos = [p for label, p in rows if label == 1]
    wins = sum((a > b) + (a == b) / 2 for a in neg for b in pos)
    return wins / (len(neg) * len(pos))


def test_auc_equals_all_pairs(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), round(rng.random(), 2)) for _ in range(300)] + [(0, 1.0), (1, 0.0), (1, 1.0)]
    got = metrics.roc_auc(frame(spark, rows, "label long, proba_negative double")).first()["roc_auc"]
    assert got == pytest.approx(auc_by_pairs(rows), abs=1e-12)


def test_auc_of_nearly_equal_scores(spark):
    rows = [(i % 2, 0.5 + i * 1e-13) for i in range(50)]
    got = metrics.roc_auc(frame(spark, rows, "label long, proba_negative double")).first()["roc_auc"]
    assert got == pytest.approx(auc_by_pairs(rows), abs=1e-12)


def macro_f1(rows, threshold):
    decided = [(label, 0 if p >= threshold else 1) for label, p in rows]
    scores = []
    for cls in (0, 1):
        tp = sum(a == b == cls for a, b in decided)
        wrong = sum((a == cls) != (b == cls) for a, b in decided)
        scores.append(2 * tp / (2 * tp + wrong) if 2 * tp + wrong else 0.0)
    return sum(scores) / 2


def test_threshold_curve_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), round(rng.random(), 3)) for _ in range(200)] + [(0, 0.3), (1, 0.8), (0, 0.525)]
    curve = metrics.threshold_curve(frame(spark, rows, "label long, proba_negative double")).collect()
    assert len(curve) == 21
    for r in curve:
        assert r["f1_macro"] == pytest.approx(macro_f1(rows, r["threshold"]), abs=1e-12)


def test_ties_go_to_the_threshold_nearest_the_default(spark):
    curve = frame(
        spark,
        [(0.3, 0.8), (0.475, 0.9), (0.525, 0.9 + 1e-12), (0.7, 0.9)],
        "threshold double, f1_macro double",
    )
    assert metrics.best_threshold(curve).first()["threshold"] == 0.475


def test_metrics_without_any_negative(spark):
    row = metrics.classification_metrics(frame(spark, [(1, 1)], "label long, pred_label long")).first()
    assert (row["f1_macro"], row["recall_negative"], row["precision_negative"]) == (0.5, 0.0, 0.0)


def test_service_percentiles(spark):
    rows = [("/p", i, float(i), i) for i in range(1, 101)] + [("/q", 1, 42.0, 1)]
    log = frame(spark, rows, "path string, ts long, duration_ms double, request_id long")
    got = {r["path"]: r for r in metrics.endpoint_latency(log).collect()}
    assert (got["/p"]["p50"], got["/p"]["p95"], got["/p"]["p99"]) == (50.5, 95.05, 99.01)
    assert (got["/q"]["p50"], got["/q"]["p99"], got["/q"]["max"]) == (42.0, 42.0, 42.0)


def test_only_recent_samples_count(spark):
    rows = [("/p", i, float(i), i) for i in range(1, 51)]
    log = frame(spark, rows, "path string, ts long, duration_ms double, request_id long")
    row = metrics.endpoint_latency(log, keep=10).first()
    assert (row["total"], row["retained"], row["p50"]) == (50, 10, 45.5)


def test_load_summary_uses_nearest_rank(spark):
    values = [float(v) for v in (5, 1, 9, 9, 9, 2, 7)]
    log = frame(spark, [(v, i > 0) for i, v in enumerate(values)], "duration_ms double, ok boolean")
    row = metrics.load_summary(log, F.col("ok"), F.max("duration_ms") - F.max("duration_ms") + 2).first()
    ordered = sorted(values)
    for p in (50, 90, 99):
        assert row[f"p{p}"] == ordered[max(math.ceil(p / 100 * len(values)) - 1, 0)]
    assert (row["requests"], row["failed"], row["throughput"]) == (7, 1, 3.5)


def test_load_summary_of_nothing(spark):
    log = frame(spark, [], "duration_ms double, ok boolean")
    row = metrics.load_summary(log, F.col("ok"), F.max("duration_ms")).first()
    assert row["requests"] == 0 and row["p99"] == 0.0 and row["throughput"] == 0.0


def test_fingerprint_ignores_order_and_sees_changes(spark):
    rows = [(str(i), i, "natural") for i in range(20)]
    schema = "review_id string, created_at long, sample_source string"
    a = metrics.dataset_fingerprint(frame(spark, rows, schema)).first()
    b = metrics.dataset_fingerprint(frame(spark, rows[::-1], schema).repartition(3)).first()
    c = metrics.dataset_fingerprint(frame(spark, [("z", 0, "natural")] + rows[1:], schema)).first()
    assert a == b and a["data_hash"] != c["data_hash"]


def test_unmeasured_candidates_rank_last(spark):
    folds = frame(
        spark,
        [("a", 0.5), ("a", 0.7), ("b", float("nan")), ("c", 0.9)],
        "candidate string, f1_macro double",
    )
    ranked = metrics.rank_candidates(metrics.fold_statistics(folds)).collect()
    assert [r["candidate"] for r in ranked] == ["c", "a", "b"]
    assert ranked[1]["f1_std"] == pytest.approx(0.1)


def test_cells_follow_the_order_of_doubles(spark):
    values = [-1e308, -8.0, -7.999999, -1.0, -1e-300, 0.0, 5e-324, 1e-9, 0.5, 0.9999999999999999, 1.0, 1.0000000000000002, 8.0, 1e12, 1e308]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    cells = [tuple(r) for r in df.orderBy("v").select(*number_cells(F.col("v"))).collect()]
    assert cells == sorted(cells) and len(set(cells)) == len(values)


def test_load_summary_ignores_missing_durations_and_outliers(spark):
    rows = [(None,), (None,), (None,), (10.0,), (20.0,), (float("nan"),), (1e12,)]
    log = spark.createDataFrame(rows, "duration_ms double")
    row = metrics.load_summary(log, F.lit(True), F.lit(1.0)).first()
    assert (row["requests"], row["p50"], row["p99"], row["max"]) == (7, 20.0, 1e12, 1e12)


def test_auc_with_saturated_scores(spark):
    rows = [(0, 1.0)] * 30 + [(1, 1.0)] * 10 + [(1, 0.0)] * 50 + [(0, 0.0)] * 10
    df = spark.createDataFrame(rows, "label long, proba_negative double")
    pairs = [(a, b) for la, a in rows if la == 0 for lb, b in rows if lb == 1]
    wanted = sum((a > b) + (a == b) / 2 for a, b in pairs) / len(pairs)
    assert abs(metrics.roc_auc(df).first()["roc_auc"] - wanted) < 1e-12

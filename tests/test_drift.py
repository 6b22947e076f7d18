import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewlake.operators import drift


def halves(spark, reference, current, kind="double"):
    rows = [("reference", v) for v in reference] + [("current", v) for v in current]
    return spark.createDataFrame(rows, f"half string, v {kind}")


def numeric(spark, reference, current):
    return drift.numeric_psi(halves(spark, reference, current), "v").first()["psi"]


def brute_psi(reference, current, bins=10):
    ref, cur = pd.Series(reference), pd.Series(current)
    edges = ref.quantile(np.linspace(0, 1, bins + 1)).drop_duplicates().values
    if len(edges) < 2:
        return 0.0
    a = pd.cut(ref, edges, include_lowest=True)
    b = pd.cut(cur, edges, include_lowest=True)
    p = a.value_counts(normalize=True).reindex(a.cat.categories, fill_value=0).replace(0, 1e-6)
    q = b.value_counts(normalize=True).reindex(a.cat.categories, fill_value=0).replace(0, 1e-6)
    return float(((q - p) * np.log(q / p)).sum())


def normal(seed, mean, n=4000):
    rng = random.Random(seed)
    return [rng.gauss(mean, 1) for _ in range(n)]


def test_same_law_is_stable_and_a_shift_is_not(spark):
    same = numeric(spark, normal(1, 0), normal(2, 0))
    moved = numeric(spark, normal(1, 0), normal(3, 2))
    assert same < 0.02 and moved > 0.2 and moved > 10 * same


@pytest.mark.parametrize(
    "reference, current",
    [
        ([1, 1, 1, 1, 2, 3, 4, 5, 6, 7, 7, 7], [1, 2, 2, 9, 9, 0, 5]),
        ([float(i * i % 97) for i in range(300)], [float(i * 7 % 120) for i in range(200)]),
        ([1.0, 2.0], [2.0, 2.0, 1.0]),
        ([5.0] * 20, [1.0, 5.0]),
    ],
)
def test_numeric_index_equals_brute_force(spark, reference, current):
    expected = brute_psi(reference, current)
    got = numeric(spark, [float(v) for v in reference], [float(v) for v in current])
    assert got == pytest.approx(expected, abs=1e-9)


def test_empty_window_has_no_index(spark):
    assert numeric(spark, [1.0, 2.0, 3.0], []) == 0.0
    assert drift.numeric_psi(halves(spark, [], [1.0]), "v").first()["psi"] == 0.0
    assert drift.categorical_psi(halves(spark, ["a"], [], "string"), ["v"]).first()["psi"] == 0.0


def test_lost_category_and_nulls_are_classes(spark):
    rows = halves(spark, ["A", "B", "C"] * 10, ["A", "B"] * 15, "string")
    assert drift.categorical_psi(rows, ["v"]).first()["psi"] > 0.1
    nulls = halves(spark, ["A", None], ["A", "A"], "string")
    expected = (1 - 0.5) * math.log(1 / 0.5) + (1e-6 - 0.5) * math.log(1e-6 / 0.5)
    assert drift.categorical_psi(nulls, ["v"]).first()["psi"] == pytest.approx(expected)


def test_absent_columns_are_left_out(spark):
    df = halves(spark, [1.0, 2.0, 3.0], [1.0, 2.0]).withColumn("language", F.lit("x"))
    assert [r["column"] for r in drift.input_drift(df).collect()] == ["language"]


def summary(spark, rows):
    return spark.createDataFrame(rows, "n_reviews long, share_negative_pred double, share_negative_true double").selectExpr(
        "1L app_id", "'english' language", "date'2026-09-01' date", "*"
    )


def test_ratios_skip_small_and_all_positive_rows(spark):
    rows = drift.prediction_drift(
        summary(spark, [(30, 0.6, 0.2), (30, 0.5, 0.5), (10, 0.5, 0.5), (30, 0.5, 0.0), (30, 0.4, 0.2)])
    ).collect()
    assert sorted((round(r["ratio"], 6), r["out_of_bounds"]) for r in rows) == [
        (1.0, False), (2.0, False), (3.0, True),
    ]


def verdict(spark, inputs, flags):
    left = spark.createDataFrame(inputs, "column string, psi double")
    right = spark.createDataFrame([(f,) for f in flags], "out_of_bounds boolean")
    return drift.drift_verdict(left, right).first()


def test_psi_alert_includes_its_level(spark):
    assert verdict(spark, [("text_len", 0.2)], [])["alert"]
    assert not verdict(spark, [("text_len", 0.1999)], [])["alert"]


def test_share_alert_excludes_its_level(spark):
    assert not verdict(spark, [("text_len", 0.0)], [True] + [False] * 9)["alert"]
    row = verdict(spark, [("text_len", 0.0)], [True, True] + [False] * 8)
    assert row["alert"] and "20.00%" in row["reasons"]


def test_only_watched_columns_alert(spark):
    row = verdict(spark, [("text_len", 0.05), ("language", 3.0)], [])
    assert not row["alert"] and row["psi_max_column"] == "text_len"


def test_alert_is_written_only_when_raised(spark, tmp_path):
    quiet = spark.createDataFrame([(False, "")], "alert boolean, reasons string")
    loud = spark.createDataFrame([(True, "why")], "alert boolean, reasons string")
    drift.write_alert(quiet, str(tmp_path / "alerts"))
    assert not (tmp_path / "alerts").exists()
    drift.write_alert(loud, str(tmp_path / "alerts"), "abc123")
    row = spark.read.json(str(tmp_path / "alerts")).first()
    assert row["code_commit"] == "abc123" and row["reasons"] == "why" and row["stamped_at"]


def test_retraining_follows_the_last_report(spark, tmp_path):
    assert drift.retraining_needed(spark, str(tmp_path / "none")) is False
    empty = spark.createDataFrame([], "column string, psi double")
    for alert in (True, False):
        row = spark.createDataFrame([(alert,)], "alert boolean")
        drift.write_report(empty, empty, row, str(tmp_path / "report"))
        assert drift.retraining_needed(spark, str(tmp_path / "report")) is alert
    (tmp_path / "report" / "verdict" / "part-bad.json").write_text("{not json")
    assert drift.retraining_needed(spark, str(tmp_path / "report")) is False

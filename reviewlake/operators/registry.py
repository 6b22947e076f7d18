"""Runs, versions and the champion alias, as small tables."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlake.schemas import CHAMPION, MIN_F1_MACRO

ALIAS_SCHEMA = "alias string, version long, ts_ms long"


def promotion_history(runs: DataFrame, order: str, by: str | None = None, gate: float = MIN_F1_MACRO) -> DataFrame:
    """Which runs became champion: good enough, and strictly better than the champion before.

    The champion before a run is the best good-enough run before it. Holds one row per training run.
    """
    window = Window.partitionBy(*([by] if by else [])).orderBy(order)
    before = F.max(F.when(F.col("f1_macro") >= gate, F.col("f1_macro"))).over(
        window.rowsBetween(Window.unboundedPreceding, -1)
    )
    return runs.withColumn("champion_f1", before).withColumn(
        "promoted", promotion(F.col("f1_macro"), F.col("champion_f1"), gate)
    )


def promotion(f1: Column, champion_f1: Column, gate: float = MIN_F1_MACRO) -> Column:
    return (f1 >= gate) & (champion_f1.isNull() | (f1 > champion_f1))


def current_aliases(alias_log: DataFrame) -> DataFrame:
    """The version each alias points to now: its last move."""
    return alias_log.groupBy("alias").agg(
        F.max_by("version", F.struct("ts_ms", "version")).alias("version")
    )


def champion(alias_log: DataFrame) -> DataFrame:
    """The champion version, or no row."""
    return current_aliases(alias_log).filter(F.col("alias") == CHAMPION).select("version")


def versions_with_metrics(versions: DataFrame, runs: DataFrame, alias_log: DataFrame) -> DataFrame:
    """Versions, newest first, with the metrics of their run and their aliases; metrics may be missing."""
    aliases = (
        current_aliases(alias_log)
        .groupBy("version")
        .agg(F.array_join(F.array_sort(F.collect_list("alias")), ",").alias("aliases"))
    )
    return (
        versions.join(runs.select("run_id", "f1_macro", "train_test_gap"), "run_id", "left")
        .join(aliases, "version", "left")
        .select(
            "version",
            "created_ms",
            "f1_macro",
            "train_test_gap",
            F.coalesce("aliases", F.lit("")).alias("aliases"),
        )
        .orderBy(F.col("created_ms").desc(), F.col("version").desc())
    )


class Registry:
    """Append-only tables of runs, versions and alias moves below one folder."""

    def __init__(self, spark, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        from reviewlake.sources.snapshots import folder_exists

        path = f"{self.root}/{name}"
        if not folder_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    RUNS = (
        "run_id string, created_ms long, f1_macro double, recall_negative double, "
        "precision_negative double, roc_auc double, f1_macro_train double, train_test_gap double, "
        "n_train long, n_test long, negative_share double, threshold double, data_rows long, "
        "data_first_review timestamp, data_last_review timestamp, data_natural_rows long, "
        "data_boost_rows long, data_hash string"
    )
    VERSIONS = "version long, run_id string, created_ms long, location string"

    def runs(self) -> DataFrame:
        return self._read("runs", self.RUNS)

    def versions(self) -> DataFrame:
        return self._read("versions", self.VERSIONS)

    def aliases(self) -> DataFrame:
        return self._read("aliases", ALIAS_SCHEMA)

    def _append(self, name: str, row: dict, schema: str) -> None:
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(
            f"{self.root}/{name}"
        )

    def add_run(self, row: dict) -> None:
        self._append("runs", row, self.RUNS)

    def add_version(self, run_id: str, location: str) -> int:
        last = self.versions().agg(F.max("version").alias("v")).first()["v"] or 0
        row = {
            "version": last + 1,
            "run_id": run_id,
            "created_ms": int(time.time() * 1000),
            "location": location,
        }
        self._append("versions", row, self.VERSIONS)
        return last + 1

    def champion_version(self) -> int | None:
        found = champion(self.aliases()).first()
        return found["version"] if found else None

    def champion_f1(self) -> float | None:
        version = self.champion_version()
        if version is None:
            return None
        found = (
            self.versions()
            .filter(F.col("version") == version)
            .join(self.runs(), "run_id", "left")
            .select("f1_macro")
            .first()
        )
        return found["f1_macro"] if found else None

    def move_champion(self, version: int) -> dict:
        """Point the champion alias to an existing version and say where it pointed before."""
        if self.versions().filter(F.col("version") == int(version)).isEmpty():
            raise ValueError(f"version {version} does not exist")
        old = self.champion_version()
        last_move = self.aliases().agg(F.max("ts_ms").alias("t")).first()["t"] or 0
        stamp = max(int(time.time() * 1000), last_move + 1)
        self._append("aliases", {"alias": CHAMPION, "version": int(version), "ts_ms": stamp}, ALIAS_SCHEMA)
        return {"old": old, "new": int(version)}

    def overview(self) -> DataFrame:
        return versions_with_metrics(self.versions(), self.runs(), self.aliases())

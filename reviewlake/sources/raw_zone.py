"""Idempotent append to the raw zone, its key table, and retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from reviewlake.schemas import RETENTION_DAYS, SOURCE_NATURAL
from reviewlake.session import counted_write, pin
from reviewlake.sources.raw import RawScan, path_value
from reviewlake.sources.snapshots import _filesystem, folder_exists

KEYS = ("sample_source", "app_id", "language", "recommendationid")
KEY_SCHEMA = (
    "recommendationid string, batch string, sample_source string, app_id long, language string"
)


class BatchConflict(ValueError):
    """A batch name that already holds other reviews."""


def new_reviews(incoming: DataFrame, seen: DataFrame) -> DataFrame:
    """Reviews of which the flow holds no copy yet, one row per key: the latest update of each.

    The seen keys grow with the zone, so both sides are hashed on the key; nothing is broadcast by
    hand. The incoming batch is reduced to one row per key first; copies with equal times are told
    apart by their content, so that a rerun picks the same one.
    """
    order = [
        F.coalesce(F.expr("try_cast(timestamp_updated AS bigint)"), "timestamp_created").desc_nulls_last(),
        F.xxhash64(F.to_json(F.struct(*(F.col(c) for c in incoming.columns if c not in KEYS)))),
    ]
    ranked = incoming.withColumn("_copy", F.row_number().over(Window.partitionBy(*KEYS).orderBy(*order)))
    latest = ranked.filter(F.col("_copy") == 1).drop("_copy")
    # only the key partitions that the batch names are read
    places = latest.select(*KEYS[:3]).distinct()
    known = seen.select(*KEYS).join(places, list(KEYS[:3]), "left_semi")
    return latest.join(known, list(KEYS), "left_anti")


class RawZone:
    """Raw JSON lines, the Parquet table of keys stored, and what was set aside.

    A batch becomes seen when its keys are written, last and from the lines that are stored. A loss
    in between leaves lines without keys: a retry under the same name replaces them, one under
    another name stores the reviews again, and cleaning drops the copies; nothing is lost. Once its
    keys are written a batch never changes: the same reviews again are no change, other reviews
    under its name are refused.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys_path = f"{self.root}/keys"

    def seen(self) -> DataFrame:
        if not folder_exists(self.spark, self.keys_path):
            return self.spark.createDataFrame([], KEY_SCHEMA)
        return self.spark.read.schema(KEY_SCHEMA).parquet(self.keys_path)

    def quarantine(self) -> DataFrame | None:
        """Everything set aside so far, with its reason and batch."""
        path = f"{self.root}/quarantine"
        return self.spark.read.parquet(path) if folder_exists(self.spark, path) else None

    def append(self, incoming: DataFrame | RawScan, batch: str, day: dt.date) -> int:
        """Store the new reviews of a batch, of any flow; returns how many, and writes no file for none.

        Flows and languages may have any name that is not empty.

        A scan also hands over what it set aside, which is stored beside the lines.
        """
        if isinstance(incoming, RawScan):
            aside = incoming.quarantine
            aside.write.mode("overwrite").parquet(f"{self.root}/quarantine/batch={batch}")
            incoming = incoming.good
        flow = F.coalesce(F.nullif("sample_source", F.lit("")), F.lit(SOURCE_NATURAL))
        incoming = incoming.withColumn("sample_source", flow)
        placeless = F.col("app_id").isNull() | (F.coalesce("language", F.lit("")) == "")
        if not incoming.filter(placeless).isEmpty():
            raise ValueError("reviews without app or language have no place in the zone; a scan sets them aside")
        seen = self.seen()
        fresh = pin(new_reviews(incoming, seen.filter(F.col("batch") != batch)))
        keys_folder = f"{self.keys_path}/batch={batch}"
        if folder_exists(self.spark, f"{keys_folder}/_SUCCESS"):
            own = seen.filter(F.col("batch") == batch)
            if not fresh.join(own.select(*KEYS), list(KEYS), "left_anti").isEmpty():
                raise BatchConflict(f"batch {batch} already holds other reviews")
            return own.count()
        self._drop_lines(batch)
        lines = fresh.withColumns(
            {"dt": F.lit(day.isoformat()), "batch": F.lit(batch), "sample": F.col("sample_source")}
        ).drop("sample_source", "source_file")
        natural = F.col("sample") == SOURCE_NATURAL
        folders = ["app_id", "language", "dt", "batch"]
        lines.filter(natural).drop("sample").write.mode("append").partitionBy(*folders).json(self.root)
        lines.filter(~natural).write.mode("append").partitionBy("sample", *folders).json(self.root)
        stored = self._stored_keys(batch)
        if stored is None:
            return 0
        places = ("sample_source", "app_id", "language")
        return counted_write(
            stored, lambda writer: writer.mode("overwrite").partitionBy(*places).parquet(keys_folder)
        )

    def _folders(self, batch: str) -> list:
        """Folders that hold lines of a batch, found by name."""
        fs, _ = _filesystem(self.spark, self.root)
        path_class = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        found = []
        for level in ("", "sample=*/"):
            pattern = f"{self.root}/{level}app_id=*/language=*/dt=*/batch={batch}"
            found += [status.getPath() for status in fs.globStatus(path_class(pattern)) or []]
        return found

    def _drop_lines(self, batch: str) -> None:
        fs, _ = _filesystem(self.spark, self.root)
        for folder in self._folders(batch):
            fs.delete(folder, True)

    def _stored_keys(self, batch: str) -> DataFrame | None:
        """The keys of a batch as its stored lines have them."""
        folders = [str(f.toString()) for f in self._folders(batch)]
        if not folders:
            return None
        lines = self.spark.read.schema("recommendationid string").json(folders)
        path = F.col("_metadata.file_path")
        return lines.select(
            F.coalesce(path_value(path, "sample"), F.lit(SOURCE_NATURAL)).alias("sample_source"),
            F.regexp_extract(path, "/app_id=([0-9]+)/", 1).cast("long").alias("app_id"),
            path_value(path, "language").alias("language"),
            "recommendationid",
        )


def retention_split(partitions: DataFrame, today, keep_days: int = RETENTION_DAYS) -> DataFrame:
    """Mark day partitions ``expired`` when strictly older than the retention period."""
    cutoff = F.date_sub(today if not isinstance(today, dt.date) else F.lit(today), keep_days)
    return partitions.withColumn("expired", F.col("dt") < cutoff)


def purge_raw(
    spark: SparkSession, root: str, today: dt.date, keep_days: int = RETENTION_DAYS
) -> int:
    """Delete expired ``dt=`` folders of the raw zone; returns the number of files removed.

    Only folder names are looked at: no data is read or rewritten.
    """
    cutoff = today - dt.timedelta(days=keep_days)
    fs, _ = _filesystem(spark, root)
    path_class = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    removed = 0
    for pattern in ("app_id=*/language=*/dt=*", "sample=*/app_id=*/language=*/dt=*"):
        for status in fs.globStatus(path_class(f"{root.rstrip('/')}/{pattern}")) or []:
            if not status.isDirectory():
                continue
            try:
                day = dt.date.fromisoformat(status.getPath().getName()[len("dt="):])
            except ValueError:
                continue
            if day < cutoff:
                removed += int(fs.getContentSummary(status.getPath()).getFileCount())
                fs.delete(status.getPath(), True)
    return removed

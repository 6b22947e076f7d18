"""Tables whose every overwrite is a restorable snapshot: Parquet folders plus a log.

Data is written first; the log row appended afterwards makes it visible. A job that dies in between
leaves an unlisted folder and no damage.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from reviewlake.schemas import ContractError
from reviewlake.session import counted_write

#: Metadata of the key column of a bucketed version: the number of buckets.
BUCKETS = "buckets"

LOG = "snapshot_id long, ts_ms long, operation string, n_rows long, location string, schema_json string"


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


class SnapshotTable:
    """One table below a lake folder; a single writer is assumed."""

    def __init__(self, spark: SparkSession, lake: str, name: str):
        self.spark = spark
        self.name = name
        self.root = f"{lake.rstrip('/')}/{name.replace('.', '/')}"

    def log(self) -> DataFrame:
        path = f"{self.root}/log"
        if not folder_exists(self.spark, path):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).parquet(path)

    def _latest(self, snapshot_id: int | None = None):
        rows = self.log()
        if snapshot_id is not None:
            rows = rows.filter(F.col("snapshot_id") == snapshot_id)
        found = rows.agg(
            F.max_by(F.struct(*rows.columns), F.struct("ts_ms", "snapshot_id")).alias("row")
        ).first()["row"]
        return found

    def _append_log(self, row: dict) -> None:
        self.spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").parquet(
            f"{self.root}/log"
        )

    def _next(self) -> tuple[int, int]:
        last = self.log().agg(F.max("snapshot_id").alias("id"), F.max("ts_ms").alias("ts")).first()
        stamp = max(int(time.time() * 1000), (last["ts"] or 0) + 1)
        return (last["id"] or 0) + 1, stamp

    def stage(
        self, df: DataFrame, partition_by: list[str] | None = None, buckets: tuple[str, int] | None = None
    ) -> dict:
        """Write a new version without making it visible: the log row that ``commit`` will append.

        Column names must be those of the stored table; the types are cast to the stored ones.
        ``buckets`` names a key and a number: versions with equal buckets join on the key without an
        exchange. A frame already hashed on the key is stored as it lies; others should be
        repartitioned on it first, as every task writes a file per bucket it holds rows of.
        """
        current = self._latest()
        if current is not None:
            stored = T.StructType.fromJson(json.loads(current["schema_json"]))
            if df.columns != stored.fieldNames():
                raise ContractError(
                    f"{self.name}: columns {df.columns} are not {stored.fieldNames()}"
                )
            df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored])
        schema = df.schema
        snapshot_id, stamp = self._next()
        location = f"{self.root}/data/snapshot_id={snapshot_id}-{uuid.uuid4().hex[:8]}"
        if buckets:
            key, number = buckets
            schema = T.StructType(
                [T.StructField(f.name, f.dataType, f.nullable, {BUCKETS: number} if f.name == key else {}) for f in schema]
            )
            table = self._bucketed(location, schema)
            rows = counted_write(df, lambda writer: writer.insertInto(table))
        else:
            rows = counted_write(
                df, lambda writer: writer.mode("errorifexists").partitionBy(*partition_by or []).parquet(location)
            )
        return {
            "snapshot_id": snapshot_id,
            "ts_ms": stamp,
            "operation": "overwrite",
            "n_rows": rows,
            "location": location,
            "schema_json": schema.json(),
        }

    def commit(self, staged: dict) -> dict:
        """Make a staged version the current one."""
        self._append_log(staged)
        return {
            "table": self.name,
            "rows": staged["n_rows"],
            "snapshots": self.history().count(),
            "location": staged["location"],
        }

    def overwrite(
        self, df: DataFrame, partition_by: list[str] | None = None, buckets: tuple[str, int] | None = None
    ) -> dict:
        """Replace the content with a new snapshot: staged, then committed by one log row."""
        return self.commit(self.stage(df, partition_by, buckets))

    def open(self, row) -> DataFrame:
        """The data of a log row, staged or committed."""
        schema = T.StructType.fromJson(json.loads(row["schema_json"]))
        if any(BUCKETS in f.metadata for f in schema):
            return self.spark.table(self._bucketed(row["location"], schema))
        return self.spark.read.schema(schema).parquet(row["location"]).select(*schema.fieldNames())

    def _bucketed(self, location: str, schema: T.StructType) -> str:
        """The catalog's name of a bucketed folder, entered on first use in a session."""
        name = f"snapshot_{hashlib.sha256(location.encode()).hexdigest()[:32]}"
        if not self.spark.catalog.tableExists(name):
            key, number = next((f.name, f.metadata[BUCKETS]) for f in schema if BUCKETS in f.metadata)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet "
                f"CLUSTERED BY (`{key}`) INTO {int(number)} BUCKETS LOCATION :location",
                args={"location": location},
            )
        return name

    def read(self) -> DataFrame:
        """The current version."""
        row = self._latest()
        if row is None:
            raise ValueError(f"{self.name} does not exist")
        return self.open(row)

    def read_at(self, snapshot_id: int) -> DataFrame:
        """An older version; the current one is left alone."""
        row = self._latest(snapshot_id)
        if row is None:
            raise ValueError(f"unknown snapshot {snapshot_id} of {self.name}")
        return self.open(row)

    def history(self) -> DataFrame:
        """Snapshots by time, the current one flagged."""
        return snapshot_history(self.log())

    def restore(self, snapshot_id: int) -> dict:
        """Make an existing snapshot the current one again."""
        row = self._latest(snapshot_id)
        if row is None:
            raise ValueError(f"unknown snapshot {snapshot_id} of {self.name}")
        _, stamp = self._next()
        self._append_log({**row.asDict(), "ts_ms": stamp, "operation": "restore"})
        return {"table": self.name, "snapshot_id": snapshot_id, "rows": row["n_rows"]}


class SnapshotGroup:
    """Several tables that change together: one log row names all their versions."""

    def __init__(self, spark: SparkSession, lake: str, name: str):
        self._table = SnapshotTable(spark, lake, name)
        self.spark = spark

    def overwrite(self, tables: dict[str, DataFrame]) -> dict[str, int]:
        """Write every table, then commit all of them at once; the rows of each."""
        snapshot_id, stamp = self._table._next()
        location = f"{self._table.root}/data/snapshot_id={snapshot_id}-{uuid.uuid4().hex[:8]}"
        rows = {
            name: counted_write(
                df, lambda writer, name=name: writer.mode("errorifexists").parquet(f"{location}/{name}")
            )
            for name, df in tables.items()
        }
        self._table._append_log(
            {
                "snapshot_id": snapshot_id,
                "ts_ms": stamp,
                "operation": "overwrite",
                "n_rows": sum(rows.values()),
                "location": location,
                "schema_json": json.dumps({n: df.schema.json() for n, df in tables.items()}),
            }
        )
        return rows

    def read(self, name: str) -> DataFrame:
        """One table of the current version."""
        row = self._table._latest()
        if row is None:
            raise ValueError(f"{self._table.name} does not exist")
        schema = T.StructType.fromJson(json.loads(json.loads(row["schema_json"])[name]))
        return self.spark.read.schema(schema).parquet(f"{row['location']}/{name}")


def snapshot_history(log: DataFrame) -> DataFrame:
    """``(snapshot_id, ts_ms, operation, n_rows, current)``; the current snapshot is the last log row."""
    last = log.agg(F.max_by("snapshot_id", F.struct("ts_ms", "snapshot_id")).alias("id"))
    return log.select(
        "snapshot_id",
        "ts_ms",
        "operation",
        "n_rows",
        (F.col("snapshot_id") == last.scalar()).alias("current"),
    ).orderBy("ts_ms")

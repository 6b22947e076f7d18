"""Session defaults and the reliable checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType


#: Padded keys appear as 128 hex digits; plans, event logs and explain show them masked.
KEY_MATERIAL = "[0-9A-Fa-f]{128}"


def build_session(app_name: str = "reviewlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; cluster sizing stays with the submitter."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.redaction.string.regex", KEY_MATERIAL)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def in_utc(spark: SparkSession) -> SparkSession:
    """Dates are UTC days, whatever the zone of the machine."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach; a local one only where the cluster names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if not context._jsc.sc().getCheckpointDir().isDefined():
            context.setCheckpointDir(named)
        return named
    current = context._jsc.sc().getCheckpointDir()
    if not current.isDefined():
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="reviewlake-"))
        current = context._jsc.sc().getCheckpointDir()
    return current.get()


def pin(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cut lineage that survives lost executors.

    Parquet rather than a plain checkpoint, so that later readers still prune columns and push
    filters down. ``schema`` may read the columns back as other types with the same storage.
    """
    spark = df.sparkSession
    path = f"{_pin_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def counted_write(df: DataFrame, write: Callable[[DataFrameWriter], None]) -> int:
    """Run a write and return its number of rows, observed on the way; nothing is read again.

    The count sits in the tasks that write, of which each partition's only counts once, whatever is retried.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")).write)
    return seen.get["n"]


def _pin_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/pinned-{spark.sparkContext.applicationId}"


def release_pins(spark: SparkSession) -> None:
    """Delete what this application pinned; frames read from pins are unusable afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_pin_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once per application, before functions of it run in their Python workers."""
    context = spark.sparkContext
    if getattr(context, "_ships_reviewlake", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="reviewlake-")) / "reviewlake.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, f"{package.name}/{file.relative_to(package)}")
    context.addPyFile(str(archive))
    context._ships_reviewlake = True


def parallelism(spark: SparkSession) -> int:
    """The number of groups a hot key is spread over."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

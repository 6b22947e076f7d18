"""Scan of the raw zone: JSON lines below partitioned folders."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reviewlake.schemas import RAW_SCHEMA, SOURCE_NATURAL


class RawScan(NamedTuple):
    """Usable rows, and the rows set aside with the reason."""

    good: DataFrame
    quarantine: DataFrame


def raw_paths(
    root: str,
    sources: list[str] | None = None,
    app_ids: list[int] | None = None,
    languages: list[str] | None = None,
    days: list[str] | None = None,
) -> list[str]:
    """Folder patterns that list only the wanted partitions: pruning before any file is opened."""

    def level(name: str, values: list | None) -> str:
        return f"{name}={{{','.join(map(str, values))}}}" if values else f"{name}=*"

    tail = "/".join([level("app_id", app_ids), level("language", languages), level("dt", days)])
    wanted = sources or [SOURCE_NATURAL]
    paths = []
    for source in wanted:
        prefix = "" if source == SOURCE_NATURAL else f"sample={source}/"
        paths.append(f"{root.rstrip('/')}/{prefix}{tail}")
    return paths


def scan_raw(spark: SparkSession, paths: str | list[str]) -> RawScan:
    """Read every JSON-lines file below the paths; the partition values come from the path.

    A broken line, a file outside the partition layout, or a review without id, creation time or
    vote is set aside and kept visible instead of being guessed or silently lost.
    """
    lines = (
        spark.read.schema(RAW_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{jsonl,json}")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(paths)
    )
    return split_raw(with_path_columns(lines, F.col("_metadata.file_path")))


def decoded(value: Column) -> Column:
    """Percent escapes undone; a value whose escapes are not valid is taken as it is."""
    return F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value)


def path_value(path: Column, name: str) -> Column:
    """The value of ``name=value`` in a file's path, null without one.

    Spark escapes some characters when it names a folder, and the path of a file is handed out as a URI, which escapes
    those of the folder again: values are decoded twice, after the path is cut at its slashes.
    """
    found = F.nullif(F.regexp_extract(path, f"/{name}=([^/]+)/", 1), F.lit(""))
    value = decoded(decoded(found))
    return F.nullif(value, F.lit(NO_VALUE))


#: The folder value that stands for null or an empty string.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def with_path_columns(lines: DataFrame, path) -> DataFrame:
    """Partition values found in the path; they win over the fields of the review itself."""
    placed = lines.withColumn("source_file", path)
    at = F.col("source_file")
    return placed.withColumns(
        {
            "app_id": F.expr("try_cast(regexp_extract(source_file, '/app_id=([0-9]+)/', 1) AS bigint)"),
            "language": path_value(at, "language"),
            "sample_source": F.coalesce(path_value(at, "sample"), F.lit(SOURCE_NATURAL)),
        }
    )


def split_raw(placed: DataFrame) -> RawScan:
    """Separate usable rows from the others; only lines without any content are passed over."""
    blank = F.coalesce(F.trim("_corrupt_record") == "", F.lit(False))
    reason = (
        F.when(F.col("_corrupt_record").isNotNull(), "invalid json")
        .when(F.col("app_id").isNull() | F.col("language").isNull(), "outside the partition layout")
        .when(F.col("recommendationid").isNull(), "missing id")
        .when(F.col("timestamp_created").isNull(), "missing creation time")
        .when(F.col("voted_up").isNull(), "missing vote")
    )
    judged = placed.filter(~blank).withColumn("reason", reason)
    return RawScan(
        good=judged.filter(F.col("reason").isNull()).drop("reason", "_corrupt_record"),
        quarantine=judged.filter(F.col("reason").isNotNull()).select(
            "source_file",
            "reason",
            "recommendationid",
            F.col("_corrupt_record").alias("line"),
        ),
    )

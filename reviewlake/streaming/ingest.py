"""New raw files, as they land, appended once each to the raw zone."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewlake.schemas import RAW_SCHEMA
from reviewlake.sources.raw import split_raw, with_path_columns
from reviewlake.sources.raw_zone import RawZone


def stream_ingest(
    spark: SparkSession, landing: str, zone_root: str, checkpoint: str, day: dt.date
) -> StreamingQuery:
    """Consume what the landing folder holds now and stop; run again to go on.

    A batch is named by the id that the checkpoint gives the stream and its number there: a
    micro-batch replayed after a loss is recognised, and another stream on the same zone cannot take
    its name. Seen keys live in the zone, not in stream state, so the state does not grow with the
    history. Rows set aside are stored with their reason.
    """
    landed = (
        spark.readStream.schema(RAW_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{jsonl,json}")
        .json(landing)
    )
    placed = with_path_columns(landed, F.col("_metadata.file_path"))

    def append(batch: DataFrame, number: int) -> None:
        zone = RawZone(batch.sparkSession, zone_root)
        zone.append(split_raw(batch), f"stream-{_stream_id(spark, checkpoint)}-{number:012d}", day)

    return (
        placed.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the checkpoint keeps for its stream."""
    metadata = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(metadata)["id"]

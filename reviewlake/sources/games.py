"""The typed seed of followed games."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewlake.schemas import DIM_GAME_SCHEMA


def read_games(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and declared types: nothing is inferred."""
    return spark.read.schema(DIM_GAME_SCHEMA).option("header", True).csv(path)

"""Contiguous shards of near-equal bytes: global prefix sums from per-partition totals, cut at equal targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import ranged_sums, table, text_or_empty

#: What a row costs besides its text.
ROW_BYTES = 16
SHARDS = 40


def assign_shards(sized: DataFrame, order: list[str], shards: int, size: str = "size") -> DataFrame:
    """Add `shard` (0 to shards - 1) and `slot` (gapless from 0 in each shard) to rows with a positive long `size`.

    Rows are laid end to end in the order of `order` and a row belongs to the shard in whose equal share of the
    bytes its midpoint lies, so a shard differs from its target by at most one row's size at either end. A row
    larger than a share leaves shards without rows. Nulls in `order` come first; rows that tie in all of `order`
    take consecutive places in any sequence. An empty frame gives an empty result.
    """
    spark = sized.sparkSession
    laid, total, _ = ranged_sums(sized, order, size)
    middle = F.expr(f"((2 * start + `{size}`) * {int(shards)}) div {max(2 * total, 1)}")
    cut = laid.withColumn("shard", F.least(middle, F.lit(shards - 1)).cast("int"))
    firsts = [tuple(r) for r in cut.groupBy("shard").agg(F.min("index")).collect()]  # at most `shards` rows
    starts = spark.createDataFrame(firsts, "shard int, first_index long")
    return (
        cut.join(F.broadcast(starts), "shard").withColumn("slot", F.col("index") - F.col("first_index"))
    ).drop("start", "index", "first_index")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The text itself is never shuffled. Null text counts as empty, a null doc_id sorts first. The position of a row
    in its file only breaks ties between equal rows, so that one repeated row spreads over partitions.
    """
    rows = docs.select(
        "doc_id",
        (F.octet_length(text_or_empty()).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text_or_empty()).alias("text_crc32"),
        F.xxhash64(F.monotonically_increasing_id()).alias("tie"),
    )
    placed = assign_shards(rows, ["doc_id", "text_crc32", "size", "tie"], shards)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))

"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions alone.

Each source is a queue of its shuffled documents, served at a rate equal to its target. A document's virtual finish
time is the cumulative words of its source up to and with it, divided by that target, so every queue reaches its target
at virtual time 1. The documents of all queues are range-sorted by finish time and cut at the total budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import table, text_or_empty
from reviewlake.session import parallelism, pin

#: Weights of the sources, repeating in their order; the words of the mix as a share of all words; uses of a document.
WEIGHTS, SHARE, REPEATS = (5, 2, 1), 1.5, 2
#: Repeated rows of one document that stand together in the shuffled order.
BLOCK = 1000
#: A word is a run of anything but ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def running(df: DataFrame, order: list[Column], **sums: str) -> DataFrame:
    """Add exclusive running sums over the global order: `name=column` adds `name`, the sum of `column` before the row.

    Rows are range-partitioned once and stored with their partition's number; windows run inside a partition, and one
    total per partition is added up in a second window. Rows should not tie in all of `order`. A key that many rows
    share does not matter: ranges follow the whole order.
    """
    parts = pin(df.repartitionByRange(parallelism(df.sparkSession), *order).withColumn("__part", F.spark_partition_id()))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    totals = parts.groupBy("__part").agg(*(F.sum(column).alias(f"__{name}") for name, column in sums.items()))
    totals = totals.select("__part", *(F.coalesce(F.sum(f"__{n}").over(earlier), F.lit(0)).alias(f"__{n}") for n in sums))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    held = parts.withColumns({n: F.coalesce(F.sum(column).over(inside), F.lit(0)) for n, column in sums.items()})
    whole = held.join(F.broadcast(totals), "__part")  # `parallelism` rows
    return whole.withColumns({n: F.col(n) + F.col(f"__{n}") for n in sums}).drop("__part", *(f"__{n}" for n in sums))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """source, source_size, target, uses, base of each source in `sizes` (source, source_size).

    Sources in code point order, null last, take the weights in turn. All targets are the same level times the
    weight, but at most `repeats` times the source's size; the level is such that they add up to `share` times all
    sizes (where the caps allow it). That is where sharing out what capped sources leave comes to rest. `uses` is how
    often the source's documents are queued, `base` the words that earlier sources queue.
    """
    by_name = F.col("source").asc_nulls_last()
    ranked = running(sizes.select("source", "source_size", F.lit(1).cast("long").alias("one")), [by_name], rank="one")
    turn = F.array(*(F.lit(float(w)) for w in weights))
    queued = ranked.select(
        "source",
        "source_size",
        "rank",
        F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(float(repeats))).alias("cap"),
    ).withColumn("full", F.col("cap") / F.col("weight"))
    filled = pin(running(queued, [F.col("full"), F.col("rank")], caps="cap", weights="weight"))
    facts = filled.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words, weight = facts["words"] or 0, facts["weight"] or 0.0
    level = (F.lit(share * words) - F.col("caps")) / (F.lit(weight) - F.col("weights"))
    reached = filled.select(level.alias("level"), "full").filter("level <= full").agg(F.max("level")).first()[0]
    target = F.col("cap") if reached is None else F.least("cap", F.lit(reached) * F.col("weight"))
    uses = F.when(F.col("source_size") > 0, F.greatest(F.ceil(F.col("target") / F.col("source_size")), F.lit(1))).otherwise(1)
    aimed = filled.withColumn("target", target).withColumn("uses", uses.cast("long"))
    aimed = aimed.withColumn("queued", F.col("uses") * F.col("source_size"))
    return pin(running(aimed, [by_name], base="queued").select("source", "source_size", "target", "uses", "base"))


def mixed(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """The mix: one row for each use of each document (of `copies` equal rows of it), in the order of `place`.

    Columns: doc_id, source, size (words of the text), source_size, target, block, copies, use (0 for the first),
    finish (virtual time at which it is served), place (words of the mix before it), words (that the mix takes).
    A row of a source beyond its target is served 0 words, at most one per source is cut, so the words a source gives
    are its target rounded down. Uses of a source follow each other, each in its own shuffled order, which only
    depends on doc_id, size and use: reruns agree.

    Null text has no words; null doc_id and null source are values like others; rows that agree in doc_id, source and
    size count each and are queued by up to BLOCK together; documents without words are queued and take nothing; an
    empty table gives an empty mix; other columns of `docs` are not read. Long texts only count by their words.
    """
    sized = docs.select("doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"))
    groups = pin(sized.groupBy("source", "doc_id", "size").agg(F.count("*").alias("rows")))
    sizes = groups.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = source_targets(sizes, weights, share, repeats)
    blocks = groups.select("*", F.explode(F.expr(f"sequence(0L, (rows - 1) div {BLOCK})")).alias("block")).withColumn(
        "copies", F.least(F.lit(BLOCK).cast("long"), F.col("rows") - F.col("block") * BLOCK)
    )
    aimed = targets.withColumnRenamed("source", "queue")
    items = (
        blocks.join(aimed, F.col("source").eqNullSafe(F.col("queue")))
        .select("*", F.explode(F.expr("sequence(0L, uses - 1)")).alias("use"))
        .withColumn("asked", F.col("copies") * F.col("size"))
        .withColumn("shuffled", F.md5(F.concat_ws(":", "use", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "size", "block")))
        .drop("queue", "uses", "rows")
    )
    by_name = F.col("source").asc_nulls_last()
    same = [F.col("shuffled"), F.col("doc_id"), F.col("size"), F.col("block")]
    queued = running(items, [by_name, F.col("use"), *same], before="asked")
    start = F.col("before") - F.col("base")
    left = F.floor("target").cast("long") - start
    served = F.greatest(F.least("asked", left), F.lit(0).cast("long"))
    timed = queued.withColumn("served", served).withColumn("finish", F.expr("(before - base + asked) / nullif(target, 0)"))
    # what is in service when the budget is spent is cut there: nothing is served after virtual time 1
    timed = timed.withColumn("finish", F.least("finish", F.lit(1.0))).drop("before", "base", "asked")
    budget = targets.agg(F.floor(F.sum("target")).cast("long")).first()[0] or 0
    sequence = running(timed, [F.col("finish"), by_name, F.col("use"), *same], place="served")
    words = F.greatest(F.least("served", F.lit(budget) - F.col("place")), F.lit(0).cast("long"))
    return sequence.withColumn("words", words).drop("served", "shuffled")


def taken_words(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of each document: the words that the mix takes of it."""
    used = [f"__use{k}" for k in range(repeats)]
    mix = mixed(docs, weights, share, repeats)
    row = ["source", "doc_id", "size", "block", "copies", "source_size", "target"]
    per = mix.groupBy(*row).agg(*(F.sum(F.when(F.col("use") == k, F.col("words")).otherwise(0)).alias(u) for k, u in enumerate(used)))
    each = per.select("*", F.explode(F.expr("sequence(0L, copies - 1)")).alias("copy"))
    nothing = F.lit(0).cast("long")
    shares = [F.greatest(F.least(F.col(u) - F.col("copy") * F.col("size"), F.col("size")), nothing) for u in used]
    taken = shares[0]
    for more in shares[1:]:
        taken = taken + more
    return each.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def op13_fair_mix(spark, sf_dir: str) -> DataFrame:
    return taken_words(table(spark, sf_dir, "documents")).drop("source")

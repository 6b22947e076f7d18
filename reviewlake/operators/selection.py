"""Exact ranks on data of any size, without sorting it in one place.

Ranks of a number take two passes: a sketch brackets each rank, then everything outside the brackets
is only counted and the few values inside are ordered (``values_at_ranks``). Other keys are found by
counting rows per coarse cell, then per finer cell inside the one cell that holds the wanted rank
(``keys_at_ranks``). Every pass is an aggregation with map-side combine.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Sequence
from math import ceil, floor
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlake.session import pin

#: Rank error of the sketch is one part in so many; a bracket holds about four such parts of the rows.
SKETCH = 20_000


class Located(NamedTuple):
    """A value at a rank, the number of rows below it, of rows equal to it, and of all rows."""

    value: Any
    below: int
    ties: int
    population: int


def values_at_ranks(
    rows: DataFrame,
    value: Column,
    targets: dict[str, tuple[float, Callable[[int], int]]],
    sketch: int = SKETCH,
) -> dict[str, Located]:
    """The value found at each wanted rank, exactly, in two passes over ``rows``.

    ``targets`` map a name to the share of rows at which the rank lies, give or take a row, and to the
    1-based rank as a function of the number of rows; a rank outside of them is left out. Nulls and
    NaN take no part. A bracket that a sketch puts wrongly is noticed, as the wanted rank is not in
    it, and drawn wider; the result never depends on the sketch.
    """
    present = rows.select(value.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan(F.col("v").cast("double")))
    margin = 2 / sketch
    while True:
        around = [
            F.percentile_approx("v", [max(share - margin, 0.0), min(share + margin, 1.0)], sketch).alias(name)
            for name, (share, _) in targets.items()
        ]
        first = present.agg(F.count("*").alias("population"), *around).first()
        population = first["population"]
        ranks = {name: rank(population) for name, (_, rank) in targets.items()}
        ranks = {name: rank for name, rank in ranks.items() if 1 <= rank <= population}
        if not ranks:
            return {}
        whole = population <= sketch or margin >= 1
        found = _inside_brackets(present, [] if whole else [first[name] for name in ranks], ranks)
        if len(found) == len(ranks):
            return found
        margin *= 16


def _inside_brackets(present: DataFrame, brackets: list, ranks: dict[str, int]) -> dict[str, Located]:
    """Order the values inside the brackets, count the others; all values, if there are no brackets."""
    joined: list[list] = []
    for low, high in sorted(brackets):
        if joined and low <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], high)
        else:
            joined.append([low, high])
    if joined:
        # even segments are gaps, odd ones brackets
        segment = sum(
            ((F.col("v") >= F.lit(low)).cast("int") + (F.col("v") > F.lit(high)).cast("int") for low, high in joined),
            F.lit(0),
        )
    else:
        segment = F.lit(1)
    kept = F.when(F.col("segment") % 2 == 1, F.col("v")).alias("v")
    counts = pin(
        present.withColumn("segment", segment).groupBy("segment", kept).agg(F.count("*").alias("n"))
    )
    sizes = dict(counts.groupBy("segment").agg(F.sum("n")).collect())
    before, wanted = 0, []
    for part in sorted(sizes):
        if part % 2 == 1:
            inside = sorted({rank for rank in ranks.values() if before < rank <= before + sizes[part]})
            wanted += [(part, before, rank) for rank in inside]
        before += sizes[part]
    if not wanted:
        return {}
    running = Window.partitionBy("segment").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    offsets = F.create_map(*[F.lit(x) for part, offset in sorted({w[:2] for w in wanted}) for x in (part, offset)])
    upto = F.sum("n").over(running) + offsets[F.col("segment")]
    hit = F.exists(
        F.array(*[F.lit(rank) for _, _, rank in wanted]),
        lambda rank: (rank <= F.col("upto")) & (rank > F.col("upto") - F.col("n")),
    )
    cells = [
        Located(row["v"], row["upto"] - row["n"], row["n"], before)
        for row in counts.filter(F.col("segment") % 2 == 1).withColumn("upto", upto).filter(hit).collect()
    ]
    cells.sort(key=lambda cell: cell.below)
    ends = [cell.below + cell.ties for cell in cells]
    reached = {rank for _, _, rank in wanted}
    return {name: cells[bisect_left(ends, rank)] for name, rank in ranks.items() if rank in reached}


def row_quantiles(
    rows: DataFrame, value: Column, probabilities: Sequence[float], sketch: int = SKETCH
) -> list[float]:
    """Linear-interpolation quantiles of a number over rows; an empty list where there is none."""
    targets: dict[str, tuple[float, Callable[[int], int]]] = {}
    for i, p in enumerate(probabilities):
        targets[f"{i}:lo"] = (p, lambda n, p=p: floor((n - 1) * p) + 1)
        targets[f"{i}:hi"] = (p, lambda n, p=p: ceil((n - 1) * p) + 1)
    found = values_at_ranks(rows, value, targets, sketch)
    if not found:
        return []
    quantiles = []
    for i, p in enumerate(probabilities):
        low, high = found[f"{i}:lo"], found[f"{i}:hi"]
        place = (low.population - 1) * p
        quantiles.append(float(low.value) + (float(high.value) - float(low.value)) * (place - floor(place)))
    return quantiles


def keys_at_ranks(
    df: DataFrame,
    cells: Sequence[Column],
    key: Sequence[str],
    targets: dict[str, Callable[[Column], Column]],
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """The key found at each wanted rank, as rows ``(*by, target, population, *key)``.

    ``cells`` go from coarse to fine and must follow the order of ``key``. ``targets`` map a name
    to a 1-based rank computed from the number of rows of the group; a rank outside the group
    gives no row. ``by`` must have few values (labels, windows): one row per group and target is
    broadcast.
    """
    by = list(by)
    names = [f"cell_{i}" for i in range(len(cells))]
    base = df.select(
        *by,
        *[c.alias(n) for c, n in zip(cells, names)],
        *key,
        (F.col(weight) if weight else F.lit(1)).cast("long").alias("w"),
    )
    located: DataFrame | None = None
    path = list(by)
    for depth, name in enumerate(names):
        if located is None:
            counts = base.groupBy(*by, name).agg(F.sum("w").alias("n"))
            whole = Window.partitionBy(*by)
            running = whole.orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
            wanted = F.array(
                *[
                    F.struct(
                        F.lit(target).alias("target"),
                        rank(F.col("population")).cast("long").alias("rank"),
                    )
                    for target, rank in targets.items()
                ]
            )
            spread = (
                counts.withColumn("upto", F.sum("n").over(running))
                .withColumn("population", F.sum("n").over(whole))
                .withColumn("wanted", F.explode(wanted))
                .select(*by, name, "n", "upto", "population", "wanted.target", "wanted.rank")
            )
        else:
            inside = base.join(F.broadcast(located), path)
            counts = inside.groupBy(*path, "target", "rank", "population", name).agg(
                F.sum("w").alias("n")
            )
            running = (
                Window.partitionBy(*by, "target")
                .orderBy(name)
                .rowsBetween(Window.unboundedPreceding, 0)
            )
            spread = counts.withColumn("upto", F.sum("n").over(running))
        path = list(by) + names[: depth + 1]
        located = spread.filter(
            (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n"))
        ).select(
            *path,
            "target",
            "population",
            (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"),
        )
    running = (
        Window.partitionBy(*by, "target")
        .orderBy(*key)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    last = base.join(F.broadcast(located), path).groupBy(
        *by, "target", "rank", "population", *key
    )
    return (
        last.agg(F.sum("w").alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .filter((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
        .select(*by, "target", "population", *key)
    )


def shuffle_key(identifier: Column, seed: int) -> Column:
    """A repeatable random order of identifiers, the same on every engine with SHA-256."""
    return F.sha2(F.concat(identifier.cast("string"), F.lit(f"#{seed}")), 256)


def number_cells(value: Column) -> list[Column]:
    """Four nested levels that follow the order of doubles, whatever their distribution.

    The first level is the sign, the power of two and the top four bits of the mantissa; each further
    level holds 16 bits of it. A cell of the last level is one value, and no cell has more than 65 536
    below it. NaN comes last.
    """
    x = value.cast("double")
    size = F.abs(x)
    guess = F.floor(F.log2(size))
    off = size / F.pow(F.lit(2.0), guess)
    power = guess + F.when(off < 1, -1).when(off >= 2, 1).otherwise(0)
    mantissa = (size / F.pow(F.lit(2.0), power) - 1) * 16
    parts = [(power + 1100) * 16 + F.floor(mantissa)]
    for _ in range(3):
        mantissa = (mantissa - F.floor(mantissa)) * 65536
        parts.append(F.floor(mantissa))
    sign = F.when(x < 0, -1).otherwise(1)
    odd = F.when(F.isnan(x) | (size == float("inf")), F.lit(1 << 20)).when(size == 0, F.lit(0))
    top = F.when(F.isnan(x), F.lit(1 << 21)).otherwise(sign * F.coalesce(odd, parts[0]))
    rest = [F.when(odd.isNotNull(), F.lit(0)).otherwise(sign * part) for part in parts[1:]]
    return [c.cast("long") for c in (top, *rest)]


def exact_quantiles(
    histogram: DataFrame, value: str, weight: str, probabilities: Sequence[float]
) -> DataFrame:
    """Linear-interpolation quantiles of a stored ``(value, weight)`` histogram: ``(position, quantile)``.

    Nulls and NaN take no part.
    """
    spec = [(i, float(p)) for i, p in enumerate(probabilities)]
    targets: dict[str, Callable[[Column], Column]] = {}
    for i, p in spec:
        targets[f"{i}:lo"] = lambda n, p=p: F.floor((n - 1) * F.lit(p)) + 1
        targets[f"{i}:hi"] = lambda n, p=p: F.ceil((n - 1) * F.lit(p)) + 1
    present = histogram.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    cells = number_cells(F.col(value))
    found = keys_at_ranks(present, cells, [value], targets, weight=weight)
    pieces = found.select(
        F.split("target", ":")[0].cast("int").alias("position"),
        F.split("target", ":")[1].alias("side"),
        F.col(value).cast("double").alias("v"),
        "population",
    )
    chosen = F.element_at(
        F.array(*[F.lit(p) for _, p in spec]), F.col("position") + 1
    )
    paired = pieces.groupBy("position").agg(
        F.max(F.when(F.col("side") == "lo", F.col("v"))).alias("lo"),
        F.max(F.when(F.col("side") == "hi", F.col("v"))).alias("hi"),
        F.max("population").alias("n"),
    )
    place = (F.col("n") - 1) * chosen
    return paired.select(
        "position",
        (F.col("lo") + (F.col("hi") - F.col("lo")) * (place - F.floor(place))).alias("quantile"),
    )


def chronological_halves(df: DataFrame, moment: str, identifier: str) -> DataFrame:
    """Mark the earliest ``n // 2`` rows ``reference`` and the others ``current``.

    Rows of the same moment are ordered by the digest of their identifier; rows without a moment are
    ``current`` and do not count. The one key at the cut is looked up first and becomes a literal of
    the plan; the rows themselves are never ordered or moved. Only where the cut falls among rows of
    one moment are these looked at for their digests.
    """
    digest = F.sha2(F.col(identifier).cast("string"), 256)
    micros = F.unix_micros(F.col(moment).cast("timestamp"))
    cut = values_at_ranks(df, micros, {"half": (0.5, lambda n: n // 2)}).get("half")
    if cut is None:  # fewer than two rows
        return df.withColumn("half", F.lit("current"))
    early = micros <= F.lit(cut.value)
    inside = cut.population // 2 - cut.below
    if inside < cut.ties:
        tied = df.filter(micros == F.lit(cut.value)).select(digest.alias("digest"))
        last = keys_at_ranks(
            tied, [F.substring("digest", 1, 4)], ["digest"], {"last": lambda n: F.lit(inside)}
        ).first()["digest"]
        early = (micros < F.lit(cut.value)) | ((micros == F.lit(cut.value)) & (digest <= F.lit(last)))
    return df.withColumn("half", F.when(early, "reference").otherwise("current"))


def _cut_digests(
    df: DataFrame, label: str, identifier: str, seed: int, targets: dict
) -> DataFrame:
    keyed = df.select(label, shuffle_key(F.col(identifier), seed).alias("digest"))
    return keys_at_ranks(
        keyed, [F.substring("digest", 1, 4)], ["digest"], targets, by=[label]
    )


def stratified_split(
    df: DataFrame, label: str, identifier: str, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split``: per label, exactly ``round(test_share * n)`` rows are ``test``."""
    cuts = _cut_digests(
        df, label, identifier, seed, {"test": lambda n: F.round(n * F.lit(test_share))}
    ).select(F.col(label).alias("cut_label"), F.col("digest").alias("cut_digest"))
    marked = df.join(F.broadcast(cuts), F.col(label).eqNullSafe(F.col("cut_label")), "left")
    inside = shuffle_key(F.col(identifier), seed) <= F.col("cut_digest")
    return marked.withColumn(
        "split", F.when(F.coalesce(inside, F.lit(False)), "test").otherwise("train")
    ).drop("cut_label", "cut_digest")


def stratified_folds(
    df: DataFrame, label: str, identifier: str, folds: int = 5, seed: int = 42
) -> DataFrame:
    """Add ``fold`` in ``0 … folds-1``: per label, fold sizes differ by at most one row."""
    cuts = _cut_digests(
        df,
        label,
        identifier,
        seed,
        {str(k): (lambda n, k=k: F.floor(n * k / folds)) for k in range(1, folds)},
    )
    per_label = cuts.groupBy(label).agg(F.collect_list("digest").alias("fold_cuts"))
    per_label = per_label.withColumnRenamed(label, "cut_label")
    marked = df.join(
        F.broadcast(per_label), F.col(label).eqNullSafe(F.col("cut_label")), "left"
    )
    digest = shuffle_key(F.col(identifier), seed)
    # A label with fewer rows than folds has fewer cuts; its missing cuts are empty folds at the front.
    passed = F.size(F.filter("fold_cuts", lambda c: c < digest))
    missing = F.lit(folds - 1) - F.size("fold_cuts")
    fold = F.when(F.col("fold_cuts").isNull(), F.lit(folds - 1)).otherwise(passed + missing)
    return marked.withColumn("fold", fold.cast("int")).drop("cut_label", "fold_cuts")

"""Declarative data-quality suites, evaluated in one pass over the table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from reviewlake.functions.decision import is_negative
from reviewlake.schemas import (
    CLEAN_SCHEMA,
    LANGUAGES,
    NEGATIVE_SHARE_BOUNDS,
    PERSONAL_COLUMNS,
    SOURCE_NATURAL,
    SOURCES,
    contract_differences,
)

PSEUDONYM = r"^[0-9a-f]{64}$"

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("suite", T.StringType()),
        T.StructField("check", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("unexpected_count", T.LongType()),
    ]
)


class QualityError(ValueError):
    """A blocking gate found failures; all of them are listed."""


@dataclass(frozen=True)
class Check:
    """One expectation.

    ``bad`` flags unexpected rows (row checks); ``unique`` checks need a grouping of their own;
    ``table`` checks judge the aggregate or the columns.
    """

    name: str
    column: str | None = None
    bad: Callable[[Column], Column] | None = None
    unique: bool = False
    min_rows: int | None = None
    columns: tuple[str, ...] | None = None


def columns_match(columns: Sequence[str]) -> Check:
    return Check("columns_match", columns=tuple(columns))


def row_count(at_least: int = 1) -> Check:
    return Check("row_count", min_rows=at_least)


def not_null(column: str) -> Check:
    return Check("not_null", column, bad=lambda c: c.isNull())


def unique(column: str) -> Check:
    return Check("unique", column, unique=True)


def in_set(column: str, values: Sequence) -> Check:
    return Check("in_set", column, bad=lambda c: ~c.isin(list(values)))


def between(column: str, low: float | None = None, high: float | None = None) -> Check:
    def outside(c: Column) -> Column:
        bad = F.lit(False)
        if low is not None:
            bad = bad | (c < low)
        if high is not None:
            bad = bad | (c > high)
        return bad

    return Check("between", column, bad=outside)


def matches(column: str, pattern: str) -> Check:
    return Check("matches", column, bad=lambda c: ~c.rlike(pattern))


# The five suites.


def clean_zone_suite(languages: Sequence[str] = LANGUAGES) -> list[Check]:
    return [
        columns_match(CLEAN_SCHEMA.fieldNames()),
        row_count(1),
        *[not_null(c) for c in ("review_id", "review_text", "created_at", "author_pseudo")],
        unique("review_id"),
        in_set("label", (0, 1)),
        in_set("language", languages),
        in_set("sample_source", SOURCES),
        between("text_len", low=1),
        between("weighted_vote_score", low=0, high=1),
        between("votes_up", low=0),
        between("playtime_at_review_min", low=0),
        matches("author_pseudo", PSEUDONYM),
    ]


def silver_reviews_suite(languages: Sequence[str] = LANGUAGES) -> list[Check]:
    return [
        row_count(1),
        not_null("review_id"),
        unique("review_id"),
        in_set("label", (0, 1)),
        in_set("language", languages),
        in_set("sample_source", SOURCES),
        between("text_len", low=1),
        matches("author_pseudo", PSEUDONYM),
    ]


def silver_predictions_suite() -> list[Check]:
    return [
        row_count(1),
        not_null("review_id"),
        unique("review_id"),
        in_set("pred_label", (0, 1)),
        between("proba_negative", low=0, high=1),
        between("decision_threshold", low=0, high=1),
        not_null("model_version"),
    ]


def gold_facts_suite(languages: Sequence[str] = LANGUAGES) -> list[Check]:
    return [
        row_count(1),
        not_null("review_id"),
        unique("review_id"),
        in_set("pred_label", (0, 1)),
        between("proba_negative", low=0, high=1),
        in_set("sample_source", SOURCES),
        in_set("language", languages),
    ]


def gold_mart_suite(languages: Sequence[str] = LANGUAGES) -> list[Check]:
    return [
        row_count(1),
        between("n_reviews", low=1),
        between("share_pred_negative", low=0, high=1),
        between("share_actual_negative", low=0, high=1),
        between("n_pred_negative", low=0),
        between("n_actual_negative", low=0),
        in_set("language", languages),
    ]


def run_suite(
    df: DataFrame, name: str, checks: Sequence[Check], nulls_fail: bool = False
) -> DataFrame:
    """One row per check: ``suite, check, column, success, unexpected_count``.

    All row checks share a single aggregation; each uniqueness check adds one grouped count over
    its key alone. Every check is evaluated. A null is ignored by value checks unless
    ``nulls_fail``.
    """
    absent = [c for c in checks if c.column and c.column not in df.columns]
    static: list[tuple[Check, int]] = [(c, 1) for c in absent]
    counted: list[Check] = []
    distinct: list[Check] = []
    for check in checks:
        if check in absent:
            continue
        if check.columns is not None:
            static.append((check, 0 if tuple(df.columns) == check.columns else 1))
        elif check.unique:
            distinct.append(check)
        else:
            counted.append(check)

    def outcome(check: Check, unexpected: Column) -> Column:
        return F.struct(
            F.lit(name).alias("suite"),
            F.lit(check.name).alias("check"),
            F.lit(check.column).cast("string").alias("column"),
            (unexpected == 0).alias("success"),
            unexpected.cast("long").alias("unexpected_count"),
        )

    measures, outcomes = [], []
    for i, check in enumerate(counted):
        if check.min_rows is not None:
            measures.append(F.greatest(F.lit(check.min_rows) - F.count("*"), F.lit(0)).alias(f"m{i}"))
        else:
            bad = F.coalesce(
                check.bad(F.col(check.column)), F.lit(nulls_fail and check.name != "not_null")
            )
            measures.append(F.count_if(bad).alias(f"m{i}"))
        outcomes.append(outcome(check, F.col(f"m{i}")))
    outcomes += [outcome(check, F.lit(count)) for check, count in static]
    if not measures:
        measures = [F.count("*").alias("rows")]
    results = df.agg(*measures).select(F.inline(F.array(*outcomes))) if outcomes else None
    for check in distinct:
        repeated = (
            (df if nulls_fail else df.filter(F.col(check.column).isNotNull()))
            .groupBy(check.column)
            .agg(F.count("*").alias("copies"))
            .filter(F.col("copies") > 1)
            .agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("m"))
            .select(F.inline(F.array(outcome(check, F.col("m")))))
        )
        results = repeated if results is None else results.unionByName(repeated)
    return results


def suite_verdict(results: DataFrame) -> DataFrame:
    """One row per suite: evaluated, failed, success."""
    return results.groupBy("suite").agg(
        F.count("*").alias("evaluated"),
        F.count_if(~F.col("success")).alias("failed"),
        F.bool_and("success").alias("success"),
    )


def negative_share(df: DataFrame, bounds: tuple[float, float] = NEGATIVE_SHARE_BOUNDS) -> DataFrame:
    """Share of negative reviews in the natural flow and whether it is plausible."""
    share = F.avg(is_negative(F.col("label")).cast("int"))
    return (
        df.filter(F.col("sample_source") == SOURCE_NATURAL)
        .agg(F.count("*").alias("n_natural"), share.alias("negative_share"))
        .withColumn(
            "success",
            F.coalesce(F.col("negative_share").between(*bounds), F.lit(False)),
        )
    )


def gate_results(df: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """The blocking checks of the clean zone that look at rows (nulls are bad values here)."""
    checks = [
        row_count(1),
        not_null("review_id"),
        unique("review_id"),
        in_set("label", (0, 1)),
        in_set("language", languages),
        in_set("sample_source", SOURCES),
        Check("between", "text_len", bad=lambda c: F.coalesce(c < 1, F.lit(False))),
        matches("author_pseudo", PSEUDONYM),
    ]
    rows = run_suite(df, "gate", checks, nulls_fail=True)
    if not {"label", "sample_source"} <= set(df.columns):
        return rows
    share = negative_share(df).select(
        F.lit("gate").alias("suite"),
        F.lit("negative_share").alias("check"),
        F.lit("label").alias("column"),
        "success",
        F.when(F.col("success"), 0).otherwise(1).cast("long").alias("unexpected_count"),
    )
    return rows.unionByName(share)


def assert_quality(df: DataFrame, languages: Sequence[str] = LANGUAGES) -> None:
    """Raise with every failure of the clean-zone gate; return quietly when there is none."""
    problems = contract_differences(df, CLEAN_SCHEMA)
    leaked = sorted(set(df.columns) & set(PERSONAL_COLUMNS))
    if leaked:
        problems.append(f"personal columns present: {leaked}")
    failures = gate_results(df, languages).filter(~F.col("success")).collect()
    problems += [f"{r['check']} on {r['column']}: {r['unexpected_count']} unexpected" for r in failures]
    if problems:
        raise QualityError("; ".join(problems))


def assert_suites(results: DataFrame) -> None:
    """Raise when any check of any suite failed."""
    failures = results.filter(~F.col("success")).collect()
    if failures:
        raise QualityError(
            "; ".join(
                f"{r['suite']}.{r['check']}({r['column']}): {r['unexpected_count']} unexpected"
                for r in failures
            )
        )

"""Labels, thresholds and bands."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from reviewlake.schemas import (
    DEFAULT_THRESHOLD,
    LABEL_NEGATIVE,
    LABEL_POSITIVE,
    SOURCE_NATURAL,
)


def predicted_label(proba_negative: Column, threshold: Column | float) -> Column:
    """Negative as soon as the probability reaches the threshold."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (
        F.when(proba_negative >= limit, LABEL_NEGATIVE).otherwise(LABEL_POSITIVE).cast("long")
    )


def label_name(label: Column) -> Column:
    """``negative`` or ``positive``; anything else stops the job."""
    return (
        F.when(label == LABEL_NEGATIVE, "negative")
        .when(label == LABEL_POSITIVE, "positive")
        .otherwise(F.raise_error(F.concat(F.lit("unknown label "), F.coalesce(label.cast("string"), F.lit("null")))))
    )


def effective_threshold(threshold: Column) -> Column:
    """The threshold stored with a model, or the default one."""
    return F.coalesce(threshold, F.lit(DEFAULT_THRESHOLD))


def source_priority(source: Column) -> Column:
    """The natural flow wins over any other."""
    return F.when(source == SOURCE_NATURAL, 0).otherwise(1)


def psi_band(psi: Column) -> Column:
    """Reading of a population stability index (fixed band names)."""
    return (
        F.when(psi < 0.1, "stable").when(psi < 0.2, "à surveiller").otherwise("dérive")
    )


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def is_negative(label: Column) -> Column:
    return label == LABEL_NEGATIVE


def version_number(version: Column) -> Column:
    """Versions are numbers kept as text: 10 comes after 9."""
    return version.cast("bigint")

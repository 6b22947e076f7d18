"""Why a review was scored the way it was."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlake.operators.features import (
    WORDS,
    document_terms,
    small_side,
    sublinear,
    weighted_words,
    with_countable,
    with_terms,
)
from reviewlake.operators.scoring import LinearModel


def local_contributions(
    reviews: DataFrame, model: LinearModel, n: int | None = 10, text: str = "review_text"
) -> DataFrame:
    """The ``n`` terms of each review that weigh most, either way: ``(review_id, rank, term, contribution)``.

    A contribution is the normalised weight times the coefficient toward the negative class; all of
    them (``n=None``) plus the intercept add up to the decision margin. A review without a known
    term keeps one row of nulls.
    """
    review = Window.partitionBy("review_id")
    strongest_first = review.orderBy(F.round(F.abs("push"), 9).desc(), F.col("term"))
    docs = with_countable(reviews, model.vectorizer, text) if n is not None else reviews
    weighted = weighted_words(model.terms) if WORDS in docs.columns and "terms" not in docs.columns else None
    if n is not None and weighted:
        pushes = docs.select("review_id", F.inline(_strongest_words(F.col(WORDS), weighted, n)))
    else:
        pushes = _weighted_terms(reviews, model, text).withColumn("square", F.col("raw") * F.col("raw"))
    # rank and norm come from one exchange, so that the text is taken apart once
    ranked = pushes.select(
        "review_id",
        F.row_number().over(strongest_first).alias("rank"),
        "term",
        (F.col("push") / F.sqrt(F.sum("square").over(review))).alias("contribution"),
    )
    shown = ranked if n is None else ranked.filter(F.col("rank") <= n)
    return reviews.select("review_id").join(shown, "review_id", "left")


def _strongest_words(words: Column, weighted, n: int) -> Column:
    """``array<struct<term, push, square>>``: all words of a text that can be among its ``n`` strongest to nine digits.

    ``square`` is that of the whole text, on the first word, zero on the others.
    """

    def strongest(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("term", pa.string()), ("push", pa.float64()), ("square", pa.float64())]))
        parts = [pa.array([], kind)]
        for rows, names, row, place, raw, push in weighted(texts):
            size = np.abs(push)
            order = np.lexsort((-size, row))
            row, place, push, size = row[order], place[order], push[order], size[order]
            n_terms = np.bincount(row, minlength=rows)
            first = np.cumsum(n_terms) - n_terms
            # rounding moves a size by half a unit of the ninth digit at most
            least = size[first[row] + np.minimum(n_terms[row], n) - 1] - 2e-9
            square = np.zeros(len(row))
            some = np.flatnonzero(n_terms)
            square[first[some]] = np.bincount(row, (raw * raw)[order], rows)[some]
            kept = size >= least
            ends = np.concatenate(([0], np.cumsum(np.bincount(row[kept], minlength=rows))))
            columns = [names.take(pa.array(place[kept])), pa.array(push[kept]), pa.array(square[kept])]
            found = pa.StructArray.from_arrays(columns, ["term", "push", "square"])
            parts.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found).cast(kind))
        return pa.concat_arrays(parts)

    strongest.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(strongest, "array<struct<term: string, push: double, square: double>>")(words)


def contribution_sums(reviews: DataFrame, model: LinearModel, text: str = "review_text") -> DataFrame:
    """``(review_id, n_terms, margin)``: all contributions of a review added up, one aggregation."""
    sums = _weighted_terms(reviews, model, text).groupBy("review_id").agg(
        F.count("*").alias("n_terms"),
        (F.sum("push") / F.sqrt(F.sum(F.col("raw") * F.col("raw")))).alias("margin"),
    )
    return (
        reviews.select("review_id")
        .join(sums, "review_id", "left")
        .select(
            "review_id",
            F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
            F.coalesce("margin", F.lit(0.0)).alias("margin"),
        )
    )


def _weighted_terms(reviews: DataFrame, model: LinearModel, text: str) -> DataFrame:
    """``(review_id, term, raw, push)``: the weight before normalisation, and that times the coefficient."""
    docs = with_terms(reviews, model.vectorizer, text)
    known = small_side(
        model.terms.select("term", "idf", "coef_neg"), model.vectorizer.max_features
    )
    raw = sublinear(F.col("tf")) * F.col("idf")
    weighted = document_terms(docs, "review_id").join(known, "term").withColumn("raw", raw)
    return weighted.select("review_id", "term", "raw", (F.col("raw") * F.col("coef_neg")).alias("push"))


def global_terms(model: LinearModel, n: int = 20) -> DataFrame:
    """The ``n`` strongest terms toward each class; only coefficients that really point there."""

    def toward(direction: str, sign: int) -> DataFrame:
        weight = F.col("coef_neg") * sign
        return (
            model.terms.select(F.lit(direction).alias("direction"), "term", weight.alias("weight"))
            .filter(F.col("weight") > 0)
            .orderBy(F.col("weight").desc(), "term")
            .limit(n)
        )

    return toward("negative", 1).unionByName(toward("positive", -1))


def extreme_coefficients(model: LinearModel, n: int = 20) -> DataFrame:
    """Both ends of the coefficient list, toward the positive class, as kept with a training run."""
    signed = model.terms.select("term", (-F.col("coef_neg")).alias("coefficient"))
    lowest = signed.orderBy("coefficient", "term").limit(n).withColumn("end", F.lit("negative"))
    highest = (
        signed.orderBy(F.col("coefficient").desc(), "term").limit(n).withColumn("end", F.lit("positive"))
    )
    return lowest.unionByName(highest)

"""Text features as long tables: term counts, vocabulary, TF-IDF."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from reviewlake.functions.text import (
    COUNTED,
    analyzed_counts,
    count_in_pieces,
    counted_words,
    padded_words,
    spaced_words,
    word_pieces,
)
from reviewlake.operators.selection import keys_at_ranks
from reviewlake.session import pin, ship_package

#: Bytes of counted words that a task adds up before it sends any on, and the rows of a batch that it sends.
COUNT_BYTES, ROWS_SENT = 64 << 20, 100_000
BROADCASTABLE_TERMS = 1_000_000  # a vocabulary capped at this size is safe to broadcast


@dataclass(frozen=True)
class Vectorizer:
    """How texts become terms (fixed defaults of the sentiment model)."""

    analyzer: str = "char_wb"
    ngram_range: tuple[int, int] = (2, 5)
    min_df: int = 2
    max_features: int | None = 100_000

    def counts(self, text: Column) -> Column:
        return analyzed_counts(text, self.analyzer, self.ngram_range)

    @property
    def single_words(self) -> bool:
        return self.analyzer == "word" and tuple(self.ngram_range) == (1, 1)

    @property
    def broadcastable(self) -> bool:
        return self.max_features is not None and self.max_features <= BROADCASTABLE_TERMS


#: The column of words that are stored to be counted: one string takes a fraction of the room and time of its counts.
WORDS = "spaced_words"
#: The column of words, parted at blanks, whose character n-grams are to be counted.
PARTED = "parted_words"
CHAR_TERMS = Vectorizer()
# A linear model keeps its coefficients on one machine, hence the cap.
WORD_TERMS = Vectorizer(analyzer="word", ngram_range=(1, 2), max_features=BROADCASTABLE_TERMS)


def with_terms(df: DataFrame, vectorizer: Vectorizer, text: str = "review_text") -> DataFrame:
    """Add ``terms array<struct<term, tf>>``; counting happens inside the row. Stored counts (a column ``terms``) are kept."""
    if "terms" in df.columns:
        return df
    if vectorizer.single_words and WORDS in df.columns:
        return df.withColumn("terms", counted_words(F.col(WORDS)))
    if vectorizer.analyzer == "char_wb":
        ship_package(df.sparkSession)
        shortest, longest = vectorizer.ngram_range
        schema = T.StructType([*df.schema.fields, T.StructField("terms", T.DataType.fromDDL(COUNTED))])
        worded = df.withColumn("padded words", padded_words(F.col(text)))
        return worded.mapInArrow(lambda batches: count_in_pieces(batches, shortest, longest), schema)
    return df.withColumn("terms", vectorizer.counts(F.col(text)))


def with_words(df: DataFrame, text: str = "review_text") -> DataFrame:
    """Add the single words of the text as one string; stored ones are kept."""
    return df if WORDS in df.columns else df.withColumn(WORDS, spaced_words(F.col(text)))


def with_countable(df: DataFrame, vectorizer: Vectorizer, text: str = "review_text") -> DataFrame:
    """Add what scores are made of: the words, where the weights of single words fit into every task, else the terms."""
    if vectorizer.single_words and vectorizer.broadcastable and "terms" not in df.columns:
        return with_words(df, text)
    return with_terms(df, vectorizer, text)


def document_terms(df: DataFrame, *keep: str) -> DataFrame:
    """One row per document and distinct term; a document without terms keeps one null row."""
    return df.select(*keep, F.inline_outer("terms"))


def term_statistics(docs: DataFrame, vectorizer: Vectorizer, **extra: Column) -> DataFrame:
    """``(term, df, cf)`` of the terms worth keeping, plus ``extra`` aggregates over their documents.

    Terms below ``min_df`` go first. With a cap, the counts are stored; when there are more terms than
    the cap, those above the corpus frequency at which it is reached are kept whole, and the ties at
    that frequency are taken in the order of their digest. Nothing is sorted as a whole.
    """
    rest = [c for c in docs.columns if c != "terms"] if extra else []
    # An inner generator would first filter by the size of the terms, which counts every text once more.
    counted = (
        document_terms(docs, *rest)
        .filter(F.col("term").isNotNull())
        .groupBy("term")
        .agg(
            F.count("*").alias("df"),
            F.sum("tf").alias("cf"),
            *[column.alias(name) for name, column in extra.items()],
        )
        .filter(F.col("df") >= vectorizer.min_df)
    )
    return _capped(counted, vectorizer.max_features)


def word_statistics(docs: DataFrame, vectorizer: Vectorizer, marked: str) -> DataFrame:
    """``(term, df, cf, df_marked)`` of stored words, chosen as by ``term_statistics``; ``df_marked`` counts the documents
    whose boolean column ``marked`` is true.
    """
    counted = words_of_tasks(docs, marked).groupBy("term").agg(*(F.sum(c).alias(c) for c in ("df", "cf", "df_marked")))
    return _capped(counted.filter(F.col("df") >= vectorizer.min_df), vectorizer.max_features)


def words_of_tasks(docs: DataFrame, marked: str) -> DataFrame:
    """``(term, df, cf, df_marked)`` as far as each task has them.

    A task adds up its texts in pieces and the pieces in tables of some megabytes, so a word of a table is one row, however
    many texts hold it.
    """
    pieces, names, most = word_pieces(), ["term", "df", "cf", "df_marked"], COUNT_BYTES

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for counts in of_pieces(batches):
            held, size = [*held, counts], size + counts.nbytes
            if size > most:
                held, size = merged(held)
                if 2 * size > most:
                    yield from held[0].to_batches(ROWS_SENT)
                    held, size = [], 0
        if held:
            yield from merged(held)[0][0].to_batches(ROWS_SENT)

    def merged(held: list) -> tuple[list, int]:
        added = pa.concat_tables(held).group_by("term", use_threads=False).aggregate([(c, "sum") for c in names[1:]])
        total = added.select(["term", *(f"{c}_sum" for c in names[1:])]).rename_columns(names).combine_chunks()
        return [total], total.nbytes

    def of_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for batch in batches:
            marks, at = pc.fill_null(batch.column(1), False).to_numpy(zero_copy_only=False), 0
            for rows, terms, row, code, tf in pieces(batch.column(0)):
                n = len(terms)
                df = np.bincount(code, minlength=n)
                found = np.flatnonzero(df)
                of_marked = np.bincount(code[marks[at : at + rows][row]], minlength=n)
                cf = np.bincount(code, tf, n).astype(np.int64)
                columns = [terms.take(pa.array(found)), *(pa.array(c[found], pa.int64()) for c in (df, cf, of_marked))]
                yield pa.Table.from_arrays(columns, names)
                at += rows

    return docs.select(WORDS, marked).mapInArrow(add_up, "term string, df long, cf long, df_marked long")


def _capped(counted: DataFrame, cap: int | None) -> DataFrame:
    if cap is None:
        return counted
    counted = pin(counted)
    return counted.filter(above_cap(counted, cap))


def above_cap(counted: DataFrame, cap: int, cf: str = "cf") -> Column:
    """The condition that a counted term is among the ``cap`` most frequent ones.

    Terms above the frequency at which the cap is reached are kept whole; the ties at that frequency
    are taken in the order of their digest. Nothing is sorted as a whole.
    """
    if counted.count() <= cap:
        return F.lit(True)
    downward = Window.orderBy(F.col(cf).desc()).rowsBetween(Window.unboundedPreceding, 0)
    edge = (
        counted.groupBy(cf)
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(downward))
        .filter(F.col("upto") >= cap)
        .orderBy(F.col(cf).desc())
        .first()
    )
    wanted = cap - (edge["upto"] - edge["n"])
    digest = F.sha2("term", 256)
    tied = counted.filter(F.col(cf) == edge[cf]).select(digest.alias("digest"))
    last = keys_at_ranks(
        tied, [F.substring("digest", 1, 4)], ["digest"], {"last": lambda n: F.lit(wanted)}
    ).first()["digest"]
    return (F.col(cf) > edge[cf]) | ((F.col(cf) == edge[cf]) & (digest <= last))


def smoothed_idf(documents: Column, document_frequency: Column) -> Column:
    return F.log((1 + documents) / (1 + document_frequency)) + 1


def vocabulary(docs: DataFrame, vectorizer: Vectorizer) -> DataFrame:
    """``(term, df, cf, idf)`` with the smoothed inverse document frequency."""
    total = docs.agg(F.count("*").alias("n"))
    return term_statistics(docs, vectorizer).withColumn(
        "idf", smoothed_idf(total.scalar(), F.col("df"))
    )


def sublinear(tf: Column) -> Column:
    return 1 + F.log(tf.cast("double"))


def weighted_words(terms: DataFrame) -> Callable[[pa.Array], Iterator[tuple]] | None:
    """A function over spaced texts: pieces ``(rows, terms, row, place, raw, push)`` of their known words.

    ``row`` and ``place`` (in ``terms``) tell text and word, ``raw`` is the weight before normalisation and ``push`` that
    times the coefficient. ``terms(term, idf, coef_neg)`` has to be capped, since it goes to every task. None, where
    a term is repeated or a weight is missing or not finite: joins tell what that means.
    """
    known = terms.select("term", F.col("idf").cast("double"), F.col("coef_neg").cast("double")).toArrow().combine_chunks()
    names, idf, coef = (c.combine_chunks() for c in known.columns)
    whole = all(not c.null_count and np.isfinite(c.to_numpy()).all() for c in (idf, coef))
    if not whole or names.null_count or pc.count_distinct(names).as_py() < len(names):
        return None
    shared = terms.sparkSession.sparkContext.broadcast((names, idf.to_numpy(), coef.to_numpy()))
    pieces = word_pieces(lambda: shared.value[0])

    def weighted(texts: pa.Array) -> Iterator[tuple]:
        _, idf, coef = shared.value
        for rows, names, row, place, tf in pieces(texts):
            raw = (1 + np.log(tf)) * idf[place]
            yield rows, names, row, place, raw, raw * coef[place]

    return weighted


def small_side(terms: DataFrame, size_limit: int | None) -> DataFrame:
    """Broadcast a vocabulary only when its cap proves it small; otherwise the planner decides."""
    if size_limit is not None and size_limit <= BROADCASTABLE_TERMS:
        return F.broadcast(terms)
    return terms


def tfidf(
    docs: DataFrame, terms: DataFrame, *keep: str, size_limit: int | None = None
) -> DataFrame:
    """L2-normalised weights, one row per document and known term: ``(*keep, term, tfidf)``.

    ``keep`` starts with the document id.
    """
    raw = (
        document_terms(docs, *keep)
        .filter(F.col("term").isNotNull())
        .join(small_side(terms.select("term", "idf"), size_limit), "term")
        .withColumn("raw", sublinear(F.col("tf")) * F.col("idf"))
    )
    per_document = raw.groupBy(*keep).agg(
        F.collect_list(F.struct("term", "raw")).alias("weights"),
        F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("length"),
    )
    flat = per_document.select(*keep, "length", F.inline("weights"))
    return flat.select(*keep, "term", (F.col("raw") / F.col("length")).alias("tfidf"))


def word_tfidf(docs: DataFrame, terms: DataFrame, *keep: str) -> DataFrame:
    """``tfidf`` of stored words, where ``keep`` names one text and the capped ``terms`` fit into every task.

    Each text is weighed where it lies, in one Arrow function; nothing is exchanged.
    """
    weighted = weighted_words(terms.select("term", "idf", F.lit(0.0).alias("coef_neg")))
    if weighted is None:
        return tfidf(docs.withColumn("terms", counted_words(F.col(WORDS))), terms, *keep)

    def normalised(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("term", pa.string()), ("tfidf", pa.float64())]))
        parts = [pa.array([], kind)]
        for rows, names, row, place, raw, _ in weighted(texts):
            lengths = np.sqrt(np.bincount(row, raw * raw, rows))
            ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows))))
            weights = pa.StructArray.from_arrays([names.take(pa.array(place)), pa.array(raw / lengths[row])], ["term", "tfidf"])
            parts.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), weights).cast(kind))
        return pa.concat_arrays(parts)

    normalised.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    weights = F.arrow_udf(normalised, "array<struct<term: string, tfidf: double>>")(F.col(WORDS))
    return docs.select(*keep, F.inline(weights))


def number_terms(terms: DataFrame) -> DataFrame:
    """Give each term a column number, in term order: ranges are numbered apart, then shifted.

    The driver adds up one count per range.
    """
    ranged = terms.repartitionByRange("term").sortWithinPartitions("term")
    place = F.monotonically_increasing_id()
    stored = pin(ranged.withColumn("part", F.shiftright(place, 33)).withColumn("place", place.bitwiseAND(2**33 - 1)))
    before, shifts = 0, []
    for part, n in sorted(stored.groupBy("part").agg(F.count("*")).collect()):
        shifts.append((part, before))
        before += n
    shift = F.broadcast(terms.sparkSession.createDataFrame(shifts, "part long, before long"))
    numbered = stored.join(shift, "part").withColumn("idx", (F.col("place") + F.col("before")).cast("int"))
    return numbered.drop("part", "place", "before")


def sparse_vectors(
    docs: DataFrame,
    numbered: DataFrame,
    size: int,
    *keep: str,
    size_limit: int | None = None,
) -> DataFrame:
    """One normalised sparse ML vector per document: ``(*keep, features)``.

    The entries of a document never outnumber the vocabulary. The vectors are stored as plain structs
    and read back as vectors; no row passes through Python.
    """
    weighted = (
        document_terms(docs, *keep)
        .join(small_side(numbered.select("term", "idx", "idf"), size_limit), "term", "left")
        .withColumn("raw", sublinear(F.col("tf")) * F.col("idf"))
    )
    entry = F.when(F.col("idx").isNotNull(), F.struct("idx", "raw"))
    gathered = weighted.groupBy(*keep).agg(
        F.sort_array(F.collect_list(entry)).alias("entries"),
        F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("length"),
    )
    values = F.transform("entries", lambda e: e["raw"] / F.col("length"))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        F.transform("entries", lambda e: e["idx"]).alias("indices"),
        values.alias("values"),
    )
    plain = gathered.select(*keep, vector.alias("features"))
    fields = [f for f in plain.schema if f.name != "features"]
    return pin(plain, T.StructType([*fields, T.StructField("features", VectorUDT())]))

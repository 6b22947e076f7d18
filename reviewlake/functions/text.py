"""Text cleaning and tokenisation as JVM-side column expressions."""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# Fixed patterns.
BBCODE_TAG = r"\[/?[a-zA-Z*]+(?:=[^\]]*)?\]"
UNICODE_SPACES = r"(?U)[\s\x1c-\x1f]+"
# The same runs without the lone plain spaces, which are already what they should become. One range rules out most
# characters; whether the first blank is a plain space is looked up behind it.
SPACES_TO_FOLD = r"(?U)[[^!-~]&&[\s\x1c-\x1f]](?:(?<=[^ ])[\s\x1c-\x1f]*|[\s\x1c-\x1f]+)"
# Two characters or more, in the form that Java matches in a plain loop.
WORD = r"[\p{L}\p{N}_][\p{L}\p{N}_]+"
# What parts the words of a lower-cased text, but for spaces, which part them as they are. A range like a-z in front
# made this four times slower next to SPACES_TO_FOLD: threads contend for the type checks of Java's shared range class.
NO_WORD = r"[^ \p{L}\p{N}_]"


def clean_text(text: Column) -> Column:
    """Strip tags, fold every kind of blank into one space, trim.

    Blanks are what Python splits at, so an Arrow function folds them; a text that is no valid UTF-8 goes by the pattern.
    """
    given = F.coalesce(text, F.lit(""))
    # looking for a bracket takes a fraction of the pattern's time
    untagged = F.when(F.contains(given, F.lit("[")), F.regexp_replace(given, BBCODE_TAG, "")).otherwise(given)
    folded = _per_text(lambda text: " ".join(text.split()))(untagged)
    return F.coalesce(folded, F.trim(F.regexp_replace(untagged, SPACES_TO_FOLD, " ")))


def _per_text(change: Callable[[str], str]) -> Callable[[Column], Column]:
    """An Arrow function of one text; null where Python cannot read it or ``change`` cannot encode it.

    The function is complete in itself, so workers need no package for it.
    """

    def changed(texts: pa.Array) -> pa.Array:
        found = []
        for text in texts:
            try:
                found.append(change(text.as_py()) if text.is_valid else None)
            except UnicodeError:
                found.append(None)
        return pa.array(found, pa.string())

    changed.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(changed, "string")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words of two characters or more, lower-cased, in reading order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def word_ngrams(text: Column, longest: int = 2) -> Column:
    """Word n-grams of 1 to ``longest`` words, joined by a space."""

    def sized(tokens: Column, n: int) -> Column:
        starts = F.when(
            F.size(tokens) >= n, F.sequence(F.lit(0), F.size(tokens) - n)
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(
            starts, lambda i: F.concat_ws(" ", *[F.get(tokens, i + k) for k in range(n)])
        )

    return bind(
        words(text),
        lambda tokens: F.concat(tokens, *[sized(tokens, n) for n in range(2, longest + 1)]),
    )


def padded_words(text: Column) -> Column:
    """Lower-cased words between blanks of any kind, a space on either side."""
    pieces = F.filter(F.split(F.lower(text), UNICODE_SPACES), lambda w: w != "")
    return F.transform(pieces, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))


def ngrams_of(padded: str, shortest: int, longest: int) -> list[str]:
    """The n-grams of one padded word, with repeats; a word shorter than n counts once."""
    found = []
    for n in range(min(shortest, len(padded)), min(longest, len(padded)) + 1):
        found += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    return found


#: What an analyzer gives, and the rows whose n-grams are in memory at once.
COUNTED, ROWS_AT_ONCE = "array<struct<term: string, tf: bigint>>", 256
#: Words whose n-grams a Python worker keeps at hand; two kilobytes each.
KNOWN_WORDS = 20_000


def char_ngram_counts(text: Column, shortest: int = 2, longest: int = 5) -> Column:
    """``array<struct<term, tf>>``: character n-grams inside each padded word, counted inside the row.

    Words are counted first, then each distinct one adds its n-grams as often as it stands. As nested array functions
    the same work ran interpreted (figures in the README), so it is one Arrow function over the words.
    """

    def count(words: pa.Array) -> pa.Array:
        return count_ngrams(words, shortest, longest)

    count.__annotations__ = {"words": pa.Array, "return": pa.Array}
    return F.arrow_udf(count, COUNTED)(padded_words(text))


def count_ngrams(words: pa.Array, shortest: int, longest: int) -> pa.Array:
    """The counted n-grams of each list of padded words, in the type of COUNTED."""
    texts, sizes, tf = [], [0], []
    for row in words:
        totals: dict[str, int] = {}
        for word, n in Counter(row.as_py() or ()).items():
            grams = _NGRAMS.get((word, shortest, longest))
            if grams is None:
                if len(_NGRAMS) >= KNOWN_WORDS:
                    _NGRAMS.clear()
                grams = _NGRAMS[word, shortest, longest] = ngrams_of(word, shortest, longest)
            for gram in grams:
                totals[gram] = totals.get(gram, 0) + n
        texts += totals
        tf += totals.values()
        sizes.append(len(texts))
    pairs = pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(tf, pa.int64())], ["term", "tf"])
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pairs)


def count_in_pieces(batches: Iterator[pa.RecordBatch], shortest: int, longest: int) -> Iterator[pa.RecordBatch]:
    """The last column, padded words, becomes counted n-grams; a batch goes on in pieces, since n-grams take many times
    the room of their text."""
    for batch in batches:
        names = [*batch.schema.names[:-1], "terms"]
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            piece = batch.slice(at, ROWS_AT_ONCE)
            terms = count_ngrams(piece.column(piece.num_columns - 1), shortest, longest)
            yield pa.RecordBatch.from_arrays([*piece.columns[:-1], terms], names)


_NGRAMS: dict[tuple[str, int, int], list[str]] = {}


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of a token array, counted inside the row: no shuffle.

    The array is sorted, then each run of equal neighbours is one term.
    """

    def runs(ordered: Column) -> Column:
        positions = F.when(
            F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1)
        ).otherwise(F.array().cast("array<int>"))
        starts = F.filter(
            positions, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
        )
        return bind(
            starts,
            lambda at: F.transform(
                at,
                lambda start, k: F.struct(
                    F.get(ordered, start).alias("term"),
                    (F.coalesce(F.get(at, k + 1), F.size(ordered)) - start)
                    .cast("long")
                    .alias("tf"),
                ),
            ),
        )

    return bind(F.sort_array(tokens), runs)


#: What ``spaced_words`` makes of each character of Latin-1: letters and numbers in lower case, a space of any other.
LATIN_WORDS = "".join(c.lower() if c == "_" or unicodedata.category(c)[0] in "LN" else " " for c in map(chr, range(256))).encode("latin-1")
#: Bytes of words that are counted at once; ten times that in memory.
WORD_BYTES = 4 << 20


def spaced_words(text: Column) -> Column:
    """The lower-cased text with a space for whatever is no part of a word: its words, to be counted later, in one string.

    Single characters stay in it; whoever counts leaves them out. Texts whose characters all have one byte in Latin-1 are
    looked up in a table of these by an Arrow function, the others go by the pattern.
    """
    table = LATIN_WORDS
    looked_up = _per_text(lambda text: text.encode("latin-1").translate(table).decode("latin-1"))(text)
    return F.coalesce(looked_up, F.regexp_replace(F.lower(text), NO_WORD, " "))


def word_pieces(known: Callable[[], pa.Array] | None = None) -> Callable[[pa.Array], Iterator[tuple]]:
    """A function that counts the words of spaced texts, some megabytes at a time.

    Each piece is ``(rows, terms, row, code, tf)``: its number of texts, distinct words and, for each text and distinct
    word in it, the text, the place of the word in ``terms`` and its count, ordered by text and place. ``terms`` are
    those found, or what ``known`` gives: words that are not among these are left out. The function is complete in
    itself, so workers need no package for it.
    """
    # known terms are hashed anew for each piece, which pays in larger ones
    largest = WORD_BYTES if known is None else 4 * WORD_BYTES

    def pieces(texts: pa.Array) -> Iterator[tuple]:
        upto = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            done = int(upto[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(upto, done + largest, side="right")))
            words = pc.split_pattern(texts.slice(at, end - at), " ")
            sizes = pc.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False)
            words, row = words.flatten(), np.repeat(np.arange(end - at), sizes)
            if known is None:
                coded = words.dictionary_encode()
                terms, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
                kept = pc.greater(pc.utf8_length(terms), 1).to_numpy(zero_copy_only=False)[code]
            else:
                terms = known()
                code = pc.index_in(words, value_set=terms).fill_null(-1).to_numpy(zero_copy_only=False)
                kept = code >= 0
            distinct = max(len(terms), 1)
            keys = row[kept] * distinct + code[kept]
            keys.sort()
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            tf = np.diff(first, append=len(keys))
            yield end - at, terms, *np.divmod(keys[first], distinct), tf
            at = end

    return pieces


def counted_words(spaced: Column) -> Column:
    """``array<struct<term, tf>>`` of spaced words, in the order of the terms, counted by an Arrow function."""
    pieces = word_pieces()

    def count(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int64())]))
        parts = [pa.array([], kind)]
        for rows, terms, row, code, tf in pieces(texts):
            order, rank = pc.sort_indices(terms).to_numpy(), np.empty(len(terms), np.int64)
            rank[order] = np.arange(len(order))
            sorted_keys = np.argsort(row * max(len(terms), 1) + rank[code])
            code, tf = code[sorted_keys], tf[sorted_keys]
            ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows))))
            pairs = pa.StructArray.from_arrays([terms.take(pa.array(code)), pa.array(tf, pa.int64())], ["term", "tf"])
            parts.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs))
        return pa.concat_arrays([part.cast(kind) for part in parts])

    count.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(count, COUNTED)(spaced)


def word_counts(text: Column) -> Column:
    """``array<struct<term, tf>>`` of single words, in the order of the terms; words are found in the JVM."""
    return counted_words(F.array_join(words(text), " "))


def analyzed_counts(text: Column, analyzer: str, ngram_range: tuple[int, int]) -> Column:
    """Counted terms of the named analyzer."""
    if analyzer == "char_wb":
        return char_ngram_counts(text, *ngram_range)
    if analyzer == "word" and tuple(ngram_range) == (1, 1):
        return word_counts(text)
    if analyzer == "word" and ngram_range[0] == 1:
        return term_counts(word_ngrams(text, ngram_range[1]))
    raise ValueError(f"unsupported analyzer {analyzer} {ngram_range}")


def preview(text: Column, size: int = 80) -> Column:
    """The first characters, for display only."""
    return F.substring(text, 1, size)


def shorten(text: Column, size: int = 200) -> Column:
    """Display form: an ellipsis only when something was cut."""
    return F.when(
        F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("…"))
    ).otherwise(text)

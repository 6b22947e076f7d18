"""Language identification by partial matching: per-language byte context trees score exact code lengths."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import python_ready, table

#: Bytes of context at most.
ORDER = 3
#: Bytes scored at a time.
SLICE = 1 << 20
LETTER = regex.compile(r"\p{L}")


def held_out() -> F.Column:
    """Documents whose crc32(doc_id as text) mod 4 is 2 teach nothing; a null doc_id does teach."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes end to end, the ORDER bytes before each as one number (zeros before a text), text starts."""
    padded = np.frombuffer(b"".join(b"\0" * ORDER + t for t in texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + ORDER)
    real = np.ones(len(padded), dtype=bool)
    for k in range(ORDER):
        real[ends - sizes - ORDER + k] = False
    wide = padded.astype(np.uint32)
    context = np.zeros(len(padded), dtype=np.uint32)
    context[3:] = (wide[:-3] << 16) | (wide[1:-2] << 8) | wide[2:-1]
    return padded[real], context[real], np.cumsum(sizes) - sizes


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    all_keys = np.concatenate(keys)
    unique, where = np.unique(all_keys, return_inverse=True)
    return unique, np.bincount(where, weights=np.concatenate(counts), minlength=len(unique)).astype(np.int64)


def gram_counts(labelled: DataFrame) -> DataFrame:
    """lang, gram (ORDER + 1 bytes as a number), n over all bytes of `labelled` (columns text, lang; no nulls)."""
    python_ready(labelled.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys: dict[str, list[np.ndarray]] = {}
        counts: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                data, context, _ = _laid_out([t.encode("utf-8", "surrogatepass") for t in texts])
                grams = np.sort((context << np.uint32(8)) | data)
                if not len(grams):
                    continue
                first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
                keys.setdefault(lang, []).append(grams[first])
                counts.setdefault(lang, []).append(np.diff(np.append(first, len(grams))))
                if len(keys[lang]) >= 32:
                    merged = _summed(keys[lang], counts[lang])
                    keys[lang], counts[lang] = [merged[0]], [merged[1]]
        for lang in keys:
            unique, n = _summed(keys[lang], counts[lang])
            for at in range(0, len(unique), 50_000):
                part = slice(at, at + 50_000)
                yield pd.DataFrame({"lang": lang, "gram": unique[part].astype(np.int64), "n": n[part]})

    counted = labelled.select("text", "lang").mapInPandas(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Order:
    """Contexts of one length, as sorted arrays: escape bits of each, and bits of each gram (context and next byte)."""

    contexts: np.ndarray
    escapes: np.ndarray
    grams: np.ndarray
    bits: np.ndarray


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted number stands, or would, in the sorted keys, and whether it does."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Model:
    """Frozen statistics: code lengths in bits for every context and gram that was learned, under each language."""

    def __init__(self, langs: list[str], orders: list[Order]):
        self.langs, self.orders = langs, orders

    @property
    def contexts(self) -> list[tuple[int, int]]:
        return [(k, c) for k, order in enumerate(self.orders) for c in order.contexts.tolist()]

    def lookup(self) -> list[Order]:
        """The tables to search, longest contexts first."""
        return self.orders[::-1]

    def lengths(self, lookup: list[Order], texts: list[bytes]) -> np.ndarray:
        """Bits of each non-empty text under each language."""
        data, context, starts = _laid_out(texts)
        out = np.zeros((len(texts), len(self.langs)))
        for at in range(0, len(data), SLICE):
            part = slice(at, at + SLICE)
            grams = (context[part] << np.uint32(8)) | data[part]
            bits = np.zeros((len(grams), len(self.langs)), dtype=np.float32)
            left = np.arange(len(grams))
            for k, order in zip(range(ORDER, -1, -1), lookup, strict=True):
                wanted = grams[left] & np.uint32((1 << (8 * (k + 1))) - 1)
                row, known = _found(order.grams, wanted)
                bits[left[known]] += order.bits[row[known]]
                left = left[~known]
                row, known = _found(order.contexts, wanted[~known] >> np.uint32(8))
                bits[left[known]] += order.escapes[row[known]]
            bits[left] += 8.0
            low = np.searchsorted(starts, at, side="right") - 1
            high = np.searchsorted(starts, at + len(grams), side="left")
            cuts = np.maximum(starts[low:high] - at, 0)
            out[low:high] += np.add.reduceat(bits, cuts, axis=0, dtype=np.float64)
        return out


def build_model(langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """Code lengths from counts of grams of ORDER + 1 bytes; `lang` is the place in `langs`. All contexts are kept.

    A context that a language has seen n times before d different bytes gives a byte seen c times the probability
    c / (n + d); any other byte costs the escape d / (n + d) and is coded in the context shortened by its oldest
    byte. A context the language never saw passes on at no cost. Below the empty context all bytes are equal.
    """
    orders: list[Order] = []
    for k in range(ORDER + 1):
        grams, row = np.unique((gram & ((1 << (8 * (k + 1))) - 1)).astype(np.uint32), return_inverse=True)
        counts = np.zeros((len(grams), len(langs)))
        np.add.at(counts, (row, lang), n)
        contexts, first, of = np.unique(grams >> np.uint32(8), return_index=True, return_inverse=True)
        total, kinds = np.add.reduceat(counts, first), np.add.reduceat(counts > 0, first, dtype=np.int64)
        with np.errstate(divide="ignore", invalid="ignore"):
            escapes = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
            seen = -np.log2(counts / (total + kinds)[of])
        if k:
            shorter = orders[-1].bits[_found(orders[-1].grams, grams & np.uint32((1 << (8 * k)) - 1))[0]]
        else:
            shorter = np.full(counts.shape, 8.0)
        orders.append(Order(contexts, escapes, grams, np.where(counts > 0, seen, escapes[of] + shorter)))
    small = [Order(o.contexts, o.escapes.astype(np.float32), o.grams, o.bits.astype(np.float32)) for o in orders]
    return Model(langs, small)


def learn(labelled: DataFrame) -> Model | None:
    """Count all of `labelled` and freeze code lengths for every context of at most ORDER bytes that occurs in it."""
    counted = gram_counts(labelled).toArrow()
    if not counted.num_rows:
        return None
    langs, lang = np.unique(counted["lang"].to_numpy().astype(str), return_inverse=True)
    return build_model(langs.tolist(), lang, counted["gram"].to_numpy(), counted["n"].to_numpy())


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, from its whole text alone.

    The language with the shortest code wins, the first by name of equal ones. The score is the posterior at equal
    priors with the evidence of a text scaled to at most 64 bytes, so it does not saturate on long texts. Null text,
    text without a letter, and any text when nothing could be learned give `und` with score 0.
    """
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        lookup = model.lookup() if model else None
        for batch in batches:
            whole = batch.column("text").to_pylist()
            lang, score = ["und"] * len(whole), [0.0] * len(whole)
            at = [i for i, t in enumerate(whole) if model and t and LETTER.search(t)]
            if at:
                texts = [whole[i].encode("utf-8", "surrogatepass") for i in at]
                bits = model.lengths(lookup, texts)
                sizes = np.array([[len(t)] for t in texts])
                best = bits.argmin(axis=1)
                evidence = (bits.min(axis=1, keepdims=True) - bits) * np.minimum(1.0, 64.0 / sizes)
                top = 1.0 / np.exp2(evidence).sum(axis=1)
                for i, b, p in zip(at, best, top, strict=True):
                    lang[i], score[i] = model.langs[b], float(p)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    teaching = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return predict(docs, learn(teaching))

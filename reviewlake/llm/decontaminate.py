"""Benchmark decontamination: n-gram seeds find places, Smith-Waterman alignment scores edited copies."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import python_ready, table

#: Words of a seed: replacing every third word of an item, which still scores SCORE, leaves pairs but no triples.
SEED = 2
#: Alignment score from which a document holds an item (1: every word of the item, in order).
SCORE = 0.5
# Alignment of words: what a match earns, what a different or missing word costs.
MATCH, MISS = 2, 1
#: Words of benchmark items handled in one pass over the documents; a larger benchmark takes several passes.
BLOCK_WORDS = 1_000_000

WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Items:
    """A block of benchmark items as word numbers, with the seeds that point into them."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.ids = [i for i, _ in items]
        self.number = {w: k + 1 for k, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.words = [np.array([self.number[w] for w in ws], dtype=np.int64) for _, ws in items]
        self.counts = [Counter(ws.tolist()) for ws in self.words]
        places: dict[int, dict[int, list[tuple[int, int]]]] = {}
        self.need = []
        for item, numbers in enumerate(self.words):
            run = min(SEED, len(numbers))
            keys = self.keys(numbers, run).tolist()
            self.need.append(min(2, len(set(keys))))
            own = places.setdefault(run, defaultdict(list))
            for at, key in enumerate(keys):
                own[key].append((item, at))
        # per length of seeds: the seeds in order, and where each points
        self.seeds = {run: np.array(sorted(own), dtype=np.int64) for run, own in places.items()}
        self.places = {run: [own[k] for k in self.seeds[run].tolist()] for run, own in places.items()}

    def keys(self, numbers: np.ndarray, run: int) -> np.ndarray:
        """One number per run of words, -1 where a word is unknown."""
        size = len(self.number) + 1
        if len(numbers) < run:
            return np.zeros(0, dtype=np.int64)
        parts = [numbers[k : len(numbers) - run + 1 + k] for k in range(run)]
        key, known = np.zeros_like(parts[0]), np.ones(len(parts[0]), dtype=bool)
        for part in parts:
            key, known = key * size + part, known & (part > 0)
        return np.where(known, key, -1)

    def numbers(self, words: list[str]) -> np.ndarray:
        get = self.number.get
        return np.array([get(w, 0) for w in words], dtype=np.int64)

    def hits(self, numbers: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in a text and the seeds of that length that stand there."""
        keys, seeds = self.keys(numbers, run), self.seeds[run]
        at = np.flatnonzero(keys > 0)
        found = np.minimum(np.searchsorted(seeds, keys[at]), len(seeds) - 1)
        same = seeds[found] == keys[at]
        return at[same], found[same]

    def windows(self, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, from, to): stretches of a text where at least two seeds of an item point to one place.

        Every seed serves, however common it is: those that an edited copy keeps may be the item's most frequent.
        Items with one different seed need one. Stretches of one item that touch are one.
        """
        pointed: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for run in self.seeds:
            at, seeds = self.hits(numbers, run)
            for place, seed in zip(at.tolist(), seeds.tolist(), strict=True):
                for item, inside in self.places[run][seed]:
                    size = len(self.words[item])
                    slack = size // 2
                    pointed[item].append((max(0, place - inside - slack), place - inside + size + slack, seed))
        for item, spans in pointed.items():
            need = self.need[item]
            spans.sort()
            low, high, met = spans[0][0], spans[0][1], {spans[0][2]}
            for a, b, seed in [*spans[1:], (1 << 60, 0, -1)]:
                if a <= high:
                    high = max(high, b)
                    met.add(seed)
                    continue
                if len(met) >= need:
                    yield item, low, min(high, len(numbers))
                low, high, met = a, b, {seed}

    def enough(self, item: int, window: list[int]) -> bool:
        """Whether the window has as many of the item's words as SCORE takes, in any order: no better score is possible."""
        present = set(window)
        return sum(n for w, n in self.counts[item].items() if w in present) >= SCORE * len(self.words[item])


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int]:
    """Best local alignment of `text` to `item` as a share of the item's full score, and where it ends in `text`."""
    steps = np.arange(1, len(text) + 1) * MISS
    row, best, end = np.zeros(len(text) + 1, dtype=np.int64), 0, 0
    for word in item:
        down = row[1:] - MISS
        across = row[:-1] + np.where(text == word, MATCH, -MISS)
        new = np.maximum(np.maximum(down, across), 0)
        new = np.maximum(new, np.maximum.accumulate(new + steps) - steps)
        row[1:] = new
        top = int(new.argmax())
        if new[top] > best:
            best, end = int(new[top]), top
    return best / (MATCH * len(item)), end


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """Items in blocks of bounded size, in the order of their ids."""
    block, held = [], 0
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        words = words_of(row.text)
        if words:
            block.append((row.item_id, words))
            held += len(words)
        if held >= BLOCK_WORDS:
            yield Items(block)
            block, held = [], 0
    if block:
        yield Items(block)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, end_word: each document that holds a benchmark item, and the item.

    Words are compared without case and punctuation. A text is aligned with an item where two different pairs of
    neighbouring words of it stand in one place (one, where the item has no more; an item of one word stands wherever
    the word does). Texts of any length are searched whole. Null and empty texts and items hold nothing; rows that repeat
    give equal rows; an item id that repeats gives a row per text; without items or documents the result is empty.
    end_word is the number of the word of the document at which the best alignment ends. Other columns are not read.
    """
    spark = docs.sparkSession
    python_ready(spark)
    kind, item_kind = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {kind}, item_id {item_kind}, score double, end_word long"
    found = _none(spark, schema)
    for items in _blocks(benchmark):
        found = found.unionByName(_aligned(docs, items, schema))
    return found


def _none(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def _aligned(docs: DataFrame, items: Items, schema: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = shared.value
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                numbers = items.numbers(words_of(text))
                plain = numbers.tolist()
                best: dict[int, tuple[float, int]] = {}
                for item, low, high in items.windows(numbers):
                    if not items.enough(item, plain[low:high]):
                        continue
                    score, end = align(items.words[item], numbers[low:high])
                    if score >= SCORE and score > best.get(item, (0.0, 0))[0]:
                        best[item] = (score, low + end)
                doc = doc.asDict() if hasattr(doc, "asDict") else doc
                out += [(doc, items.ids[i], s, e) for i, (s, e) in sorted(best.items())]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "score", "end_word"])

    return docs.select("doc_id", "text").mapInPandas(run, schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` whose text holds no benchmark item; columns and repeats stay, a null text passes."""
    keyed = docs.select("doc_id", "text")
    found = leaks(keyed.select(F.struct("doc_id", F.xxhash64("text").alias("text_id")).alias("doc_id"), "text"), benchmark)
    leaky = found.select(F.col("doc_id.doc_id").alias("__doc"), F.col("doc_id.text_id").alias("__text")).distinct()
    same = docs["doc_id"].eqNullSafe(leaky["__doc"]) & (F.xxhash64(docs["text"]) == leaky["__text"])
    return docs.join(leaky, same, "left_anti")


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""Quality rules: gradient-boosted trees over document statistics, flattened into node arrays."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import python_ready, table, with_columns

#: Labelled documents used to fit at most, those whose ids hash lowest.
SAMPLE = 20_000
#: Probability of good quality from which a document is kept.
KEEP_FROM = 0.5

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: White space to str.split() that belongs to words here.
OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
SYMBOLS = "#*$%&|<>"
NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
NOT_DIGIT = bytes(b for b in range(256) if not 48 <= b <= 57)
WINDOW = 5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Feature names with the sign that quality must follow (0: free).
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbol_share": -1,
    "duplicate_line_share": -1,
    "repeat_share": -1,
    "distinct_share": 0,
    "upper_share": 0,
    "exclamations": -1,
    "digit_share": 0,
    "stops": 0,
    "commas": 0,
    "longest_word": 0,
    "stutter": -1,
}


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of five words which occurs at least twice in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    windows = list(zip(*(words[k:] for k in range(WINDOW))))
    if len(set(windows)) == n:
        return 0
    times = Counter(windows)
    covered, end = 0, 0
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered += i + WINDOW - max(end, i)
            end = i + WINDOW
    return covered


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The five base counts and the features of one whole text; null counts as empty."""
    text = text or ""
    words = WORD.findall(text) if OTHER_SPACE.search(text) else text.split()
    n, chars = len(words), sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    dup = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    raw = text.encode("utf-8", "surrogatepass")
    per_word, per_char = max(n, 1), max(chars, 1)
    features = [
        math.log1p(n),
        chars / per_word,
        symbols / per_char,
        dup / max(len(lines), 1),
        repeats / per_word,
        len(set(words)) / per_word,
        len(raw.translate(None, NOT_UPPER)) / per_char,
        text.count("!") / per_word,
        len(raw.translate(None, NOT_DIGIT)) / per_char,
        text.count(".") / per_word,
        text.count(",") / per_word,
        math.log1p(max(map(len, words), default=0)),
        sum(map(eq, words, words[1:])) / per_word,
    ]
    return [n, chars, symbols, dup, repeats], features


class Trees:
    """A boosted ensemble as node arrays: one row per tree, leaves pointing at themselves."""

    def __init__(self, base: float, trees: list[list[tuple[int, float, int, int, float]]], depth: int):
        size = max((len(t) for t in trees), default=1)
        self.base, self.depth = base, depth
        self.feature = np.zeros((len(trees), size), dtype=np.int32)
        self.threshold = np.full((len(trees), size), np.inf)
        self.left = np.tile(np.arange(size, dtype=np.int32), (len(trees), 1))
        self.right = self.left.copy()
        self.value = np.zeros((len(trees), size))
        for t, nodes in enumerate(trees):
            for i, (feature, threshold, left, right, value) in enumerate(nodes):
                self.feature[t, i], self.threshold[t, i], self.value[t, i] = feature, threshold, value
                if left >= 0:
                    self.left[t, i], self.right[t, i] = left, right

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Of good quality, for each row of features."""
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), dtype=np.int32)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            go_left = x[rows, self.feature[trees, at]] <= self.threshold[trees, at]
            at = np.where(go_left, self.left[trees, at], self.right[trees, at])
        return 1.0 / (1.0 + np.exp(-(self.base + self.value[trees, at].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, smooth: float = 1.0, least: int = 5) -> Trees:
    """Logistic boosting on binned features with monotonic constraints.

    A split on a constrained feature must order its two leaf values by the sign, and everything below it stays on
    its side of their midpoint, so that the sum of all trees is monotonic in that feature.
    """
    share = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
    base = math.log(share / (1 - share))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    codes = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    margin, grown = np.full(len(x), base), []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        nodes: list[tuple[int, float, int, int, float]] = []

        def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
            g, h = grad[rows].sum(), hess[rows].sum()
            value = min(max(g / (h + smooth), low), high)
            me = len(nodes)
            nodes.append((0, math.inf, -1, -1, rate * value))
            best = (1e-6, -1, 0, 0.0, 0.0)
            if level < depth and len(rows) >= 2 * least:
                for f, sign in enumerate(signs):
                    size = len(edges[f]) + 1
                    code = codes[rows, f]
                    gs = np.bincount(code, grad[rows], size).cumsum()[:-1]
                    hs = np.bincount(code, hess[rows], size).cumsum()[:-1]
                    ns = np.bincount(code, minlength=size).cumsum()[:-1]
                    if not len(gs):
                        continue
                    a = np.clip(gs / (hs + smooth), low, high)
                    b = np.clip((g - gs) / (h - hs + smooth), low, high)
                    gain = _gain(gs, hs, a, smooth) + _gain(g - gs, h - hs, b, smooth) - _gain(g, h, value, smooth)
                    allowed = (ns >= least) & (len(rows) - ns >= least) & (sign * (b - a) >= 0)
                    gain = np.where(allowed, gain, -np.inf)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k, float(a[k]), float(b[k]))
            if best[1] < 0:
                margin[rows] += rate * value
                return me
            _, f, k, a, b = best
            left = codes[rows, f] <= k
            middle, sign = (a + b) / 2, signs[f]
            l_high, r_low = (middle, middle) if sign > 0 else (high, low)
            l_low, r_high = (middle, middle) if sign < 0 else (low, high)
            first = grow(rows[left], level + 1, l_low, l_high)
            second = grow(rows[~left], level + 1, r_low, r_high)
            nodes[me] = (f, float(edges[f][k]), first, second, rate * value)
            return me

        grow(np.arange(len(x)), 0, -math.inf, math.inf)
        grown.append(nodes)
    return Trees(base, grown, depth)


def _gain(g, h, value, smooth):
    """How much a leaf of this value lowers the second-order loss."""
    return 2 * g * value - (h + smooth) * value * value


def sample_of(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features and quality of at most `limit` labelled documents; a document labelled twice takes the lower label."""
    python_ready(docs.sparkSession)
    rank = F.xxhash64("doc_id")
    marked = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    chosen = marked.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(rank, "doc_id").limit(limit)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["doc_id", "quality"]].assign(x=[statistics(t)[1] for t in batch["text"]])

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
    measured = rows.mapInPandas(run, "doc_id long, quality int, x array<double>")
    taken = measured.orderBy(rank, "doc_id", "x").limit(limit).collect()
    return np.array([r.x for r in taken]).reshape(-1, len(FEATURES)), np.array([float(r.quality) for r in taken])


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Trees | None:
    """None where the labels don't hold both qualities: then only the base rules decide."""
    x, y = sample_of(docs, labels, limit)
    return fit(x, y, list(FEATURES.values())) if len(set(y)) > 1 else None


def _verdict(found: list, model: Trees | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    base = np.array([f[0] for f in found], dtype=np.int64).reshape(-1, len(BASE))
    failed = (base[:, 0] < 10) | (100 * base[:, 4] > 20 * base[:, 0])
    x = np.array([f[1] for f in found]).reshape(-1, len(FEATURES))
    quality = model.probability(x) if model else np.ones(len(x))
    return failed, quality, ~failed & (quality >= KEEP_FROM)


def judge(docs: DataFrame, model: Trees | None, columns: list[str] | None = None) -> DataFrame:
    """The columns named (doc_id if none are), the base counts, base_failed, quality (the model's) and kept.

    A document fails the base with fewer than 10 words or when repeated windows cover more than a fifth of them.
    Null and empty texts have no words and fail; repeated rows give equal rows; an empty table gives an empty one.
    Input columns that share a name with a result are dropped.
    """
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(model)
    made = (*BASE, "base_failed", "quality", "kept")
    carried = [c for c in columns or ["doc_id"] if c not in made]
    names = list(dict.fromkeys([*carried, "text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [statistics(t) for t in batch.column("text").to_pylist()]
            base = np.array([f[0] for f in found], dtype=np.int64).reshape(-1, len(BASE))
            failed, quality, kept = _verdict(found, model)
            counts = {name: np.ascontiguousarray(base[:, i]) for i, name in enumerate(BASE)}
            yield with_columns(batch.select(carried), **counts, base_failed=failed, quality=quality, kept=kept)

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    schema += "".join(f", {c} long" for c in BASE) + ", base_failed boolean, quality double, kept boolean"
    return docs.select(*(F.col(f"`{c}`") for c in names)).mapInArrow(run, schema)


def keep(docs: DataFrame, model: Trees | None) -> DataFrame:
    """The rows of `docs` that `judge` keeps, with all their columns as they are."""
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [statistics(t) for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(_verdict(found, model)[2].tolist(), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, train(docs, table(spark, sf_dir, "labels")))

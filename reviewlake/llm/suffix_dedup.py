"""Removal of repeated passages: suffix arrays by two-stage sorting over strings that share a minimizer.

Every window of SPAN bytes is assigned to the smallest hash among its k-byte substrings. Runs of windows with the
same minimizer are one string, and equal windows, wherever they stand, meet under the same minimizer. Only strings
whose minimizer occurs in at least two documents are moved; their suffix array and adjacent common prefixes tell
which windows are equal, and the smallest doc_id that has a window decides who keeps it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import discard, forget_shuffles, python_ready, store, table, text_or_empty
from reviewlake.session import pin

#: Bytes of a passage that counts as repeated, and of the substrings whose hashes pick a minimizer.
SPAN, KEY = 50, 16
#: Bytes of strings in one suffix array, and different strings of a minimizer from which windows are dealt singly.
BLOB, MANY = 4 << 20, 20_000
#: Ends a string; no UTF-8 text holds this byte.
END = 0xFF

_RANDOM = np.random.default_rng(77)
LETTERS = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64)
ODD = [np.uint64(int(x) * 2 + 1) for x in _RANDOM.integers(0, 1 << 62, 5)]


def minimizers(data: np.ndarray) -> np.ndarray:
    """The minimizer of each window of SPAN bytes."""
    if len(data) < SPAN:
        return np.zeros(0, dtype=np.uint64)
    h, step = LETTERS[data], 1
    for k in range(4):  # 2, 4, 8, 16 bytes
        h, step = h[:-step] * ODD[k] + h[step:], step * 2
    h ^= h >> np.uint64(31)
    h *= ODD[4]
    h ^= h >> np.uint64(29)
    width, held = SPAN - KEY + 1, 1
    while held < width:
        step = min(held, width - held)
        h, held = np.minimum(h[:-step], h[step:]), held + step
    return h


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimizer, first and last-plus-one window of each stretch of windows under one minimizer."""
    values = minimizers(data)
    if not len(values):
        return values, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[starts], starts, np.append(starts[1:], len(values))


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes of `text` (bytes that end with END) in the order of their first SPAN bytes, and their 8-byte words.

    Two stages: suffixes smaller than their successor are sorted directly; then one scan over the buckets of first
    bytes, from small to large, appends before each sorted suffix the one that starts a byte earlier, if that is
    larger than its successor, to the front part of its own bucket.
    """
    n = len(text)
    padded = np.concatenate((text, np.full(SPAN + 16, END, dtype=np.uint8))).astype(np.uint64)
    word, step = padded, 1
    while step < 8:
        word = (word[:-step] << np.uint64(8 * step)) | word[step:]
        step *= 2
    change = np.flatnonzero(text[1:] != text[:-1])
    rising = np.zeros(n, dtype=bool)
    if len(change):  # a run of equal bytes has the type of its last byte
        kind = text[change] < text[change + 1]
        rising[: change[-1] + 1] = np.repeat(kind, np.diff(np.concatenate(([-1], change))))
    # what follows the end is larger than nothing: the last run counts as rising
    rising[change[-1] + 1 if len(change) else 0 :] = True
    small = np.flatnonzero(rising)
    small = small[_order(word, small)]
    first = text[small]
    cuts = np.searchsorted(first, np.arange(257))
    front: list[list[np.ndarray]] = [[] for _ in range(256)]
    sorted_all = []
    for c in range(256):
        large = front[c]
        new = np.concatenate(large) if large else small[:0]
        large = [new]
        while len(new):
            new = new[new > 0] - 1
            new = new[text[new] == c]
            large.append(new)
        whole = np.concatenate((*large, small[cuts[c] : cuts[c + 1]]))
        sorted_all.append(whole)
        front[c] = []
        before = whole[whole > 0] - 1
        letter = text[before]
        up = letter > c
        before, letter = before[up], letter[up]
        order = np.argsort(letter, kind="stable")
        before, letter = before[order], letter[order]
        where = np.searchsorted(letter, np.arange(c + 1, 257))
        for k in range(c + 1, 256):
            low, high = where[k - c - 1], where[k - c]
            if low < high:
                front[k].append(before[low:high])
    tail = np.uint64(0xFFFF << 48)
    words = [word[8 * k : 8 * k + n] if 8 * k + 8 <= SPAN else word[8 * k : 8 * k + n] & tail for k in range(7)]
    return np.concatenate(sorted_all), words


def _order(word: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Order of the suffixes at `at` by their first SPAN + 6 bytes: one word at a time, only among those still equal."""
    order = np.argsort(word[at], kind="stable")
    key = word[at[order]]
    tied = np.zeros(len(at), dtype=bool)
    group = np.cumsum(np.concatenate(([0], (key[1:] != key[:-1]).astype(np.int64)))) if len(at) else tied
    for k in range(1, 7):
        same = np.zeros(len(at), dtype=bool)
        if len(at) > 1:
            same[1:] = group[1:] == group[:-1]
            same[:-1] |= same[1:]
        rows = np.flatnonzero(same)
        if not len(rows):
            break
        key = word[at[order[rows]] + 8 * k]
        inner = np.lexsort((key, group[rows]))
        order[rows] = order[rows][inner]
        key, own = key[inner], group[rows]
        fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])))
        head = np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), 0))
        group = group.astype(np.int64)
        group[rows] = rows[head]
        untied = ~same
        group[untied] = np.flatnonzero(untied)
    return order


def common_prefixes(order: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Common prefix, up to SPAN bytes, of each suffix in `order` with the one before it (0 for the first)."""
    out = np.zeros(len(order), dtype=np.int64)
    rows = np.arange(1, len(order))
    for word in words:
        a, b = word[order[rows]], word[order[rows - 1]]
        differ = a ^ b
        same = differ == 0
        apart = differ[~same]
        # whole equal bytes before the first bit that differs
        high = np.frexp((apart >> np.uint64(32)).astype(np.float64))[1]
        low = np.frexp((apart & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
        bits = np.where(high > 0, 32 - high, 64 - low)
        out[rows[~same]] += bits // 8
        rows = rows[same]
        out[rows] += 8
    return np.minimum(out, SPAN)


def first_owners(data: np.ndarray, sizes: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """The smallest owner of each window among all strings given (laid end to end in `data`), string after string.

    Each string has SPAN bytes or more, hence `size - SPAN + 1` windows.
    """
    which = np.repeat(np.arange(len(sizes)), sizes)
    text = np.full(len(data) + len(sizes), END, dtype=np.uint8)
    text[np.arange(len(data)) + which] = data
    ends = np.cumsum(sizes + 1)
    owner_of = np.repeat(np.arange(len(sizes)), sizes + 1)
    left = ends[owner_of] - 1 - np.arange(len(text))
    order, words = suffix_array(text)
    order = order[left[order] >= SPAN]
    same = common_prefixes(order, words) >= SPAN
    heads = np.flatnonzero(~same)
    low = np.minimum.reduceat(owners[owner_of[order]], heads)
    best = np.zeros(len(text), dtype=np.int64)
    best[order] = np.repeat(low, np.diff(np.append(heads, len(order))))
    return best[left >= SPAN]


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, its rank (a null id is larger than any other), the text's bytes and its two hashes."""
    last = F.lit((1 << 63) - 1)
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), last).alias("rank"), text_or_empty().alias("text")).select(
        "doc_id", "rank", F.col("text").cast("binary").alias("data"), F.xxhash64("text").alias("text_id"), F.md5("text").alias("md5")
    )


def _data(value) -> np.ndarray:
    return np.frombuffer(value, dtype=np.uint8)


def _shared_minimizers(keyed: DataFrame) -> DataFrame:
    """text_id, marks: the minimizers of each text that occur in more than one text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [np.unique(runs(_data(d))[0]) for d in batch["data"]]
            found = np.concatenate([*own, np.zeros(0, dtype=np.uint64)]).astype(np.int64)
            texts = np.repeat(batch["text_id"].to_numpy(), [len(o) for o in own])
            order = np.lexsort((texts, found))
            found, texts = found[order], texts[order]
            first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))) if len(found) else order
            last = np.append(first[1:], len(found)) - 1 if len(found) else order
            yield pd.DataFrame({"m": found[first], "low": texts[first], "high": texts[last]})

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [np.unique(runs(_data(d))[0]) for d in batch["data"]]
            texts = np.repeat(batch["text_id"].to_numpy(), [len(o) for o in own])
            yield pd.DataFrame({"m": np.concatenate([*own, np.zeros(0, dtype=np.uint64)]).astype(np.int64), "text_id": texts})

    counted = keyed.select("data", "text_id").mapInPandas(count, "m long, low long, high long")
    counted = counted.groupBy("m").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    shared = store(counted.filter("low < high").select("m"))
    forget_shuffles(keyed.sparkSession)
    placed = keyed.select("data", "text_id").mapInPandas(place, "m long, text_id long")
    marks = store(placed.join(shared, "m").groupBy("text_id").agg(F.collect_set("m").alias("marks")))
    discard(keyed.sparkSession, shared)
    forget_shuffles(keyed.sparkSession)
    return marks


def _strings(chosen: DataFrame) -> DataFrame:
    """m, h, s, owner, text_id, at: the strings under shared minimizers, where each text has them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.split(batch.column("marks").flatten().to_numpy(), batch.column("marks").offsets.to_numpy()[1:-1])
            found, places, sizes, pieces = [], [], [], []
            for data, own in zip(batch.column("data"), marks, strict=True):
                data = np.frombuffer(data.as_buffer(), dtype=np.uint8)
                values, starts, ends = runs(data)
                values = values.astype(np.int64)
                own = np.sort(own)
                at = np.minimum(np.searchsorted(own, values), len(own) - 1)
                kept = np.flatnonzero(own[at] == values) if len(own) else np.zeros(0, dtype=np.int64)
                begin, size = starts[kept], ends[kept] - starts[kept] + (SPAN - 1)
                found.append(values[kept])
                places.append(begin)
                sizes.append(size)
                shift = np.cumsum(size) - size
                pieces.append(data[np.repeat(begin - shift, size) + np.arange(int(size.sum()))])
            rows = pa.array(np.repeat(np.arange(batch.num_rows), [len(f) for f in found]))
            lengths = np.concatenate(sizes)
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            s = pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate(pieces))])
            columns = [pa.array(np.concatenate(found)), s, batch.column("owner").take(rows), batch.column("text_id").take(rows)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(places))], ["m", "s", "owner", "text_id", "at"])

    schema = "m long, s binary, owner long, text_id long, at long"
    cut_out = chosen.select("data", "marks", "owner", "text_id").mapInArrow(cut, schema)
    return cut_out.select("m", F.xxhash64("s").alias("h"), "s", "owner", "text_id", "at")


SPANS = "array<struct<low: long, high: long, owner: long>>"


def _verdicts(strings: DataFrame) -> DataFrame:
    """m, h, base, spans: for each different string, who owns its windows from `base` on.

    Equal strings combine map-side into their smallest and largest owner, so a passage that very many documents hold
    arrives as a few rows. A minimizer with one string needs no sorting: its smallest owner has all windows. Of a
    minimizer with more than MANY different strings, windows are grouped singly, again combined map-side. The strings
    of the others go through suffix arrays. Strings that nobody loses are left out.
    """
    spark = strings.sparkSession
    low, high = F.min("owner").alias("low"), F.max("owner").alias("high")
    different = store(strings.groupBy("m", "h", "s").agg(low, high))
    forget_shuffles(spark)
    crowded = pin(different.groupBy("m").count().filter(F.col("count") > MANY).select("m"))
    plain, by_window = different, None
    if not crowded.isEmpty():
        plain = different.join(crowded, "m", "left_anti")
        by_window = _window_verdicts(different.join(crowded, "m"))
    counted = plain.withColumn("n", F.count("*").over(Window.partitionBy("m")))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("low"), (F.octet_length("s") - (SPAN - 1)).cast("long").alias("high"), F.col("low").alias("owner")))
    settled = counted.filter((F.col("n") == 1) & (F.col("low") < F.col("high"))).select("m", "h", F.lit(0).cast("long").alias("base"), whole.alias("spans"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:  # ordered by m: a set of strings ends where m changes
            if not batch.num_rows:
                continue
            m = batch.column("m").to_numpy()
            if size >= BLOB:
                upto = int(np.searchsorted(m != last, True)) if m[0] == last else 0
                if upto < batch.num_rows:
                    yield from _judged([*held, batch.slice(0, upto)])
                    held, size, batch = [], 0, batch.slice(upto)
            held.append(batch)
            size, last = size + batch.column("s").nbytes, m[-1]
        yield from _judged(held)

    many = counted.filter("n > 1").select("m", "h", "s", "low", "high").sortWithinPartitions("m")
    judged = many.mapInArrow(judge, f"m long, h long, base long, spans {SPANS}")
    told = settled.unionByName(judged)
    return told if by_window is None else told.unionByName(by_window)


def _window_verdicts(strings: DataFrame) -> DataFrame:
    """Verdicts on single windows, for minimizers with very many different strings around them.

    The smallest owner of each window is combined map-side and joined back, so one window in any number of
    surroundings spreads over tasks.
    """
    window = F.expr(f"substring(s, CAST(base AS int) + 1, {SPAN})")
    each = strings.select("*", F.explode(F.expr(f"sequence(0L, octet_length(s) - {SPAN})")).alias("base"))
    each = each.select("m", "h", "base", "low", "high", window.alias("w"))
    first = each.groupBy("w").agg(F.min("low").alias("first"))
    spans = F.array(F.struct(F.lit(0).cast("long").alias("low"), F.lit(1).cast("long").alias("high"), F.col("first").alias("owner")))
    return each.join(first, "w").filter("first < high").select("m", "h", "base", spans.alias("spans"))


def _judged(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Who owns the windows of a set of different strings, for those that some document loses."""
    table_ = pa.Table.from_batches(held) if held else None
    if table_ is None or not table_.num_rows:
        return
    s = table_.column("s").combine_chunks()
    offsets = np.frombuffer(s.buffers()[1], dtype=np.int32)[s.offset : s.offset + len(s) + 1].astype(np.int64)
    data = np.frombuffer(s.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    m, h, low, high = (table_.column(n).to_numpy() for n in ("m", "h", "low", "high"))
    owner = first_owners(data, sizes, low)
    windows = sizes - (SPAN - 1)
    begin = np.cumsum(windows) - windows
    lost = np.minimum.reduceat(owner, begin) < high
    which = np.repeat(np.arange(len(sizes)), windows)
    kept = lost[which]
    owner, which, at = owner[kept], which[kept], (np.arange(len(owner)) - begin[which])[kept]
    if not len(owner):
        return
    starts = np.flatnonzero(np.concatenate(([True], (which[1:] != which[:-1]) | (owner[1:] != owner[:-1]))))
    ends = np.append(starts[1:], len(owner)) - 1
    spans = pa.StructArray.from_arrays([pa.array(at[starts]), pa.array(at[ends] + 1), pa.array(owner[starts])], ["low", "high", "owner"])
    per = np.concatenate(([0], np.cumsum(np.bincount(which[starts], minlength=len(sizes))[lost]))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(per), spans)
    yield pa.RecordBatch.from_arrays(
        [pa.array(m[lost]), pa.array(h[lost]), pa.array(np.zeros(int(lost.sum()), dtype=np.int64)), lists], ["m", "h", "base", "spans"]
    )


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left, for spans [low, high) that may overlap."""
    out, at, removed, n = [], 0, 0, 0
    for low, high in sorted(spans):
        if low > at or not n:
            out.append(data[at:low])
            n += 1
            removed += high - low
            at = high
        elif high > at:
            removed += high - at
            at = high
    out.append(data[at:])
    return removed, n, b"".join(out)


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What to remove: (texts: md5, owner) and (spans: text_id, rank, spans) for the first document of each text.

    Any other document with an equal text of at least SPAN bytes is removed whole.
    """
    spark = docs.sparkSession
    python_ready(spark)
    keyed = _keyed(docs)
    texts = store(keyed.groupBy("md5", "text_id").agg(F.min("rank").alias("owner")))
    forget_shuffles(spark)
    marks = _shared_minimizers(keyed)
    marked = marks.join(texts, "text_id")
    first = [keyed["text_id"] == marked["text_id"], keyed["md5"] == marked["md5"], keyed["rank"] == marked["owner"]]
    chosen = keyed.join(marked, first).select("data", "marks", "owner", marked["text_id"])
    strings = store(_strings(chosen))
    discard(spark, marks)
    del chosen, marked
    forget_shuffles(spark)
    verdicts = store(_verdicts(strings))
    forget_shuffles(spark)
    places = strings.select("m", "h", F.col("owner").alias("rank"), "text_id", "at").join(verdicts, ["m", "h"])
    losing = places.select("text_id", "rank", F.col("at") + F.col("base"), F.explode("spans").alias("x")).toDF("text_id", "rank", "at", "x")
    losing = losing.filter("x.owner < rank").select(
        "text_id", "rank", F.struct((F.col("at") + F.col("x.low")).alias("low"), (F.col("at") + F.col("x.high") + (SPAN - 1)).alias("high")).alias("span")
    )
    spans = store(losing.groupBy("text_id", "rank").agg(F.collect_set("span").alias("spans")))
    discard(spark, strings, verdicts)
    del places, losing
    forget_shuffles(spark)
    return texts, spans


def removed_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document's UTF-8 text.

    A byte goes if a 50-byte string over it also starts in a document with a smaller doc_id; strings are judged on
    the input. Null text is empty, a null doc_id is larger than any other, repeats inside a document and in
    documents with the same doc_id stay, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts, spans = repeated_spans(docs)
    keyed = _keyed(docs)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for data, found in zip(batch["data"], batch["spans"], strict=True):
                removed, n, left = kept_bytes(bytes(data), [(s["low"], s["high"]) for s in found])
                out.append((removed, n, hashlib.sha256(left).hexdigest()))
            cut_out = pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256"])
            yield pd.concat([batch[["text_id", "rank"]].reset_index(drop=True), cut_out], axis=1)

    schema = "text_id long, rank long, n_removed long, n_spans long, kept_sha256 string"
    partly = keyed.join(spans, ["text_id", "rank"]).select("text_id", "rank", "data", "spans").mapInPandas(cut, schema)
    partly = store(partly.distinct())
    forget_shuffles(spark)
    facts = keyed.select("doc_id", "rank", "text_id", "md5", F.octet_length("data").cast("long").alias("n_bytes"), F.sha2("data", 256).alias("whole"))
    joined = facts.join(texts.select("md5", "owner"), "md5").join(partly, ["text_id", "rank"], "left")
    copy = (F.col("rank") > F.col("owner")) & (F.col("n_bytes") >= SPAN)
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return removed_repeats(table(spark, sf_dir, "documents"))

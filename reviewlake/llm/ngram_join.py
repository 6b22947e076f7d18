"""N-gram Jaccard join: a MinHash LSH forest proposes groups, exact set intersections decide."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import forget_shuffles, python_ready, table, text_or_empty
from reviewlake.llm.components import components
from reviewlake.session import parallelism, pin

#: Words of a shingle, and the similarity from which two documents are linked.
WORDS = 5
SIMILAR = 0.8
#: Share of the links at SIMILAR that the forest must propose.
RECALL = 0.99999
# The forest: values of a signature, trees over it, and values on the longest path of a tree.
VALUES, TREES, DEPTH = 128, 64, 12
#: Sets of a group that one task compares with each other at a time.
BLOCK = 256
#: Distinct words whose hash a Python worker remembers.
REMEMBERED = 500_000

WORD = re.compile(r"\w+")
_RANDOM = np.random.default_rng(20240229)
MASKS = _RANDOM.integers(0, 1 << 63, VALUES, dtype=np.uint64)
FACTORS = _RANDOM.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: The signature values on the path of each tree. As many trees as a shuffle of the values can hold share none.
_APART = VALUES // DEPTH
PATHS = np.concatenate([_RANDOM.permutation(VALUES)[: _APART * DEPTH].reshape(_APART, DEPTH) for _ in range(-(-TREES // _APART))])[:TREES]
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, hashes: dict[str, int]) -> np.ndarray:
    """Sorted 64-bit fingerprints of the distinct five-word runs of a text, without case and punctuation.

    A text of one to four words is one run; a text without words has none.
    """
    found = []
    for word in WORD.findall(text.lower()):
        value = hashes.get(word)
        if value is None:
            if len(hashes) >= REMEMBERED:
                hashes.clear()
            hashes[word] = value = xxhash.xxh64_intdigest(word)
        found.append(value)
    if not found:
        return np.zeros(0, dtype=np.uint64)
    words = np.array(found, dtype=np.uint64)
    run = min(WORDS, len(words))
    mixed = np.full(len(words) - run + 1, np.uint64(run))
    for k in range(run):
        mixed = (mixed ^ words[k : len(words) - run + 1 + k]) * MIX
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(hashed: np.ndarray) -> np.ndarray:
    """The smallest of each of VALUES scrambled orders of the fingerprints."""
    low = np.full(VALUES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashed), 4096):
        low = np.minimum(low, ((hashed[at : at + 4096, None] ^ MASKS) * FACTORS).min(axis=0))
    return (low >> np.uint64(32)).astype(np.uint32)


def found_share(similar, length: int):
    """Probability, at least, that two sets of this similarity meet in at least one tree at this prefix length.

    All trees read one signature, so they depend on each other through the number of its values that are equal: the
    chance is summed over that number. Given it, paths of `length` different values count as drawn independently;
    paths that share no value miss together less often than that.
    """
    similar = np.asarray(similar, dtype=float)[..., None]
    equal = np.arange(VALUES + 1)
    ways = np.array([float(math.comb(VALUES, k)) for k in equal])
    meets = np.array([math.comb(k, length) / math.comb(VALUES, length) for k in equal])
    return 1.0 - (ways * similar**equal * (1.0 - similar) ** (VALUES - equal) * (1.0 - meets) ** TREES).sum(axis=-1)


def first_length() -> int:
    """The longest prefix at which links at the threshold itself reach the target."""
    length = DEPTH
    while length > 1 and found_share(SIMILAR, length) < RECALL:
        length -= 1
    return length


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, text_id, set_id, signature (null without words) of every document, from its whole text."""
    python_ready(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: dict[str, int] = {}
        for batch in batches:
            sets, signs = [], []
            for text, text_id in zip(batch.column("text").to_pylist(), batch.column("text_id").to_pylist(), strict=True):
                hashed = shingles(text, hashes)
                if len(hashed):
                    sets.append(np.uint64(xxhash.xxh64_intdigest(hashed.tobytes())).astype(np.int64))
                    signs.append(signature(hashed).tobytes())
                else:
                    sets.append(np.int64(text_id))
                    signs.append(None)
            columns = [batch.column("doc_id"), batch.column("text_id"), pa.array(sets, pa.int64()), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_id", "set_id", "signature"])

    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn("text_id", F.xxhash64("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, text_id long, set_id long, signature binary")


def proposed_groups(sets: DataFrame, length: int) -> DataFrame:
    """set_id, cluster: sets that a chain of shared prefixes joins; sets that meet no other are left out.

    `sets` holds set_id and signature. In each tree the sets are sorted into a trie by their path's values; those
    below one node at depth `length` are tied to the smallest of them, which keeps every shared prefix without
    listing its pairs.
    """
    python_ready(sets.sparkSession)

    def labels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        salt = np.arange(TREES, dtype=np.uint64)
        for batch in batches:
            signs = np.frombuffer(b"".join(batch["signature"]), dtype=np.uint32).reshape(-1, VALUES)
            label = np.tile(salt, (len(signs), 1))
            for k in range(length):
                label = (label ^ signs[:, PATHS[:, k]]) * MIX
                label ^= label >> np.uint64(31)
            ids = np.repeat(batch["set_id"].to_numpy(), TREES)
            yield pd.DataFrame({"label": label.reshape(-1).astype(np.int64), "set_id": ids})

    tries = sets.select("set_id", "signature").mapInPandas(labels, "label long, set_id long")
    shared = tries.groupBy("label").agg(F.min("set_id").alias("head"), F.max("set_id").alias("last"))
    heads = pin(shared.filter(F.col("head") != F.col("last")).select("label", "head"))
    edges = tries.join(heads, "label").select(F.col("set_id").alias("a"), F.col("head").alias("b"))
    found = components(edges)
    return found.select(F.col("node").alias("set_id"), F.col("root").alias("cluster"))


def _intersections(sets: list[np.ndarray], split: int) -> np.ndarray:
    """Sizes of the intersections of the first `split` sets with all sets."""
    if len(sets) <= 6:
        common = [[len(np.intersect1d(a, b, assume_unique=True)) for b in sets] for a in sets[:split]]
        return np.array(common, dtype=np.int64).reshape(split, -1)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    order = np.argsort(column[shared], kind="stable")
    column, owner = column[shared][order], owner[shared][order]
    column = np.cumsum(np.concatenate(([0], column[1:] != column[:-1]))) if len(column) else column
    out = np.zeros((split, len(sets)), dtype=np.int64)
    width = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        low, high = np.searchsorted(column, (at, at + width))
        dense = np.zeros((len(sets), width), dtype=np.float32)
        dense[owner[low:high], column[low:high] - at] = 1.0
        out += (dense[:split] @ dense.T).astype(np.int64)  # at most `width`, so exact in float32
    return out


def compare(ids: list[int], texts: list[int], blocks: list[int], sets: list[np.ndarray], length: int) -> list[tuple[int, int, int, float]]:
    """Exact comparison of one block with itself (`blocks` all equal) or with another.

    One row per set with a link: (set_id, smallest set it hangs together with here, texts it links to, chance that
    the forest misses a link as weak as the weakest of these).
    """
    order = sorted(range(len(ids)), key=lambda i: (blocks[i], ids[i]))
    split = len(ids) if len(set(blocks)) == 1 else sum(b == blocks[order[0]] for b in blocks)
    ids, texts, sets = [ids[i] for i in order], np.array([texts[i] for i in order]), [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    common = _intersections(sets, split)
    with np.errstate(divide="ignore", invalid="ignore"):
        jaccard = common / (sizes[:split, None] + sizes[None, :] - common)
    bound = Fraction(str(SIMILAR))
    linked = common * (bound.denominator + bound.numerator) >= bound.numerator * (sizes[:split, None] + sizes[None, :])
    if split == len(ids):
        np.fill_diagonal(linked, False)
    else:
        linked[:, :split] = False
    rows, columns = np.nonzero(linked)
    n, weakest, root = np.zeros(len(ids), dtype=np.int64), np.ones(len(ids)), list(range(len(ids)))
    np.add.at(n, rows, texts[columns])
    np.minimum.at(weakest, rows, jaccard[rows, columns])
    if split < len(ids):
        np.add.at(n, columns, texts[rows])
        np.minimum.at(weakest, columns, jaccard[rows, columns])
    linking = np.flatnonzero(n)
    lost = dict(zip(linking.tolist(), (1.0 - found_share(weakest[linking], length)).tolist(), strict=True))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in zip(rows.tolist(), columns.tolist(), strict=True):
        a, b = top(a), top(b)
        if a != b:
            root[max(a, b, key=lambda i: ids[i])] = min(a, b, key=lambda i: ids[i])
    return [(ids[i], ids[top(i)], int(n[i]), missed) for i, missed in lost.items()]


def verified(docs: DataFrame, members: DataFrame, length: int) -> DataFrame:
    """set_id, root, n, missed: exact links inside each proposed group, one row per set and comparison it links in.

    `members`: set_id, cluster, doc_id, text_id of a document that has the set, n_texts. A group of more than BLOCK
    sets is cut into blocks and every pair of blocks is a unit of work of its own, so no task holds a large group
    and no pair of documents becomes a row.
    """
    spark = docs.sparkSession
    python_ready(spark)
    sized = members.groupBy("cluster").agg(F.count("*").alias("size"))
    cut = members.join(sized, "cluster").withColumn("n_blocks", F.expr(f"CAST((size + {BLOCK - 1}) div {BLOCK} AS int)"))
    cut = cut.withColumn("block", F.expr("CAST(pmod(xxhash64(set_id, 7), n_blocks) AS int)"))
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn("text_id", F.xxhash64("text"))
    same = rows["doc_id"].eqNullSafe(cut["doc_id"]) & (rows["text_id"] == cut["text_id"])
    chosen = rows.join(cut, same).select("cluster", "set_id", "n_texts", "block", "n_blocks", "text")

    def fingerprint(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes: dict[str, int] = {}
        for batch in batches:
            sets = [shingles(t, hashes).tobytes() for t in batch["text"]]
            yield batch[["cluster", "set_id", "n_texts", "block", "n_blocks"]].assign(hashed=sets)

    schema = "cluster long, set_id long, n_texts long, block int, n_blocks int, hashed binary"
    prints = chosen.mapInPandas(fingerprint, schema)
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")
    units = prints.select("cluster", "set_id", "n_texts", "block", "hashed", other).select(
        "cluster", "set_id", "n_texts", "block", "hashed",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )
    dealt = units.repartition(parallelism(spark), "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, out = None, {}, []
        for batch in batches:
            for row in batch.itertuples(index=False):
                unit = (row.cluster, row.i, row.j)
                if unit != key:
                    out += _unit(held, length)
                    key, held = unit, {}
                held[row.set_id] = (row.n_texts, row.block, np.frombuffer(row.hashed, dtype=np.uint64))
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=["set_id", "root", "n", "missed"])
                out = []
        out += _unit(held, length)
        yield pd.DataFrame(out, columns=["set_id", "root", "n", "missed"])

    return dealt.mapInPandas(work, "set_id long, root long, n long, missed double")


def _unit(held: dict[int, tuple[int, int, np.ndarray]], length: int) -> list[tuple[int, int, int, float]]:
    if len(held) < 2:
        return []
    texts, blocks, sets = zip(*held.values(), strict=True)
    return compare(list(held), list(texts), list(blocks), list(sets), length)


def similar_classes(docs: DataFrame) -> DataFrame:
    """doc_id, text_id, class_id, n_links of every document.

    Documents whose sets of five-word shingles have a Jaccard similarity of at least 0.8 are linked, and those that
    a chain of links joins are one class, named by its smallest doc_id. n_links counts the different texts a
    document is linked to. Equal texts and texts with equal sets are one set to the join; texts without a word
    (null counts as empty) are linked to none and share a class only with equal texts. A null doc_id is larger than
    any other; an empty table gives an empty result.

    The prefix length starts at the longest that meets RECALL at the threshold and is shortened while links as weak
    as the weakest one found are missed more often than 1 - RECALL, however many closer ones there are.
    """
    spark = docs.sparkSession
    rows = pin(signed(docs))
    texts = rows.groupBy("set_id", "text_id").agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"))
    ordered = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id")
    sets = pin(
        texts.groupBy("set_id").agg(
            F.min(ordered).alias("first"), F.first("signature").alias("signature"), F.count("*").alias("n_texts")
        )
    )
    forget_shuffles(spark)
    signatures = sets.filter(F.col("signature").isNotNull())
    length = first_length()
    while True:
        groups = pin(proposed_groups(signatures, length))
        facts = sets.select("set_id", "first.doc_id", "first.text_id", "n_texts")
        links = pin(verified(docs, groups.join(facts, "set_id"), length))
        forget_shuffles(spark)
        missed = links.agg(F.max("missed")).first()[0]
        if length == 1 or missed is None or missed <= 1 - RECALL:
            break
        length -= 1
    classes = components(links.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("set_id").agg(F.sum("n").alias("links"))
    known = (
        sets.select("set_id", "first", "n_texts")
        .join(counted, "set_id", "left")
        .join(classes.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("root", F.coalesce("root", "set_id"))
    )
    named = known.groupBy("root").agg(F.min("first").alias("head"))
    told = known.join(named, "root").select(
        "set_id",
        F.col("head.doc_id").alias("class_id"),
        F.col("head.text_id").alias("class_text"),
        (F.coalesce("links", F.lit(0)) + F.col("n_texts") - 1).alias("n_links"),
    )
    return rows.select("doc_id", "text_id", "set_id").join(told, "set_id").drop("set_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The columns of `docs` for one document of each class: its smallest doc_id; repeated rows of it count once."""
    firsts = similar_classes(docs).select(F.col("class_id").alias("first_id"), F.col("class_text").alias("first_text")).distinct()
    text_id = F.xxhash64(text_or_empty())
    joined = docs.join(firsts, docs["doc_id"].eqNullSafe(firsts["first_id"]) & (text_id == firsts["first_text"]), "left_semi")
    columns = joined.columns
    marked = joined.withColumn("__text_id", F.xxhash64(text_or_empty()))
    return marked.dropDuplicates(["doc_id", "__text_id"]).select(*(F.col(f"`{c}`") for c in columns))


def op3_ngram_join(spark, sf_dir: str) -> DataFrame:
    return similar_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")

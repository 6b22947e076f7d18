"""Conversation structure repair: dynamic programming over a grammar that all conversations share.

Each turn becomes one symbol for its role and fault. Re-Pair turns frequent pairs of symbols into rules; every rule has
one min-plus matrix over the four states of the wanted order, whose entries hold a cost and the cheapest edits as a
rope. Matrices are evaluated bottom-up, once for every rule, and each different sequence of symbols once for all
conversations that have it. Matrix products are associative, so long conversations are evaluated in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import python_ready, table
from reviewlake.session import parallelism, pin

#: Turns in one piece of a conversation.
PIECE = 4096
#: A pair becomes a rule if it is used this often; rules in all, which bounds what is broadcast, and rounds of pairs.
#: Beyond these bounds symbols stay as they are and are multiplied singly: results don't depend on them.
USES, RULES, ROUNDS = 8, 4096, 16
#: Costs of the edits.
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
#: The first character that names a rule: private-use characters, none of which is a symbol.
FIRST_RULE = 0xE000

#: States: nothing kept, after system, after user, after assistant. Accepted: the first and the last.
STATES = range(4)
#: The cheapest insertions between states: user after none, system or assistant; assistant after user.
INSERTS = {(0, 2): "I", (0, 3): "II", (1, 2): "I", (1, 3): "II", (2, 3): "I", (3, 2): "I"}
#: What ends a conversation from each state.
CLOSING = ("", "II", "I", "")


class Rope:
    """A string as a tree of shared parts, with a polynomial hash by which equal parts are recognised."""

    __slots__ = ("n", "hash", "power", "left", "right", "text")
    BASE, PRIME = 1_000_003, (1 << 61) - 1

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.n, self.hash = len(text), 0
            for c in text:
                self.hash = (self.hash * self.BASE + ord(c)) % self.PRIME
            self.power = pow(self.BASE, self.n, self.PRIME)
        else:
            self.n = left.n + right.n
            self.hash = (left.hash * right.power + right.hash) % self.PRIME
            self.power = left.power * right.power % self.PRIME

    def __add__(self, other: Rope) -> Rope:
        if not self.n or not other.n:
            return self if self.n else other
        return Rope(left=self, right=other)

    def __str__(self) -> str:
        out, stack = [], [self]
        while stack:
            rope = stack.pop()
            if rope.left is None:
                out.append(rope.text)
            else:
                stack += (rope.right, rope.left)
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        """ASCII order; parts that agree are skipped whole."""
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a is b or (a.n == b.n and a.hash == b.hash):
                continue
            if a.left is not None and (a.n >= b.n or b.left is None):
                mine += (a.right, a.left)
                theirs.append(b)
            elif b.left is not None:
                theirs += (b.right, b.left)
                mine.append(a)
            else:
                n = min(a.n, b.n)
                if a.text[:n] != b.text[:n]:
                    return a.text < b.text
                mine += [Rope(a.text[n:])] if a.n > n else []
                theirs += [Rope(b.text[n:])] if b.n > n else []
        return bool(theirs) and not mine


#: A matrix: 16 entries by state before and state after, each None or (cost, edits).
Matrix = list


def _better(a, b):
    """The cheaper of two entries, the ASCII-least of equally cheap ones.

    Two equally cheap edits between the same states are never prefixes of each other (what the longer adds would be
    insertions, which cost), so the order is kept when more edits follow.
    """
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if b[1] < a[1] else a


def product(a: Matrix, b: Matrix, rows=STATES) -> Matrix:
    """Min-plus product; only the given rows of `a` (others stay empty). Works on ropes and on strings."""
    out = [None] * 16
    for i in rows:
        for k in STATES:
            first = a[4 * i + k]
            if first is None:
                continue
            for j in STATES:
                then = b[4 * k + j]
                if then is not None and (out[4 * i + j] is None or first[0] + then[0] <= out[4 * i + j][0]):
                    out[4 * i + j] = _better(out[4 * i + j], (first[0] + then[0], first[1] + then[1]))
    return out


def _terminal(symbol: str) -> Matrix:
    """What one turn allows, with the insertions before it: delete, keep where its role fits, or rerole."""
    own: Matrix = [None] * 16
    for i in STATES:
        own[5 * i] = (DELETE, Rope("D"))
    if symbol not in "BD":
        extra, role = (UNFINISHED if symbol.islower() else 0), symbol.lower()
        for i in STATES:
            after = 3 if i == 2 else 2
            own[4 * i + after] = (REROLE + extra, Rope("R"))
            if role == "s" and i == 0:
                own[1] = (extra, Rope("K"))
            elif role == "ua"[after - 2]:
                own[4 * i + after] = (extra, Rope("K"))
    before: Matrix = [None] * 16
    for i in STATES:
        before[5 * i] = (0, Rope())
    for (i, j), edits in INSERTS.items():
        before[4 * i + j] = (INSERT * len(edits), Rope(edits))
    return product(before, own)


#: Symbols: role (system, user, assistant, other; lower case if truncated), or B and D for blank and duplicate turns.
SYMBOLS = "SsUuAaOoBD"


def matrices(rules: list[tuple[str, str, str]]) -> dict[str, Matrix]:
    """The matrix of every symbol and rule; a rule's is the product of its two parts'."""
    known = {s: _terminal(s) for s in SYMBOLS}
    for left, right, name in rules:
        known[name] = product(known[left], known[right])
    return known


def rewritten(sequences: list[str], rules: list[tuple[str, str, str]]) -> list[str]:
    """The sequences with the rules applied in order."""
    text = "\n".join(sequences)
    for left, right, name in rules:
        text = text.replace(left + right, name)
    return text.split("\n")


def pair_counts(sequences: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of adjacent symbols (left << 32 | right) and how often each can be replaced."""
    codes = np.frombuffer("\n".join(sequences).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    left, right = codes[:-1], codes[1:]
    fits = (left != 10) & (right != 10)
    if len(left):  # in a run of one symbol only every other pair can be replaced
        change = np.concatenate(([True], left[1:] != left[:-1]))
        since = np.arange(len(left)) - np.maximum.accumulate(np.where(change, np.arange(len(left)), 0))
        fits &= (left != right) | (since % 2 == 0)
    return np.unique((left << 32 | right)[fits], return_counts=True)


def learn_rules(sequences: DataFrame) -> list[tuple[str, str, str]]:
    """Re-Pair over all of `sequences` (column seq): (left, right, name) of each rule, parts before wholes.

    Each round counts the pairs of all sequences and takes the most frequent ones that share no symbol, which can be
    replaced independently. The driver sees the frequent pairs of a round only.
    """
    rules: list[tuple[str, str, str]] = []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, uses = pair_counts(rewritten(batch.column("seq").to_pylist(), rules))
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(uses)], ["pair", "uses"])

    for _ in range(ROUNDS):
        counted = sequences.select("seq").mapInArrow(count, "pair long, uses long").groupBy("pair").agg(F.sum("uses").alias("uses"))
        best = counted.filter(F.col("uses") >= USES).orderBy(F.desc("uses"), "pair").limit(RULES).collect()
        taken: set[int] = set()
        before = len(rules)
        for pair, _ in best:
            left, right = pair >> 32, pair & 0xFFFFFFFF
            if left not in taken and right not in taken and len(rules) < RULES:
                taken |= {left, right}
                rules.append((chr(left), chr(right), chr(FIRST_RULE + len(rules))))
        if len(rules) == before:
            break
    return rules


def evaluate(sequence: str, known: dict[str, Matrix], rows=STATES) -> Matrix:
    """The matrix of a rewritten sequence, edits as strings."""
    total = known[sequence[0]]
    for symbol in sequence[1:]:
        total = product(total, known[symbol], rows)
    return [None if entry is None or n // 4 not in rows else (entry[0], str(entry[1])) for n, entry in enumerate(total)]


CELLS = "array<struct<cost: long, edits: string>>"


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of `turns` (nulls: one space) after the damage that a checksum of the place decides.

    crc32 of `conv_id:turn` modulo 20: 0 drops the row, 1 empties its text, 2 removes its ends of sentences, 3 repeats
    it, 4 makes it the user's. Repeated rows are damaged alike.
    """
    blank = F.lit(" ")
    place = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(place) % 20).alias("hit")
    ).filter("hit != 0")
    text = F.when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"),
    ).drop("again")


def _laid(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, digest, part, index: the turns in order, stored with their places.

    Ranges follow the turns, so a conversation of any length, and a turn repeated any number of times, spread.
    """
    keyed = turns.select("conv_id", "turn", "role", "text", F.md5("text").alias("digest"), F.xxhash64(F.monotonically_increasing_id()).alias("tie"))
    order = ["conv_id", "turn", "role", "digest", "tie"]
    spread = keyed.repartitionByRange(parallelism(turns.sparkSession), *order).sortWithinPartitions(*order)
    return pin(
        spread.select(
            "conv_id", "turn", "role", "text", "digest",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("index"),
        )
    )


def _symbols(laid: DataFrame) -> DataFrame:
    """conv_id, part, index, symbol of each turn."""
    held = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    letter = F.substring("role", 1, 1)
    role = F.when(letter.isin("s", "u", "a"), letter).otherwise("o")
    facts = laid.select("conv_id", "part", "index", "role", "digest", held.alias("held"), F.when(ended, F.upper(role)).otherwise(role).alias("symbol"))
    spoken = facts.filter("held")
    first = spoken.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("part", "index")).alias("first"))
    first = first.select(F.col("first.part").alias("part"), F.col("first.index").alias("index"), F.lit(True).alias("new"))
    seen = spoken.join(first, ["part", "index"], "left").select(
        "conv_id", "part", "index", F.when(F.col("new").isNull(), F.lit("D")).otherwise(F.col("symbol")).alias("symbol")
    )
    return seen.unionByName(facts.filter("NOT held").select("conv_id", "part", "index", F.lit("B").alias("symbol")))


def _pieces(symbols: DataFrame, piece: int) -> DataFrame:
    """conv_id, part, block, seq, alone: the symbols of up to `piece` turns in a row, and whether that is all."""
    cut = symbols.withColumn("block", F.floor(F.col("index") / piece))
    ordered = F.sort_array(F.collect_list(F.struct("index", "symbol")))
    grouped = cut.groupBy("conv_id", "part", "block").agg(F.array_join(F.transform(ordered, lambda s: s["symbol"]), "").alias("seq"))
    parts = grouped.groupBy("conv_id").agg(F.count("*").alias("pieces")).withColumnRenamed("conv_id", "whole")
    joined = grouped.join(parts, F.col("conv_id").eqNullSafe(F.col("whole")))
    return pin(joined.select("conv_id", "part", "block", "seq", (F.col("pieces") == 1).alias("alone")))


def _joined(grouped: DataFrame, key: list[str]) -> DataFrame:
    """Pieces put together in their order: one row per key with seq and cells."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, cells = [], []
            for pieces in batch.column("pieces").to_pylist():
                pieces.sort(key=lambda p: p["at"])
                total = None
                for p in pieces:
                    own = [None if c is None else (c["cost"], c["edits"]) for c in p["cells"]]
                    total = own if total is None else product(total, own)
                seqs.append("".join(p["seq"] for p in pieces))
                cells.append([None if c is None else {"cost": c[0], "edits": c[1]} for c in total])
            arrays = [*(batch.column(k) for k in key), pa.array(seqs, pa.string()), pa.array(cells, CELL_TYPE)]
            yield pa.RecordBatch.from_arrays(arrays, [*key, "seq", "cells"])

    schema = T.StructType([*(grouped.schema[k] for k in key), T.StructField("seq", T.StringType()), T.StructField("cells", T._parse_datatype_string(CELLS))])
    return grouped.mapInArrow(put, schema)


CELL_TYPE = pa.list_(pa.struct([("cost", pa.int64()), ("edits", pa.string())]))


def plans(laid: DataFrame, piece: int = PIECE) -> DataFrame:
    """conv_id, seq, cost, audit: symbols and cheapest edits of each conversation.

    Pieces of one conversation are multiplied within a range partition first, then across partitions; a conversation
    arrives as its result alone, one string as long as its edits.
    """
    pieces = _pieces(_symbols(laid), piece)
    different = pin(pieces.groupBy("seq").agg(F.bool_and("alone").alias("alone")))
    rules = learn_rules(different)
    known = matrices(rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            short = rewritten(batch.column("seq").to_pylist(), rules) if batch.num_rows else []
            found = []
            for sequence, alone in zip(short, batch.column("alone").to_pylist(), strict=True):
                cells = evaluate(sequence, known, (0,) if alone else STATES)
                found.append([None if c is None else {"cost": c[0], "edits": c[1]} for c in cells])
            yield pa.RecordBatch.from_arrays([batch.column("seq"), pa.array(found, CELL_TYPE)], ["seq", "cells"])

    judged = pin(pieces.join(different.mapInArrow(judge, f"seq string, cells {CELLS}"), "seq"))
    within = judged.filter("NOT alone").groupBy("conv_id", "part").agg(F.collect_list(F.struct(F.col("block").alias("at"), "seq", "cells")).alias("pieces"))
    across = _joined(within, ["conv_id", "part"]).groupBy("conv_id").agg(F.collect_list(F.struct(F.col("part").alias("at"), "seq", "cells")).alias("pieces"))
    whole = judged.filter("alone").select("conv_id", "seq", "cells").unionByName(_joined(across, ["conv_id"]))
    ends = [
        F.when(F.col("cells")[n].isNotNull(), F.struct((F.col("cells")[n]["cost"] + INSERT * len(e)).alias("cost"), F.concat(F.col("cells")[n]["edits"], F.lit(e)).alias("audit")))
        for n, e in enumerate(CLOSING)
    ]
    best = F.array_min(F.array(*ends))
    return whole.select("conv_id", "seq", best["cost"].alias("cost"), best["audit"].alias("audit"))


def _edited(laid: DataFrame, planned: DataFrame, conv_type: T.DataType) -> DataFrame:
    """The edits of `repaired`, conversations one after another within partitions."""
    heads = planned.select("conv_id", F.lit(-1).alias("part"), F.lit(-1).cast("long").alias("index"), F.col("seq").alias("role"), F.col("audit").alias("text"))
    rows = laid.select("conv_id", "part", "index", "role", "text").unionByName(heads)
    dealt = rows.repartition(parallelism(laid.sparkSession), "conv_id").sortWithinPartitions("conv_id", "part", "index")
    schema = T.StructType(
        [T.StructField("conv_id", conv_type)]
        + [T.StructField(n, T.LongType()) for n in ("step", "place")]
        + [T.StructField(n, T.StringType()) for n in ("edit", "fault", "before", "role", "text")]
    )
    faults = {"B": "blank", "D": "duplicate"}

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seq, audit, at, row, step, place, state = None, "", "", 0, 0, 0, 0, 0
        out: list[tuple] = []
        conv_arrow = None

        def inserts():
            nonlocal at, step, place, state
            while at < len(audit) and audit[at] == "I":
                state = 3 if state == 2 else 2
                out.append((conv, step, place, "I", None, None, "assistant" if state == 3 else "user", ""))
                at, step, place = at + 1, step + 1, place + 1

        def told():
            columns = list(zip(*out, strict=True)) if out else [()] * 8
            arrays = [pa.array(columns[0], conv_arrow)] + [pa.array(c, pa.int64()) for c in columns[1:3]] + [pa.array(c, pa.string()) for c in columns[3:]]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        for batch in batches:
            conv_arrow = batch.column("conv_id").type
            ids, parts, roles, texts = (batch.column(n).to_pylist() for n in ("conv_id", "part", "role", "text"))
            for n, part in enumerate(parts):
                if part < 0:  # a new conversation: its symbols and edits
                    inserts()
                    conv, seq, audit, at, row, step, place, state = ids[n], roles[n], texts[n], 0, 0, 0, 0, 0
                    continue
                inserts()
                edit, symbol, role = audit[at], seq[row], roles[n]
                fault = faults.get(symbol) or ("truncated" if symbol.islower() else None)
                if edit == "K":
                    state = "sua".index(role[0]) + 1
                elif edit == "R":
                    state = 3 if state == 2 else 2
                new = role if edit != "R" else "assistant" if state == 3 else "user"
                out.append((conv, step, None if edit == "D" else place, edit, fault, role, new, texts[n]))
                at, row, step, place = at + 1, row + 1, step + 1, place + (edit != "D")
            yield told()
        if conv_arrow is not None:
            inserts()
            yield told()

    return dealt.mapInArrow(walk, schema)


def repaired(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """The cheapest edits that give each conversation the order (system? (user assistant)+)?, one row per edit.

    Columns: conv_id, step (of the edit), place (of the turn in the repaired conversation, null if deleted), edit (K
    keep, R rerole, D delete, I insert), fault (blank, duplicate, truncated or null), before (role before; null for an
    inserted turn), role and text. Keeping costs 0, rerole 3, insertion of an empty turn 3, deletion 4, an undeleted
    truncated turn 3 more; blank and duplicate turns must go. Of equally cheap edits the ASCII-least string wins.

    Turns are ordered by turn (nulls first), then role, then digest of the text; repeated rows count each. Null role
    and text are one space; roles count by their first letter, and one that is none of s, u, a can't be kept. Rows
    with a null conv_id are one conversation. Texts of any length pass through, one Arrow batch at a time; an empty
    table gives an empty result; other columns of `turns` are not read.
    """
    python_ready(turns.sparkSession)
    blank = F.lit(" ")
    laid = _laid(turns.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")))
    return _edited(laid, plans(laid, piece), turns.schema["conv_id"].dataType)


def _digests(edits: DataFrame, conv_type: T.DataType) -> DataFrame:
    """conv_id, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, read off the edits as they come."""
    counted = ("blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType(
        [T.StructField("conv_id", conv_type)]
        + [T.StructField(n, T.LongType()) for n in counted]
        + [T.StructField(n, T.StringType()) for n in ("audit", "repaired_sha256")]
    )
    prices = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, audit, digest, last, lines = None, [], None, None, 0
        out: list[tuple] = []
        conv_arrow = None

        def closed():
            if held is not None:
                out.append((*held.values(), "".join(audit), digest.hexdigest()))

        def told():
            columns = list(zip(*out, strict=True)) if out else [()] * len(schema)
            arrays = [pa.array(columns[0], conv_arrow)] + [pa.array(c, pa.int64()) for c in columns[1:6]] + [pa.array(c, pa.string()) for c in columns[6:]]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        for batch in batches:
            conv_arrow = batch.column("conv_id").type
            for conv, step, _, edit, fault, before, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if step == 0:
                    closed()
                    held, audit, digest, last, lines = dict.fromkeys(("conv_id", *counted), 0), [], hashlib.sha256(), None, 0
                    held["conv_id"] = conv
                audit.append(edit)
                held["cost"] += prices[edit] + (UNFINISHED if fault == "truncated" and edit != "D" else 0)
                if fault:
                    held[fault] += 1
                if before is not None:
                    letter = before[:1]
                    held["illegal"] += last is not None and last + letter not in ("su", "ua", "au")
                    last = letter
                if edit != "D":
                    digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
            yield told()
        if conv_arrow is not None:
            closed()
            yield told()

    return edits.mapInArrow(read, schema)


def structure_digests(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each damaged conversation.

    One row for every conv_id of `turns`, a null one included; a conversation without rows after the damage has
    zeros, no edits and the digest of the empty string. See `damaged` and `repaired` for the handling of odd rows.
    """
    python_ready(turns.sparkSession)
    conv_type = turns.schema["conv_id"].dataType
    laid = _laid(damaged(turns))
    facts = _digests(_edited(laid, plans(laid, piece), conv_type), conv_type)
    numbered = laid.filter("turn IS NOT NULL").select("conv_id", "turn").distinct()
    gaps = numbered.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))
    all_ids = turns.select("conv_id").distinct()
    out = all_ids.alias("c")
    for name, found in (("f", facts), ("g", gaps)):
        out = out.join(found.alias(name), F.col("c.conv_id").eqNullSafe(F.col(f"{name}.conv_id")), "left")
    zero = F.lit(0).cast("long")
    counts = [F.coalesce(F.col(f"{n}"), zero).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing: Column = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        "c.conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )


def op11_structure_repair(spark, sf_dir: str) -> DataFrame:
    return structure_digests(table(spark, sf_dir, "conversations"))

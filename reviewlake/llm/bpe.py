"""Byte-pair encoding by a priority queue over a linked symbol list, and decoding by vocabulary strings."""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame

from reviewlake.llm.common import python_ready, table

#: Words, and pieces of words, remembered with their ids per Python worker; forgetting only costs time.
STORE = 400_000

# The white space the vocabulary's normaliser folds, and where it cuts a text into pieces.
SPACE = regex.compile(r"[\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: str.split() also cuts at these four, which are no white space to the vocabulary.
SEPARATORS = regex.compile(r"[\x1c-\x1f]")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Recent:
    """A bounded store in two generations: when the younger is full, it becomes the older one."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def find(self, key: str) -> bytes | None:
        value = self.old.get(key)
        if value is not None:
            self.keep(key, value)
        return value

    def keep(self, key: str, value: bytes) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Vocabulary:
    """Ids, merge ranks and special strings of a byte-level vocabulary with word ends."""

    def __init__(self, ids: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int], end: str, library):
        self.special = special
        self.width = max([*ids.values(), *special.values()]) + 1
        self.strings = [""] * self.width
        for text, i in [*ids.items(), *special.items()]:
            self.strings[i] = text
        letters = byte_characters()
        self.inner = [ids[c] for c in letters]
        self.final = [ids[c + end] for c in letters]
        # a pair of ids is one integer; its rank also says what it merges to
        self.ranks = {ids[a] * self.width + ids[b]: rank for rank, (a, b) in enumerate(merges)}
        self.merged = [ids[a + b] for a, b in merges]
        self.marks = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        self.words, self.pieces = Recent(STORE), Recent(STORE)
        # the library's normaliser and splitter serve characters that its Unicode version sees in another way
        self.library = library
        self.bytes_of = {c: b for b, c in enumerate(letters)}
        self.strange: dict[str, bool] = {}
        self.plain = frozenset(map(chr, range(128)))


@lru_cache(maxsize=2)
def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    model = parts["model"]
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    special = {a["content"]: a["id"] for a in parts["added_tokens"]}
    library = tokenizers.Tokenizer.from_file(path)
    return Vocabulary(model["vocab"], merges, special, model["end_of_word_suffix"] or "", library)


def lowered(text: str) -> str:
    """Lower case letter by letter: no rule looks at a letter's neighbours."""
    return text.lower() if "Σ" not in text else "σ".join(part.lower() for part in text.split("Σ"))


def merge_piece(vocabulary: Vocabulary, piece: str) -> list[int]:
    """Ids of one piece.

    Symbols form a doubly linked list; the heap holds rank and position (as one integer) of neighbours that may
    merge. A rank belongs to one pair, so an entry is stale, and skipped, when the symbols now standing at its
    position no longer have that rank.
    """
    raw = piece.encode("utf-8", "surrogatepass")
    n, inner, ranks, width = len(raw), vocabulary.inner, vocabulary.ranks, vocabulary.width
    symbols = [inner[b] for b in raw]
    symbols[-1] = vocabulary.final[raw[-1]]
    rank_of, push, pop, merged = ranks.get, heapq.heappush, heapq.heappop, vocabulary.merged
    pairs = [rank_of(a * width + b) for a, b in zip(symbols, symbols[1:])]
    heap = [rank * n + i for i, rank in enumerate(pairs) if rank is not None]
    if not heap:
        return symbols
    heapq.heapify(heap)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    while heap:
        entry = pop(heap)
        i = entry % n
        j = after[i]
        if j < 0 or symbols[i] < 0 or rank_of(symbols[i] * width + symbols[j]) != entry // n:
            continue
        symbols[i] = new = merged[entry // n]
        symbols[j] = -1
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            rank = rank_of(new * width + symbols[k])
            if rank is not None:
                push(heap, rank * n + i)
        k = before[i]
        if k >= 0:
            rank = rank_of(symbols[k] * width + new)
            if rank is not None:
                push(heap, rank * n + k)
    return [s for s in symbols if s >= 0]


def pack(ids: list[int]) -> bytes:
    """Unsigned 32-bit little-endian."""
    return struct.pack(f"<{len(ids)}I", *ids)


def encode_word(vocabulary: Vocabulary, word: str) -> bytes:
    """Packed ids of a word without white space; short words and pieces are remembered."""
    packed = vocabulary.words.find(word)
    if packed is not None:
        return packed
    pieces, out = vocabulary.pieces, []
    for piece in PIECE.findall(word):
        ids = pieces.young.get(piece) or pieces.find(piece)
        if ids is None:
            ids = pack(merge_piece(vocabulary, piece))
            if len(piece) <= 48:
                pieces.keep(piece, ids)
        out.append(ids)
    packed = out[0] if len(out) == 1 else b"".join(out)
    if len(word) <= 48:
        vocabulary.words.keep(word, packed)
    return packed


def _normal(text: str) -> str:
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return lowered(text)


def _words(text: str) -> list[str]:
    return SPACE.split(text) if SEPARATORS.search(text) else text.split()


def _library_pieces(vocabulary: Vocabulary, text: str) -> list[str]:
    """What the vocabulary's own normaliser and splitter make of a text."""
    normal = vocabulary.library.normalizer.normalize_str(text)
    cut = vocabulary.library.pre_tokenizer.pre_tokenize_str(normal)
    return [bytes(vocabulary.bytes_of[c] for c in piece).decode("utf-8") for piece, _ in cut]


def _strange(vocabulary: Vocabulary, character: str) -> bool:
    """Whether this Python's Unicode tables may see a character in another way than the vocabulary's do.

    They are of other versions: letters, digits and cases that one of them does not know yet differ. Marks that are
    new to one of them may also take other places among marks, so every character unknown here counts.
    """
    known = vocabulary.strange.get(character)
    if known is None:
        known = unicodedata.category(character) in ("Cn", "Co") or any(
            [p for w in _words(_normal(t)) for p in PIECE.findall(w)] != _library_pieces(vocabulary, t)
            for t in (character, f"a{character}a", f"1{character}", f"!{character}!")
        )
        vocabulary.strange[character] = known
    return known


def _encode_plain(vocabulary: Vocabulary, text: str) -> bytes:
    if not text.isascii() and any(_strange(vocabulary, c) for c in set(text) if c not in vocabulary.plain):
        return b"".join(pack(merge_piece(vocabulary, piece)) for piece in _library_pieces(vocabulary, text))
    store, out = vocabulary.words, []
    for word in _words(_normal(text)):
        packed = store.young.get(word)
        out.append(encode_word(vocabulary, word) if packed is None else packed)
    return b"".join(out)


def encode(vocabulary: Vocabulary, text: str | None) -> bytes:
    """Packed ids of a whole text. Null is empty; special strings keep their own ids."""
    text, at, out = text or "", 0, []
    for mark in vocabulary.marks.finditer(text):
        out += [_encode_plain(vocabulary, text[at : mark.start()]), pack([vocabulary.special[mark[0]]])]
        at = mark.end()
    out.append(_encode_plain(vocabulary, text[at:]))
    return b"".join(out)


def decode(vocabulary: Vocabulary, packed: bytes) -> str:
    """The vocabulary's strings one after the other, a space between (the vocabulary names no other joiner)."""
    return " ".join(map(vocabulary.strings.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


def encode_texts(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """One row per row of `df`: the key, `ids` (packed little-endian unsigned 32-bit) and `decoded`."""
    python_ready(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_vocabulary(path)
        for batch in batches:
            ids = [encode(vocabulary, t) for t in batch.column("text").to_pylist()]
            decoded = pa.array([decode(vocabulary, i) for i in ids], pa.string())
            columns = [batch.column("key"), pa.array(ids, pa.binary()), decoded]
            yield pa.RecordBatch.from_arrays(columns, ["key", "ids", "decoded"])

    kind = df.schema[key].dataType.simpleString()
    encoded = df.selectExpr(f"`{key}` AS key", f"`{text}` AS text").mapInArrow(run, f"key {kind}, ids binary, decoded string")
    return encoded.withColumnRenamed("key", key)


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document; the ids themselves stay in the task.

    Encoding and decoding work on whole texts of any length. Null text has no tokens, rows that repeat give equal
    rows, an empty table gives an empty one, other columns are not read.
    """
    python_ready(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_vocabulary(path)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                packed = encode(vocabulary, text)
                said = decode(vocabulary, packed)
                digest = hashlib.sha256(said.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((len(packed) // 4, hashlib.sha256(packed).hexdigest(), digest))
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), default_path())

"""Each document operator against brute force, on rows with nulls, repeats, ties, long texts and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from reviewlake.llm import bpe, decontaminate, lang_id, ngram_join, pii, quality_rules, sharding, suffix_dedup

CLASH = "size shard slot part start index class_id set_id text_id rank md5 marks owner spans row base tokens kept quality m".split()


def word(rnd, letters="abcdefgh"):
    return "".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7)))


def texts():
    rnd = random.Random(7)
    long = " ".join(word(rnd) for _ in range(4000))
    near = [word(rnd) for _ in range(120)]
    edits = []
    for k in range(4):
        copy = list(near)
        copy[30 * k + 3] = "edited"
        edits.append(" ".join(copy))
    passage = " ".join(word(rnd) for _ in range(30))
    return [
        (1, " ".join(near)), (1, " ".join(near)), (2, " ".join(near)), (None, " ".join(near)),
        *[(10 + k, e) for k, e in enumerate(edits)],
        (20, None), (21, ""), (22, "   \n\t"), (None, None), (23, "one two"), (24, "one two"), (25, "One, two!"),
        (30, long), (31, long[:9000] + " tail"), (32, "same line\nsame line\n" * 30), (33, "a" * 5000), (34, "a" * 5000),
        (40, passage + " alpha"), (41, "beta " + passage), (42, "x " + passage + " y " + passage), (2**60 + 1, passage + " alpha"),
        (50, "mail me at jane.doe@mail.example.com or +1 (212) 555-0187, 10.0.0.256 10.0.0.255"),
        (51, "card 4111 1111 1111 1111 not 4111 1111 1111 1112"), (52, "é🙂 a@b.co ünï "),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    df = spark.createDataFrame(texts(), schema).repartition(3)
    return df.withColumns({"lang": F.lit(None).cast("string"), **{c: F.lit("x") for c in CLASH}})


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def counted(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_empty_tables(spark, docs, none):
    results = [
        sharding.shard_documents(none),
        ngram_join.similar_classes(none),
        quality_rules.judge(none, None),
        bpe.token_digests(none, bpe.default_path()),
        pii.personal_data(none),
        lang_id.predict(none, lang_id.learn(none)),
        suffix_dedup.removed_repeats(none),
        decontaminate.leaks(none, none.select(F.col("doc_id").alias("item_id"), "text")),
        decontaminate.leaks(docs, none.select(F.col("doc_id").alias("item_id"), "text")),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_shards_are_contiguous_gapless_and_even(docs):
    got = sharding.shard_documents(docs, 5).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in texts()
    )
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    for k in range(5):
        part = [r for r in got if r.shard == k]
        assert sorted(r.slot for r in part) == list(range(len(part)))
        assert abs(sum(r.size for r in part) - total / 5) <= largest
    order = sorted((r.shard, r.slot, -1 if r.doc_id is None else r.doc_id) for r in got)
    assert [o[2] for o in order] == sorted(o[2] for o in order)


def shingle_set(text):
    words = re.findall(r"\w+", (text or "").lower())
    return {tuple(words)} if 0 < len(words) < 5 else set(zip(*(words[k:] for k in range(5))))


def classes_by_hand(rows):
    key = lambda d: (d is None, d or 0)
    firsts = {}
    for d, t in rows:
        firsts[t or ""] = min(firsts.get(t or "", d), d, key=key)
    names = list(firsts)
    sets = [shingle_set(t) for t in names]
    root, links = list(range(len(names))), [0] * len(names)

    def top(i):
        return i if root[i] == i else top(root[i])

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and len(a & b) / len(a | b) >= 0.8:
                links[i], links[j] = links[i] + 1, links[j] + 1
                root[top(i)] = top(j)
    head = {}
    for i, name in enumerate(names):
        head[top(i)] = min(head.get(top(i), firsts[name]), firsts[name], key=key)
    at = {name: i for i, name in enumerate(names)}
    return Counter((d, head[top(at[t or ""])], links[at[t or ""]]) for d, t in rows)


def test_similar_classes_and_links(docs):
    assert counted(ngram_join.similar_classes(docs), "doc_id", "class_id", "n_links") == classes_by_hand(texts())


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    rnd = random.Random(3)
    base = [word(rnd) for _ in range(150)]
    rows = []
    for i in range(60):
        copy = list(base)
        copy[rnd.randrange(150)] = f"w{i}"
        rows.append((i, " ".join(copy)))
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert counted(ngram_join.similar_classes(df), "doc_id", "class_id", "n_links") == classes_by_hand(rows)


def test_links_at_exactly_the_threshold_in_groups_of_any_size():
    for k in (1, 2, 3, 6, 7, 8, 9, 11, 50, 333):
        a, b, less = np.arange(5 * k), np.arange(4 * k), np.arange(k, 5 * k - 1)  # 4k of 5k in common, and one fewer
        for others in (0, 6):
            sets = [s.astype(np.uint64) for s in (a, b, less, *(np.arange(10 * k) + 10_000 * (i + 1) for i in range(others)))]
            n = len(sets)
            got = {r[0]: r[2] for r in ngram_join.compare(list(range(n)), [1] * n, [0] * n, sets, 6)}
            wanted = {i: sum(j != i and 5 * len(np.intersect1d(x, y)) >= 4 * len(np.union1d(x, y)) for j, y in enumerate(sets)) for i, x in enumerate(sets)}
            assert got == {i: m for i, m in wanted.items() if m} and got[0] == got[1] == 1


def test_one_of_each_class_is_kept(docs):
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    wanted = {c for (_, c, _) in classes_by_hand(texts())}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(wanted)


def test_prefix_length_meets_the_target():
    length = ngram_join.first_length()
    assert ngram_join.found_share(0.8, length) >= ngram_join.RECALL > ngram_join.found_share(0.8, length + 1)


def test_the_forest_itself_meets_the_target_at_the_threshold():
    rng, length, missed = np.random.default_rng(2), ngram_join.first_length(), 0.0
    values = ngram_join.VALUES
    for k in range(66, 122):  # by the number of equal values of a signature; fewer or more hardly ever occur or miss
        share = math.comb(values, k) * 0.8**k * 0.2 ** (values - k)
        if share > 1e-9:
            equal = np.zeros((4000, values), dtype=bool)
            np.put_along_axis(equal, np.argsort(rng.random((4000, values)), axis=1)[:, :k], True, axis=1)
            missed += share * (~np.any([equal[:, p].all(axis=1) for p in ngram_join.PATHS[:, :length]], axis=0)).mean()
    assert missed <= 1 - ngram_join.RECALL
    assert 1 - ngram_join.found_share(0.8, 8) == pytest.approx(8.7e-4, rel=0.01)


def test_close_copies_do_not_hide_the_loss_of_weak_links():
    near = [np.arange(1000, dtype=np.uint64) + np.uint64(k) for k in range(20)]
    weak = np.arange(110, 1000, dtype=np.uint64)[:800]  # 0.8 of the first set
    sets = [*near, weak]
    told = ngram_join.compare(list(range(21)), [1] * 21, [0] * 21, sets, 8)
    assert max(r[3] for r in told) > 50 * (1 - ngram_join.RECALL)


def base_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    times, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if times[w] > 1:
            covered |= set(range(k, k + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_base_counts(docs):
    columns = ("doc_id", *quality_rules.BASE, "base_failed")
    assert counted(quality_rules.judge(docs, None), *columns) == Counter((d, *base_by_hand(t)) for d, t in texts())
    assert quality_rules.statistics("a\x1cb \x85c d")[0][0] == 2


def test_trees_follow_their_constraints_and_learn():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] < 0.5) & (x[:, 1] > 0.3)).astype(float)
    trees = quality_rules.fit(x, y, [-1, 0, 0])
    assert ((trees.probability(x) >= 0.5) == (y > 0)).mean() > 0.98
    noisy = quality_rules.fit(x, rng.integers(0, 2, 3000).astype(float), [-1, 1, 0])
    grid = np.linspace(0, 1, 50)
    for fixed in rng.random((20, 3)):
        rows = np.tile(fixed, (50, 1))
        rows[:, 0] = grid
        assert (np.diff(noisy.probability(rows)) <= 1e-12).all()
        rows = np.tile(fixed, (50, 1))
        rows[:, 1] = grid
        assert (np.diff(noisy.probability(rows)) >= -1e-12).all()


def test_tokens_are_those_of_the_library(docs):
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.default_path()
    theirs = tokenizers.Tokenizer.from_file(path)
    theirs.no_truncation()
    theirs.no_padding()
    mine = bpe.load_vocabulary(path)
    rnd = random.Random(1)
    pool = "aAbZ'sdtré É́ΣςİßǅK\x1c\x1f\x85​ \t\n 09²½漢字🙂<|endoftext|>_-..!?'ll'RE"
    for text in ["", "<|startoftext|>a<|endoftext|> b", *("".join(rnd.choices(pool, k=rnd.randint(0, 50))) for _ in range(600))]:
        ids = theirs.encode(text, add_special_tokens=False).ids
        packed = bpe.encode(mine, text)
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert bpe.decode(mine, packed) == theirs.decode(ids, skip_special_tokens=False)
    wanted = Counter()
    for d, t in texts():
        ids = theirs.encode(t or "", add_special_tokens=False).ids
        said = theirs.decode(ids, skip_special_tokens=False)
        wanted[d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()] += 1
    assert counted(bpe.token_digests(docs, path), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == wanted


RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def rules_by_hand(text):
    out = []
    for rank, (kind, pattern) in enumerate(RULES.items()):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if c.isdigit()]
            luhn = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits[::-1])) % 10 == 0
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15}
            if good[kind]:
                out.append((m.start(), rank, m.end(), kind))
    return tuple(sorted(out))


def test_rules_find_what_the_plain_patterns_find(spark, docs):
    got = Counter((r.doc_id, tuple(tuple(s) for s in r.base)) for r in pii.personal_data(docs).collect())
    assert got == Counter((d, rules_by_hand(t)) for d, t in texts())
    rnd = random.Random(5)
    odd = ["".join(rnd.choices("0123456789 -.+()@ab_é🙂\n", k=rnd.randint(0, 70))) for _ in range(1500)] + ["0" * 20_000, "1-" * 4000]
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    got = {r.doc_id: tuple(tuple(s) for s in r.base) for r in pii.personal_data(df).collect()}
    assert [i for i, t in enumerate(odd) if got[i] != rules_by_hand(t)] == []


def test_context_finds_identifiers_no_rule_knows(spark):
    rows = [(i, f"please contact user{i}@mail.example.org today") for i in range(12)]
    rows += [(100, "please contact ID77-4411-902 today"), (101, "nothing of that kind 12345678 here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: [(s.start, s.end, s.kind) for s in r.spans] for r in pii.personal_data(df).collect()}
    assert spans[100] == [(15, 28, "identifier")] and spans[101] == []
    clean = {r.doc_id: r.text for r in pii.redacted(df).collect()}
    assert clean[100] == "please contact <IDENTIFIER> today" and clean[3] == "please contact <EMAIL> today"
    assert clean[101] == rows[-1][1]


def test_redaction_keeps_rows_and_columns(docs):
    clean = pii.redacted(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert [r.text for r in clean.filter("doc_id = 52").collect()] == ["é🙂 <EMAIL> ünï "]


def ppm_by_hand(contexts, counts, text):
    """Bits of `text` by the rule, byte by byte: counts[(order, context)][byte] of one language."""
    raw, total = b"\0" * 3 + text, 0.0
    for at in range(3, len(raw)):
        last, order = raw[at - 3 : at], 3
        while (order, int.from_bytes(last[3 - order :], "big")) not in contexts:
            order -= 1
        while True:
            seen = counts.get((order, int.from_bytes(last[3 - order :], "big")), {})
            n, d = sum(seen.values()), len(seen)
            if raw[at] in seen:
                total -= np.log2(seen[raw[at]] / (n + d))
                break
            total -= np.log2(d / (n + d)) if n else 0.0
            if order == 0:
                total += 8
                break
            order -= 1
    return total


def test_code_lengths_and_languages(spark):
    rnd = random.Random(2)
    alphabets = {"aa": "abcde", "bb": "cdefg", "cc": "éüxyz"}
    rows = [(i, " ".join(word(rnd, alphabets[lang]) for _ in range(30)), lang) for i in range(60) for lang in alphabets]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "12 34 !", "cc"), (903, "abc", None), (None, "xyz xyz", "cc")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    teaching = df.filter("lang is not null and text is not null")
    model = lang_id.learn(teaching)
    got = {(r.doc_id, r.lang_pred) for r in lang_id.predict(df, model).collect()}
    assert {(i, lang) for i, _, lang in rows[:180]} <= got
    assert {(900, "und"), (901, "und"), (902, "und"), (None, "cc")} <= got
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in lang_id.predict(df, model).collect())
    contexts = set(model.contexts)
    for k, lang in enumerate(model.langs):
        counts = {}
        for _, text, own in rows:
            if own == lang and text:
                raw = b"\0" * 3 + text.encode()
                for at in range(3, len(raw)):
                    for order in range(4):
                        key = (order, int.from_bytes(raw[at - order : at], "big"))
                        counts.setdefault(key, Counter())[raw[at]] += 1
        for text in ("abc cab é", "zzz q"):
            bits = model.lengths(model.lookup(), [text.encode()])[0][k]
            assert abs(bits - ppm_by_hand(contexts, counts, text.encode())) < 1e-3


def test_every_context_of_a_small_language_is_kept(spark):
    rnd = random.Random(12)
    rows = [(i, "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=4000)), "big") for i in range(40)]
    small = "éñüç βγδ"
    rows.append((99, small, "tiny"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    raws = [b"\0" * 3 + t.encode() for _, t, _ in rows]
    wanted = {(k, int.from_bytes(raw[at - k : at], "big")) for raw in raws for at in range(3, len(raw)) for k in range(4)}
    assert len(wanted) > 4096 and set(lang_id.learn(df).contexts) == wanted


def test_every_code_point_has_the_ids_of_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    vocabulary, library = bpe.load_vocabulary(bpe.default_path()), tokenizers.Tokenizer.from_file(bpe.default_path())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b {chr(c)}" for c in points if c < 0x33500 or 0xE0000 <= c < 0xF0000]
    rest = [c for c in points if not (c < 0x33500 or 0xE0000 <= c < 0xF0000)]  # unassigned or private: many in a text
    texts += [" ".join(f"a{chr(c)}b {chr(c)}" for c in rest[at : at + 200]) for at in range(0, len(rest), 200)]
    for at in range(0, len(texts), 50_000):
        part = texts[at : at + 50_000]
        for text, found in zip(part, library.encode_batch(part, add_special_tokens=False), strict=True):
            assert bpe.encode(vocabulary, text) == bpe.pack(found.ids), text[:40].encode("unicode_escape")


def repeats_by_hand(rows):
    key = lambda d: 2**63 if d is None else d
    owner = {}
    for d, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - 49):
            w = raw[k : k + 50]
            owner[w] = min(owner.get(w, 2**64), key(d))
    out = Counter()
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 49):
            if owner[raw[k : k + 50]] < key(d):
                gone[k : k + 50] = b"\1" * 50
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out[d, len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()] += 1
    return out


@pytest.mark.parametrize("many", [20_000, 2])
def test_repeats_go(docs, monkeypatch, many):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert counted(suffix_dedup.removed_repeats(docs), *columns) == repeats_by_hand(texts())


@pytest.mark.parametrize("many", [20_000, 50])
def test_one_passage_in_many_surroundings(spark, monkeypatch, many):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    rnd = random.Random(6)
    passage = "this very passage stands in all the documents of this table, whatever is around it."
    rows = [(k, f"{word(rnd)} {word(rnd)}{k} {passage} {k} {word(rnd)}") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert counted(suffix_dedup.removed_repeats(df), *columns) == repeats_by_hand(rows)


def test_suffixes_are_sorted_and_prefixes_measured():
    rnd = random.Random(9)
    for alphabet in ("a", "ab", "abc de"):
        parts = [("".join(rnd.choices(alphabet, k=rnd.randint(50, 160)))).encode() for _ in range(5)]
        text = np.frombuffer(b"\xff".join(parts) + b"\xff", dtype=np.uint8)
        order, words = suffix_dedup.suffix_array(text)
        assert sorted(order.tolist()) == list(range(len(text)))
        whole = bytes(text)
        valid = [i for i in order.tolist() if b"\xff" not in whole[i : i + 50] and i + 50 <= len(whole)]
        assert [whole[i : i + 50] for i in valid] == sorted(whole[i : i + 50] for i in valid)
        measured = suffix_dedup.common_prefixes(np.array(valid), words)
        for a, b, n in zip(valid, valid[1:], measured[1:]):
            same = next((k for k in range(50) if whole[a + k] != whole[b + k]), 50)
            assert n == same


def test_leaks_exact_and_edited(spark):
    rnd = random.Random(4)
    items = [(k, " ".join(word(rnd) for _ in range(36))) for k in range(6)] + [(7, None), (8, ""), (9, "the of")]
    rows = [(k, " ".join(word(rnd) for _ in range(200))) for k in range(40)] + [(60, None), (61, "")]
    for k in range(5):
        body = [word(rnd) for _ in range(80)]
        copy = items[k][1].split()
        if k % 2:
            for at in range(2, 36, 7):
                copy[at] = "changed"
            copy.insert(20, "more")
        rows.append((100 + k, " ".join(body[:40]) + "! " + " ".join(copy).upper() + ". " + " ".join(body[40:])))
    rows += [rows[-1], (None, rows[-1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect())
    assert got == Counter([(100 + k, k) for k in range(5)] + [(104, 4), (None, 4)])
    kept = decontaminate.without_leaks(docs, bench)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter([*range(40), 60, 61])


def test_leaks_equal_full_alignment(spark):
    """Every document against every item, aligned whole; copies edited down to the least score that counts."""
    rnd = random.Random(14)
    few = [word(rnd) for _ in range(60)]
    items = [(k, " ".join(rnd.choice(few) for _ in range(rnd.randint(12, 30)))) for k in range(12)]
    items += [(20, "no no no no"), (21, "two words"), (22, "wordalone"), (23, "again and again and again and again")]
    rows = [(k, " ".join(rnd.choice(few) for _ in range(rnd.randint(5, 150)))) for k in range(80)]
    rows += [(200 + k, f"{few[k]} {items[k][1] if k < 12 else ''} {few[k + 1]}") for k in range(12)]
    for k, step in enumerate((3, 3, 4, 5, 3, 3, 6, 4)):
        copy = [f"x{n}" if n % step == step - 1 else w for n, w in enumerate(items[k][1].split())]
        rows.append((300 + k, " ".join([*(rnd.choice(few) for _ in range(9)), *copy, few[0]])))
    rows += [(400, "oh no no no no way"), (401, "just two words here"), (402, "a wordalone b"), (403, "x again and again and again and again")]
    expected = set()
    for doc, text in rows:
        for item, wanted in items:
            a, b = decontaminate.words_of(wanted), decontaminate.words_of(text)
            number = {w: n for n, w in enumerate(dict.fromkeys(a + b))}
            if decontaminate.align(np.array([number[w] for w in a]), np.array([number[w] for w in b]))[0] >= decontaminate.SCORE:
                expected.add((doc, item))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    copies = {(200 + k, k) for k in range(12)} | {(300 + k, k) for k in range(8)} | {(400, 20), (401, 21), (402, 22), (403, 23)}
    assert got <= expected and copies & expected <= got and len(copies & expected) >= 20
    assert len(got) >= 0.9 * len(expected), (len(got), len(expected))


def test_common_contamination_is_still_found(spark):
    rnd = random.Random(6)
    item = " ".join(word(rnd) for _ in range(30))
    rows = [(k, f"{word(rnd)} {item} {word(rnd)}") for k in range(50)] + [(k, " ".join(word(rnd) for _ in range(60))) for k in range(50, 100)]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.leaks(docs, bench).collect()) == list(range(50))


def test_edited_copies_are_found_beside_exact_ones(spark):
    rnd = random.Random(8)
    item = [word(rnd) for _ in range(20)]
    fill = lambda n: " ".join(word(rnd, "qrstuv") for _ in range(n))
    edited = " ".join("changed" if k % 4 == 3 else w for k, w in enumerate(item))
    held = [*[" ".join(item)] * 5, edited, " ".join(item[:12])]
    rows = [(k, f"{fill(30)} {text} {fill(30)}") for k, text in enumerate(held)] + [(k, fill(60)) for k in range(100, 293)]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r.score for r in decontaminate.leaks(docs, bench).collect()}
    # Of the edited copy's last run, the replaced last word is left out: 15 kept words, 4 replaced between them.
    assert got == {**{k: 1.0 for k in range(5)}, 5: 26 / 40, 6: 24 / 40}


def test_stages_keep_the_columns(spark, docs, tmp_path):
    labels = spark.createDataFrame([(1, 1), (32, 0), (33, 0), (30, 1)], "doc_id long, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "nothing like it")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality rules"
    assert corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).count() == now.count() > 0

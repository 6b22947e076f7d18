"""Structure repair, whitening and fair mixing against brute force, on rows with nulls, repeats, ties and odd columns."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm import fair_mix, structure, whitening

CLASH = "part index seq cells step place block fault audit n x id finish use target taken base rank level size".split()


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASH if c not in df.columns})


# --- structure repair -------------------------------------------------------------------------------------------------


def turn_rows():
    rnd = random.Random(3)
    said = ["Hello there.", "Hello", "yes?", "", " \t", "What!", "no", "ü.\n", None]
    rows = []
    for conv in range(60):
        for turn in range(rnd.randint(1, 7)):
            if rnd.random() < 0.9:
                role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
                rows.append((conv, turn, role, rnd.choice(said)))
    rows += [(100, None, "user", "a."), (100, 2, "assistant", "b."), (100, None, "user", "a."), (None, 1, "user", "q."), (None, 1, "user", "q.")]
    rows += [(101, None, None, None), (103, 5, "user", "x" * 200_000 + ".")]
    rows += [(102, 0, "user", "same.")] * 30 + [(104, k, "user" if k % 3 else "assistant", f"turn {k}.") for k in range(90)]
    return rows


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(place.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))


def brute(rows):
    """Counts and cheapest repair of one conversation, state by state over whole edit strings."""
    rows = in_order(rows)
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append(
            "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        )
        seen.add((role, text))
    best = {0: (0, "", ())}  # roles so far: nothing, s, u, a -> cost, edits, repaired

    def insert(now):
        for _ in range(2):
            for state, (cost, edits, out) in list(now.items()):
                new = (cost + 3, edits + "I", (*out, ("assistant" if state == 2 else "user") + ":"))
                to = 3 if state == 2 else 2
                if to not in now or new[:2] < now[to][:2]:
                    now[to] = new
        return now

    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        after = {}

        def offer(to, new, after=after):
            if to not in after or new[:2] < after[to][:2]:
                after[to] = new

        for state, (cost, edits, out) in insert(best).items():
            offer(state, (cost + 4, edits + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more, wanted = 3 if fault else 0, "assistant" if state == 2 else "user"
            to = 3 if state == 2 else 2
            offer(to, (cost + 3 + more, edits + "R", (*out, f"{wanted}:{text}")))
            if role[:1] == wanted[0]:
                offer(to, (cost + more, edits + "K", (*out, f"{role}:{text}")))
            if role[:1] == "s" and state == 0:
                offer(1, (cost + more, edits + "K", (*out, f"{role}:{text}")))
        best = after
    cost, audit, out = min((v for k, v in insert(best).items() if k in (0, 3)), key=lambda v: v[:2])
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    letters = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(letters))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


TURNS = T.StructType([T.StructField(n, t()) for n, t in zip(("conv_id", "turn", "role", "text"), (T.LongType, T.LongType, T.StringType, T.StringType), strict=True)])


@pytest.mark.parametrize("piece", [structure.PIECE, 3])
def test_structure_repair_equals_brute_force(spark, piece):
    rows = turn_rows()
    df = clashing(spark.createDataFrame(rows, TURNS).repartition(3))
    got = {r[0]: tuple(r)[1:] for r in structure.structure_digests(df, piece).collect()}
    kept = defaultdict(list)
    for row in hurt(rows):
        kept[row[0]].append(row)
    assert set(got) == {r[0] for r in rows}
    for conv, found in got.items():
        assert found == brute(kept[conv]), conv


def test_structure_repair_of_nothing(spark):
    none = clashing(spark.createDataFrame([], TURNS))
    assert structure.structure_digests(none).count() == 0 and structure.repaired(none).count() == 0


def test_repaired_turns_have_the_wanted_order(spark):
    edits = structure.repaired(spark.createDataFrame(turn_rows(), TURNS), 5).collect()
    by = defaultdict(list)
    for e in edits:
        if e["edit"] != "D":
            by[e["conv_id"]].append(e)
    for turns in by.values():
        turns.sort(key=lambda e: e["place"])
        assert [e["place"] for e in turns] == list(range(len(turns)))
        assert re.fullmatch("(s?(ua)+)?", "".join(e["role"][:1] for e in turns))


def test_rules_change_no_result_and_are_shared():
    rnd = random.Random(5)
    sequences = ["".join(rnd.choice("SUuAaBD") for _ in range(rnd.randint(1, 40))) for _ in range(50)]
    rules = [("U", "A", chr(structure.FIRST_RULE)), (chr(structure.FIRST_RULE),) * 2 + (chr(structure.FIRST_RULE + 1),)]
    known = structure.matrices(rules)
    for plain, short in zip(sequences, structure.rewritten(sequences, rules), strict=True):
        assert structure.evaluate(plain, known) == structure.evaluate(short, known)


def test_frequent_pairs_become_rules(spark):
    sequences = spark.createDataFrame([("UAUAUA" + "D" * k,) for k in range(20)], "seq string")
    rules = structure.learn_rules(sequences)
    assert ("U", "A") in [r[:2] for r in rules] and len(rules) > 2
    assert max(len(s) for s in structure.rewritten(["UAUAUA"], rules)) < 3
    pairs, uses = structure.pair_counts(["AAAA", "AAA"])
    assert dict(zip(pairs.tolist(), uses.tolist(), strict=True)) == {(65 << 32) + 65: 3}


def test_ropes_compare_as_strings():
    rnd = random.Random(9)
    ropes = [structure.Rope("D"), structure.Rope("I"), structure.Rope("KI")]
    for _ in range(60):
        ropes.append(rnd.choice(ropes) + rnd.choice(ropes))
    for a, b in itertools.product(ropes[::3], ropes[::2]):
        assert (a < b) == (str(a) < str(b))


# --- whitening --------------------------------------------------------------------------------------------------------


def vectors():
    rng = np.random.default_rng(2)
    sound = (rng.normal(size=(300, 20)) @ np.diag(np.linspace(0.3, 3, 20))).tolist()
    odd = [None, [], [1.0] * 19, [float("nan")] + [0.0] * 19, [float("inf")] + [0.0] * 19, [None] + [0.0] * 19]
    return sound + odd + [sound[0]] * 500


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def test_whitening_equals_a_dense_decomposition(spark):
    rows = [(None if k == 7 else k, v) for k, v in enumerate(vectors())]
    df = clashing(spark.createDataFrame(rows, VECTORS).repartition(4))
    got = whitening.whitened(df).toPandas()
    grid = [(i, [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v]) for i, v in rows if v and len(v) == 20 and None not in v and np.isfinite(v).all()]
    fit = np.array(sorted({tuple(x) for _, x in grid}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = ((fit * n - sums) / n).astype(float)
    values, rows_ = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1][:16], rows_[:, ::-1][:, :16]
    assert (got["n"] == n).all() and len(got) == 16 * len(grid) and (got["identity_error"] < 1e-10).all()
    deviation = Counter((i, int(((np.array(x, dtype=object) * n - sums) ** 2).sum())) for i, x in grid)
    one = got[got["component"] == 1]
    assert Counter(zip([None if np.isnan(i) else int(i) for i in one["vec_id"]], one["deviation"], strict=True)) == deviation
    expected = {i: ((np.array(x, dtype=object) * n - sums) / n).astype(float) @ components / np.sqrt(values) for i, x in grid}
    wide = got[got["vec_id"].notna()].drop_duplicates(["vec_id", "component"]).pivot(index="vec_id", columns="component", values="whitened")
    whole = np.array([expected[int(i)] for i in wide.index])
    signs = np.sign((wide.to_numpy() * whole).sum(axis=0))
    assert np.allclose(wide.to_numpy(), whole * signs, atol=1e-8)
    trace = np.trace(centred.T @ centred / n)
    assert np.allclose(got.drop_duplicates("component").sort_values("component")["explained"], values / trace, rtol=1e-9)


def test_whitening_of_few_and_of_equal_vectors(spark):
    none = spark.createDataFrame([], VECTORS)
    assert whitening.whitened(none).count() == 0
    equal = spark.createDataFrame([(k, [0.5, 1.0]) for k in range(5)], VECTORS)
    assert whitening.whitened(equal).count() == 0
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 0.0]) for k in range(9)], VECTORS)
    got = whitening.whitened(line).collect()
    assert len(got) == 9 and {r["component"] for r in got} == {1} and got[0]["identity_error"] < 1e-12
    huge = spark.createDataFrame([(k, [1e12 * (k % 3), float(k)]) for k in range(9)], VECTORS)
    assert whitening.whitened(huge).count() == 18


def test_scatter_is_exact_beyond_doubles(spark):
    rows = [(k, [float(2**30 + 3 * k), float(k * k % 7)]) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit_whitening(whitening.gridded(df).select("x"))
    grid = np.array([[int(64 * c) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    assert model.n == 40 and list(model.sums) == grid.sum(axis=0).tolist()
    scaled = grid * 40 - grid.sum(axis=0)
    assert model.trace == int((scaled**2).sum()) / 40**3


def test_jacobi_keeps_small_scales_and_ranks():
    rng = np.random.default_rng(4)
    for d, rank in ((30, 30), (30, 4), (1, 1), (5, 5)):
        x = rng.normal(size=(200, rank)) @ rng.normal(size=(rank, d))
        v = x.T @ x
        values, rows = whitening.eigen(v)
        assert len(values) == rank and np.allclose(rows @ rows.T, np.eye(rank), atol=1e-12)
        assert np.allclose((rows.T * values) @ rows, v, atol=1e-9 * v.max())
    apart = np.diag([1e14, 1.0, 1e-6])
    assert np.allclose(whitening.eigen(apart)[0], [1e14, 1.0, 1e-6], rtol=1e-12)


# --- fair mixing ------------------------------------------------------------------------------------------------------


def mix_rows():
    rnd = random.Random(11)
    rows = []
    for k in range(400):
        source = rnd.choice(["web", "web", "web", "books", "Äther", "code", None])
        rows.append((k, " ".join("w" for _ in range(rnd.choice([0, 1, 5, 30, 400]))), source))
    rows += [(1000, "one two three", "web")] * 2500  # one row repeated
    rows += [(1001, "long " * 20_000, "rare"), (1002, "a b", "rare"), (None, "x y z", "code"), (None, None, None), (1003, "", "empty")]
    return rows


DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())])


def targets_by_resharing(sizes, weights, share, repeats):
    """What the contract says, step by step: hand out by weight, stop at the cap, reshare the excess."""
    target = {s: 0.0 for s in sizes}
    left, open_ = share * sum(sizes.values()), set(sizes)
    while left > 1e-9 and open_:
        whole = sum(weights[s] for s in open_)
        for s in open_:
            target[s] += left * weights[s] / whole
        left = sum(max(target[s] - repeats * sizes[s], 0) for s in sizes)
        for s in sizes:
            target[s] = min(target[s], repeats * sizes[s])
        open_ = {s for s in open_ if target[s] < repeats * sizes[s]}
    return target


def test_mix_meets_targets_and_reruns_agree(spark):
    rows = mix_rows()
    df = clashing(spark.createDataFrame(rows, DOCS))
    got = fair_mix.taken_words(df.repartition(5)).collect()
    again = fair_mix.taken_words(df.repartition(2)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((d, s, size(t)) for d, t, s in rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += size(text)
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: fair_mix.WEIGHTS[k % 3] for k, s in enumerate(order)}
    expected = targets_by_resharing(sizes, weights, 1.5, 2)
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]], rel=1e-9, abs=1e-9)
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert expected[s] - 1.001 <= taken[s] <= expected[s] + 1e-6


def test_mix_is_a_sequence_within_its_budget(spark):
    mix = [r for r in fair_mix.mixed(spark.createDataFrame(mix_rows(), DOCS)).collect() if r["words"]]
    mix.sort(key=lambda r: r["place"])
    at = 0
    for r in mix:
        assert r["place"] == at
        at += r["words"]
    assert [r["finish"] for r in mix] == sorted(r["finish"] for r in mix)
    half = Counter()
    for r in mix:  # at any moment sources are served in proportion to their targets
        if r["place"] < at / 2:
            half[r["source"]] += r["words"]
    target = {r["source"]: r["target"] for r in mix}
    for s in ("web", "books", "code"):
        assert half[s] == pytest.approx(target[s] / 2, abs=3000 + 400)
    cut = [r for r in mix if r["words"] < r["size"] * r["copies"]]
    assert all(n == 1 for n in Counter(r["source"] for r in cut).values())


def test_mix_of_nothing_and_of_no_words(spark):
    none = spark.createDataFrame([], DOCS)
    assert fair_mix.taken_words(none).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (2, " ", None)], DOCS)
    assert [tuple(r)[2:] for r in fair_mix.taken_words(blank).collect()] == [(0, 0, 0.0, 0)] * 3


def test_mix_runs_no_python_worker(spark):
    plan = fair_mix.taken_words(spark.createDataFrame(mix_rows(), DOCS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan

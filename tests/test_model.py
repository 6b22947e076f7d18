import datetime as dt
import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewlake.functions.decision import label_name, predicted_label, psi_band
from reviewlake.functions import text
from reviewlake.functions.text import analyzed_counts, count_in_pieces, shorten
from reviewlake.operators import explain, serving, training
from reviewlake.operators.features import Vectorizer, term_statistics, tfidf, vocabulary, with_terms, with_words, word_statistics, word_tfidf
from reviewlake.operators.registry import Registry, promotion_history
from reviewlake.operators.scoring import LinearModel, daily_summary, negative_probability, predictions
from reviewlake.schemas import CLEAN_SCHEMA, ContractError, conform

GOOD = "superb lovely smooth charming brilliant delightful polished elegant joyful bright".split()
BAD = "broken awful boring crash refund ugly laggy buggy terrible waste".split()


def clean_frame(spark, boost=False):
    rng = random.Random(42)
    rows = []
    for i in range(200):
        label = 1 if i < 100 else 0
        text = " ".join(rng.choice(GOOD if label else BAD) for _ in range(rng.randint(5, 15)))
        rows.append((f"r{i}", text, label, "natural", 1_672_531_200 + 60 * i))
        if boost and label == 0 and i < 140:
            rows.append((f"r{i}_b", text, label, "negative_boost", 1_672_531_200 + 60 * i))
    df = spark.createDataFrame(rows, "review_id string, review_text string, label long, sample_source string, s long")
    return conform(
        df.withColumns(
            {
                "app_id": F.lit(1),
                "language": F.lit("english"),
                "created_at": F.timestamp_seconds("s"),
                "updated_at": F.timestamp_seconds("s"),
                "votes_up": F.lit(0),
                "weighted_vote_score": F.lit(0.5),
                "playtime_at_review_min": F.lit(1),
                "author_pseudo": F.sha2("review_id", 256),
                "text_len": F.length("review_text"),
            }
        ),
        CLEAN_SCHEMA,
    )


def grams_of(text, low, high):
    found = []
    for word in text.lower().split():
        padded = f" {word} "
        for n in range(low, high + 1):
            if n >= len(padded):
                found.append(padded)
                break
            found += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    return Counter(found)


TEXTS = ["Le Jeu est génial!", "a", "", "  ", "aa aa b", "ça  ira\tbien", "été 日本語 ok", "x" * 40]


@pytest.mark.parametrize("low, high", [(2, 5), (2, 3), (3, 4)])
def test_char_ngrams_equal_brute_force(spark, low, high):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    rows = df.select("i", analyzed_counts(F.col("t"), "char_wb", (low, high)).alias("c")).collect()
    for row in rows:
        assert {x["term"]: x["tf"] for x in row["c"]} == dict(grams_of(TEXTS[row["i"]], low, high))


def test_word_ngrams_equal_brute_force(spark):
    texts = TEXTS + ["one two  two three_4 é è un mot"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", analyzed_counts(F.col("t"), "word", (1, 2)).alias("c")).collect()
    for row in rows:
        words = re.findall(r"(?u)\b\w\w+\b", texts[row["i"]].lower())
        expected = Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
        assert {x["term"]: x["tf"] for x in row["c"]} == dict(expected)


def test_vocabulary_cap_keeps_the_most_frequent(spark):
    docs = [("d1", "aa aa aa bb cc"), ("d2", "aa bb bb dd"), ("d3", "cc dd ee")]
    df = spark.createDataFrame(docs, "review_id string, review_text string")
    spec = Vectorizer("word", (1, 1), min_df=2, max_features=3)
    kept = term_statistics(with_terms(df, spec), spec).collect()
    assert [(r["term"], r["df"], r["cf"]) for r in kept] == [("aa", 2, 4), ("bb", 2, 3), ("cc", 2, 2)]
    free = Vectorizer("word", (1, 1), min_df=2, max_features=None)
    assert term_statistics(with_terms(df, free), free).count() == 4


def test_tfidf_is_sublinear_smoothed_and_normalised(spark):
    docs = [("d1", "aa aa bb"), ("d2", "aa bb bb cc"), ("d3", "cc")]
    df = spark.createDataFrame(docs, "review_id string, review_text string")
    spec = Vectorizer("word", (1, 1), min_df=1, max_features=None)
    counted = with_terms(df, spec)
    got = {(r["review_id"], r["term"]): r["tfidf"] for r in tfidf(counted, vocabulary(counted, spec), "review_id").collect()}
    idf = math.log(4 / 3) + 1
    a, b = (1 + math.log(2)) * idf, idf
    assert got[("d1", "aa")] == pytest.approx(a / math.hypot(a, b))
    assert got[("d3", "cc")] == pytest.approx(1.0)


@pytest.fixture(scope="module")
def fitted(spark):
    settings = training.FitSettings(
        vectorizer=Vectorizer("char_wb", (2, 3), min_df=2, max_features=5000), max_iter=50, folds=2
    )
    model, row = training.train(clean_frame(spark, boost=True), settings, "7")
    return model, row.first()


def test_training_report(fitted):
    _, row = fitted
    assert row["f1_macro"] > 0.9 and row["roc_auc"] > 0.9
    assert (row["n_test"], row["data_boost_rows"], row["data_natural_rows"]) == (40, 40, 200)
    assert row["n_train"] == 160 + 40  # boost rows are only ever trained on
    assert 0.3 <= row["threshold"] <= 0.8
    assert -0.05 <= row["train_test_gap"] < 0.35
    assert row["negative_share"] == 0.5


def test_probability_points_to_the_negative_class(spark, fitted):
    model, _ = fitted
    texts = spark.createDataFrame(
        [("bad", "awful broken refund"), ("good", "superb lovely smooth"), ("none", "ζζζ")],
        "review_id string, review_text string",
    )
    got = {r["review_id"]: r for r in serving.predict_batch(texts, model).collect()}
    assert got["bad"]["label"] == "negative" and got["good"]["label"] == "positive"
    assert got["bad"]["proba_negative"] > 0.5 > got["good"]["proba_negative"]
    intercept = model.header.first()["intercept_neg"]
    assert got["none"]["proba_negative"] == pytest.approx(1 / (1 + math.exp(-intercept)))
    assert got["bad"]["model_version"] == "7"


def test_contributions_add_up_to_the_margin(spark, fitted):
    model, _ = fitted
    texts = clean_frame(spark).limit(20)
    sums = {
        r["review_id"]: r["s"]
        for r in explain.local_contributions(texts, model, None)
        .groupBy("review_id").agg(F.sum("contribution").alias("s")).collect()
    }
    intercept = model.header.first()["intercept_neg"]
    docs = with_terms(texts, model.vectorizer)
    for r in negative_probability(docs, model, "review_id").collect():
        p = r["proba_negative"]
        assert sums[r["review_id"]] + intercept == pytest.approx(math.log(p / (1 - p)), abs=1e-9)


def test_local_terms_are_sorted_belong_to_the_text_and_empty_texts_stay(spark, fitted):
    model, _ = fitted
    texts = spark.createDataFrame(
        [("a", "awful smooth crash"), ("e", "ζζζ")], "review_id string, review_text string"
    )
    rows = explain.local_contributions(texts, model, 5).collect()
    mine = sorted((r for r in rows if r["review_id"] == "a"), key=lambda r: r["rank"])
    assert len(mine) == 5
    sizes = [abs(r["contribution"]) for r in mine]
    assert sizes == sorted(sizes, reverse=True)
    assert {r["term"] for r in mine} <= set(grams_of("awful smooth crash", 2, 3))
    assert [r["term"] for r in rows if r["review_id"] == "e"] == [None]
    one = explain.local_contributions(texts.filter("review_id = 'a'"), model, 5).collect()
    assert sorted(one) == sorted(mine)


def test_global_terms_are_positive_and_disjoint(fitted):
    model, _ = fitted
    rows = explain.global_terms(model, 15).collect()
    assert all(r["weight"] > 0 for r in rows) and len(rows) == 30
    negative = {r["term"] for r in rows if r["direction"] == "negative"}
    positive = {r["term"] for r in rows if r["direction"] == "positive"}
    assert not negative & positive
    best = {r["term"]: r["coef_neg"] for r in model.terms.collect()}
    assert max(best, key=best.get) in negative and min(best, key=best.get) in positive


def test_summary_of_mixed_flows_and_asymmetric_shares(spark):
    rows = [(str(i), p, t, "natural") for i, (p, t) in enumerate([(0, 0), (1, 0), (1, 1), (1, 1), (1, 1)])]
    rows.append(("boost", 0, 0, "negative_boost"))
    df = spark.createDataFrame(rows, "review_id string, pred_label long, label long, sample_source string").withColumns(
        {
            "app_id": F.lit(1).cast("long"),
            "language": F.lit("english"),
            "created_at": F.timestamp_seconds(F.lit(1_700_000_000)),
            "model_version": F.lit("3"),
        }
    )
    row = daily_summary(df).first()
    assert (row["n_reviews"], row["share_negative_pred"], row["share_negative_true"]) == (5, 0.2, 0.4)
    assert daily_summary(df.drop("sample_source")).first()["n_reviews"] == 6
    with pytest.raises(ContractError):
        daily_summary(df.drop("label"))


def test_scoring_needs_its_columns(spark, fitted):
    with pytest.raises(ContractError):
        predictions(clean_frame(spark).drop("label"), fitted[0])


def test_decisions(spark):
    df = spark.createDataFrame([(0.49,), (0.5,), (0.51,)], "p double")
    assert [r[0] for r in df.select(predicted_label(F.col("p"), 0.5)).collect()] == [1, 0, 0]
    bands = spark.createDataFrame([(0.0999,), (0.1,), (0.2,)], "p double").select(psi_band(F.col("p"))).collect()
    assert [r[0] for r in bands] == ["stable", "à surveiller", "dérive"]
    with pytest.raises(Exception, match="unknown label"):
        spark.createDataFrame([(2,)], "l long").select(label_name(F.col("l"))).collect()


def test_request_bounds(spark, fitted):
    model, _ = fitted
    for texts in ([], ["x"] * 101, [""], ["x" * 5001]):
        with pytest.raises(ValueError):
            serving.predict_texts(spark, texts, model)
    assert serving.predict_texts(spark, ["fine", "x" * 5000], model).count() == 2
    with pytest.raises(ValueError):
        serving.insights(spark.range(1), 1, 91)
    with pytest.raises(ValueError):
        serving.explanation(spark.range(1), model, 51)


def test_insights_count_from_the_latest_day_of_the_app(spark):
    days = [(1, dt.date(2026, 9, d)) for d in (1, 9, 10)] + [(2, dt.date(2026, 9, 20))]
    df = spark.createDataFrame(days, "app_id long, date date").selectExpr(
        "app_id", "'english' language", "date", "1L n_reviews", "0.1D share_negative_pred",
        "0.2D share_negative_true", "'3' model_version",
    )
    assert sorted(r["date"] for r in serving.insights(df, 1, 2).collect()) == ["2026-09-09", "2026-09-10"]
    assert serving.insights(df, 99).count() == 0
    assert serving.insights_all(df, 1).count() == 2


def test_kpis_of_an_empty_view(spark):
    df = spark.createDataFrame(
        [], "review_id string, label long, pred_label long, model_version string, decision_threshold double, created_at timestamp"
    )
    row = serving.kpi_line(df).first()
    assert tuple(row) == (0, 0.0, 0.0, "N/A", 0.5)


def test_shorten_only_what_is_long(spark):
    df = spark.createDataFrame([("x" * 200,), ("x" * 201,)], "t string")
    assert [len(r[0]) for r in df.select(shorten(F.col("t"))).collect()] == [200, 201]


def test_promotion_needs_the_gate_and_a_better_score(spark):
    runs = spark.createDataFrame(list(enumerate([0.7, 0.76, 0.76, 0.74, 0.8, 0.79])), "run long, f1_macro double")
    rows = promotion_history(runs, "run").orderBy("run").collect()
    assert [r["promoted"] for r in rows] == [False, True, False, False, True, False]


def test_registry_moves_only_to_known_versions(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    assert registry.champion_version() is None and registry.champion_f1() is None
    registry.add_run({f.strip().split(" ")[0]: None for f in Registry.RUNS.split(",")} | {"run_id": "a", "f1_macro": 0.8})
    assert registry.add_version("a", "x") == 1
    assert registry.add_version("lost", "y") == 2
    assert registry.move_champion(1) == {"old": None, "new": 1}
    assert registry.move_champion(2) == {"old": 1, "new": 2}
    assert registry.move_champion(1) == {"old": 2, "new": 1}
    assert registry.champion_f1() == 0.8
    with pytest.raises(ValueError, match="does not exist"):
        registry.move_champion(9)
    assert registry.champion_version() == 1
    rows = registry.overview().collect()
    assert [(r["version"], r["f1_macro"], r["aliases"]) for r in rows] == [(2, None, ""), (1, 0.8, "champion")]


def test_model_bench_judges_each_family_at_its_own_threshold(spark):
    words = Vectorizer(analyzer="word", ngram_range=(1, 1), min_df=1, max_features=50)

    def fit(train, settings):
        return lambda rows: rows.withColumn("proba_negative", F.when(F.col("label") == 0, 0.44).otherwise(0.36))

    settings = training.FitSettings(vectorizer=words, folds=2)
    rows = sorted(training.model_bench(clean_frame(spark), settings, [training.Candidate("low", fit, words)]).collect(), key=lambda r: r.fold)
    assert [(r.candidate, r.fold, r.f1_macro, r.roc_auc) for r in rows] == [("low", 0, 1.0, 1.0), ("low", 1, 1.0, 1.0)]


def test_model_queries_run_the_operators_defaults():
    import inspect

    from verification import queries

    for query, call in (
        (queries.logreg_train, "training.train(pin(silver(spark, sf_dir)))"),
        (queries.hyperparameter_grid, "training.hyperparameter_grid(pin(silver(spark, sf_dir)))"),
        (queries.model_bench, "training.model_bench(pin(silver(spark, sf_dir)))"),
    ):
        assert call in inspect.getsource(query)


def test_words_of_a_text_are_counted_once_in_statistics(spark):
    spec = Vectorizer(analyzer="word", ngram_range=(1, 1), min_df=1, max_features=None)
    docs = with_terms(spark.createDataFrame([("a", "one two one"), ("b", ""), ("c", None)], "i string, review_text string"), spec)
    counted = term_statistics(docs, spec)
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert {(r["term"], r["df"], r["cf"]) for r in counted.collect()} == {("one", 1, 2), ("two", 1, 1)}


def test_char_ngrams_leave_in_small_pieces(spark):
    texts = [(i, f"word{i} text") for i in range(600)]
    df = spark.createDataFrame(texts, "i int, review_text string").coalesce(1)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(600)), pa.array([[" ab "]] * 600)], ["i", "words"])]
    assert [p.num_rows for p in count_in_pieces(iter(batches), 2, 5)] == [256, 256, 88]
    for row in with_terms(df, Vectorizer()).collect():
        assert {x["term"]: x["tf"] for x in row["terms"]} == dict(grams_of(row["review_text"], 2, 5))
    assert df.columns == ["i", "review_text"]


@pytest.mark.parametrize("largest", [1, 12, 4 << 20])
def test_single_words_are_counted_over_arrow_in_pieces(spark, monkeypatch, largest):
    monkeypatch.setattr(text, "WORD_BYTES", largest)
    texts = ["b a bb BB a1 bb", "", None, "é x", "éa ÉA ⅷ² ζζζ 中中", "I i", "zz _z 11 zz"]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string").coalesce(1)
    found = df.select("i", analyzed_counts(F.col("t"), "word", (1, 1)).alias("new"), text.term_counts(text.words(F.col("t"))).alias("old"))
    assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
    got = found.collect()
    assert [r["new"] for r in got] == [r["old"] or [] for r in got]
    assert {r["i"]: [tuple(p) for p in r["new"]] for r in got}[0] == [("a1", 1), ("bb", 3)]


def test_texts_without_brackets_are_not_searched_for_tags(spark):
    texts = ["[b]bold[/b] [url=x]", "plain  text\n", "[ b ] ]", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    cleaned = df.select("i", text.clean_text(F.col("t")).alias("c"))
    assert "Contains(" in cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert [r["c"] for r in cleaned.orderBy("i").collect()] == ["bold", "plain text", "[ b ] ]", "", ""]


ODD_TEXTS = ["b a bb BB a1 bb", "", None, "é x", "éa ÉA ⅷ² ζζζ 中中", "I i", "zz _z 11 zz", "bb,a1.bb\nzz-zz", "İİ a1\u0307b"]


def odd_reviews(spark):
    rows = [(str(i), t, i % 2) for i, t in enumerate(ODD_TEXTS)] + [("0", "a1 zz", None)]
    return spark.createDataFrame(rows, "review_id string, review_text string, label long").coalesce(1)


@pytest.mark.parametrize("largest", [1, 12, 4 << 20])
def test_stored_words_give_the_statistics_of_counted_terms(spark, monkeypatch, largest):
    monkeypatch.setattr(text, "WORD_BYTES", largest)
    spec = Vectorizer(analyzer="word", ngram_range=(1, 1), min_df=2, max_features=4)
    reviews = odd_reviews(spark)
    even = F.col("label") == 0
    counted = term_statistics(with_terms(reviews, spec), spec, df_marked=F.count_if(even))
    stored = with_words(reviews).withColumn("even", even)
    assert sorted(word_statistics(stored, spec, "even").collect()) == sorted(counted.collect())
    assert "terms" not in stored.columns
    again = {r["review_id"] + str(r["label"]): r["terms"] for r in with_terms(stored, spec).collect()}
    assert again == {r["review_id"] + str(r["label"]): r["terms"] for r in with_terms(reviews, spec).collect()}


def word_model(spark, weights):
    terms = spark.createDataFrame(weights, "term string, idf double, coef_neg double")
    header = spark.createDataFrame([("1", 0.25, 0.6)], "version string, intercept_neg double, threshold double")
    return LinearModel(terms, header, Vectorizer("word", (1, 1), min_df=1, max_features=100))


WEIGHTS = [("bb", 1.5, 0.75), ("a1", 1.25, -0.5), ("zz", 1.0, 0.5), ("11", 1.0, -0.5), ("_z", 1.0, 0.5), ("éa", 2.0, 0.0), ("none", 1.0, 1.0)]


@pytest.mark.parametrize("weights", [WEIGHTS, WEIGHTS + [("zz", 1.0, 0.5)], WEIGHTS[1:] + [("bb", 1.5, None)], WEIGHTS[:0]])
def test_stored_words_give_the_scores_and_contributions_of_counted_terms(spark, weights):
    model, reviews = word_model(spark, weights), odd_reviews(spark)
    counted, stored = with_terms(reviews, model.vectorizer), with_words(reviews)

    def scores(docs):
        found = negative_probability(docs, model, "review_id", "label").collect()
        return {(r["review_id"], r["label"]): pytest.approx(r["proba_negative"], abs=1e-12) for r in found}

    assert scores(stored) == scores(counted)

    def strongest(docs, n):
        found = explain.local_contributions(docs, model, n).collect()
        return sorted(((r["review_id"], r["rank"] or 0, r["term"] or "", round(r["contribution"] or 0, 9)) for r in found))

    for n in (1, 2, 50):
        assert strongest(stored, n) == strongest(counted, n)


@pytest.mark.parametrize("weights", [WEIGHTS, WEIGHTS + [("zz", 1.0, 0.5)], WEIGHTS[:0]])
def test_stored_words_give_the_tfidf_of_counted_terms(spark, weights):
    model, reviews = word_model(spark, weights), odd_reviews(spark).filter("label is not null")
    found = word_tfidf(with_words(reviews), model.terms, "review_id")
    if weights == WEIGHTS:
        assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    expected = tfidf(with_terms(reviews, model.vectorizer), model.terms, "review_id")
    rows = [sorted((r["review_id"], r["term"], round(r["tfidf"], 12)) for r in frame.collect()) for frame in (found, expected)]
    assert rows[0] == rows[1]


def test_no_term_of_a_text_is_shuffled_to_be_scored(spark):
    model, reviews = word_model(spark, WEIGHTS), with_words(odd_reviews(spark))
    plan = negative_probability(reviews, model, "review_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan


def test_only_words_that_can_be_strongest_are_ranked(spark):
    ranked = explain.local_contributions(with_words(odd_reviews(spark)), word_model(spark, WEIGHTS), 2)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "strongest(" in plan and plan.count("Join") == 1


def test_blanks_are_found_as_before(spark):
    blanks = [" ", "\t", "\n", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "x", "\u200b", "\ufeff"]
    texts = [f"a{p}{q}{r}b" for p in blanks for q in blanks for r in blanks]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    old = F.regexp_replace("t", r"(?U)[\s\x1c-\x1f]{2,}|[\s\x1c-\x1f&&[^ ]]", " ")
    assert df.filter(F.regexp_replace("t", text.SPACES_TO_FOLD, " ") != old).count() == 0


def test_texts_of_the_tables_are_exchanged_once_for_joins_and_deduplication(spark, tmp_path, monkeypatch):
    from verification import adapter

    spark.sql("select 1L doc_id, 'one two' text, 'en' lang, 'src1' source").write.parquet(f"{tmp_path}/documents.parquet")
    spark.sql("select 1L doc_id, 0 quality, 0 toxic").write.parquet(f"{tmp_path}/labels.parquet")
    event = "select 1L event_id, timestamp_ntz'2024-01-01 00:00:00' ts, 7L user_id, 'view' event_type, 5D value, '{\"k\": 3}' props"
    spark.sql(event).write.parquet(f"{tmp_path}/events.parquet")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        clean = adapter.silver(spark, str(tmp_path))
        plan = clean._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3
        assert [(r["review_id"], r["review_text"], r["label"]) for r in clean.collect()] == [("1", "one two", 0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


FOREIGN = ["", " ", "İSTANBUL İ", "ΑΣ ΟΔΟΣ", "Ünïcode ße", "中文 字", "İx", "\U0001f600 ok", "a\u200bb", "ﬁ ﬂ", "Ǆ ǅ", "٣ Ⅷ ²"]


def test_blanks_are_folded_by_an_arrow_function_as_by_the_pattern(spark):
    blanks = [" ", "\t", "\n\r", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u3000", "x", "\u180e", "\ufeff", "[b]"]
    texts = [f"{p}a{q}{r}b{p}" for p in blanks for q in blanks for r in blanks] + [*FOREIGN, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    broken = spark.sql("select cast(x'61200920c320e28062ff' as string) t").unionByName(spark.sql("select cast(x'eda08020200a' as string) t"))
    df = df.unionByName(broken)
    untagged = F.regexp_replace(F.coalesce("t", F.lit("")), text.BBCODE_TAG, "")
    old = F.trim(F.regexp_replace(untagged, text.SPACES_TO_FOLD, " "))
    both = df.select(text.clean_text(F.col("t")).alias("new"), old.alias("old"))
    assert "ArrowEvalPython" in both._jdf.queryExecution().executedPlan().toString()
    assert both.filter(~F.col("new").eqNullSafe(F.col("old"))).count() == 0


def test_words_of_latin_texts_are_looked_up_as_the_pattern_finds_them(spark):
    texts = [f"a{chr(c)}B {chr(c)}{chr(c)}" for c in range(256)] + [*FOREIGN, "É中", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).unionByName(spark.sql("select cast(x'41c320ff42' as string) t"))
    old = F.regexp_replace(F.lower("t"), text.NO_WORD, " ")
    both = df.select(text.spaced_words(F.col("t")).alias("new"), old.alias("old"))
    assert "ArrowEvalPython" in both._jdf.queryExecution().executedPlan().toString()
    assert both.filter(~F.col("new").eqNullSafe(F.col("old"))).count() == 0


@pytest.mark.parametrize("most, rows", [(0, None), (64 << 20, 5)])
def test_a_task_sends_a_word_once(spark, monkeypatch, most, rows):
    from reviewlake.operators import features

    monkeypatch.setattr(text, "WORD_BYTES", 1)  # each text is a piece
    monkeypatch.setattr(features, "COUNT_BYTES", most)
    docs = [("aa bb aa", True), ("aa cc", False), (None, True), ("bb aa x", None), ("dd ee", True)]
    df = spark.createDataFrame(docs, f"{features.WORDS} string, marked boolean").coalesce(1)
    sent = features.words_of_tasks(df, "marked").collect()
    assert rows is None or len(sent) == rows
    totals: dict = {}
    for term, *counts in sent:
        totals[term] = [a + b for a, b in zip(totals.get(term, [0, 0, 0]), counts)]
    assert totals == {"aa": [3, 4, 1], "bb": [2, 2, 1], "cc": [1, 1, 0], "dd": [1, 1, 1], "ee": [1, 1, 1]}


def test_texts_are_stored_only_for_who_reads_them(spark, tmp_path):
    from verification.adapter import Star

    docs = "select id doc_id, if(id % 3 = 0, 'good\\n fun', concat('bad game ', id)) text, 'en' lang, 'src1' source from range(12)"
    spark.sql(docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.sql("select id doc_id, int(id % 3 = 0) quality, 0 toxic from range(12)").write.parquet(f"{tmp_path}/labels.parquet")
    event = "select id event_id, timestamp_ntz'2024-01-01 00:00:00' ts, id user_id, 'view' event_type, 5D value, '{\"k\": 3}' props from range(12)"
    spark.sql(event).write.parquet(f"{tmp_path}/events.parquet")
    lean, whole = Star(spark, str(tmp_path)), Star(spark, str(tmp_path), texts=True)
    assert "review_text" not in lean.counted.columns and "review_text" in whole.silver.columns
    kept = ("review_id", "proba_negative", "pred_label")
    found, wanted = (sorted(map(tuple, s.predictions.select(*kept).collect())) for s in (lean, whole))
    assert found == wanted and len({r[1] for r in found}) > 1

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from reviewlake.functions.pseudonym import hmac_pads, pseudonym
from reviewlake.functions.text import clean_text
from reviewlake.operators.silver import clean_reviews
from reviewlake.schemas import CLEAN_SCHEMA, ContractError, conform, refuse_personal_columns
from reviewlake.sources.raw import raw_paths, scan_raw

NATURAL = "app_id=1/language=english/dt=2026-09-16"
BOOST = "sample=negative_boost/app_id=1/language=english/dt=2026-09-16"


def cleaned(spark, root):
    rows = clean_reviews(scan_raw(spark, str(root)).good, "salt").collect()
    return {r["review_id"]: r for r in rows}


def test_cleaning_and_dedup_cases(spark, tmp_path, review, write_lines):
    noon = 1_790_000_400
    write_lines(
        tmp_path,
        NATURAL,
        [
            review(11, "[b]Worth[/b] \t every  [i]cent[/i]", created=noon, updated=noon + 5),
            review(12, " [url=x][/url] "),
            review(13, "crashes at start", voted_up=False, created=noon + 1),
            review(14, "first thoughts", created=noon + 2, updated=noon + 100),
            review(14, "second thoughts", created=noon + 2, updated=noon + 300),
            review(15, "\u2003Schön\u00a0und\u3000kurz\u2029"),
            review(16, "tab\u001dstop"),
        ],
    )
    later = [review(14, "thoughts from the other flow", created=noon + 2, updated=noon + 900)]
    write_lines(tmp_path, BOOST, later, "other.jsonl")
    rows = cleaned(spark, tmp_path)
    assert {k: r["review_text"] for k, r in rows.items()} == {
        "11": "Worth every cent",
        "13": "crashes at start",
        "14": "second thoughts",
        "15": "Schön und kurz",
        "16": "tab stop",
    }
    assert (rows["11"]["label"], rows["13"]["label"], rows["11"]["text_len"]) == (1, 0, 16)
    assert rows["14"]["sample_source"] == "natural"
    assert rows["11"]["created_at"].timestamp() == noon


def test_traps(spark, tmp_path, review, write_lines):
    no_playtime = review(3)
    del no_playtime["author"]["playtime_at_review"]
    write_lines(
        tmp_path,
        NATURAL,
        [
            review(1, "older text", created=10, updated=20),
            review(1, "[i][/i]", created=10, updated=30),  # the winning version is empty: dropped
            review(2, updated=None, created=50),
            no_playtime,
            review(4, author=None),
            review(5, voted_up=None),
            review(6, "tie one", created=5, updated=6),
            review(6, "tie two", created=5, updated=6),
            review(7, updated="not a number", created=70),
            "{broken json",
            "",
            "   ",
            "{}",
            '{"votes_up": 3}',
            {"recommendationid": "9", "review": "no time", "voted_up": True},
        ],
    )
    write_lines(tmp_path, "app_id=1/dt=2026-09-16", [review(8)], "no_language.jsonl")
    scan = scan_raw(spark, str(tmp_path))
    rows = {r["review_id"]: r for r in clean_reviews(scan.good, "salt").collect()}
    assert set(rows) == {"2", "3", "4", "6", "7"}
    assert rows["2"]["updated_at"] == rows["2"]["created_at"]
    assert rows["7"]["updated_at"].timestamp() == 70
    assert rows["3"]["playtime_at_review_min"] == 0
    assert rows["4"]["author_pseudo"] == hmac.new(b"salt", b"", hashlib.sha256).hexdigest()
    assert rows["6"]["review_text"] == "tie one"
    reasons = sorted(r["reason"] for r in scan.quarantine.collect())
    assert reasons == [
        "invalid json", "missing creation time", "missing id", "missing id", "missing vote", "outside the partition layout",
    ]


def test_partition_language_wins_and_columns_are_the_contract(spark, tmp_path, review, write_lines):
    write_lines(tmp_path, "app_id=77/language=french/dt=2026-09-16", [review(1, language="english")])
    clean = clean_reviews(scan_raw(spark, str(tmp_path)).good, "salt")
    assert clean.schema.fieldNames() == CLEAN_SCHEMA.fieldNames()
    row = clean.first()
    assert (row["app_id"], row["language"], row["sample_source"]) == (77, "french", "natural")


def test_raw_paths_list_only_wanted_partitions(spark, tmp_path, review, write_lines):
    write_lines(tmp_path, NATURAL, [review(1)])
    write_lines(tmp_path, "app_id=2/language=english/dt=2026-09-16", [review(2)])
    write_lines(tmp_path, BOOST, [review(3)])
    only = scan_raw(spark, raw_paths(str(tmp_path), app_ids=[2])).good
    assert [r["recommendationid"] for r in only.collect()] == ["2"]
    both = scan_raw(spark, raw_paths(str(tmp_path), sources=["natural", "negative_boost"], app_ids=[1])).good
    assert sorted(r["recommendationid"] for r in both.collect()) == ["1", "3"]


@pytest.mark.parametrize("key", ["salt", "é" * 50, b"k" * 64])
def test_pseudonym_equals_hmac(spark, key):
    values = ["7656119800000000", "", "é　", None]
    rows = (
        spark.createDataFrame([(v,) for v in values], "v string")
        .select("v", pseudonym(F.col("v"), key).alias("p"))
        .collect()
    )
    raw = key.encode() if isinstance(key, str) else key
    for row in rows:
        assert row["p"] == hmac.new(raw, (row["v"] or "").encode(), hashlib.sha256).hexdigest()


def test_salt_is_mandatory():
    with pytest.raises(ValueError):
        hmac_pads("")


def test_personal_columns_cannot_leave(spark):
    with pytest.raises(ContractError):
        refuse_personal_columns(spark.range(1).withColumn("steamid", F.lit("x")))


def test_conform_reports_missing_columns(spark):
    with pytest.raises(ContractError):
        conform(spark.range(1), CLEAN_SCHEMA)


def test_every_python_blank_is_folded(spark):
    blanks = [chr(c) for c in range(1, 0x3100) if chr(c).isspace()]
    frame = spark.createDataFrame([("a" + b + "b",) for b in blanks], "v string")
    assert {r[0] for r in frame.select(clean_text(F.col("v"))).collect()} == {"a b"}


def test_hot_key_is_reduced_before_the_shuffle(spark, tmp_path, review, write_lines):
    write_lines(tmp_path, NATURAL, [review(1)])
    clean = clean_reviews(scan_raw(spark, str(tmp_path)).good, "salt")
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_one_review_copied_into_a_third_of_all_rows(spark, tmp_path, review, write_lines):
    copies = [review("hot", f"version {i}", updated=2_000_000_000 + (i * 11) % 301) for i in range(301)]
    write_lines(tmp_path, NATURAL, copies + [review(i) for i in range(600)])
    rows = cleaned(spark, tmp_path)
    assert len(rows) == 601
    newest = max(range(301), key=lambda i: (i * 11) % 301)
    assert rows["hot"]["review_text"] == f"version {newest}"

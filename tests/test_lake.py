import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from reviewlake.schemas import ContractError
from reviewlake.sources.raw import scan_raw
from reviewlake.sources.raw_zone import BatchConflict, RawZone, new_reviews, purge_raw
from reviewlake.sources.snapshots import SnapshotGroup, SnapshotTable
from reviewlake.streaming.ingest import stream_ingest

DAY = dt.date(2026, 9, 16)


def rows(spark, factor=1):
    data = [("a", 1 * factor), ("b", 2 * factor), ("c", 3 * factor)]
    return spark.createDataFrame(data, "text string, value long").withColumn(
        "ts", F.timestamp_seconds(F.lit(1_700_000_000))
    )


def test_snapshots_travel_and_restore(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "silver.reviews")
    first = table.overwrite(rows(spark))
    second = table.overwrite(rows(spark, 10))
    assert (first["rows"], first["snapshots"], second["snapshots"]) == (3, 1, 2)
    assert table.read().agg(F.sum("value")).first()[0] == 60
    assert table.read_at(1).agg(F.sum("value")).first()[0] == 6
    assert table.read().agg(F.sum("value")).first()[0] == 60
    assert [r["current"] for r in table.history().collect()] == [False, True]
    assert table.restore(1)["rows"] == 3
    assert table.read().agg(F.sum("value")).first()[0] == 6
    table.overwrite(rows(spark, 100))
    assert [r["snapshot_id"] for r in table.history().collect()] == [1, 2, 1, 3]
    assert table.read().agg(F.sum("value")).first()[0] == 600


def test_unknown_snapshots_are_refused(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "t")
    with pytest.raises(ValueError):
        table.read()
    table.overwrite(rows(spark))
    for action in (table.restore, table.read_at):
        with pytest.raises(ValueError, match="unknown snapshot"):
            action(99)
    assert table.history().count() == 1


def test_other_columns_are_refused_and_types_cast(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "t")
    table.overwrite(rows(spark))
    with pytest.raises(ContractError):
        table.overwrite(rows(spark).withColumn("extra", F.lit(1)))
    table.overwrite(rows(spark).withColumn("value", F.col("value").cast("int")))
    assert dict(table.read().dtypes)["value"] == "bigint"


def test_data_without_a_log_row_is_invisible(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "t")
    table.overwrite(rows(spark))
    rows(spark, 7).write.parquet(f"{table.root}/data/snapshot_id=2-dead")
    assert table.read().agg(F.sum("value")).first()[0] == 6


def incoming(spark, tmp_path, review, ids, source="natural", name="in"):
    folder = tmp_path / name
    prefix = "" if source == "natural" else f"sample={source}/"
    target = folder / f"{prefix}app_id=1/language=english/dt=2026-09-16"
    target.mkdir(parents=True)
    (target / "x.jsonl").write_text("\n".join(json.dumps(review(i)) for i in ids) + "\n")
    return scan_raw(spark, str(folder)).good


def stored(spark, root):
    return sorted(
        (r["sample_source"], r["recommendationid"]) for r in scan_raw(spark, str(root)).good.collect()
    )


def data_files(root):
    return sorted(str(p) for p in root.rglob("part-*.json"))


def test_ingest_is_idempotent(spark, tmp_path, review):
    root = tmp_path / "raw"
    zone = RawZone(spark, str(root))
    first = incoming(spark, tmp_path, review, [1, 2, 2, 3], name="one")
    assert zone.append(first, "b1", DAY) == 3
    files = data_files(root)
    assert zone.append(first, "b2", DAY) == 0
    assert data_files(root) == files
    assert zone.append(first, "b1", DAY) == 3  # the same batch again changes nothing
    assert stored(spark, root) == [("natural", i) for i in "123"]
    more = incoming(spark, tmp_path, review, [3, 4], name="two")
    assert zone.append(more, "b3", DAY) == 1
    boost = incoming(spark, tmp_path, review, [3], source="negative_boost", name="three")
    assert zone.append(boost, "b4", DAY) == 1  # the other flow keeps its own keys
    assert stored(spark, root) == [("natural", i) for i in "1234"] + [("negative_boost", "3")]


def test_stored_lines_keep_the_review(spark, tmp_path, review):
    root = tmp_path / "raw"
    RawZone(spark, str(root)).append(incoming(spark, tmp_path, review, [1]), "b1", DAY)
    row = scan_raw(spark, str(root)).good.first()
    assert row["review"] == "solid fun" and row["author"]["playtime_at_review"] == 45
    assert (row["app_id"], row["language"], row["voted_up"]) == (1, "english", True)


def test_purge_keeps_the_boundary_day(spark, tmp_path, review, write_lines):
    today = dt.date(2026, 9, 30)
    for days in (0, 30, 31, 90):
        day = today - dt.timedelta(days=days)
        write_lines(tmp_path, f"app_id=1/language=english/dt={day}", [review(days)])
    write_lines(tmp_path, "sample=negative_boost/app_id=1/language=english/dt=2026-01-01", [review(1)])
    assert purge_raw(spark, str(tmp_path), today, 30) == 3
    left = sorted(p.name for p in tmp_path.glob("app_id=1/language=english/dt=*"))
    assert left == ["dt=2026-08-31", "dt=2026-09-30"]
    assert purge_raw(spark, str(tmp_path / "absent"), today, 30) == 0


def test_stream_ingest_appends_each_review_once(spark, tmp_path, review, write_lines):
    landing, zone = tmp_path / "landing", tmp_path / "zone"
    part = "app_id=1/language=english/dt=2026-09-16"
    for name, ids in (("a.jsonl", [1, 2]), ("b.jsonl", [2, 3])):
        write_lines(landing, part, [review(i) for i in ids], name)
        query = stream_ingest(spark, str(landing), str(zone), str(tmp_path / "cp"), DAY)
        assert query.awaitTermination(120)
        assert query.exception() is None
    assert stored(spark, zone) == [("natural", i) for i in "123"]


def test_every_flow_is_stored(spark, tmp_path, review):
    zone = RawZone(spark, str(tmp_path / "raw"))
    mixed = incoming(spark, tmp_path, review, [1, 2], name="one").unionByName(
        incoming(spark, tmp_path, review, [3, 4], source="curated", name="two")
    )
    assert zone.append(mixed, "b1", DAY) == 4
    assert stored(spark, tmp_path / "raw") == [("curated", "3"), ("curated", "4"), ("natural", "1"), ("natural", "2")]
    assert zone.append(mixed, "b2", DAY) == 0


def test_a_batch_name_is_never_reused_for_other_reviews(spark, tmp_path, review):
    zone = RawZone(spark, str(tmp_path / "raw"))
    zone.append(incoming(spark, tmp_path, review, [1], name="one"), "b1", DAY)
    with pytest.raises(BatchConflict):
        zone.append(incoming(spark, tmp_path, review, [2], name="two"), "b1", DAY)
    assert stored(spark, tmp_path / "raw") == [("natural", "1")]


def test_a_loss_between_lines_and_keys_loses_nothing(spark, tmp_path, review, monkeypatch):
    zone = RawZone(spark, str(tmp_path / "raw"))
    batch = incoming(spark, tmp_path, review, [1, 2], name="one")

    def lost(_):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(zone, "_stored_keys", lost)
        with pytest.raises(OSError):
            zone.append(batch, "b1", DAY)
    assert zone.append(batch, "b1", DAY) == 2  # replaces the lines it left
    assert stored(spark, tmp_path / "raw") == [("natural", "1"), ("natural", "2")]


def test_a_loss_before_the_lines_loses_nothing(spark, tmp_path, review, monkeypatch):
    zone = RawZone(spark, str(tmp_path / "raw"))
    batch = incoming(spark, tmp_path, review, [1, 2], name="one")

    def lost(_):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(zone, "_drop_lines", lost)
        with pytest.raises(OSError):
            zone.append(batch, "b1", DAY)
    assert zone.append(batch, "another name", DAY) == 2
    assert stored(spark, tmp_path / "raw") == [("natural", "1"), ("natural", "2")]


def test_the_latest_copy_of_a_review_is_stored(spark, tmp_path, review, write_lines):
    rows = [review(1, "early", updated=1_765_432_200), review(1, "late", updated=1_765_432_900)]
    write_lines(tmp_path / "in", "app_id=1/language=english/dt=2026-09-16", rows)
    RawZone(spark, str(tmp_path / "raw")).append(scan_raw(spark, str(tmp_path / "in")), "b1", DAY)
    assert [r["review"] for r in scan_raw(spark, str(tmp_path / "raw")).good.collect()] == ["late"]


def test_streams_share_a_zone_and_keep_what_they_set_aside(spark, tmp_path, review, write_lines):
    zone, part = tmp_path / "zone", "app_id=1/language=english/dt=2026-09-16"
    for name, rows in (("one", [review(10), review(11), "{broken"]), ("two", [review(20), "{}"])):
        write_lines(tmp_path / name, part, rows)
        query = stream_ingest(spark, str(tmp_path / name), str(zone), str(tmp_path / f"cp-{name}"), DAY)
        assert query.awaitTermination(120) and query.exception() is None
    assert stored(spark, zone) == [("natural", "10"), ("natural", "11"), ("natural", "20")]
    reasons = sorted(r["reason"] for r in RawZone(spark, str(zone)).quarantine().collect())
    assert reasons == ["invalid json", "missing id"]


def test_a_failed_publish_leaves_the_version_before(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), "scored.reviews")
    table.overwrite(rows(spark))
    broken = rows(spark).withColumn("value", F.raise_error(F.lit("midway")).cast("long"))
    with pytest.raises(Exception, match="midway"):
        table.overwrite(broken)
    assert table.read().agg(F.sum("value")).first()[0] == 6


def test_tables_of_a_group_change_together(spark, tmp_path):
    group = SnapshotGroup(spark, str(tmp_path), "gold.star")
    with pytest.raises(ValueError):
        group.read("fact")
    assert group.overwrite({"fact": rows(spark), "mart": rows(spark)}) == {"fact": 3, "mart": 3}
    broken = rows(spark).withColumn("value", F.raise_error(F.lit("midway")).cast("long"))
    with pytest.raises(Exception, match="midway"):
        group.overwrite({"fact": rows(spark, 10), "mart": broken})
    assert [group.read(n).agg(F.sum("value")).first()[0] for n in ("fact", "mart")] == [6, 6]


@pytest.mark.parametrize("flow", ["other flow", "50% off", "a=b", "a+b", "été/日本", "x%20y", "[q]?"])
def test_flows_of_any_name_are_stored_once(spark, tmp_path, review, flow):
    zone = RawZone(spark, str(tmp_path / "raw"))
    batch = incoming(spark, tmp_path, review, [1, 2]).withColumn("sample_source", F.lit(flow))
    assert zone.append(batch, "b1", DAY) == 2
    assert zone.append(batch, "b2", DAY) == 0
    assert stored(spark, tmp_path / "raw") == [(flow, "1"), (flow, "2")]
    assert {r["sample_source"] for r in zone.seen().collect()} == {flow}


@pytest.mark.parametrize("language", ["zh-Hans", "pt_BR", "en US", "100%", "français", "a/b"])
def test_languages_of_any_name_come_back(spark, tmp_path, review, language):
    zone = RawZone(spark, str(tmp_path / "raw"))
    batch = incoming(spark, tmp_path, review, [1, 2]).withColumn("language", F.lit(language))
    assert zone.append(batch, "b1", DAY) == 2
    scan = scan_raw(spark, str(tmp_path / "raw"))
    assert [r["language"] for r in scan.good.collect()] == [language] * 2 and scan.quarantine.count() == 0
    assert zone.append(batch, "b2", DAY) == 0


def test_reviews_without_a_place_are_refused(spark, tmp_path, review):
    zone = RawZone(spark, str(tmp_path / "raw"))
    batch = incoming(spark, tmp_path, review, [1])
    for column, value in (("language", ""), ("language", None), ("app_id", None)):
        with pytest.raises(ValueError, match="no place"):
            zone.append(batch.withColumn(column, F.lit(value).cast(batch.schema[column].dataType)), "b1", DAY)
    assert zone.append(batch.withColumn("sample_source", F.lit(None).cast("string")), "b1", DAY) == 1
    assert stored(spark, tmp_path / "raw") == [("natural", "1")]


def test_only_named_key_partitions_are_read(spark, tmp_path, review):
    zone = RawZone(spark, str(tmp_path / "raw"))
    batch = incoming(spark, tmp_path, review, [1, 2])
    zone.append(batch, "b1", DAY)
    fresh = new_reviews(batch, zone.seen())
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() and fresh.count() == 0


def test_rows_are_counted_while_they_are_written(spark, tmp_path, monkeypatch):
    left = spark.range(100).withColumn("k", F.col("id") % 7)
    nothing = left.join(spark.range(0), "id")
    monkeypatch.setattr(type(left), "count", lambda self: pytest.fail("read again to be counted"))
    group = SnapshotGroup(spark, str(tmp_path), "gold.star")
    assert group.overwrite({"a": left, "b": nothing, "c": left.groupBy("k").agg(F.max("id"))}) == {"a": 100, "b": 0, "c": 7}
    table = SnapshotTable(spark, str(tmp_path), "t")
    assert table.stage(left, ["k"])["n_rows"] == 100
    assert table.stage(nothing)["n_rows"] == 0

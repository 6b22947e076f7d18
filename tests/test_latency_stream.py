"""The stream of endpoint latencies against the batch form over the same requests."""

import datetime as dt
import random

import pytest

from reviewlake.operators.metrics import endpoint_latency
from reviewlake.streaming.latency import current_latency, run_endpoint_latency

SCHEMA = "path string, ts timestamp, request_id long, duration_ms double"
START = dt.datetime(2026, 3, 1, 12)


def requests_of(seed, n, first_id, start):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        path = rng.choice(["/score", "/score", "/score", "/health", "/explain", None])
        moment = start + dt.timedelta(seconds=rng.randrange(600))  # many requests of one moment
        rows.append((path, moment, first_id + i, rng.choice([None, round(rng.expovariate(0.01), 4)])))
    return rows


def land(spark, rows, landing):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landing)


@pytest.fixture
def stream(spark, tmp_path):
    landing, folder = str(tmp_path / "landing"), str(tmp_path / "figures")

    def run(**options):
        requests = spark.readStream.schema(SCHEMA).parquet(landing)
        run_endpoint_latency(requests, folder, str(tmp_path / "cp"), **options).awaitTermination()
        return {tuple(r) for r in current_latency(spark, folder).collect()}

    return landing, run


def test_equals_the_batch_after_restarts(spark, stream):
    landing, run = stream
    rows = []
    for part in range(3):
        more = requests_of(part, 400, part * 1_000, START + dt.timedelta(minutes=5 * part))
        rows += more
        land(spark, more, landing)
        wanted = endpoint_latency(spark.createDataFrame(rows, SCHEMA), keep=50)
        # the batch form leaves an endpoint without a name unjoined
        named = {tuple(r) for r in run(keep=50) if r[0] is not None}
        assert named == {tuple(r) for r in wanted.collect() if r[0] is not None}
    assert run(keep=50) >= named  # nothing new, nothing counted twice


def test_unmeasured_and_nameless_requests(spark, stream):
    landing, run = stream
    rows = [("/a", START, 1, None), ("/a", None, 2, float("nan")), (None, START, 3, 4.0), (None, START, 4, 8.0)]
    land(spark, rows, landing)
    assert run() == {
        ("/a", 2, 2, 0.0, 0.0, 0.0, 0.0, 0.0),
        (None, 2, 2, 6.0, 7.8, 7.96, 6.0, 8.0),
    }


def test_quiet_endpoints_leave_the_state(spark, stream):
    landing, run = stream
    land(spark, [("/old", START, 1, 1.0), ("/new", START, 2, 1.0)], landing)
    run(forget_after="1 hour")
    later = START + dt.timedelta(hours=3)
    land(spark, [("/new", later, 3, 3.0)], landing)
    run(forget_after="1 hour")
    land(spark, [("/old", later, 4, 5.0), ("/new", later, 5, 5.0)], landing)
    totals = {r[0]: r[1] for r in run(forget_after="1 hour")}
    assert totals == {"/old": 1, "/new": 3}

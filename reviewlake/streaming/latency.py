"""Endpoint latencies of a request stream: the latest samples of each endpoint live in the state store."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from reviewlake.operators.metrics import LATENCY_WINDOW
from reviewlake.session import ship_package

#: An endpoint without a request for so long, in the time of the requests, is forgotten.
FORGET_AFTER = "30 days"

_UNKNOWN = -(1 << 62)
_THINNED = "path string, newest timestamp, total long, moments array<long>, ids array<long>, durations array<double>"
_STATE = "total long, moments array<long>, ids array<long>, durations array<double>"
_FIGURES = "path string, total long, retained long, p50 double, p95 double, p99 double, mean double, max double"
_SAMPLES = ("moments", "ids", "durations")


def endpoint_latency_stream(
    requests: DataFrame, keep: int = LATENCY_WINDOW, forget_after: str = FORGET_AFTER
) -> DataFrame:
    """A row per endpoint with new requests, as ``metrics.endpoint_latency`` gives it over all requests so far.

    ``requests`` is a stream of ``(path, ts, request_id, duration_ms)`` with whole-number ids. Each
    Arrow batch is reduced to its latest ``keep`` samples per endpoint before the exchange, so a busy
    endpoint does not fill the task of its state; the state of an endpoint never holds more than
    ``keep`` samples. Requests of one moment are ordered by id; without a moment they rank last, and
    without a duration (null or NaN) they count but take no part in the figures. The watermark is the
    time of the newest request less ``forget_after``: endpoints quiet for longer leave the state, and
    requests that come later than that are dropped.
    """
    ship_package(requests.sparkSession)
    moment = F.col("ts").cast("timestamp")
    plain = requests.select(
        "path",
        moment.alias("newest"),
        F.coalesce(F.unix_micros(moment), F.lit(_UNKNOWN)).alias("moments"),
        F.coalesce(F.col("request_id").cast("long"), F.lit(_UNKNOWN)).alias("ids"),
        F.col("duration_ms").cast("double").alias("durations"),
    )

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, group in batch.groupby("path", dropna=False, sort=False):
                kept = _latest([group[c].to_numpy() for c in _SAMPLES], keep)
                name = None if pd.isna(path) else path
                rows.append((name, group["newest"].max(), len(group), *kept))
            yield pd.DataFrame(rows, columns=["path", "newest", "total", *_SAMPLES])

    def advance(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        total, *samples = state.get if state.exists else (0, [], [], [])
        held = [np.asarray(samples[0], "int64"), np.asarray(samples[1], "int64"), np.asarray(samples[2], "float64")]
        for chunk in chunks:
            total += int(chunk["total"].sum())
            arrived = [np.concatenate(chunk[c].to_list()) for c in _SAMPLES]
            held = _latest([np.concatenate(pair) for pair in zip(held, arrived)], keep)
        state.update((total, *(part.tolist() for part in held)))
        last_ms = max(int(held[0].max()) // 1000, state.getCurrentWatermarkMs(), 0)
        state.setTimeoutTimestamp(last_ms + 1)
        yield pd.DataFrame([(key[0], total, len(held[0]), *_figures(held[2]))], columns=_columns(_FIGURES))

    figures = (
        plain.mapInPandas(thin, _THINNED)
        .withWatermark("newest", forget_after)
        .groupBy("path")
        .applyInPandasWithState(advance, _FIGURES, _STATE, "update", GroupStateTimeout.EventTimeTimeout)
    )
    rounded = [F.round(c, 3).alias(c) for c in ("p50", "p95", "p99", "mean", "max")]
    return figures.select("path", "total", "retained", *rounded)


def run_endpoint_latency(requests: DataFrame, folder: str, checkpoint: str, **options) -> StreamingQuery:
    """Take in what has arrived, write the changed rows under ``folder`` and stop; run again to go on.

    Every micro-batch owns a folder named by its number and replaces it when it is replayed after a
    loss, so each request counts once.
    """

    def store(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/micro_batch={number}")

    return (
        endpoint_latency_stream(requests, **options)
        .writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_latency(spark: SparkSession, folder: str) -> DataFrame:
    """The last row written of each endpoint."""
    schema = f"{_FIGURES}, micro_batch long"
    newest = Window.partitionBy("path").orderBy(F.col("micro_batch").desc())
    written = spark.read.schema(schema).parquet(folder)
    last = written.withColumn("age", F.row_number().over(newest)).filter(F.col("age") == 1)
    return last.drop("age", "micro_batch")


def _columns(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _latest(samples: list[np.ndarray], keep: int) -> list[np.ndarray]:
    """The ``keep`` samples latest by moment, then by id."""
    if len(samples[0]) <= keep:
        return samples
    order = np.lexsort((samples[1], samples[0]))[-keep:]
    return [part[order] for part in samples]


def _figures(durations: np.ndarray) -> tuple[float, ...]:
    """Interpolated percentiles, mean and maximum; zeros where nothing was measured."""
    measured = np.sort(durations[~np.isnan(durations)])
    if not len(measured):
        return (0.0,) * 5
    places = np.array([0.5, 0.95, 0.99]) * (len(measured) - 1)
    low = np.floor(places).astype("int64")
    high = np.ceil(places).astype("int64")
    share = places - low
    # both ends weighted, as the percentile of the batch form
    points = np.where(low == high, measured[low], (1 - share) * measured[low] + share * measured[high])
    return (*points.tolist(), float(measured.mean()), float(measured[-1]))

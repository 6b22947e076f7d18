"""Reading, running sums over range partitions, and column helpers used by several operators."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import reviewlake
from reviewlake.session import parallelism, pin, shared_folder

#: Arrow batches hold whole rows; long texts make batches of the default 10 000 rows too large for a worker.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_ready(spark: SparkSession) -> None:
    """Before Python runs on executors: bound Arrow batches of whole texts, and ship this package once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    context = spark.sparkContext
    if getattr(context, "_ships_reviewlake", False):
        return
    package = Path(reviewlake.__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="reviewlake-")) / "reviewlake.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, f"reviewlake/{file.relative_to(package)}")
    context.addPyFile(str(archive))
    context._ships_reviewlake = True


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def store(df: DataFrame) -> DataFrame:
    """`pin` with the denser of Parquet's codecs, for the larger intermediate tables."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the files of frames that `store` or `pin` made and that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for folder in {file.rsplit("/", 1)[0] for frame in frames for file in frame.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def with_columns(batch: pa.RecordBatch, **columns) -> pa.RecordBatch:
    """A batch with columns added; those it has pass through untouched, so that null and large ids stay exact."""
    added = [pa.array(c if isinstance(c, np.ndarray) else list(c)) for c in columns.values()]
    return pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *columns])


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nobody holds any more."""
    for _ in range(2):  # frames hold each other in cycles across both heaps
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def ranged_sums(df: DataFrame, order: list[str], value: str) -> tuple[DataFrame, int, int]:
    """Exclusive running sum of `value` and running row number over the global order of `order`.

    Rows are range-partitioned and sorted; each partition sums locally while it is written once to the shared
    folder, and the driver adds up one total per partition. Returns the frame with `start` and `index`, the total
    and the number of rows. Rows that agree in all of `order` may come in any sequence.
    """
    spark = df.sparkSession
    python_ready(spark)
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.LongType()) for n in ("part", "start", "index"))])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total, rows = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            sizes = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes) + total
            yield with_columns(batch, part=np.full(n, part), start=ends - sizes, index=np.arange(rows, rows + n))
            if n:
                total, rows = int(ends[-1]), rows + n

    spread = df.repartitionByRange(parallelism(spark), *order).sortWithinPartitions(*order)
    stored = pin(spread.mapInArrow(local, schema))
    totals = sorted(stored.groupBy("part").agg(F.sum(value).alias("s"), F.count("*").alias("n")).collect())
    before, seen, offsets = 0, 0, []
    for part, size, rows in totals:  # one row per partition
        offsets.append((part, before, seen))
        before, seen = before + size, seen + rows
    shift = spark.createDataFrame(offsets, "part long, start_before long, index_before long")
    summed = (
        stored.join(F.broadcast(shift), "part")
        .withColumn("start", F.col("start") + F.col("start_before"))
        .withColumn("index", F.col("index") + F.col("index_before"))
        .drop("part", "start_before", "index_before")
    )
    return summed, before, seen

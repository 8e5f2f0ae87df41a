"""Incremental ingest with Structured Streaming: micro-batches through the same keyed operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.tables import Table
from ..storage import scratch_dir


def ingest(
    stream: DataFrame, table: Table, checkpoint: str, key: str = "link", prepare: Callable[[DataFrame], DataFrame] | None = None,
    ts: str | None = None, late: str = "1 hour",
):
    """Starts a query that upserts each micro-batch of string rows into ``table``; available data, then it ends.

    A batch that is run again, after a failure between the table's change and the stream's own note of it, changes
    nothing: the change carries the batch's id. With an event time ``ts``, rows whose key came within ``late`` of it are left out.
    """
    if ts:
        stream = stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])

    def step(batch: DataFrame, number: int) -> None:
        rows = prepare(batch) if prepare else batch
        if "row_pos" not in rows.columns:
            rows = rows.withColumn("row_pos", F.monotonically_increasing_id())
        table.upsert(rows, key, batch=(checkpoint, number))

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, ts: str, key: str, window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts by event-time window and key; rows later than the watermark are left out."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, window), key).agg(F.count(F.lit(1)).alias("n"))


def latest_by_key(spark: SparkSession, path: str, schema: StructType, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The last value of ``columns`` and the number of events of each key, kept up by a stream over ``path``'s files.

    Each micro-batch is folded to one row a key and merged with the table's; batches may come in any order. The
    stream ends when the available files are read.
    """
    folder = f"{scratch_dir(spark)}/newsloom-stream-{uuid.uuid4().hex}"
    table = Table(spark, f"{folder}/state")
    fold = [F.max_by(F.struct(*columns), F.struct(*order)).alias("v"), F.max(F.struct(*order)).alias("o"), F.count(F.lit(1)).alias("events")]

    def step(batch: DataFrame, number: int) -> None:
        if table.holds((folder, number)):
            return  # counted before a failure
        new = batch.groupBy(key).agg(*fold)
        old = table.read()
        both = new if old is None else old.unionByName(new)
        folded = both.groupBy(key).agg(F.max_by("v", "o").alias("v"), F.max("o").alias("o"), F.sum("events").alias("events"))
        table.overwrite(folded, (folder, number))

    # a file source takes folders; a single file is read through its folder and a filter on names
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema)
    if not fs.getFileStatus(at).isDirectory():
        reader, path = reader.option("pathGlobFilter", at.getName()), at.getParent().toString()
    query = reader.parquet(path).writeStream.foreachBatch(step).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    out = table.read()
    if out is None:
        out = spark.createDataFrame([], schema).groupBy(key).agg(*fold)
    return out.select(key, *[F.col(f"v.{c}").alias(c) for c in columns], "events")

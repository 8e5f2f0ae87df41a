"""Helpers shared by the training-data operators: Arrow text access and sizing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import materialise, scratch_dir

__all__ = ["byte_rows", "component_ids", "materialise", "partitions_for", "scratch_dir", "shuffle_partitions", "survivors", "tune"]

ARROW_ROWS = 2000
ARROW_BYTES = 8 << 20
#: Bytes that a shuffle partition is planned for, and the most partitions of a shuffle.
PARTITION_BYTES = 32 << 20
MOST_PARTITIONS = 20_000


def tune(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so that long documents don't add up in a Python worker."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(rows, "10000")) > ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))
    spark.conf.set(size, str(ARROW_BYTES))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def partitions_for(spark: SparkSession, size: int, each: int = PARTITION_BYTES) -> int:
    """Partitions of about ``each`` bytes for ``size`` bytes: the session's number at least, MOST_PARTITIONS at most."""
    return min(max(shuffle_partitions(spark), -(-size // each)), max(shuffle_partitions(spark), MOST_PARTITIONS))


def byte_rows(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a string or binary column as bytes, without decoding; None for null."""
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    valid = column.is_valid().to_pylist() if column.null_count else None
    for i in range(n):
        yield None if valid is not None and not valid[i] else bytes(view[at[i] : at[i + 1]])


def survivors(docs: DataFrame, verdicts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose verdict (doc_id, text_key, kept, copies) is to stay.

    copies: whether rows that repeat both id and text are copies of each other; then one of them stays, which one is
    arbitrary. Rows without a verdict stay.
    """
    verdicts = materialise(verdicts.select("doc_id", "text_key", "kept", "copies"), "verdicts")
    key = [F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")]
    gone = verdicts.where(~F.col("kept")).select(*key).distinct()
    again = verdicts.where(F.col("kept") & F.col("copies")).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_id", "_key")
    again = materialise(again, "again")
    same = lambda t: docs[id_col].eqNullSafe(t["_id"]) & (F.xxhash64(docs[text_col]) == t["_key"])
    if again.isEmpty():
        return docs.join(gone, same(gone), "left_anti")
    both = gone.unionByName(again)
    one = docs.join(again, same(again), "left_semi")
    first = Window.partitionBy(F.col(id_col), F.xxhash64(text_col)).orderBy(F.lit(0))
    one = one.withColumn("_newsloom_rank", F.row_number().over(first)).where("_newsloom_rank = 1").drop("_newsloom_rank")
    return docs.join(both, same(both), "left_anti").unionByName(one)


def component_ids(rows: DataFrame, components: DataFrame) -> DataFrame:
    """``rows`` (doc_id, class, ...) with component_id, the least doc_id of the classes that (node, component) joins.

    Rows of one class belong together; a null class stands alone and keeps its own id. What is joined back is written
    first, so that the join of a large class or component can be split.
    """
    classes = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("least"))
    named = classes.join(components.withColumnRenamed("node", "class"), "class", "left")
    named = materialise(named.withColumn("component", F.coalesce("component", "class")), "classes")
    least = materialise(named.groupBy("component").agg(F.min("least").alias("component_id")), "component_ids")
    ids = materialise(named.join(least, "component").select("class", "component_id"), "class_ids")
    out = rows.join(ids, "class", "left")
    return out.withColumn("component_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))

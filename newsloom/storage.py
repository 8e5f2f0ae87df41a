"""Tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

def scratch_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, as in tests, a folder of this machine is set, but only for a master
    that runs in this process: on a cluster executors couldn't read it, so there it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="newsloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def temporary(spark: SparkSession, label: str) -> str:
    """A new folder's path in the shared folder; it goes when the driver's JVM ends."""
    path = f"{scratch_dir(spark)}/newsloom-{uuid.uuid4().hex}/{label}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent()
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialise(df: DataFrame, label: str, large_rows: int = 0) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts lineage: a lost executor costs a reread of the table, not a recomputation. The table
    goes when the driver's JVM ends. large_rows: for packed rows of megabytes, the most of a file; each is a page of its
    own, not compressed again. Else Parquet puts up to a hundred in a page, whose codec holds it outside the heap.
    """
    spark = df.sparkSession
    path = temporary(spark, label)
    out = df.write.mode("overwrite")
    if large_rows:
        out = out.options(**{"maxRecordsPerFile": large_rows, "compression": "none", "parquet.page.row.count.limit": 1, "parquet.page.size.row.check.min": 1})
    out.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

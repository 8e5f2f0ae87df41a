"""Long work in chunks: each is written when it is done, so that a failure costs one chunk."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialise
from .keyed import row_numbers


def run_in_chunks(
    rows: DataFrame, order: Sequence[Column], work: Callable[[DataFrame], DataFrame], on_success: Callable[[DataFrame], None],
    on_failure: Callable[[DataFrame, str], None] | None = None, sync: Callable[[int, int, int, int], None] | None = None, size: int = 1_000_000,
) -> dict[str, int]:
    """Counts of rows processed, success and failed, and of chunks and of failed syncs.

    Rows are numbered in ``order``, which should be unique, and worked on ``size`` at a time. ``work`` gives a row for
    each of a chunk's rows, with a column status: ok or something else. Good rows go to ``on_success``, others to
    ``on_failure``; where ``work`` itself fails, all the chunk's rows do, with the error, and the next chunk follows.
    ``sync`` gets (chunk, chunks, success, failed) after each; what it raises is counted and ends nothing. No rows: no
    chunk. Each chunk reads only its own range of the numbered table, which Parquet's statistics find.
    """
    numbered = materialise(row_numbers(rows, order, "_number").sortWithinPartitions("_number"), "numbered")
    total = numbered.count()
    chunks, done = -(-total // size), {"processed": 0, "success": 0, "failed": 0, "chunks": 0, "sync_failed": 0}
    for k in range(chunks):
        own = numbered.where(F.col("_number").between(k * size + 1, (k + 1) * size)).drop("_number")
        expected = min(size, total - k * size)
        try:
            got = materialise(work(own), "chunk")
            good = got.where(F.col("status") == "ok").count()
        except Exception as error:  # whatever the work answers: its rows count as failed
            good, failed = 0, own.withColumn("status", F.lit("failed"))
            reason = f"{type(error).__name__}: {error}"[:500]
        else:
            failed, reason = got.where(~F.col("status").eqNullSafe(F.lit("ok"))), "no answer"
            if good:
                on_success(got.where(F.col("status") == "ok"))
        bad = expected - good
        if bad and on_failure:
            on_failure(failed, reason)
        done = done | {"processed": done["processed"] + expected, "success": done["success"] + good, "failed": done["failed"] + bad, "chunks": k + 1}
        if sync:
            try:
                sync(k + 1, chunks, good, bad)
            except Exception:  # the next chunk saves again
                done["sync_failed"] += 1
    return done

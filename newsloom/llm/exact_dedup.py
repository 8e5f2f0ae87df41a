"""Exact deduplication with a heavy-hitter split.

Misra-Gries summaries, one per task, name the digests that may be frequent; exact counts verify them.
The verified winners (at most ``counters`` rows, whatever the input) are broadcast, so the members of
huge groups are resolved where they lie and never meet in one task. All other digests are rarer than
one row in ``counters`` and take the ordinary shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, survivors, tune


def trim_counters(counts: Counter, k: int) -> Counter:
    """The Misra-Gries step for a batch: take off the (k+1)th largest count everywhere, keep what is positive."""
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return Counter({x: c - cut for x, c in counts.items() if c > cut})


def misra_gries(k: int):
    """A mapInArrow function: at most ``k`` (digest, lower bound of its count) rows for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            counts.update(b.column(0).to_pylist())
            counts = trim_counters(counts, k)
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                names=["digest", "seen"],
            )

    return run


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, digest): SHA-256 of the text in UTF-8 after lower-casing A-Z only; null counts as empty.

    text_key is a hash of the text as it is, to find the row again.
    """
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), ascii_uppercase, ascii_lowercase)
    return docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.unhex(F.sha2(lowered, 256)).alias("digest")
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 1024, least: int = 64
) -> DataFrame:
    """For every row: doc_id, keep_id, group_size, kept, digest (binary SHA-256), text_key.

    Texts are equal when identical after lower-casing A-Z only; null equals empty. The largest doc_id of
    a group stays. Null doc_ids count in group_size and never win against another id; a group of null ids
    only has keep_id null and kept true. Repeated rows of one doc_id share its verdict. Other columns of
    ``docs``, whatever their names, are not looked at. An empty table gives an empty result.

    counters: the most digests that are broadcast. least: smallest verified group that is broadcast.
    """
    tune(docs.sparkSession)
    rows = materialise(text_digests(docs, id_col, text_col), "digests")
    summaries = rows.select("digest").mapInArrow(misra_gries(counters), "digest binary, seen bigint")
    candidates = (
        summaries.groupBy("digest").agg(F.sum("seen").alias("seen")).orderBy(F.desc("seen"), "digest").limit(counters)
    )
    winners = materialise(
        rows.join(F.broadcast(candidates.select("digest")), "digest")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where(F.col("group_size") >= least),
        "winners",
    )
    heavy = rows.join(F.broadcast(winners), "digest")
    w = Window.partitionBy("digest")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        "doc_id",
        "text_key",
        F.max("doc_id").over(w).alias("keep_id"),
        F.count(F.lit(1)).over(w).alias("group_size"),
        "digest",
    )
    both = heavy.select("doc_id", "text_key", "keep_id", "group_size", "digest").unionByName(rest)
    return both.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns as they are, without those that ``exact_groups`` drops.

    Null and empty texts are equal to each other. Of rows that repeat both the id and the text of the row that stays,
    one stays (an arbitrary one, should other columns differ). An empty table gives an empty result.
    """
    groups = exact_groups(docs, id_col, text_col, **options).withColumn("copies", F.lit(True))
    return survivors(docs, groups, id_col, text_col)

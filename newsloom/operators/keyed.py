"""Keyed operators: dedupe, numbering, key filters, upsert. Ties always end on an explicit unique order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import UPSERT_FIELDS
from ..functions.text import clean_invisible, header_key, non_blank
from ..storage import materialise


def keep_one(df: DataFrame, key: str, order: Sequence[Column], keep_blank: bool = False) -> DataFrame:
    """The first row of each key by ``order``; with ``keep_blank`` every row whose key is blank stays."""
    ranked = lambda rows: rows.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_rank = 1").drop("_rank")
    if not keep_blank:
        return ranked(df)
    # blank keys are no group: their rows, however many, are never brought together
    blank = F.col(key).isNotNull() & (clean_invisible(F.col(key)) == "")
    return ranked(df.where(~blank)).unionByName(df.where(blank))


def left_join_filled(df: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    """A left join on ``key`` = ``other_key``. Rows whose key is null or empty match nothing and, however many, never meet."""
    text = df.schema[key].dataType.typeName() == "string"
    bare = (F.coalesce(F.col(key), F.lit("")) == "") if text else F.col(key).isNull()
    return df.where(~bare).join(other, F.col(key) == F.col(other_key), "left").unionByName(df.where(bare), allowMissingColumns=True)


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    return keep_one(df, key, [F.col(order).asc_nulls_last()])


def keep_last(df: DataFrame, key: str, order: str) -> DataFrame:
    return keep_one(df, key, [F.col(order).desc_nulls_last()])


def merge_keep(first: DataFrame, second: DataFrame, key: str, order: str, last: bool) -> DataFrame:
    """Rows of both, one for each key: the second table's (``last``) or the first's; columns may differ."""
    both = first.withColumn("_table", F.lit(0)).unionByName(second.withColumn("_table", F.lit(1)), allowMissingColumns=True)
    side = [F.col("_table").desc(), F.col(order).desc()] if last else [F.col("_table"), F.col(order)]
    return keep_one(both, key, side).drop("_table")


def primary_key(df: DataFrame) -> DataFrame:
    """pk: originallink, or link where that is blank."""
    return df.withColumn("pk", F.coalesce(non_blank(F.col("originallink")), F.col("link")))


def dedupe_latest(df: DataFrame, ts: str = "pub_datetime", tie: str = "link") -> DataFrame:
    """One row for each pk, the latest (nulls last), with the distinct queries of all its rows joined by '|', sorted.

    Queries that were joined before are taken apart first. The queries are gathered by a partial aggregate; the
    rows themselves are ranked, and Spark trims each task's ranks before the shuffle.
    """
    keyed = primary_key(df)
    parts = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.split("query", r"\|")))))
    names = keyed.where(F.col("query").isNotNull()).groupBy("pk").agg(F.array_join(parts, "|").alias("_query"))
    latest = keep_one(keyed, "pk", [F.col(ts).desc_nulls_last(), F.col(tie)])
    return latest.join(names, "pk", "left").withColumn("query", F.coalesce("_query", "query")).drop("_query")


def row_numbers(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with 1, 2, ... in ``order``, which should be unique, as ``name``.

    Ranks come from a range partitioning and per-partition counts, not from one task's window over all rows.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    ranged = materialise(ranged.withColumn("_at", F.monotonically_increasing_id() - F.shiftleft(F.col("_part").cast("long"), 33)), "ranged")
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    counts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(counts), "_part").withColumn(name, (F.col("_before") + F.col("_at") + 1).cast("bigint")).drop("_part", "_at", "_before")


def number_rows(df: DataFrame, column: str, ts: str, tie: str, start: int | Column = 0) -> DataFrame:
    """Rows without a number get one: start + 1, ... in (time, nulls last, tie) order; existing numbers stay."""
    have = df.withColumn(column, F.col(column).try_cast("bigint"))
    todo = row_numbers(have.where(F.col(column).isNull()).drop(column), [F.col(ts).asc_nulls_last(), F.col(tie)], column)
    base = start if isinstance(start, Column) else F.lit(start)
    return have.where(F.col(column).isNotNull()).unionByName(todo.withColumn(column, (base + F.col(column)).cast("bigint")))


def new_rows(df: DataFrame, known: DataFrame, key: str = "link") -> DataFrame:
    return df.join(known.select(key).distinct(), key, "left_anti")


def selected_rows(df: DataFrame, targets: DataFrame, key: str = "link") -> DataFrame:
    return df.join(targets.select(key).distinct(), key, "left_semi")


def reset_where(df: DataFrame, targets: DataFrame, key: str = "link", column: str = "classified_at") -> DataFrame:
    """``column`` set to '' for the targets' keys; without the column nothing changes."""
    if column not in df.columns:
        return df
    flag = targets.select(F.col(key).alias("_key")).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(flag, df[key] == flag["_key"], "left")
    return joined.withColumn(column, F.when(F.col("_hit"), "").otherwise(F.col(column))).drop("_key", "_hit")


def attach(df: DataFrame, source: DataFrame, columns: Sequence[str], key: str = "link") -> DataFrame:
    """``df`` with ``columns`` taken from the row of ``source`` with its key, in place of its own; '' where there is none.

    A key that ``source`` repeats gives a row for each of its rows; null keys match nothing.
    """
    right = source.select(F.col(key).alias("_key"), *columns)
    out = df.drop(*columns).join(right, df[key] == right["_key"], "left").drop("_key")
    return out.fillna("", subset=list(columns))


def islands(df: DataFrame, row: str) -> DataFrame:
    """Contiguous ranges (first_row, last_row, rows) of integer row numbers."""
    ranked = row_numbers(df.select(F.col(row).alias("_r")).distinct(), [F.col("_r").asc()], "_n").withColumn("_g", F.col("_r") - F.col("_n"))
    return ranked.groupBy("_g").agg(F.min("_r").alias("first_row"), F.max("_r").alias("last_row"), F.count(F.lit(1)).alias("rows")).drop("_g")


def duplicate_losers(df: DataFrame, key: str, brand: str, row: str, last: bool = False) -> DataFrame:
    """Rows to delete for each non-blank key with several rows: the keeper is the first (or last) row with a brand
    value, or if none has one the first (or last)."""
    k = clean_invisible(F.col(key))
    order = F.col(row).desc() if last else F.col(row)
    w = Window.partitionBy("_k").orderBy((clean_invisible(F.col(brand)) == ""), order)
    ranked = df.withColumn("_k", k).where(F.col("_k") != "").withColumn("_rank", F.row_number().over(w))
    return ranked.where(F.col("_rank") > 1).drop("_rank", "_k")


def align_headers(columns: Sequence[str], header: Sequence[str]) -> tuple[list[str], dict[str, str]]:
    """(header with the table's own spelling plus the new columns on the right, input column -> header column).

    Names match without case and invisible characters; of equal header names the first counts.
    """
    known: dict[str, str] = {}
    for h in header:
        known.setdefault(header_key(h), header_key(h) and _clean(h))
    out = list(dict.fromkeys(known.values()))
    names = {}
    for c in columns:
        k = header_key(c)
        if k not in known:
            known[k] = _clean(c)
            out.append(known[k])
        names[c] = known[k]
    return out, names


def _clean(name: str) -> str:
    import re

    return re.sub("[﻿​-‏]", "", name).strip()


def upsert(
    stored: DataFrame, new: DataFrame, key: str = "link", row: str = "row_pos",
    fields: Sequence[str] = tuple(UPSERT_FIELDS), force: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(table after the upsert, one row of counts: attempted, added, updated, skipped, errors), see ``upsert_changes``."""
    header, changed, added, stats = upsert_changes(stored, new, key, row, fields, force)
    if header is None:
        return stored, stats
    return header.join(changed.select(row), row, "left_anti").unionByName(changed).unionByName(added), stats


def upsert_changes(
    stored: DataFrame, new: DataFrame, key: str = "link", row: str = "row_pos",
    fields: Sequence[str] = tuple(UPSERT_FIELDS), force: bool = False,
) -> tuple[DataFrame | None, DataFrame, DataFrame, DataFrame]:
    """(stored rows under the new header, the rows that change, the rows that are added, one row of counts).

    ``stored`` and ``new`` hold strings; ``row`` is the position of a row in its table. A new row with a blank key
    is always appended, as is each one whose key the table lacks. A row with a known key updates the last stored
    row of that key if any watched field is non-blank and differs (or ``force``); then every column takes the new
    value unless it is blank. Columns the table lacks are added. With rows but no key column in the table nothing
    changes, every row is an error, and the stored rows are None.

    Only stored rows whose key is among the new ones are looked at; rows with blank keys meet nobody.
    """
    spark = new.sparkSession
    counts = "attempted bigint, added bigint, updated bigint, skipped bigint, errors bigint"
    header, names = align_headers([c for c in new.columns if c != row], [c for c in stored.columns if c != row])
    stored = stored.select(*[F.col(f"`{c}`").alias(_clean(c)) if c != row else F.col(row) for c in stored.columns])
    by_key = {header_key(h): h for h in header}
    k = by_key[header_key(key)]
    if header_key(key) not in {header_key(c) for c in stored.columns} and stored.columns != [row] and stored.limit(1).count():
        n = new.count()
        none = stored.limit(0)
        return None, none, none, spark.createDataFrame([(n, 0, 0, 0, n)], counts)
    missing = [h for h in header if h not in stored.columns]
    old = stored.select(row, *[clean_invisible(F.col(f"`{h}`")).alias(h) if h not in missing else F.lit("").alias(h) for h in header])
    fresh = new.select(F.col(row).alias("_new_row"), *[clean_invisible(F.col(f"`{c}`")).alias(f"_new_{h}") for c, h in names.items()])
    blank = F.coalesce(F.col(f"_new_{k}"), F.lit("")) == ""
    asked = fresh.where(~blank).select(F.col(f"_new_{k}").alias(k)).distinct()
    target = keep_one(old.where(F.col(k) != "").join(asked, k, "left_semi"), k, [F.col(row).desc()]).select(row, *header)
    probe = fresh.where(~blank).join(target, F.col(f"_new_{k}") == F.col(k), "left")
    alone = fresh.where(blank)
    probe = probe.unionByName(alone.select("*", F.lit(None).cast(old.schema[row].dataType).alias(row), *[F.lit(None).cast("string").alias(h) for h in header]))
    given = set(names.values())
    watched = [f for f in fields if f in given]
    differs = F.lit(False)
    for f in watched:
        differs = differs | ((F.col(f"_new_{f}") != "") & (F.col(f"_new_{f}") != F.col(f)))
    action = F.when(F.col(row).isNull(), "added").when(F.lit(force) | differs, "updated").otherwise("skipped")
    probe = materialise(probe.withColumn("_action", action), "upsert_probe")
    last = Window.partitionBy(row).orderBy(F.col("_new_row").desc())
    changed = probe.where(F.col("_action") == "updated").withColumn("_rank", F.row_number().over(last)).where("_rank = 1")
    changed = changed.select(
        F.col(row), *[(F.when(F.col(f"_new_{h}") != "", F.col(f"_new_{h}")).otherwise(F.col(h)) if h in given else F.col(h)).alias(h) for h in header]
    )
    top = old.agg(F.coalesce(F.max(row), F.lit(0)).alias("_top"))
    added = probe.where(F.col("_action") == "added").crossJoin(F.broadcast(top)).select(
        (F.col("_top") + 1 + F.col("_new_row")).alias(row),
        *[(F.col(f"_new_{h}") if h in given else F.lit("")).alias(h) for h in header],
    )
    stats = probe.agg(
        F.count(F.lit(1)).alias("attempted"),
        *[F.count_if(F.col("_action") == a).alias(a) for a in ("added", "updated", "skipped")],
        F.lit(0).cast("bigint").alias("errors"),
    )
    return old.select(row, *header), changed, added, stats

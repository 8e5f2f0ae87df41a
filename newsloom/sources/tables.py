"""Tables at rest: Parquet tables that grow by logged changes, string scans, CSV, key and counter scans, date filters."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import BRAND_NAMES, COMPETITOR, DATE_COLUMNS, ORIGINAL_LINK_NAMES, OUR
from ..functions.dates import to_instant
from ..functions.text import clean_invisible, find_column, header_key
from ..operators.keyed import align_headers, duplicate_losers, keep_one, upsert_changes
from ..storage import exists, materialise


class Table:
    """A table in the shared folder that grows by changes: appending or updating rows writes these rows only.

    Rows lie in folders below ``data``. A numbered ``log`` says what each folder is: ``base`` (the whole table), ``append``
    (more rows) or ``rows`` (rows that take the place of those at their positions, or are new). A folder counts once its
    log entry is there, so a reader or a failed job never sees half a change. An entry's file gets its name by a rename
    that fails where the number is taken: of two writers one comes second, and none overwrites the other. An append then
    takes the next number; an upsert reads the table again and is worked out anew. Once changes are many or large they
    are folded into a new base, so each row is rewritten a bounded number of times on average.
    """

    #: Changes after which a new base is written; and their share of the base's bytes, from LEAST_BYTES on.
    MOST_CHANGES = 16
    MOST_SHARE = 0.5
    LEAST_BYTES = 64 << 20
    ATTEMPTS = 20

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        self._jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._path = self._jvm.org.apache.hadoop.fs.Path
        at = self._path(self.path)
        self._fs = at.getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.makeQualified(at).toUri(), conf)

    # ---- log ----

    def _entries(self, bases: int = 1) -> list[dict]:
        """Log entries from the newest base on, in order; or from as many bases back; -1: all.

        Another writer may be putting an entry in place (on a local file system a file and its checksum come one after
        the other) or dropping old ones, so a read that fails is done again.
        """
        for attempt in range(self.ATTEMPTS):
            try:
                return self._log(bases)
            except Py4JJavaError:
                if attempt + 1 == self.ATTEMPTS:
                    raise
                time.sleep(0.02 * (attempt + 1))
        return []

    def _log(self, bases: int) -> list[dict]:
        if not exists(self.spark, f"{self.path}/log"):
            return []
        numbers = sorted(n for s in self._fs.listStatus(self._path(f"{self.path}/log")) if (n := s.getPath().getName()).isdigit())
        out: list[dict] = []
        for n in reversed(numbers):
            stream = self._fs.open(self._path(f"{self.path}/log/{n}"))
            try:
                out.append(json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")) | {"number": int(n)})
            finally:
                stream.close()
            bases -= out[-1]["kind"] == "base"
            if not bases:
                break
        return out[::-1]

    def _write(self, df: DataFrame) -> str:
        folder = uuid.uuid4().hex
        df.write.mode("overwrite").parquet(f"{self.path}/data/{folder}")
        return folder

    def _commit(self, number: int, kind: str, folder: str, **more) -> bool:
        """Whether the entry has the number; not so where another writer was first."""
        new = self._path(f"{self.path}/log/.{folder}")
        out = self._fs.create(new, True)
        out.write(bytearray(json.dumps({"kind": kind, "folder": folder, **more}).encode()))
        out.close()
        none = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename").NONE
        options = self.spark.sparkContext._gateway.new_array(getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
        options[0] = none
        try:
            self._context.rename(new, self._path(f"{self.path}/log/{number:012d}"), options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            self._fs.delete(new, False)
            return False
        return True

    def _add(self, kind: str, folder: str, batch: tuple[str, int] | None = None) -> None:
        """An entry at the next free number."""
        for _ in range(self.ATTEMPTS * 10):
            entries = self._entries()
            if self._commit(entries[-1]["number"] + 1 if entries else 1, kind, folder, batches=self._batches(entries, batch)):
                return
        raise RuntimeError(f"no place in the log of {self.path}")

    @staticmethod
    def _batches(entries: list[dict], batch: tuple[str, int] | None = None) -> dict[str, int]:
        """The last batch of each stream that the table holds; every entry hands them on."""
        return (entries[-1].get("batches", {}) if entries else {}) | (dict([batch]) if batch else {})

    def holds(self, batch: tuple[str, int]) -> bool:
        """Whether a change of this (stream, batch id) or a later one of the stream is in the table."""
        return self._batches(self._entries()).get(batch[0], -1) >= batch[1]

    # ---- reading ----

    def _data(self, entry: dict) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/data/{entry['folder']}")

    def _now(self, entries: list[dict]) -> DataFrame | None:
        """The table that the entries give: whole and appended rows, without those that changed, and the newest of these."""
        if not entries:
            return None
        still = [self._data(e) for e in entries if e["kind"] != "rows"]
        changes = [e for e in entries if e["kind"] == "rows"]
        df = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), still) if still else None
        if not changes:
            return df
        row = changes[0]["row"]
        new = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [self._data(e).withColumn("_change", F.lit(e["number"])) for e in changes])
        new = new.groupBy(row).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in new.columns if c not in (row, "_change")]), "_change").alias("_new")).select(row, "_new.*")
        if df is None:
            return new
        out = df.join(new.select(row), row, "left_anti").unionByName(new, allowMissingColumns=True)
        late = [c for c in new.columns if c not in df.columns]  # columns that came with a change are empty before it
        return out.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in late if out.schema[c].dataType.typeName() == "string"})

    def read(self, schema: str | None = None) -> DataFrame | None:
        """The table as the log has it now; without any entry an empty table of ``schema``, or None."""
        df = self._now(self._entries())
        return df if df is not None or not schema else self.spark.createDataFrame([], schema)

    # ---- writing ----

    def overwrite(self, df: DataFrame, batch: tuple[str, int] | None = None) -> None:
        self._add("base", self._write(df), batch)
        self._forget()

    def append(self, df: DataFrame) -> None:
        """More rows; columns may differ. Appends at one time all count."""
        folder = self._write(df)
        if self._entries() or not self._commit(1, "base", folder):
            self._add("append", folder)
        self._fold()

    def upsert(self, new: DataFrame, key: str = "link", row: str = "row_pos", force: bool = False, batch: tuple[str, int] | None = None) -> dict[str, int]:
        """Counts of what ``upsert`` does; only rows that are added or changed are written, whatever the table's size.

        batch: the (stream, batch id) that the rows are; a batch that the table holds already changes nothing.
        """
        new = materialise(new, "upsert")
        for _ in range(self.ATTEMPTS):
            entries = self._entries()
            if batch and self._batches(entries).get(batch[0], -1) >= batch[1]:
                return dict.fromkeys(("attempted", "added", "updated", "skipped", "errors"), 0)
            old = self._now(entries)
            if old is None:
                names = [c for c in new.columns if c != row]
                old = self.spark.createDataFrame([], f"{row} bigint, " + ", ".join(f"`{c}` string" for c in names))
            _, changed, added, counts = upsert_changes(old, new, key, row, force=force)
            got = counts.first().asDict()
            if got["errors"] or not got["added"] + got["updated"]:
                return got
            number = entries[-1]["number"] + 1 if entries else 1
            if self._commit(number, "rows" if entries else "base", self._write(changed.unionByName(added)), row=row, batches=self._batches(entries, batch)):
                self._fold()
                return got
        raise RuntimeError(f"{self.path} changes faster than it can be updated")

    def _bytes(self, entries: list[dict]) -> int:
        return sum(self._fs.getContentSummary(self._path(f"{self.path}/data/{e['folder']}")).getLength() for e in entries)

    def _fold(self) -> None:
        """A new base where changes are many or large; left to the next writer where another change comes first."""
        entries = self._entries()
        base, changes = [e for e in entries if e["kind"] == "base"], [e for e in entries if e["kind"] != "base"]
        if len(changes) <= self.MOST_CHANGES and self._bytes(changes) <= max(self.LEAST_BYTES, self.MOST_SHARE * self._bytes(base)):
            return
        if self._commit(entries[-1]["number"] + 1, "base", self._write(self._now(entries)), batches=self._batches(entries)):
            self._forget()

    def _forget(self) -> None:
        """Drops what only bases before the newest ``keep`` need; readers of the ones kept go on."""
        whole, kept = self._entries(bases=-1), self._entries(self.keep)
        for e in whole[: -len(kept)]:
            self._fs.delete(self._path(f"{self.path}/log/{e['number']:012d}"), False)
            self._fs.delete(self._path(f"{self.path}/data/{e['folder']}"), True)

    def dedupe(self, key: str = "link", row: str = "row_pos") -> dict[str, int]:
        """Keeps the first row of each key, and every row whose key is blank; rewrites only if rows go."""
        old = self.read()
        if old is None:
            return {"before": 0, "after": 0, "removed": 0}
        left = keep_one(old, key, [F.col(row)], keep_blank=True)
        before, after = old.count(), left.count()
        if after < before:
            self.overwrite(left)
        return {"before": before, "after": after, "removed": before - after}


    def delete(self, rows: DataFrame, row: str = "row_pos", dry_run: bool = False, attempts: int = 3) -> tuple[int, bool]:
        """(rows deleted, whether it was given up): a snapshot without the rows whose position is in ``rows``.

        A dry run counts only. A snapshot counts whole or not at all, so a failed write is done again; after
        ``attempts`` of them nothing is deleted and the table stays as it was.
        """
        old = self.read()
        if old is None:
            return 0, False
        gone = materialise(rows.select(row).distinct(), "deleted")
        n = old.join(gone, row, "left_semi").count()
        if dry_run or not n:
            return n, False
        for _ in range(attempts):
            try:
                self.overwrite(old.join(gone, row, "left_anti"))
                return n, False
            except Exception:  # whatever the store answers
                continue
        return 0, True

    def delete_duplicates(self, row: str = "row_pos", last: bool = False, dry_run: bool = False) -> tuple[int, bool]:
        """Deletes what ``duplicate_losers`` finds by original link; without such a column, or a table, nothing.

        Without a brand column the order of rows alone decides.
        """
        old = self.read()
        link = find_column(old.columns, ORIGINAL_LINK_NAMES) if old is not None else None
        if link is None:
            return 0, False
        brand = find_column(old.columns, BRAND_NAMES)
        own = old.select(row, F.col(f"`{link}`").alias("_link"), (F.col(f"`{brand}`") if brand else F.lit("")).alias("_brand"))
        return self.delete(duplicate_losers(own, "_link", "_brand", row, last), row, dry_run)

    def backfill(self, columns: Sequence[str]) -> int:
        """How many of ``columns`` were added, empty, on the right; names match as in ``align_headers``."""
        old = self.read()
        if old is None:
            self.overwrite(self.spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns)))
            return len(columns)
        more = align_headers(columns, old.columns)[0][len({header_key(c) for c in old.columns}) :]
        if more:
            self.overwrite(old.withColumns({c: F.lit("") for c in more}))
        return len(more)


def sync_tables(raw: Table, result: Table, raw_rows: DataFrame, result_rows: DataFrame, cutoff: str, row: str = "row_pos") -> dict[str, dict[str, int]]:
    """Counts of both upserts and their totals: raw rows as they are, then result rows from ``cutoff`` on, forced.

    Each table is saved on its own: what the second one raises leaves the first as it is.
    """
    out = {"raw_data": raw.upsert(raw_rows, row=row), "total_result": result.upsert(filter_by_best_date(result_rows, cutoff), row=row, force=True)}
    return out | {"all": {k: sum(x[k] for x in out.values()) for k in out["raw_data"]}}


def read_strings(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """CSV with a header as strings; a byte-order mark and invisible characters in names don't count."""
    df = spark.read.option("header", True).option("recursiveFileLookup", recursive).option("multiLine", True).option("escape", '"').csv(path)
    return df.select(*[F.col(f"`{c}`").alias(c.replace("﻿", "").strip()) for c in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    """Quoted UTF-8 CSV of cleaned cells with a header; the first name carries a byte-order mark."""
    out = clean_table(df)[0]
    first = out.columns[0]
    out.withColumnRenamed(first, "﻿" + first).write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def clean_table(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(df with invisible characters gone from its strings, one row with the number of changed cells)."""
    names = [f.name for f in df.schema if f.dataType.typeName() == "string"]
    cleaned = {c: F.when(F.col(f"`{c}`").isNull() | (F.col(f"`{c}`") == ""), F.col(f"`{c}`")).otherwise(clean_invisible(F.col(f"`{c}`"))) for c in names}
    changed = sum((F.count_if(~cleaned[c].eqNullSafe(F.col(f"`{c}`"))) for c in names), F.lit(0))
    return df.withColumns(cleaned), df.agg(changed.alias("changed"))


def known_keys(df: DataFrame, key: str = "link") -> DataFrame:
    """Distinct non-blank cleaned keys; the key's column is found by its normalised name."""
    name = next((c for c in df.columns if header_key(c) == key), None)
    if name is None:
        return df.sparkSession.createDataFrame([], f"{key} string")
    return df.select(clean_invisible(F.col(f"`{name}`")).alias(key)).where(F.col(key) != "").distinct()


def max_counters(df: DataFrame) -> DataFrame:
    """max_cluster (of ids that end in _c and digits) and max_article (of numeric article numbers)."""
    number = F.nullif(F.regexp_extract("cluster_id", "_c([0-9]+)$", 1), F.lit("")).try_cast("bigint")
    return df.agg(F.max(number).alias("max_cluster"), F.max(F.col("article_no").try_cast("bigint")).alias("max_article"))


def on_or_after(df: DataFrame, instant: Column, cutoff: str) -> DataFrame:
    """Rows whose time is ``cutoff`` or later; rows without a time go."""
    return df.where(instant >= F.to_timestamp(F.lit(cutoff)))


def filter_by_best_date(df: DataFrame, cutoff: str, columns: Sequence[str] = tuple(DATE_COLUMNS)) -> DataFrame:
    """Rows on or after ``cutoff`` by the candidate column with most kept, then most valid dates; ties: the first."""
    have = [c for c in columns if c in df.columns]
    if not have:
        return df
    day = F.to_timestamp(F.lit(cutoff))
    marks = [x for c in have for x in (F.count_if(to_instant(F.col(c)) >= day).alias(f"k_{c}"), F.count(to_instant(F.col(c))).alias(f"v_{c}"))]
    got = df.agg(*marks).first()
    best = max(have, key=lambda c: (got[f"k_{c}"], got[f"v_{c}"], -have.index(c)))
    return on_or_after(df, to_instant(F.col(best)), cutoff)


def migrate_group_labels(df: DataFrame) -> DataFrame:
    """Old group labels replaced by the canonical ones; other values stay."""
    name = next((c for c in df.columns if header_key(c) == "group"), None)
    if name is None:
        return df
    x = F.trim(F.col(f"`{name}`"))
    return df.withColumn(name, F.when(x.isin("OUR", "our"), OUR).when(x.isin("COMPETITOR", "competitor"), COMPETITOR).otherwise(F.col(f"`{name}`")))

"""Collecting articles page by page from a search service behind a small transport function."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..constants import COMPETITOR, COMPETITORS, INGEST_COLUMNS, OUR, OUR_BRANDS
from ..storage import materialise
from .tables import Table, known_keys

#: (query, start, size) -> (HTTP status, list of items)
Transport = Callable[[str, int, int], tuple[int, list[dict]]]
#: Known links that go to the executors, where they end paging early; more are only joined.
KNOWN = 200_000
SCHEMA = ", ".join(f"`{c}` string" for c in INGEST_COLUMNS)


def fetch_page(transport: Transport, query: str, start: int, size: int) -> list[dict]:
    """Items of one page; network errors give none, refusals and overload raise."""
    try:
        status, items = transport(query, start, size)
    except OSError:
        return []
    if status in (401, 429) or status >= 500:
        raise RuntimeError(f"search answered {status}")
    return items if status == 200 else []


def fetch_all(transport: Transport, query: str, known: frozenset[str], pages: int = 9, size: int = 100, patience: int = 3, pause: float = 0.0) -> Iterator[dict]:
    """New items of a query; ends on an empty page, or when ``patience`` pages running bring nothing new.

    ``known`` is a snapshot that collecting never changes.
    """
    seen, idle = set(known), 0
    for p in range(pages):
        items = fetch_page(transport, query, 1 + p * size, size)
        if not items:
            return
        fresh = [x for x in items if x.get("link") and x["link"] not in seen]
        seen.update(x["link"] for x in fresh)
        yield from fresh
        idle = 0 if fresh else idle + 1
        if idle >= patience:
            return
        if pause:
            time.sleep(pause)


class _Brand(InputPartition):
    def __init__(self, query: str, group: str):
        super().__init__((query, group))
        self.query, self.group = query, group


def search_source(transport: Transport, brands: Sequence[tuple[str, str]], known: frozenset[str] = frozenset(), **paging) -> type[DataSource]:
    """A batch data source of ingest rows: a partition for each brand (query, group), whose pages an executor reads.

    ``transport`` and ``known`` go to the executors with the source.
    """

    class Reader(DataSourceReader):
        def partitions(self):
            return [_Brand(*b) for b in brands]

        def read(self, partition):
            for x in fetch_all(transport, partition.query, known, **paging):
                yield tuple({"query": partition.query, "group": partition.group}.get(c) or str(x.get(c) or "") for c in INGEST_COLUMNS)

    class Search(DataSource):
        @classmethod
        def name(cls):
            return "newsloom_search"

        def schema(self):
            return SCHEMA

        def reader(self, schema):
            return Reader()

    return Search


def brands_of(our: Sequence[str] | None = None, others: Sequence[str] | None = None) -> list[tuple[str, str]]:
    """(query, group) of every brand, own ones first."""
    return [(b, OUR) for b in (OUR_BRANDS if our is None else our)] + [(b, COMPETITOR) for b in (COMPETITORS if others is None else others)]


def _read(spark: SparkSession, transport: Transport, brands: Sequence[tuple[str, str]], known: DataFrame | Iterable[str] | None, **paging) -> DataFrame:
    """New ingest rows of the brands. Known links are left out by a join; where they are few, paging also ends early by them."""
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame([(x,) for x in known or ()], "link string")
    known = known.select("link").where("link is not null").distinct()
    few = known.limit(KNOWN + 1).collect()
    spark.dataSource.register(search_source(transport, brands, frozenset(r.link for r in few) if len(few) <= KNOWN else frozenset(), **paging))
    return spark.read.format("newsloom_search").load().join(known, "link", "left_anti").select(*INGEST_COLUMNS)


def collect(
    spark: SparkSession, transport: Transport, known: DataFrame | Iterable[str] | None = None, our: Sequence[str] | None = None, others: Sequence[str] | None = None, **paging,
) -> DataFrame:
    """New ingest rows of all brands with their query and group, read by executors, a task for each brand.

    A refusal or overload of any brand fails the whole; ``collect_into`` saves each brand for itself.
    """
    return _read(spark, transport, brands_of(our, others), known, **paging)


def _reason(error: Exception) -> str:
    """The innermost error's own line: an executor's error carries its whole trace."""
    own = [x for x in str(error).splitlines() if re.match(r"[\w.]+(?:Error|Exception|Refused): ", x) and not x.startswith("org.apache.spark")]
    return (own[-1] if own else f"{type(error).__name__}: {error}")[:500]


def collect_into(
    table: Table, transport: Transport, our: Sequence[str] | None = None, others: Sequence[str] | None = None, at_once: int = 3, **paging,
) -> tuple[dict[str, dict[str, int]], dict[str, str]]:
    """(counts of each brand that was saved, error of each that failed): a brand's rows are upserted when its pages end.

    ``at_once`` brands are read at a time. Each one's rows are written once before they are saved, so its pages are asked
    for once; a brand that fails leaves the others as they are. A link that two brands find is saved by the first to end.
    """
    spark, counts, errors = table.spark, {}, {}
    schema = ", ".join(["row_pos bigint", *[f"`{c}` string" for c in INGEST_COLUMNS]])
    reading = Lock()

    def one(brand: tuple[str, str]) -> None:
        try:
            with reading:  # the name of the source is one for the session; reading is lazy
                rows = _read(spark, transport, [brand], known_keys(table.read(schema)), **paging)
            rows = materialise(rows.withColumn("row_pos", F.monotonically_increasing_id()), "collected")
            counts[brand[0]] = table.upsert(rows)
        except Exception as error:  # whatever the service or the store answers: the other brands go on
            errors[brand[0]] = _reason(error)

    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(one, brands_of(our, others)))
    return counts, errors

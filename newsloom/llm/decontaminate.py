"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The alignment score alone decides. A score of t or more over an item of L words takes m >= t + x matched words
with x mismatches and gaps between them, so the matches lie in at most x + 1 runs, and x <= L - t. The runs hold
at least m - x - 1 >= t - 1 of the item's bigrams, whatever was put in, and m - 2 * (x + 1) >= 2 * t - L - 2 of its
trigrams. Where c of an item's N n-grams are sure, any N - c + 1 of them hold one. Seeds are therefore the N - c + 1
n-grams of each item that are rarest in the corpus (counted over all documents), bigrams or trigrams, whichever
are rarer together: no passage with that score escapes, and common phrases rarely seed. Around a seed hit, the
passage must hold t - 1 of the item's bigrams; it is then aligned with the item word by word. The corpus is never
shuffled; seeds and items go out in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, tune
from .substring_dedup import mix, word_hashes, words_of

#: Share of an item's words that may be edited; words of items in a block.
EDITS = 0.2
BLOCK_WORDS = 2_000_000

_Q = np.uint64(0x9E3779B97F4A7C15)
_SPLIT = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words; ASCII characters other than letters and digits part words."""
    data = np.frombuffer((text or "").lower().encode().translate(_SPLIT), np.uint8)
    return word_hashes(data, *words_of(data))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words."""
    if len(h) < n:
        return h[:0]
    out = h[: len(h) - n + 1] + np.uint64(n)
    for j in range(1, n):
        out = out * _Q + h[j : len(h) - n + 1 + j]
    return mix(out)


def sure(length: int, least: int, n: int) -> int:
    """n-grams of an item that every alignment with a score of ``least`` keeps."""
    return (least, least - 1, 2 * least - length - 2)[n - 1]


class Items:
    """Benchmark items of a block: words, least score, n-gram lengths that can seed."""

    def __init__(self, rows: list[tuple], edits: float):
        self.ids, self.words, self.least, self.fit = [], [], [], []
        for k, text in rows:
            h = words(text)
            if not len(h):
                continue
            least = max(1, math.ceil((1 - 2 * edits) * len(h) - 1e-9))
            self.ids.append(k)
            self.words.append(h)
            self.least.append(least)
            self.fit.append([n for n in (3, 2) if sure(len(h), least, n) >= 1] or [1])
        self.lengths = sorted({n for fit in self.fit for n in fit})

    def all_grams(self) -> np.ndarray:
        own = [grams(h, n) for h, fit in zip(self.words, self.fit, strict=True) for n in fit]
        return np.unique(np.concatenate(own or [np.zeros(0, np.uint64)]))

    def seeds(self, counts: dict[int, int]) -> dict[int, dict[int, list[tuple[int, int]]]]:
        """n -> seed -> (item, place in it): the rarest places of every item, by the n whose places are rarest."""
        out = {n: defaultdict(list) for n in self.lengths}
        for i, (h, least, fit) in enumerate(zip(self.words, self.least, self.fit, strict=True)):
            choices = []
            for n in fit:
                own = grams(h, n).tolist()
                order = sorted((counts.get(v, 0), v, p) for p, v in enumerate(own))[: len(own) - sure(len(h), least, n) + 1]
                choices.append((sum(c for c, _, _ in order), -n, order))
            _, n, order = min(choices)
            for _, v, p in order:
                out[-n][v].append((i, p))
        return {n: dict(x) for n, x in out.items() if x}


class Lookup:
    """Membership of many hashes in a sorted table, behind a bitmap of 2^20 places."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(table >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, h: np.ndarray) -> np.ndarray:
        """Places of h that are in the table."""
        at = np.flatnonzero(self.bits[(h >> np.uint64(44)).astype(np.int64)])
        if not len(at) or not len(self.table):
            return at[:0]
        place = np.minimum(np.searchsorted(self.table, h[at]), len(self.table) - 1)
        return at[self.table[place] == h[at]]


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local score (match 1, mismatch and gap -1), and the passage's begin and end there."""
    m = len(item)
    step = np.arange(m + 1)
    above, start_above = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    best = (0, 0, 0)
    for i, w in enumerate(passage.tolist()):
        same = np.where(item == np.uint64(w), 1, -1)
        row, start = np.zeros(m + 1, np.int64), np.full(m + 1, i + 1)
        diagonal, down = above[:-1] + same, above[1:] - 1
        origin = np.where(above[:-1] > 0, start_above[:-1], i)
        row[1:] = np.maximum(diagonal, down)
        start[1:] = np.where(diagonal >= down, origin, start_above[1:])
        np.maximum(row, 0, out=row)
        lifted = row + step
        peak = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == peak, step, 0))
        row, start = peak - step, start[source]
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), int(start[j]), i + 1)
        above, start_above = row, start
    return best


def find_items(h: np.ndarray, items: Items, seeds: dict, looks: dict[int, Lookup], own: list[np.ndarray]):
    """(item number, score, begin, end) of each item that the text holds; the best place of each."""
    regions: dict[int, set[tuple[int, int]]] = defaultdict(set)
    for n, look in looks.items():
        g = grams(h, n)
        at = look.hits(g)
        for p, v in zip(at.tolist(), g[at].tolist(), strict=True):
            for i, q in seeds[n][v]:
                length = len(items.words[i])
                e = length - items.least[i]
                regions[i].add((max(0, p - q - e), min(len(h), p - q + length + e)))
    pairs = {n: grams(h, n) for n in (1, 2)} if regions else {}
    out = []
    for i, spans in regions.items():
        item, least = items.words[i], items.least[i]
        spans = sorted(spans)
        merged = [list(spans[0])]
        for a, b in spans[1:]:
            if a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        n, best = min(2, least), None
        for a, b in merged:
            if b - a < least or int(np.isin(pairs[n][a : b - n + 1], own[i]).sum()) < least - n + 1:
                continue
            score, x, y = smith_waterman(item, h[a:b])
            if score >= least and (best is None or score > best[1]):
                best = (i, score, a + x, a + y)
        if best:
            out.append(best)
    return out


def _counter(table, lengths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(table.value)
        total = np.zeros(len(look.table), np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                h = words(text)
                for n in lengths:
                    g = grams(h, n)
                    np.add.at(total, np.searchsorted(look.table, np.unique(g[look.hits(g)])), 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(look.table[some].view(np.int64)), pa.array(total[some])], names=["gram", "n"])

    return run


def _matcher(shared, item_kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, seeds = shared.value
        looks = {n: Lookup(np.sort(np.array(list(x), np.uint64))) for n, x in seeds.items()}
        own = [np.unique(grams(h, min(2, least))) for h, least in zip(items.words, items.least, strict=True)]
        for b in batches:
            rows, found = [], []
            for r, text in enumerate(b.column(2).to_pylist()):
                for x in find_items(words(text), items, seeds, looks, own):
                    rows.append(r)
                    found.append(x)
            if not rows:
                continue
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(at), b.column(1).take(at), pa.array([items.ids[x[0]] for x in found], item_kind),
                    pa.array([x[1] / len(items.words[x[0]]) for x in found], pa.float64()),
                    pa.array([x[2] for x in found], pa.int64()), pa.array([x[3] for x in found], pa.int64()),
                ],
                names=["doc_id", "text_key", "item_id", "score", "begin_word", "end_word"],
            )

    return run


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", edits: float = EDITS,
) -> DataFrame:
    """(doc_id, item_id, score, begin_word, end_word, text_key) of each document that holds a benchmark item.

    score: Smith-Waterman score of the best alignment over the item's words; every passage that reaches 1 - 2 * edits
    is reported, as every copy with at most ``edits`` of its words changed, dropped or put in does. Words are
    lower-cased runs of letters, digits and non-ASCII characters; whole texts are searched.

    Null or empty texts and items without words hold nothing. The score alone decides for items of any length: one of three
    words is found where two of them stand in a row, so an item of few common words is found in many texts.
    Items with one text are reported each; repeated documents are reported each; ids may be null. Tables without
    rows give no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    tune(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    item_type = benchmark.schema[item_id_col].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = f"doc_id {kind}, text_key bigint, item_id {item_type.simpleString()}, score double, begin_word bigint, end_word bigint"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    bench = benchmark.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"))
    size = bench.agg(F.sum(F.size(F.split("text", r"[^\p{L}\p{N}]+")))).first()[0] or 0
    blocks = -(-size // BLOCK_WORDS)
    out = None
    for k in range(blocks):
        own = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else bench
        items = Items([tuple(r) for r in own.collect()], edits)
        table = items.all_grams()
        if not len(table):
            continue
        sent = spark.sparkContext.broadcast(table)
        counts = rows.select("text").mapInArrow(_counter(sent, items.lengths), "gram bigint, n bigint")
        counts = counts.groupBy("gram").agg(F.sum("n").alias("n"))
        seen = {r[0] & (2**64 - 1): r[1] for r in counts.collect()}  # at most the block's own n-grams
        shared = spark.sparkContext.broadcast((items, items.seeds(seen)))
        found = materialise(rows.mapInArrow(_matcher(shared, to_arrow_type(item_type)), schema), f"leaks{k}")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], schema)
    return out.select("doc_id", "item_id", "score", "begin_word", "end_word", "text_key")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no benchmark item.

    Null and empty texts hold none and stay; repeated rows share their fate; rows with a null id are judged by their
    text. Without items every row stays; an empty table gives an empty result.
    """
    found = find_leaks(docs, benchmark, id_col, text_col, **options)
    gone = found.select(F.col("doc_id").alias("_gone"), F.col("text_key").alias("_key")).distinct()
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_gone"]) & (F.xxhash64(docs[text_col]) == gone["_key"]), "left_anti")

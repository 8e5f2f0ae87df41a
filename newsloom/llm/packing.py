"""Best-fit packing of tokenised documents into sequences, after Martello-Toth dominance reduction.

Only the histogram of piece lengths (at most ``capacity`` numbers, whatever the input) reaches the driver.
There the reduction fixes small sets that provably dominate every other set with the same longest piece:

* a piece that fills a sequence, or that no other piece fits beside, stands alone;
* two pieces that fill a sequence exactly stand together (what else could stand beside the first sums to
  no more than the second, and can be swapped for it);
* where no two pieces fit beside a piece, the longest one that fits does.

Each fixed set shrinks the instance; the rest is packed best-fit decreasing, with equal sequences held as
one group. The plan is a table of rank ranges by length. Ranks come from per-task counts and their prefix
sums, so no length, however common, gathers in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, tune
from .tokens import BLANK, NUMBER, UNKNOWN, SegmentCache, _loaded, joined_encoder, kinds, load_tokenizer, segments_of

CAPACITY = 2048
#: Segments whose ids are gathered at once.
GATHERED = 1 << 20


class Plan:
    """Placements (length, first rank, items, first sequence, items a sequence, first offset) by length."""

    def __init__(self, capacity: int):
        self.capacity, self.rows, self.sequences, self.used = capacity, [], 0, {}

    def place(self, length: int, items: int, sequence: int, each: int, offset: int) -> None:
        self.rows.append((length, self.used.get(length, 0), items, sequence, each, offset))
        self.used[length] = self.used.get(length, 0) + items

    def open(self, sequences: int) -> int:
        self.sequences += sequences
        return self.sequences - sequences


def reduce_dominated(counts: dict[int, int], plan: Plan) -> dict[int, int]:
    """Fix the dominating sets, longest piece first; what is left of the counts."""
    left = {k: c for k, c in counts.items() if c}
    sizes = sorted(left)

    def take(length: int, n: int) -> None:
        left[length] -= n
        if not left[length]:
            del left[length]
            sizes.pop(bisect_left(sizes, length))

    def pair(a: int, b: int, n: int) -> None:
        at = plan.open(n)
        plan.place(a, n, at, 1, 0)
        plan.place(b, n, at, 1, a)
        take(a, n)
        take(b, n)

    for length in sorted(left, reverse=True):
        while left.get(length):
            n, room = left[length], plan.capacity - length
            if sizes[0] > room or room == length == sizes[0] and n == 1:
                plan.place(length, n, plan.open(n), 1, 0)
                take(length, n)
            elif room in left and (room != length or n > 1):
                if room == length:
                    at = plan.open(n // 2)
                    plan.place(length, n // 2 * 2, at, 2, 0)
                    take(length, n // 2 * 2)
                else:
                    pair(length, room, min(n, left[room]))
            else:
                # the two shortest other pieces: do they fit together beside it?
                two, need = 0, 2
                for s in sizes[:2]:
                    free = left[s] - (s == length)
                    got = min(need, max(0, free))
                    two, need = two + got * s, need - got
                    if not need:
                        break
                i = bisect_left(sizes, room + 1) - 1
                best = sizes[i]
                if need == 0 and two <= room or best >= length:
                    break
                # while this holds for all n: the shortest stay the shortest or get longer
                pair(length, best, min(n, left[best]))
    return left


def best_fit(counts: dict[int, int], plan: Plan) -> None:
    """Best-fit decreasing over a histogram; sequences of one residue and history are one group."""
    groups: list[tuple[int, int, int]] = []  # residue, first sequence, sequences: sorted
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            i = bisect_left(groups, (length, -1, -1))
            if i == len(groups):
                each = plan.capacity // length
                whole, part = divmod(n, each)
                if whole:
                    at = plan.open(whole)
                    plan.place(length, whole * each, at, each, 0)
                    insort(groups, (plan.capacity - each * length, at, whole))
                if part:
                    at = plan.open(1)
                    plan.place(length, part, at, part, 0)
                    insort(groups, (plan.capacity - part * length, at, 1))
                break
            room, at, sequences = groups.pop(i)
            each = room // length
            whole = min(sequences, n // each)
            if whole:
                plan.place(length, whole * each, at, each, plan.capacity - room)
                insort(groups, (room - each * length, at, whole))
                n -= whole * each
                at, sequences = at + whole, sequences - whole
            if n and sequences:  # fewer than ``each`` are left for one more of them
                plan.place(length, n, at, n, plan.capacity - room)
                insort(groups, (room - n * length, at, 1))
                at, sequences, n = at + 1, sequences - 1, 0
            if sequences:
                insort(groups, (room, at, sequences))


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    plan = Plan(capacity)
    best_fit(reduce_dominated(counts, plan), plan)
    return plan


def lower_bound(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """Martello-Toth L2: no packing needs fewer sequences."""
    best = -(-sum(k * c for k, c in counts.items()) // capacity)
    for a in sorted(k for k in counts if 2 * k <= capacity) or [1]:
        large = sum(c for k, c in counts.items() if k > capacity - a)
        middle = [(k, c) for k, c in counts.items() if capacity // 2 < k <= capacity - a]
        small = sum(k * c for k, c in counts.items() if a <= k <= capacity // 2)
        free = sum((capacity - k) * c for k, c in middle)
        best = max(best, large + sum(c for _, c in middle) + max(0, -(-(small - free) // capacity)))
    return best


def _keys(segments: pa.Array) -> list[str]:
    """What segments are looked up by: without white space at the ends, in lower case where the ids are the same then.

    The normaliser lowers case too, but composes first, and some letters compose with a mark in lower case only, so
    only plain ASCII is lowered here. Special strings, which are matched as they stand, all hold "<|".
    """
    bare = pc.ascii_trim_whitespace(segments)
    plain = pc.and_(pc.string_is_ascii(bare), pc.invert(pc.match_substring(bare, "<|")))
    return pc.if_else(plain, pc.ascii_lower(bare), bare).to_numpy(zero_copy_only=False).tolist()


#: Characters that normalising and lower-casing keep as they are in kind and number: ASCII without controls,
#: apostrophe and "<"; Latin letters but U+0130; basic Cyrillic; CJK; Hangul syllables.
_PLAIN = np.zeros(0x110000, bool)
for _a, _b in ((0x20, 0x7F), (0xC0, 0x180), (0x410, 0x450), (0x4E00, 0x9FA6), (0xAC00, 0xD7A4)):
    _PLAIN[_a:_b] = True
_PLAIN[[0x27, 0x3C, 0xD7, 0xF7, 0x130]] = False


def pieces_of(segments: list[str]) -> np.ndarray:
    """Pieces of each segment under the pre-tokenizer's pattern: runs of letters, single numbers, runs of other signs.

    0 where that isn't proven: in segments of other than plain characters or with white space.
    """
    size = np.fromiter(map(len, segments), np.int64, len(segments))
    out, some = np.zeros(len(size), np.int64), np.flatnonzero(size)
    if not len(some):
        return out
    c = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), "<u4")
    at, k = (np.cumsum(size) - size)[some], kinds(c)
    turn = k == NUMBER
    turn[at] = True
    turn[1:] |= k[1:] != k[:-1]
    good = np.logical_and.reduceat(_PLAIN[c] & (k > BLANK) & (k != UNKNOWN), at)
    out[some] = np.where(good, np.add.reduceat(turn.astype(np.int64), at), 0)
    return out


def id_cache(tok) -> SegmentCache:
    """Ids of segments as bytes. Each piece of the pre-tokenizer ends in a token that says so."""
    last = np.zeros(tok.get_vocab_size(), bool)
    for t, i in tok.get_vocab().items():
        last[i] = t.endswith("</w>")
    encode = joined_encoder(tok, " ", pieces_of, lambda ids: np.flatnonzero(last[ids]) + 1)
    return SegmentCache(lambda xs: [x.tobytes() for x in encode(xs)])


def token_ids(texts: pa.Array, cache: SegmentCache, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, each followed by ``end_id``; where each text begins, and the number of ids at the end)."""
    own, first = segments_of(texts)
    d = own.dictionary_encode()
    values = [*cache.values(_keys(d.dictionary)), np.array([end_id], "<u4").tobytes()]
    size = np.fromiter(map(len, values), np.int64, len(values)) >> 2
    flat, start = np.frombuffer(b"".join(values), "<u4"), np.cumsum(size) - size
    index = np.insert(d.indices.to_numpy(), first[1:], len(values) - 1)
    total = np.concatenate(([0], np.cumsum(size[index])))
    begin = total[first + np.arange(len(first))]
    out = np.empty(total[-1], "<u4")
    for i in range(0, len(index), GATHERED):
        k, a, b = index[i : i + GATHERED], total[i], total[min(i + GATHERED, len(index))]
        n = size[k]
        out[a:b] = flat[np.repeat(start[k] - (total[i : i + len(k)] - a), n) + np.arange(b - a)]
    return out, begin


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = f"ids {path}"
        if key not in _loaded:
            _loaded[key] = id_cache(load_tokenizer(path))
        cache, task, seen = _loaded[key], TaskContext.get().partitionId(), {}
        for b in batches:
            ids, begin = token_ids(b.column(1), cache, end_id)
            size = np.diff(begin)
            pieces = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, size[row] - start)
            raw, at = memoryview(ids).cast("B"), (begin[row] + start) * 4
            own = [raw[i : i + n] for i, n in zip(at.tolist(), (length * 4).tolist(), strict=True)]
            rank = []
            for n in length.tolist():
                rank.append(seen.get(n, 0))
                seen[n] = rank[-1] + 1
            cols = [b.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length)]
            cols += [pa.array([zlib.crc32(x) for x in own], pa.int64())]
            cols += [pa.array(np.full(len(row), task, np.int32)), pa.array(rank, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]
            if with_ids:
                cols, names = [*cols, pa.array([bytes(x) for x in own], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def _placed(plan, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, table = plan.value
        for b in batches:
            t = pa.Table.from_batches([b])
            length, rank = t["length"].to_numpy(), t["rank"].to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length).tolist():
                own = np.flatnonzero(length == k)
                rows = table[np.searchsorted(lengths, k) : np.searchsorted(lengths, k, "right")]
                r = rows[np.searchsorted(rows[:, 1], rank[own], "right") - 1]
                place = rank[own] - r[:, 1]
                sequence[own] = r[:, 3] + place // r[:, 4]
                offset[own] = r[:, 5] + place % r[:, 4] * k
            cols = [t[n].combine_chunks() for n in names] + [pa.array(sequence), pa.array(offset)]
            yield from pa.Table.from_arrays(cols, names=[*names, "sequence_id", "offset"]).to_batches()

    return run


def pack_documents(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False,
) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` tokens; one row for each piece.

    A document is the ids of its whole text (no special tokens) and then ``end_id``. Only documents longer
    than ``capacity`` are cut. Returns doc_id, piece (from 0), start (ids before it in its document),
    length, ids_crc32 (of little-endian unsigned 32-bit ids), sequence_id and offset there (gapless from
    0); ``with_ids`` adds the ids themselves as bytes, for ``assemble``.

    Null and empty texts are one piece, of ``end_id`` alone. Ids may be null or repeat; each row is packed.
    Ties of length are placed by task and row order. Empty table: empty result. Other columns don't matter.
    The tokenizer is one whose pre-tokenizer drops white space and never spans it (word_bpe_49k.json).
    """
    spark = docs.sparkSession
    tune(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    pieces = materialise(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
            _pieces(tokenizer, capacity, end_id, with_ids), f"{schema}, task int, rank bigint" + ", ids binary" * with_ids
        ),
        "pieces",
    )
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    per_task = materialise(per_task, "lengths")
    counts = {r[0]: r[1] for r in per_task.groupBy("length").agg(F.sum("n")).collect()}
    plan = plan_packing(counts, capacity)
    table = np.array(sorted(plan.rows), np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast((table[:, 0].copy(), table))
    ranked = pieces.join(per_task.drop("n"), ["length", "task"]).withColumn("rank", F.col("rank") + F.col("before"))
    out = schema + ", ids binary" * with_ids + ", sequence_id bigint, offset bigint"
    return ranked.select(*names, "rank").mapInArrow(_placed(shared, names), out)


def assemble(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids (bytes): the sequences of ``pack_documents(..., with_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").alias("n_tokens")).select(
        "sequence_id", "n_tokens", F.expr("aggregate(transform(p, x -> x.ids), cast('' as binary), (a, x) -> a || x)").alias("ids")
    )

"""Exact Jaccard self-join on word n-grams by rare-first prefix filtering.

All texts order their n-grams alike: by document frequency, rare ones first. Two texts at the threshold then share one of
the first n - ceil(t * n) + 1 of each, the prefix, so candidates come from prefix n-grams alone; nearly all of these are
unique and meet nobody. A candidate must pass the length filter, the positional filter (what can still be shared behind
the common n-gram) and the suffix filter (the sets' sizes in fixed ranges of hashes bound their difference from below);
what is left is verified once for each pair on full sets.

Frequencies. Tasks send 48-bit hashes in sorted frames to the range of hashes they fall in; there equal hashes are
counted, and of those that occur twice or more each text gets (frequency, hash) back. N-grams that occur often within
tasks are counted first, at most HEAVY_LIMIT of them; they rank last, by count, and never travel, so a passage that a
third of all texts share makes no long list. Any order that all texts share gives the same links, so a text's copies
may count once for each flush. A frame's numbers are spooled to a task-local file and sorted in slices.

Groups. Texts with one set are one class. The members of an n-gram's list meet its first and last member; confirmed pairs
make components. Then, of every list that still holds several components, the members outside the largest one meet all
members, in blocks whose sets are compared in one task. Every candidate pair is thus compared or already connected, and
neither candidates nor the pairs within a component are ever listed.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import byte_rows, component_ids, materialise, partitions_for, tune
from .near_dedup import linked, shingle_set

#: Bits of a hash that order n-grams and name candidates; full hashes verify.
BITS = 48
#: N-grams that a task works on at once, and most texts among them (a text's number has 16 bits).
FLUSH = 2_000_000
TEXTS = 60_000
#: Occurrences within a flush that make an n-gram a candidate for the heavy list; occurrences in all; its most entries (16 MB).
HEAVY_LOCAL = 16
HEAVY_LEAST = 4096
HEAVY_LIMIT = 1_000_000
#: Ranges of hashes whose counts the suffix filter compares.
RANGES = 32
#: Numbers that are sorted at once; members of a class that one task verifies; members of a list in a block.
SLICE = 2_000_000
MEMBERS = 4096
BLOCK = 512
#: Rows (about 40 bytes) that are broadcast; larger tables are joined by a shuffle.
FEW = 200_000
#: Bytes of a class's digest that stand for it in frames; classes whose n-grams are ranked together.
REF = 10
CELL = 4000
#: Bytes that an n-gram takes in a frame.
PACKED = 9
#: Frequencies are kept up to here; n-grams above it are in order of their hashes.
MOST_FREQUENT = (1 << 16) - 1


def grams_of(text: bytes | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted 64-bit hashes of the distinct n-grams, their sorted distinct 48-bit heads)."""
    full = shingle_set(text, size)
    short = full >> np.uint64(64 - BITS)
    return full, short[np.concatenate(([True], short[1:] != short[:-1]))] if len(short) else short


def prefix_length(n: int, percent: int) -> int:
    """So many n-grams of n, rarest first, that a text at the threshold shares one of them."""
    return n + (-percent * n // 100) + 1


def _survey(size: int):
    """(doc_id, key, n, class) of every row; and (gram, count) of what is common within a flush."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[bytes] = set()
        entries = 0

        def common() -> pa.RecordBatch:
            every = np.concatenate(held)
            cell = (every & np.uint64((1 << 22) - 1)).astype(np.int64)
            often = every[np.bincount(cell, minlength=1 << 22)[cell] >= HEAVY_LOCAL]
            gram, count = np.unique(often, return_counts=True)
            gram, count = gram[count >= HEAVY_LOCAL], count[count >= HEAVY_LOCAL]
            none = lambda kind: pa.nulls(len(gram), kind)
            return pa.RecordBatch.from_arrays(
                [none(id_type), none(pa.int64()), none(pa.int64()), none(pa.binary()), pa.array(gram.astype(np.int64)), pa.array(count.astype(np.int64))], names=names
            )

        names = ["doc_id", "key", "n", "class", "gram", "count"]
        id_type = None
        for b in batches:
            id_type = b.column(0).type
            n, own = [], []
            for text in byte_rows(b.column(2)):
                full, short = grams_of(text, size)
                n.append(len(full))
                own.append(xxhash.xxh3_128_digest(full.tobytes()) if len(full) else None)
                if len(full) and own[-1] not in seen:
                    seen.add(own[-1])
                    held.append(short)
                    entries += len(short)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(own, pa.binary()), pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.int64())], names=names
            )
            if entries >= FLUSH:
                yield common()
                held, seen, entries = [], set(), 0
        if held:
            yield common()

    return run


def _frames(size: int, percent: int, heavy, parts: int):
    """A record of each class of a flush (part null), and frames of the light n-grams for each range of hashes.

    A record has what the text's prefix needs besides frequencies: sizes, counts in RANGES, and the heavy n-grams that
    reach into the prefix, in order. A frame: numbers of classes and of n-grams, classes, then 16-bit planes: text, hash.
    """
    edges = np.array([-(-(j << BITS) // parts) for j in range(1, parts)], np.uint64) << np.uint64(16)
    ranges = np.arange(1, RANGES, dtype=np.uint64) << np.uint64(64 - 5)
    names = ["part", "frame", "class", "n", "extra", "light", "tail", "sketch"]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = heavy.value if heavy else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        held: list[np.ndarray] = []
        records: list[tuple] = []
        seen: set[bytes] = set()
        entries = 0

        def flush() -> pa.RecordBatch:
            packed = np.concatenate(held)
            packed.sort()
            cut = np.concatenate(([0], np.searchsorted(packed, edges), [len(packed)]))
            refs = np.frombuffer(b"".join(r[2][:REF] for r in records), np.uint8).reshape(-1, REF)
            out = list(records)
            for p in np.flatnonzero(np.diff(cut)).tolist():
                own = packed[cut[p] : cut[p + 1]]
                planes = own.view("<u2").reshape(-1, 4)
                text = planes[:, 0].astype(np.int64)
                used = np.flatnonzero(np.bincount(text, minlength=len(refs)))
                place = np.zeros(len(refs), np.uint16)
                place[used] = np.arange(len(used))
                frame = b"".join((
                    np.array([len(used), len(own)], "<u4").tobytes(), refs[used].tobytes(), place[text].tobytes(), np.ascontiguousarray(planes[:, :0:-1].T).tobytes(),
                ))
                out.append((p, frame, None, None, None, None, None, None))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        for b in batches:
            for text in byte_rows(b.column(0)):
                full, short = grams_of(text, size)
                if not len(full):
                    continue
                own = xxhash.xxh3_128_digest(full.tobytes())
                if own in seen:
                    continue
                seen.add(own)
                at = np.searchsorted(known, short)
                at[at == len(known)] = 0
                common = known[at] == short if len(known) else np.zeros(len(short), bool)
                light = short[~common]
                left = prefix_length(len(full), percent) - len(light)
                tail = short[common][np.argsort(rank[at[common]])][: max(0, left)]
                counts = np.diff(np.concatenate(([0], np.searchsorted(full, ranges), [len(full)])))
                held.append(light << np.uint64(16) | np.uint64(len(records)))
                records.append((None, None, own, len(full), len(full) - len(short), len(light), tail.tobytes(), counts.tolist()))
                entries += len(light)
                if entries >= FLUSH or len(records) >= TEXTS:
                    yield flush()
                    held, records, seen, entries = [], [], set(), 0
        if records:
            yield flush()

    return run


def _counted(cells: int):
    """Records with their cells; and (cell, keys): the n-grams of this partition's frames that occur twice or more, as
    frequency above hash, for the classes of each cell. Frames are spooled to files of the task, which go with it."""
    names = ["class", "n", "extra", "light", "tail", "sketch"]

    def cell_of(refs: np.ndarray) -> np.ndarray:
        return (np.ascontiguousarray(refs[:, :8]).view("<u8").ravel() % np.uint64(cells)).astype(np.int64)

    def of_cells(keys: np.ndarray, text: np.ndarray, refs: np.ndarray) -> tuple[list[int], list[bytes]]:
        """A frame for each cell: numbers of classes and keys, classes, keys of each, keys."""
        used, text = np.unique(text, return_inverse=True)
        own = np.asarray(refs[used])
        cell = cell_of(own)
        rank = np.empty(len(used), np.int64)
        by_cell = np.argsort(cell, kind="stable")
        rank[by_cell] = np.arange(len(used))
        order = np.argsort(rank[text], kind="stable")
        keys, count = keys[order], np.bincount(rank[text], minlength=len(used))
        own, cell, end = own[by_cell], cell[by_cell], np.concatenate(([0], np.cumsum(count)))
        head = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        frames = []
        for a, z in zip(head.tolist(), [*head[1:].tolist(), len(cell)], strict=True):
            frames.append(b"".join((np.array([z - a, end[z] - end[a]], "<u4").tobytes(), own[a:z].tobytes(), count[a:z].astype("<u4").tobytes(), keys[end[a] : end[z]].tobytes())))
        return cell[head].tolist(), frames

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryFile() as spool, tempfile.TemporaryFile() as heads:
            frames: list[tuple[int, int, int]] = []  # place of the first number, numbers, place of the first class
            places, texts, kinds = 0, 0, []
            for b in batches:
                kinds = kinds or [b.schema.field(n).type for n in names]
                own = b.filter(b.column("class").is_valid()).select(names)
                if own.num_rows:
                    refs = np.frombuffer(b"".join(x[:REF] for x in own.column(0).to_pylist()), np.uint8).reshape(-1, REF)
                    yield pa.RecordBatch.from_arrays([pa.array(cell_of(refs)), *own.columns, pa.nulls(own.num_rows, pa.binary())], names=["cell", *names, "keys"])
                for frame in b.column("frame").drop_null().to_pylist():
                    d, e = np.frombuffer(frame, "<u4", 2).tolist()
                    heads.write(frame[8 : 8 + REF * d])
                    planes = np.frombuffer(frame, "<u2", 4 * e, 8 + REF * d).reshape(4, e)
                    packed = np.empty((e, 4), "<u2")
                    packed[:, 0], packed[:, 1:] = planes[0], planes[:0:-1].T
                    spool.write(packed.tobytes())
                    frames.append((places, e, texts))
                    places, texts = places + e, texts + d
            if not places:
                return
            spool.flush()
            heads.flush()
            refs = np.memmap(heads, np.uint8, "r", shape=(texts, REF))
            numbers = np.memmap(spool, np.uint64, "r", shape=(places,))
            parts = [numbers[a : a + e] for a, e, _ in frames]
            slices = -(-places // SLICE)
            some = np.sort(np.concatenate([p[:: max(1, places // 100_000)] for p in parts]))
            bounds = np.unique(some[np.arange(1, slices) * len(some) // slices] >> np.uint64(16) << np.uint64(16))
            cuts = [np.concatenate(([0], np.searchsorted(p, bounds), [len(p)])) for p in parts]
            for s in range(len(bounds) + 1):
                mine = [(p[c[s] : c[s + 1]], t) for p, c, (_, _, t) in zip(parts, cuts, frames, strict=True) if c[s] < c[s + 1]]
                if not mine:
                    continue
                gram = np.concatenate([x >> np.uint64(16) for x, _ in mine])
                text = np.concatenate([(x & np.uint64(0xFFFF)).astype(np.int64) + t for x, t in mine])
                order = np.argsort(gram, kind="stable")
                gram, text = gram[order], text[order]
                head = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
                count = np.diff(np.append(head, len(gram)))
                count = np.repeat(count, count)
                again = count > 1
                if again.any():
                    keys = np.minimum(count[again], MOST_FREQUENT).astype(np.uint64) << np.uint64(BITS) | gram[again]
                    cell, out = of_cells(keys, text[again], refs)
                    none = [pa.nulls(len(cell), k) for k in kinds]
                    yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), *none, pa.array(out, pa.binary())], names=["cell", *names, "keys"])

    return run


def _prefixes(percent: int):
    """Of rows sorted by cell, records and frames of keys: (gram, class, n, extra, pos, sketch) of every prefix n-gram
    that another text may share. pos: its place among the text's n-grams, extra: n-grams without a 48-bit head of their own."""
    names = ["gram", "class", "n", "extra", "pos", "sketch"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]

    def entries(own: bytes, record: tuple, ranked: np.ndarray) -> list[tuple]:
        n, extra, light, tail, sketch = record
        most, first = prefix_length(n, percent), light - len(ranked)
        head = ranked[: max(0, most - first)] & np.uint64((1 << BITS) - 1)
        last = np.frombuffer(tail, np.uint64)
        grams = np.concatenate((head, last)).astype(np.int64).tolist()
        at = [*range(first, first + len(head)), *range(light, light + len(last))]
        return [(g, own, n, extra, p, sketch) for g, p in zip(grams, at, strict=True)]

    def of_cell(records: dict[bytes, tuple], frames: list[bytes]) -> list[tuple]:
        refs, counts, keys = [], [], []
        for f in frames:
            d, e = np.frombuffer(f, "<u4", 2).tolist()
            refs.append(np.frombuffer(f, f"V{REF}", d, 8))
            counts.append(np.frombuffer(f, "<u4", d, 8 + REF * d))
            keys.append(np.frombuffer(f, "<u8", e, 8 + (REF + 4) * d))
        place: dict[bytes, int] = {}
        ends = np.zeros(1, np.int64)
        every = np.zeros(0, np.uint64)
        if frames:
            known, which = np.unique(np.concatenate(refs), return_inverse=True)
            owner, every = np.repeat(which, np.concatenate(counts)), np.concatenate(keys)
            order = np.lexsort((every, owner))
            owner, every = owner[order], every[order]
            new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (every[1:] != every[:-1])))  # a class that several flushes sent
            owner, every = owner[new], every[new]
            ends = np.searchsorted(owner, np.arange(len(known) + 1))
            place = {x.tobytes(): i for i, x in enumerate(known)}
        out = []
        for own, record in records.items():
            i = place.get(own[:REF])
            out += entries(own, record, every[ends[i] : ends[i + 1]] if i is not None else every[:0])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, records, frames = None, {}, []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*of_cell(records, frames), strict=True)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        for b in batches:
            for cell, own, *rest, keys in zip(*(b.column(i).to_pylist() for i in range(8)), strict=True):
                if cell != now:
                    if records:
                        yield batch()
                    now, records, frames = cell, {}, []
                if own is None:
                    frames.append(keys)
                else:
                    records[own] = tuple(rest)
        yield batch()

    return run


def _heavy(spark, common: DataFrame):
    """The heavy n-grams, sorted, with their ranks by count, as a broadcast of at most HEAVY_LIMIT entries; None if there are none."""
    found = common.groupBy("gram").agg(F.sum("count").alias("count")).where(F.col("count") >= HEAVY_LEAST)
    found = found.orderBy(F.col("count").desc(), "gram").limit(HEAVY_LIMIT).toArrow()
    gram, count = found.column("gram").to_numpy().astype(np.uint64), found.column("count").to_numpy()
    if not len(gram):
        return None
    order = np.lexsort((gram, count))
    rank = np.empty(len(gram), np.int64)
    rank[order] = np.arange(len(gram))
    by_gram = np.argsort(gram)
    return spark.sparkContext.broadcast((gram[by_gram], rank[by_gram]))


def needed(x: F.Column, y: F.Column, percent: int) -> F.Column:
    """The least number of shared n-grams of texts at the threshold."""
    return F.ceil((x + y) * percent / (100 + percent) - 1e-9)


def _may_link(x: F.Column, y: F.Column, percent: int) -> F.Column:
    """Length, positional and suffix filter on two entries of one n-gram's list."""
    long = F.lit(100) * F.least(x["n"], y["n"]) >= F.lit(percent) * F.greatest(x["n"], y["n"])
    need = needed(x["n"], y["n"], percent)
    behind = lambda e: e["n"] - e["extra"] - e["pos"] - 1
    shared = F.least(x["pos"], y["pos"]) + 1 + F.least(behind(x), behind(y)) + F.least(x["extra"], y["extra"])
    apart = F.aggregate(F.zip_with(x["sketch"], y["sketch"], lambda a, b: F.abs(a - b)), F.lit(0), lambda s, d: s + d)
    return long & (shared >= need) & (apart <= x["n"] + y["n"] - 2 * need)


def _met(percent: int):
    """Of rows sorted by (leader, block, share, gram): the rows (leader, block, share, query, class, component) of queries and
    members that form a pair of different components that passes the filters, once each."""

    def solve(rows: list[tuple], found: set) -> None:
        ask, members = [r for r in rows if r[0]], [r for r in rows if not r[0]]
        if not ask or not members:
            return
        arrays = lambda part: [np.array([r[i] for r in part], np.int64) for i in (3, 4, 5)]
        (n, extra, pos), (m, extra_m, pos_m) = ([c[:, None] for c in arrays(ask)], arrays(members))
        number = {c: i for i, c in enumerate({r[2] for r in rows})}
        other = np.array([number[r[2]] for r in ask])[:, None] != np.array([number[r[2]] for r in members])
        need = -(-percent * (n + m) // (100 + percent))
        shared = np.minimum(pos, pos_m) + 1 + np.minimum(n - extra - pos - 1, m - extra_m - pos_m - 1) + np.minimum(extra, extra_m)
        a, b = np.nonzero(other & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (shared >= need))
        if not len(a):
            return
        x, y = np.array([r[6] for r in ask]), np.array([r[6] for r in members])
        for at in range(0, len(a), 100_000):
            i, j = a[at : at + 100_000], b[at : at + 100_000]
            near = np.abs(x[i] - y[j]).sum(1) <= (n[i, 0] + m[j] - 2 * need[i, j])
            found.update(ask[p][:3] for p in np.unique(i[near]).tolist())
            found.update(members[q][:3] for q in np.unique(j[near]).tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, gram, rows, found = None, None, [], set()

        def done() -> pa.RecordBatch:
            cols = list(zip(*((*group, *x) for x in sorted(found)), strict=True)) or [[]] * 6
            kinds = (pa.binary(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["leader", "block", "share", "query", "class", "component"])

        for b in batches:
            for leader, block, share, own, *rest in zip(*(b.column(i).to_pylist() for i in range(11)), strict=True):
                if (leader, block, share) != group or own != gram:
                    solve(rows, found)
                    rows = []
                    if (leader, block, share) != group and found:
                        yield done()
                        found = set()
                    group, gram = (leader, block, share), own
                rows.append(tuple(rest))
        solve(rows, found)
        if found:
            yield done()

    return run


def _joined(percent: int):
    """Of rows sorted by (leader, block, share), with full sets: links that join components, as few as that takes in a group."""

    def solve(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        up: dict[bytes, bytes] = {}

        def top(c: bytes) -> bytes:
            while c in up:
                c = up[c]
            return c

        sets = {r[1]: np.frombuffer(r[3], np.uint64) for r in rows}
        members = [r[1:3] for r in rows if not r[0]]
        sizes = np.array([len(sets[c]) for c, _ in members])
        out = []
        for c, component in (r[1:3] for r in rows if r[0]):
            own = sets[c]
            fits = 100 * np.minimum(sizes, len(own)) >= percent * np.maximum(sizes, len(own))
            for i in np.flatnonzero(fits).tolist():
                other, theirs = members[i]
                if top(theirs) != top(component) and linked(sets[other], own, percent):
                    out.append((c, other))
                    up[top(theirs)] = top(component)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def done() -> pa.RecordBatch:
            found = solve(rows)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())], names=["a", "b"])

        for b in batches:
            for leader, block, share, *rest in zip(*(b.column(i).to_pylist() for i in range(7)), strict=True):
                if (leader, block, share) != group and rows:
                    yield done()
                    rows = []
                group = (leader, block, share)
                rows.append(tuple(rest))
        if rows:
            yield done()

    return run


def _verified(percent: int):
    """Of rows sorted by (leader, salt) with the leader's own set first: the pairs that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = lead = None
        for batch in batches:
            a, b = [], []
            for leader, member, salt, s in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                own = np.frombuffer(s, np.uint64)
                if member is None:
                    now, lead = (leader, salt), own
                elif now != (leader, salt):
                    raise ValueError("a member came without its leader")
                elif linked(lead, own, percent):
                    a.append(member)
                    b.append(leader)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def _verify(pairs: DataFrame, sets: DataFrame, percent: int, parts: int) -> DataFrame:
    """The rows (a, b) of ``pairs`` that are linked. Sets travel once for a pair and once for a share of a leader's members."""
    sizes = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("members"))
    shares = materialise(sizes.select("b", F.ceil(F.col("members") / MEMBERS).cast("int").alias("shares")), "shares")
    dealt = pairs.join(shares, "b").select(F.col("b").alias("leader"), F.col("a").alias("member"), F.pmod(F.xxhash64("a"), F.col("shares")).cast("int").alias("salt"))
    members = dealt.join(sets, dealt["member"] == sets["class"]).select("leader", "member", "salt", "set")
    leaders = shares.join(sets, shares["b"] == sets["class"]).select(
        F.col("b").alias("leader"), F.lit(None).cast("binary").alias("member"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("salt"), "set"
    )
    rows = members.unionByName(leaders).repartition(parts, "leader", "salt").sortWithinPartitions("leader", "salt", F.col("member").asc_nulls_first())
    return rows.mapInArrow(_verified(percent), "a binary, b binary")


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t, size).tobytes() for t in byte_rows(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], names=["class", "set"])

    return run


def small(df: DataFrame) -> DataFrame:
    """``df``, a written table, to be broadcast where it has FEW rows at most, and to be shuffled beyond that."""
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df


def ngram_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """For every row: doc_id, n_shingles, component_id (the least doc_id reachable by links, itself included).

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text after lower-casing A-Z; a set is the distinct n-grams of ``shingle``
    words (fewer words: the whole sequence as one). Rows link when 100 * intersection >= percent * union; 0 < percent <= 100.
    Exact: no link is missed, up to collisions of 64-bit hashes within the sets that are verified.

    Null, empty and blank texts have no n-gram and are linked with nothing. Repeated rows are copies of each other. A null
    id is a component_id only where the component has no other. Other columns are not looked at. An empty table gives
    an empty result. Memory follows FLUSH, SLICE and BLOCK, the longest text, and a partition's frames' digests.
    """
    spark = docs.sparkSession
    tune(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    survey = base.mapInArrow(_survey(shingle), f"doc_id {kind}, key bigint, n bigint, class binary, gram bigint, count bigint")
    survey = materialise(survey, "survey")
    rows = survey.where(F.col("gram").isNull()).select("doc_id", "key", "n", "class")
    heavy = _heavy(spark, survey.where(F.col("gram").isNotNull()).select("gram", "count"))
    number, total = rows.agg(F.count("class"), F.sum("n")).first()
    parts = partitions_for(spark, PACKED * (total or 0))

    record = "class binary, n bigint, extra bigint, light bigint, tail binary, sketch array<int>"
    sent = base.select("text").mapInArrow(_frames(shingle, percent, heavy, parts), f"part int, frame binary, {record}")
    dealt = F.when(F.col("part").isNotNull(), F.col("part")).otherwise(F.pmod(F.xxhash64("class"), F.lit(parts)).cast("int"))
    # records pass through the same exchange, so that texts are cut into n-grams once
    cells = max(parts, -(-number // CELL))
    sent = sent.repartition(parts, dealt).mapInArrow(_counted(cells), f"cell bigint, {record}, keys binary")
    ranked = sent.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(_prefixes(percent), "gram bigint, class binary, n bigint, extra bigint, pos bigint, sketch array<int>")
    ranked = materialise(ranked, "prefixes")

    entry = F.struct("class", "n", "extra", "pos", "sketch")
    lists = ranked.groupBy("gram").agg(F.count(F.lit(1)).alias("size"), F.min(entry).alias("low"), F.max(entry).alias("high")).where("size > 1")
    lists = materialise(lists, "lists")
    shared = materialise(ranked.join(lists.select("gram", F.col("low.class").alias("leader")), "gram"), "shared")
    ends = shared.select("gram", entry.alias("own")).join(lists, "gram").select("own", F.explode(F.array("low", "high")).alias("end"))
    ends = ends.where((F.col("own.class") != F.col("end.class")) & _may_link(F.col("own"), F.col("end"), percent))
    first = materialise(ends.select(F.greatest("own.class", "end.class").alias("a"), F.least("own.class", "end.class").alias("b")).distinct(), "pairs")

    involved = shared.select("class").distinct()
    holders = rows.where(F.col("class").isNotNull()).join(small(materialise(involved, "involved")), "class", "left_semi")
    holders = materialise(holders.groupBy("class").agg(F.min(F.struct("doc_id", "key")).alias("at")).select("class", F.col("at.doc_id").alias("_id"), F.col("at.key").alias("_key")), "holders")
    at = small(holders)
    texts = base.join(at, base["doc_id"].eqNullSafe(at["_id"]) & (base["key"] == at["_key"])).select("class", "text")
    sets = materialise(texts.mapInArrow(_sets(shingle), "class binary, set binary"), "sets").dropDuplicates(["class"])
    links = materialise(_verify(first, sets, percent, parts), "links")
    components = materialise(connected_components(links, "a", "b"), "components")

    named = shared.join(components.select(F.col("node").alias("class"), "component"), "class", "left")
    named = materialise(named.select("gram", "leader", "class", F.coalesce("component", "class").alias("component"), "n", "extra", "pos", "sketch"), "named")
    more = _link_across(named, sets, percent, parts)
    star = components.select(F.col("node").alias("a"), F.col("component").alias("b"))
    out = component_ids(rows, connected_components(star.unionByName(more), "a", "b"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _link_across(named: DataFrame, sets: DataFrame, percent: int, parts: int) -> DataFrame:
    """Links (a, b) between components that share a list: members outside the list's largest component against all.

    Lists with one leader are looked at together, in blocks: first on their entries, which leaves the members that meet
    anyone; only these get their sets. Pairs stay within their task, so of a large group of candidates only links go out.
    """
    sizes = named.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("gram").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"))
    mixed = mixed.where("kinds > 1").select(
        "gram", F.col("top.component").alias("largest"), F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("all") - F.col("top.n")) / BLOCK).cast("int").alias("shares"),
    )
    rows = named.join(small(materialise(mixed, "mixed")), "gram")
    up_to = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    own = lambda seed, c: F.pmod(F.xxhash64(F.lit(seed), "class"), F.col(c)).cast("int")
    group = ["leader", "block", "share"]
    cols = [*group, "gram", "query", "class", "component", "n", "extra", "pos", "sketch"]
    members = rows.withColumns({"block": own(1, "blocks"), "share": F.explode(up_to("shares")), "query": F.lit(False)})
    ask = rows.where(F.col("component") != F.col("largest")).withColumns({"share": own(2, "shares"), "block": F.explode(up_to("blocks")), "query": F.lit(True)})
    both = members.select(*cols).unionByName(ask.select(*cols)).repartition(parts, *group)
    met = both.sortWithinPartitions(*group, "gram").mapInArrow(_met(percent), "leader binary, block int, share int, query boolean, class binary, component binary")
    whole = materialise(met, "met").join(sets, "class").select(*group, "query", "class", "component", "set")
    return whole.repartition(parts, *group).sortWithinPartitions(*group).mapInArrow(_joined(percent), "a binary, b binary")

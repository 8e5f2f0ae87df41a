"""Near-duplicate detection with HyperMinHash registers.

A text's set is its distinct word shingles, as 64-bit hashes. Each of REGISTERS buckets keeps the least hash that
falls into it as a leading-zero count and MANTISSA further bits; empty buckets borrow from others by a fixed
random order (optimal densification), so a register of two texts is equal with the probability of their Jaccard
similarity, tiny sets included. Bands of ROWS registers name candidates, the collision-corrected estimate drops
those far below the threshold, and every link is confirmed on full sets.

Groups. Texts with one set are one class from the start. A bucket of a band links each member to a leader, first
within a task's flush and then among the tasks' leaders, so a bucket of n classes gives n - 1 candidates and sends
one row a flush. Confirmed links make components. A region is what candidates connect, confirmed or not; where it
still holds several components, every class outside its largest one is compared with the whole region, in blocks.
So no link is lost that any bucket shows, and the pairs within a component are never listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import byte_rows, materialise, partitions_for, survivors, tune
from .substring_dedup import mix, word_hashes, words_of

ROWS = 6
BANDS = 40
REGISTERS = ROWS * BANDS
MANTISSA = 10
#: Leader orders: a band uses one of so many, so that a class meets several leaders.
ORDERS = 4
#: Band entries gathered before leaders are sent; members of one leader that a task compares; classes in a block.
FLUSH = 1_000_000
MEMBERS = 4096
BLOCK = 256
#: Mixed regions that are broadcast (about 10 MB); more are joined by salted keys.
FEW_REGIONS = 100_000
SALTS = 64
#: Sets smaller than this are confirmed without an estimate; standard errors that an estimate may fall short.
CERTAIN = 2 * REGISTERS
ERRORS = 5.0

_BORROW = np.random.default_rng(100).integers(0, REGISTERS, (512, REGISTERS)).astype(np.int64)
_EDGES = (np.arange(REGISTERS, dtype=np.uint64) << np.uint64(32)) // np.uint64(REGISTERS) << np.uint64(32)
_Q = np.uint64(0x9E3779B97F4A7C15)
_BAND = mix(np.arange(1, ROWS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_TURN = mix(np.arange(1, ORDERS + 1, dtype=np.uint64))


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of the text after lower-casing A-Z.

    A text of fewer words than ``size`` has its whole word sequence as one shingle; without words, none.
    """
    if not text:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(text.lower(), np.uint8)
    starts, ends = words_of(data)
    if not len(starts):
        return np.zeros(0, np.uint64)
    h = word_hashes(data, starts, ends)
    n = min(size, len(h))
    out = h[: len(h) - n + 1] + np.uint64(n)
    for j in range(1, n):
        out = out * _Q + h[j : len(h) - n + 1 + j]
    return np.unique(mix(out))


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (leading zeros << MANTISSA | mantissa, as 16 bits) of a sorted hash set."""
    at = np.searchsorted(hashes, _EDGES)
    filled = np.diff(np.append(at, len(hashes))) > 0
    low = mix(hashes ^ np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    least = np.minimum.reduceat(low, at[filled])
    exponent = np.frexp(least.astype(np.float64))[1]  # bits used; rounding up to a power is alike for equal hashes
    zeros = np.minimum(63, 64 - exponent)
    shift = np.maximum(0, exponent - 1 - MANTISSA).astype(np.uint64)
    bits = (least >> shift) & np.uint64((1 << MANTISSA) - 1)
    out = np.zeros(REGISTERS, np.uint16)
    out[filled] = (zeros.astype(np.uint64) << np.uint64(MANTISSA) | bits).astype(np.uint16)
    empty = np.flatnonzero(~filled)
    for turn in _BORROW:
        if not len(empty):
            return out
        source = turn[empty]
        good = filled[source]
        out[empty[good]] = out[source[good]]
        empty = empty[~good]
    if len(empty):  # the next filled bucket to the right
        own = np.flatnonzero(filled)
        out[empty] = out[own[np.searchsorted(own, empty) % len(own)]]
    return out


def band_hashes(regs: np.ndarray) -> np.ndarray:
    """One hash for each band of each row of registers; band j is part of its hash."""
    parts = regs.reshape(-1, BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    return mix((parts * _BAND).sum(2) + np.arange(BANDS, dtype=np.uint64)[None] * _Q)


def collision(a: int, b: int) -> float:
    """Chance that registers of different least hashes are equal, for sets of a and b hashes."""
    level = 2.0 ** -np.arange(0, 64)
    mass = [np.exp(-n / REGISTERS * level / 2) - np.exp(-n / REGISTERS * level) for n in (a, b)]
    return float((mass[0] * mass[1]).sum() / (1 << MANTISSA))


def estimate(x: np.ndarray, y: np.ndarray, a: int, b: int) -> float:
    """Jaccard similarity from two register rows, corrected for chance collisions."""
    c = collision(a, b)
    return float(((x == y).mean() - c) / (1 - c))


def _signatures(size: int):
    """(doc_id, key, n, class, registers); class: 128-bit digest of the set, null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, own, regs = [], [], []
            for text in byte_rows(b.column(2)):
                s = shingle_set(text, size)
                n.append(len(s))
                own.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(own, pa.binary()), pa.array(regs, pa.binary())],
                names=["doc_id", "key", "n", "class", "regs"],
            )

    return run


def _stars(keys: np.ndarray, classes: np.ndarray, turn: np.ndarray):
    """Of entries (bucket key, class as two numbers, leader order): leaders' rows, and (member, leader) rows."""
    rank = mix(classes[:, 0] ^ _TURN[turn])
    order = np.lexsort((classes[:, 1], classes[:, 0], rank, keys))
    k, c = keys[order], classes[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    other = (c != c[head]).any(1)
    pairs = np.concatenate((c[other], c[head[other]]), 1)
    return order[new], np.unique(pairs, axis=0) if len(pairs) else pairs.reshape(0, 4)


def _local_stars(parts: int):
    """Frames of (key, leader, order) for each partition, and frames of candidate pairs (partition -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            classes = np.frombuffer(b"".join(ids), np.uint64).reshape(-1, 2)
            keys = band_hashes(np.frombuffer(b"".join(regs), np.uint16).reshape(-1, REGISTERS))
            who = np.repeat(np.arange(len(classes)), BANDS)
            turn = np.tile(np.arange(BANDS) % ORDERS, len(classes))
            lead, pairs = _stars(keys.ravel(), classes[who], turn)
            k, c, t = keys.ravel()[lead], classes[who[lead]], turn[lead]
            to = (k % np.uint64(parts)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cut = np.searchsorted(to[order], np.arange(parts + 1))
            rows = np.concatenate((k[:, None], c, t[:, None].astype(np.uint64)), 1)[order]
            where = [-1] if len(pairs) else []
            frames = [pairs.tobytes()] if len(pairs) else []
            for p in range(parts):
                if cut[p] < cut[p + 1]:
                    where.append(p)
                    frames.append(rows[cut[p] : cut[p + 1]].tobytes())
            return pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array(frames, pa.binary())], names=["part", "frame"])

        ids: list[bytes] = []
        regs: list[bytes] = []
        seen: set[bytes] = set()
        for b in batches:
            for c, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if c is not None and c not in seen:
                    seen.add(c)
                    ids.append(c)
                    regs.append(r)
            if len(ids) * BANDS >= FLUSH:
                yield flush()
                ids, regs, seen = [], [], set()
        if ids:
            yield flush()

    return run


def _pairs(pairs: np.ndarray) -> pa.RecordBatch:
    raw = np.ascontiguousarray(pairs).tobytes()
    a = [raw[i : i + 16] for i in range(0, len(raw), 32)]
    b = [raw[i + 16 : i + 32] for i in range(0, len(raw), 32)]
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _joined_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of one partition's buckets, from the leaders that the tasks sent."""
    frames = []
    for b in batches:
        for p, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if p < 0:
                yield _pairs(np.frombuffer(f, np.uint64).reshape(-1, 4))
            else:
                frames.append(f)
    if frames:
        rows = np.frombuffer(b"".join(frames), np.uint64).reshape(-1, 4)
        _, pairs = _stars(rows[:, 0], rows[:, 1:3], rows[:, 3].astype(np.int64))
        if len(pairs):
            yield _pairs(pairs)


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [shingle_set(t, size) for t in byte_rows(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([s.tobytes() for s in own], pa.binary()),
                    pa.array([registers(s).tobytes() if len(s) else b"" for s in own], pa.binary()),
                ],
                names=["class", "set", "regs"],
            )

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted full sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    common = int((a[at] == b).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _confirm(percent: int):
    """Of rows sorted by (leader, salt) with the leader's own row first: the confirmed pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = lead = regs = None
        floor = _floor(percent)
        for batch in batches:
            a, b = [], []
            cols = [batch.column(i).to_pylist() for i in range(5)]
            for leader, member, salt, s, r in zip(*cols, strict=True):
                if member is None:
                    now, lead, regs = (leader, salt), np.frombuffer(s, np.uint64), np.frombuffer(r, np.uint16)
                    continue
                if now != (leader, salt):
                    raise ValueError("a member came without its leader")
                own = np.frombuffer(s, np.uint64)
                if min(len(own), len(lead)) >= CERTAIN and estimate(regs, np.frombuffer(r, np.uint16), len(lead), len(own)) < floor:
                    continue
                if linked(lead, own, percent):
                    a.append(member)
                    b.append(leader)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def confirm_pairs(pairs: DataFrame, sets: DataFrame, percent: int, parts: int) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose full sets are similar enough.

    Sets travel once for a pair (the member's) and once for a share of at most about MEMBERS members of a leader.
    """
    sizes = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("members"))
    shares = sizes.select("b", F.ceil(F.col("members") / MEMBERS).cast("int").alias("shares"))
    dealt = pairs.join(shares, "b").select(
        F.col("b").alias("leader"), F.col("a").alias("member"), F.pmod(F.xxhash64("a"), F.col("shares")).cast("int").alias("salt")
    )
    members = dealt.join(sets, dealt["member"] == sets["class"]).select("leader", "member", "salt", "set", "regs")
    leaders = shares.join(sets, shares["b"] == sets["class"]).select(
        F.col("b").alias("leader"), F.lit(None).cast("binary").alias("member"),
        F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("salt"), "set", "regs",
    )
    return (
        members.unionByName(leaders)
        .repartition(parts, "leader", "salt")
        .sortWithinPartitions("leader", "salt", F.col("member").asc_nulls_first())
        .mapInArrow(_confirm(percent), "a binary, b binary")
    )


def _floor(percent: int) -> float:
    j = percent / 100
    return j - ERRORS * np.sqrt(j * (1 - j) / REGISTERS)


def _across(percent: int):
    """Of rows sorted by (region, block, queries' block): components of a query and of a member that are linked, where they differ."""

    def solve(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        queries, members = [r for r in rows if r[0]], [r for r in rows if not r[0]]
        if not queries or not members:
            return []
        sets = [np.frombuffer(r[3], np.uint64) for r in members]
        sizes = np.array([len(s) for s in sets])
        regs = np.stack([np.frombuffer(r[4], np.uint16) for r in members])
        parts = np.array([r[2] for r in members], object)
        out = set()
        for _, _, component, s, r in queries:
            own = np.frombuffer(s, np.uint64)
            alike = (regs == np.frombuffer(r, np.uint16)).mean(1)
            small = np.minimum(sizes, len(own)) < CERTAIN
            fits = 100 * np.minimum(sizes, len(own)) >= percent * np.maximum(sizes, len(own))
            for i in np.flatnonzero(fits & (small | (alike >= _floor(percent))) & (parts != component)).tolist():
                if (component, parts[i]) not in out and linked(sets[i], own, percent):
                    out.add((component, parts[i]))
        return sorted(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def done():
            found = solve(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())], names=["a", "b"]
            )

        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(8)]
            for region, block, share, *rest in zip(*cols, strict=True):
                if (region, block, share) != now and rows:
                    yield done()
                    rows = []
                now = (region, block, share)
                rows.append(tuple(rest))
        if rows:
            yield done()

    return run


def in_mixed(rows: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows (class, region, ...) of ``mixed`` regions. No region, however large, gathers in one task."""
    mixed = materialise(mixed, "mixed")
    if mixed.limit(FEW_REGIONS + 1).count() <= FEW_REGIONS:
        return rows.join(F.broadcast(mixed), "region")
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("class"), F.lit(SALTS)).cast("int"))
    return dealt.join(mixed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["region", "salt"]).drop("salt")


def component_pairs(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """(a, b): the components of the classes of ``pairs``, where they differ. A class without a component is its own."""
    for end in ("a", "b"):
        own = components.select(F.col("node").alias(end), "component")
        pairs = pairs.join(own, end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    return pairs.where("a != b")


def link_across(pairs: DataFrame, components: DataFrame, sets: DataFrame, percent: int, parts: int) -> DataFrame:
    """Links (a, b) between components that share a region of candidate ``pairs``.

    Links are candidates, so a component lies in one region, and regions are found among components: only candidates that
    cross from one to another go through the rounds. Every class outside a region's largest component meets all the
    region's classes, in blocks of about BLOCK.
    """
    regions = connected_components(component_pairs(pairs, components), "a", "b").select(
        F.col("node").alias("component"), F.col("component").alias("region")
    )
    roots = components.where("node = component").select("component")
    alone = regions.join(roots, "component", "left_anti").withColumn("class", F.col("component"))
    t = components.withColumnRenamed("node", "class").join(regions, "component").unionByName(alone)
    t = materialise(t.select("class", "region", "component"), "regions")
    sizes = t.groupBy("region", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("region").agg(
        F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all")
    )
    mixed = mixed.select(
        "region", F.col("top.component").alias("largest"), F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("all") - F.col("top.n")) / BLOCK).cast("int").alias("shares"),
    )
    rows = in_mixed(t, mixed).join(sets, "class")
    up_to = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    own = lambda seed, c: F.pmod(F.xxhash64(F.lit(seed), "class"), F.col(c)).cast("int")
    cols = ["region", "block", "share", "query", "class", "component", "set", "regs"]
    members = rows.withColumns({"block": own(1, "blocks"), "share": F.explode(up_to("shares")), "query": F.lit(False)})
    queries = rows.where(F.col("component") != F.col("largest")).withColumns(
        {"share": own(2, "shares"), "block": F.explode(up_to("blocks")), "query": F.lit(True)}
    )
    return (
        members.select(*cols)
        .unionByName(queries.select(*cols))
        .repartition(parts, "region", "block", "share")
        .sortWithinPartitions("region", "block", "share")
        .mapInArrow(_across(percent), "a binary, b binary")
    )


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """For every row: doc_id, n_shingles, component_id, kept, text_key (a hash of the text, to find the row again).

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text after lower-casing A-Z; a set is the distinct shingles of
    ``shingle`` words (fewer words: the whole sequence as one). Rows are linked when 100 * intersection >= percent *
    union on full sets; component_id is the least doc_id reachable, itself included; kept: doc_id = component_id.

    Null, empty and blank texts have no shingle and are linked with nothing. Repeated rows are copies of each other.
    Null ids never become a component_id unless the component has no other; other columns are not looked at. An
    empty table gives an empty result. Candidates come from bands: a pair right at 80 % is missed with chance
    (1 - 0.8^6)^40 = 5e-6, one at 85 % with less than 1e-8, unless other links connect it.
    """
    spark = docs.sparkSession
    tune(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    rows = materialise(
        base.mapInArrow(_signatures(shingle), f"doc_id {kind}, key bigint, n bigint, class binary, regs binary"), "signatures"
    )
    number, hashes = rows.where(F.col("class").isNotNull()).agg(F.count(F.lit(1)), F.sum("n")).first()
    parts = partitions_for(spark, 32 * BANDS * number)
    stars = rows.select("class", "regs").mapInArrow(_local_stars(parts), "part bigint, frame binary")
    spread = F.when(F.col("part") >= 0, F.col("part")).otherwise(-1 - F.pmod(F.xxhash64("frame"), F.lit(parts)))
    pairs = stars.repartition(parts, spread).mapInArrow(_joined_stars, "a binary, b binary")
    pairs = materialise(pairs.distinct(), "pairs")

    involved = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    holders = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min(F.struct("doc_id", "key")).alias("at"))
    holders = holders.join(involved, "class", "left_semi").select("class", F.col("at.doc_id").alias("_id"), F.col("at.key").alias("_key"))
    texts = base.join(holders, base["doc_id"].eqNullSafe(holders["_id"]) & (base["key"] == holders["_key"])).select("class", "text")
    sets = materialise(texts.mapInArrow(_sets(shingle), "class binary, set binary, regs binary"), "sets")

    # a class has some leaders: about as many sets travel
    wide = partitions_for(spark, 8 * ORDERS * (hashes or 0))
    links = materialise(confirm_pairs(pairs, sets, percent, wide), "links")
    components = connected_components(links, "a", "b")
    joined = connected_components(link_across(pairs, components, sets, percent, wide), "a", "b")
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("whole"))

    classes = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("least"))
    named = classes.join(components.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    named = named.join(joined, "component", "left").withColumn("component", F.coalesce("whole", "component")).drop("whole")
    named = materialise(named, "classes")
    # written, so that the join of a large component can be split
    least = materialise(named.groupBy("component").agg(F.min("least").alias("component_id")), "component_ids")
    ids = named.join(least, "component").select("class", "component_id")
    out = rows.drop("regs").join(ids, "class", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("key").alias("text_key"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns as they are, without those that ``near_groups`` does not keep.

    Null texts and texts without words all stay. Of rows that repeat both the id and the text of the row that stays, one
    stays (an arbitrary one, should other columns differ). An empty table gives an empty result.
    """
    groups = near_groups(docs, id_col, text_col, **options).withColumn("copies", F.col("n_shingles") > 0)
    return survivors(docs, groups, id_col, text_col)

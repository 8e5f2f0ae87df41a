"""Prefix trie of conversations from a global range sort of their turn arrays.

A turn is a 16-byte digest of its role and text, a conversation the concatenation of its turns' digests, so that byte
order puts every prefix's conversations next to each other. Equal conversations are one key with a count, their ids
joined in segments that go in order into the hash of the node where they end. Keys are range-partitioned and sorted; a task sweeps
its keys with a stack: the length of the common prefix (LCP) of neighbours closes the nodes that are deeper and opens
those of the new key, and a node that closes hands its sums to its parent. A closed LCP interval is a node.

Nodes on the path of a task's first key may have begun in an earlier task, those on the path of its last key may go on
in a later one. Both paths are kept open: a task returns them as one record with what their closed children have handed
up. A second sweep reads these records in order, one for each partition, and closes what crosses partitions, by the
same rules. Texts never meet: only digests, lengths and ids travel. A parent's smallest member is joined last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, partitions_for, tune

DIGEST = 16
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
ROOT = bytes(DIGEST)
#: Nodes in an output batch.
BATCH = 20_000
#: Ids in a segment of a list of ids at most.
SEGMENT = 4096
#: Keys that Spark samples for each range partition, so that long keys don't add up on the driver.
SAMPLED = 20

_NODES = pa.schema(
    [
        ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
        ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("open", pa.binary()),
    ]
)
NODE_COLUMNS = (
    "node binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, open binary"
)


class Node:
    """An open node: what its own end and its closed children have added so far."""

    __slots__ = ("children", "depth", "ends", "id", "least", "leaves", "length", "n", "saved")

    def __init__(self, node: bytes, depth: int, length: int):
        self.id, self.depth, self.length = node, depth, length
        self.least: int | None = None
        self.n = self.children = self.leaves = self.saved = 0
        self.ends: str | None = None

    def add(self, least: int | None, n: int) -> None:
        if least is not None and (self.least is None or least < self.least):
            self.least = least
        self.n += n

    def absorb(self, other: Node) -> None:
        """What another part of the same node has gathered."""
        self.add(other.least, other.n)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends or other.ends

    def state(self) -> tuple:
        return (self.id.hex(), self.depth, self.length, self.least, self.n, self.children, self.leaves, self.saved, self.ends)

    @staticmethod
    def of(state: tuple) -> Node:
        out = Node(bytes.fromhex(state[0]), state[1], state[2])
        out.least, out.n, out.children, out.leaves, out.saved, out.ends = state[3:]
        return out


class Stack:
    """The open path, from the root down; rows: the nodes closed so far."""

    def __init__(self) -> None:
        self.path: list[Node] = []
        self.rows: list[tuple] = []

    def close(self) -> None:
        """Close the deepest node and hand its sums to its parent."""
        x = self.path.pop()
        if not x.children:
            x.leaves = 1
        x.saved += max(0, x.n - 1) * x.length
        up = self.path[-1] if self.path else None
        self.rows.append((x.id, up and up.id, x.depth, x.least, x.n, x.children, x.leaves, x.saved, x.ends or EMPTY_SHA, None))
        if up:
            up.add(x.least, x.n)
            up.children += 1
            up.leaves += x.leaves
            up.saved += x.saved

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) or [[]] * len(_NODES)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _NODES.types, strict=True)], schema=_NODES)


def lcp(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common at their beginning."""
    most = min(len(a), len(b))
    low, step = 0, 8 * DIGEST
    while low < most and a[low : low + step] == b[low : low + step]:
        low += step
        step *= 2
    low = min(low, most)
    while low < most and a[low : low + DIGEST] == b[low : low + DIGEST]:
        low += DIGEST
    return low // DIGEST


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of sorted keys (key, lengths, n, least, ends), and one record of the paths left open on either side."""
    import json

    stack, left, before, first = Stack(), [], b"", True
    fixed = 0  # so many nodes of the path are on the first key's path
    for b in batches:
        for key, lengths, n, least, ends in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
            shared = lcp(before, key)
            while len(stack.path) > shared + 1:
                if len(stack.path) <= fixed:  # may have begun earlier: kept as it is
                    left.append(stack.path.pop())
                else:
                    stack.close()
            fixed = min(fixed, len(stack.path))
            if first:
                stack.path.append(Node(ROOT, 0, 0))
            for d in range(len(stack.path), len(key) // DIGEST + 1):
                own = hashlib.blake2b(stack.path[-1].id + key[(d - 1) * DIGEST : d * DIGEST], digest_size=DIGEST).digest()
                stack.path.append(Node(own, d, lengths[d - 1]))
            if first:
                fixed, first = len(stack.path), False
            stack.path[-1].add(least, n)
            stack.path[-1].ends = ends
            before = key
            if len(stack.rows) >= BATCH:
                yield stack.batch()
    if not first:
        both, right = stack.path[:fixed], stack.path[fixed:]
        record = json.dumps({"left": [x.state() for x in both + left[::-1]], "common": len(both), "right": [x.state() for x in right]})
        stack.rows.append((None,) * 9 + (record.encode(),))
    yield stack.batch()


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes that the sweeps left open, from their records in the order of the keys."""
    import json

    stack = Stack()
    for b in batches:
        for record in b.column(0).to_pylist():
            part = json.loads(record)
            left = [Node.of(x) for x in part["left"]]
            shared = 0
            while shared < min(len(stack.path), len(left)) and stack.path[shared].id == left[shared].id:
                stack.path[shared].absorb(left[shared])
                shared += 1
            while len(stack.path) > shared:
                stack.close()
            stack.path += left[shared:]
            while len(stack.path) > part["common"]:
                stack.close()
            stack.path += [Node.of(x) for x in part["right"]]
            if len(stack.rows) >= BATCH:
                yield stack.batch()
    while stack.path:
        stack.close()
    yield stack.batch()


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest of the key, members, least, SHA-256 of their ids) of segments sorted by (digest, least id), hashed as they come."""
    now, n, least, sha = None, 0, 0, hashlib.sha256()
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) or [[]] * 4
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["same", "n", "least", "ends"])

    for b in batches:
        for same, first, number, ids in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            if same != now:
                if now is not None:
                    out.append((now, n, least, sha.hexdigest()))
                now, n, least, sha = same, 0, first, hashlib.sha256()
            sha.update(f",{ids}".encode() if n else ids.encode())
            n += number
        if len(out) >= BATCH:
            yield batch()
            out = []
    if now is not None:
        out.append((now, n, least, sha.hexdigest()))
    yield batch()


def ends_of(seqs: DataFrame, parts: int) -> DataFrame:
    """(same, n, least, ends): of every digest the conversations that have it, and the hash of their ids in order.

    A hash over a list must be fed in order, but not row by row: ids are gathered, sorted and joined in segments of
    a range of SEGMENT ids, so that of a large group one task only hashes finished segments.
    """
    segment = seqs.groupBy("same", F.floor(F.col("conv_id") / SEGMENT).alias("segment")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    text = F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")
    rows = segment.select("same", F.element_at("ids", 1).alias("first"), F.size("ids").cast("bigint").alias("number"), text.alias("ids"))
    rows = rows.repartition(parts, "same").sortWithinPartitions("same", "first")
    return rows.mapInArrow(_ends, "same binary, n bigint, least bigint, ends string")


def turn_arrays(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): of every conversation its turns in order, each as digest and code points of the text.

    Turns are ordered by number, null first; equal numbers by role and text. Null roles and texts become empty. Rows without a
    conversation id belong to none. The window and the aggregation share one shuffle; texts go no further.
    """
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    own = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    digest = F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * DIGEST))
    turn = F.struct(F.row_number().over(own).alias("place"), digest.alias("digest"), F.length("text").alias("points"))
    return rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(turns: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """(conv_id, turns): the first h turns of conversation c - c % group, then c's own after its first h; h = crc32(c) % heads.

    All turns of the other conversation if it has fewer, none if it doesn't exist.
    """
    h = F.pmod(F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")), F.lit(heads)).cast("int")
    base = turns.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads).alias("first"))
    both = turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(base, "base", "left").withColumn("h", h)
    none = F.slice("turns", 1, 0)
    head = F.coalesce(F.slice("first", F.lit(1), F.col("h")), none)
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return both.select("conv_id", F.concat(head, own).alias("turns"))


def prefix_trie(arrays: DataFrame) -> DataFrame:
    """The nodes of (conv_id, turns) as ``turn_arrays`` makes them: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    A node is a distinct sequence of first turns, the root the empty one; conversations that start with it are its members.
    conv_id is its smallest member; saved_tokens sums (n_convs - 1) times the code points of the last text over the node and
    all below it; ends_sha256 hashes the ids of the members that end there, ascending. Turnless conversations end at the root.

    Without conversations there is no node. One conversation's digests (16 bytes a turn) and one path of open nodes must fit a
    task's memory; nothing else that grows is held. The segments of equal conversations are hashed in one stream, since the hash
    is over their whole list.
    """
    spark = arrays.sparkSession
    tune(spark)
    key = F.coalesce(F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")), F.lit(b""))
    seqs = arrays.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["points"]).alias("points"))
    seqs = materialise(seqs.withColumn("same", F.unhex(F.substring(F.sha2("key", 256), 1, 2 * DIGEST))), "turn_arrays")
    size = seqs.agg(F.sum(F.length("key") + 60)).first()[0] or 0
    parts = partitions_for(spark, size)
    ids = ends_of(seqs, parts)
    keys = seqs.groupBy("same").agg(F.first("key").alias("key"), F.first("points").alias("points"))
    keys = materialise(keys.join(ids, "same").select("key", "points", "n", "least", "ends"), "keys")

    sampled = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    was = spark.conf.get(sampled)
    spark.conf.set(sampled, str(SAMPLED))
    try:
        swept = keys.repartitionByRange(parts, "key").sortWithinPartitions("key").mapInArrow(_sweep, NODE_COLUMNS)
        swept = materialise(swept.withColumn("part", F.spark_partition_id()), "swept")
    finally:
        spark.conf.set(sampled, was)
    stitched = swept.where(F.col("open").isNotNull()).select("open", "part").repartition(1).sortWithinPartitions("part").select("open")
    nodes = swept.where(F.col("open").isNull()).drop("part").unionByName(stitched.mapInArrow(_stitch, NODE_COLUMNS)).drop("open")
    nodes = materialise(nodes, "nodes")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(parents, "parent", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

"""Exact integer k-means by partial-distance search.

Components become integers, floor(256 * x), so that distances, sums and means are exact and don't depend on the order in
which tasks finish. Assigning a block of vectors, squared differences are added up over the dimensions of greatest
variance first; a centroid is abandoned for a vector once its partial sum is strictly above the best full distance
known, so a tie is never lost, and the ones that are left finish all dimensions.

A round reads the vectors once and sends, for each task, one row a centroid with its count and sums. These are summed
in two steps, first by (centroid, share), so that what meets in one task follows the number of shares, then on the
driver, which holds CENTROIDS rows. Sums travel as decimal text: they are exact, whatever their size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import materialise, tune

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
#: Dimensions added before each look at which centroids are left.
STEP = 8
#: Vectors worked on at once.
BLOCK = 4096
#: Tasks' sums of a centroid are summed by so many shares before they reach the driver.
SHARES = 16
#: Integers up to this size have distances that fit 64 bits; vectors with larger ones are computed in Python's integers.
SMALL = 1 << 27
#: Times the vectors asked for that the cut by hash leaves, on average.
SPARE = 16


def _valid(column: str) -> F.Column:
    v = F.col(column)
    fine = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    return v.isNotNull() & (F.size(v) == DIMENSIONS) & F.forall(v, fine)


def _whole(x: float) -> int:
    """floor(SCALE * x), also where SCALE * x is beyond a double."""
    return math.floor(x * SCALE) if abs(x) < 2.0**52 else int(x) * SCALE


def quantise(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of rows of doubles: 64-bit integers, or Python's where one of them is above SMALL."""
    if np.abs(x).max(initial=0.0) < SMALL // SCALE:
        return np.floor(x * SCALE).astype(np.int64)
    return np.array([[_whole(v) for v in row] for row in x.tolist()], dtype=object).reshape(x.shape)


def nearest(vectors: np.ndarray, centroids: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each vector; ties go to the smaller number.

    ``order``: the dimensions as they are added, STEP at a time. After the first of them, the centroid that is ahead is
    finished and gives the best distance; a centroid strictly above it is abandoned, all others finish.
    """
    v, c = vectors[:, order], centroids[:, order]
    if v.dtype != object and (c.dtype == object or np.abs(c).max(initial=0) > SMALL):
        v = v.astype(object)
    if v.dtype == object:
        c = c.astype(object)
    n, rows = len(c), np.arange(len(v))
    head = ((v[:, None, :STEP] - c[None, :, :STEP]) ** 2).sum(2)
    first = np.array(head.argmin(1), np.int64)
    best = ((v - c[first]) ** 2).sum(1)
    row, number = np.nonzero(head <= best[:, None])
    partial = head[row, number]
    for at in range(STEP, v.shape[1], STEP):
        partial = partial + ((v[row, at : at + STEP] - c[number, at : at + STEP]) ** 2).sum(1)
        left = np.asarray(partial <= best[row], bool)
        row, number, partial = row[left], number[left], partial[left]
    # rows and numbers ascend, so that the first of equal distances has the smaller number
    if v.dtype == object:
        found: dict[int, tuple[int, int]] = {}
        for r, k, d in zip(row.tolist(), number.tolist(), partial.tolist(), strict=True):
            found[r] = min(found.get(r, (d, k)), (d, k))
        return np.array([found[r][1] for r in rows.tolist()], np.int64), np.array([found[r][0] for r in rows.tolist()], object)
    least = np.full(len(v), np.iinfo(np.int64).max)
    np.minimum.at(least, row, partial)
    cluster = np.full(len(v), n)
    np.minimum.at(cluster, row, np.where(partial == least[row], number, n))
    return cluster, least


def _blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, quantised rows) of a list column without nulls. Blocks with large components are split off by row."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)
    for at in range(0, len(flat), BLOCK):
        block = flat[at : at + BLOCK]
        large = np.flatnonzero(np.abs(block).max(1) >= SMALL // SCALE)
        cut = sorted({0, len(block), *large.tolist(), *(large + 1).tolist()})
        for a, b in zip(cut, cut[1:], strict=False):
            yield at + a, quantise(block[a:b])


def _assign(centroids: list[list[int]], order: list[int]) -> Callable:
    """(id, cluster, distance) of every vector; a distance beyond 64 bits is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, o = _matrix(centroids), np.array(order)
        for b in batches:
            cluster, distance = [], []
            for _, v in _blocks(b.column(1)):
                k, d = nearest(v, c, o)
                cluster += k.tolist()
                distance += [x if x < 1 << 63 else None for x in d.tolist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    return run


def _sums(centroids: list[list[int]], order: list[int]) -> Callable:
    """(cluster, share, count, sums as text) of what a task's vectors add to their nearest centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, o = _matrix(centroids), np.array(order)
        counts, sums, first = [0] * len(c), [[0] * DIMENSIONS for _ in c], None
        for b in batches:
            for _, v in _blocks(b.column(1)):
                k, _ = nearest(v, c, o)
                if first is None:
                    first = hashlib.md5(str(v[0].tolist()).encode()).digest()[0] % SHARES
                for i in np.unique(k).tolist():
                    own = v[k == i]
                    counts[i] += len(own)
                    sums[i] = [x + y for x, y in zip(sums[i], own.sum(0).tolist(), strict=True)]
        yield _summed([(i, first, n, s) for i, (n, s) in enumerate(zip(counts, sums, strict=True)) if n])

    return run


def _matrix(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(x) <= SMALL for r in rows for x in r)
    return np.array(rows, np.int64 if small else object).reshape(-1, DIMENSIONS)


def _summed(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array([",".join(map(str, s)) for s in cols[3]], pa.string())],
        names=["cluster", "share", "n", "sums"],
    )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``_sums`` summed by (cluster, share)."""
    found: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for b in batches:
        for k, share, n, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            m, s = found.get((k, share), (0, [0] * DIMENSIONS))
            found[k, share] = m + n, [x + int(y) for x, y in zip(s, text.split(","), strict=True)]
    yield _summed([(k, share, n, s) for (k, share), (n, s) in found.items()])


def _start(vectors: DataFrame, number: int, rows: int, seed: str) -> list[list[int]]:
    """The vectors with the least hash of their id, in its order; ties by components."""
    if not rows:
        return []
    named = vectors.withColumn("hash", F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256))
    share = 2.0**60 * min(1.0, number * SPARE / rows)
    few = named.where(F.conv(F.substring("hash", 1, 15), 16, 10).cast("double") < share)
    first = lambda df: df.orderBy(F.col("hash").asc_nulls_last(), "v").limit(number).select("v")
    found = first(few).collect()
    if len(found) < number:  # unlucky, or ids that repeat or are null
        found = first(named).collect()
    return [quantise(np.array([r.v], np.float64))[0].tolist() for r in found]


def centroid_clusters(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    clusters: int = CENTROIDS, rounds: int = ROUNDS, seed: str = "2:",
) -> tuple[DataFrame, DataFrame]:
    """(id, cluster, distance) of every vector that is kept, and (cluster, size, cluster_inertia, inertia, centroid, centroid_sha256).

    Kept are vectors of DIMENSIONS components none of which is null, NaN or infinite; each x becomes floor(256 * x).
    Centroids start as the ``clusters`` kept vectors (fewer, if there are fewer) with the least lowercase-hex SHA-256 of
    seed + id, numbered in that order; repeated ids are ordered by their vectors, null ids come last. Every round assigns
    all vectors (squared Euclidean distance; ties: the smaller number) and moves each centroid that has any to
    floor(sum / count) of theirs; after the last one vectors are assigned once more. A cluster without vectors has no row.

    Null vectors are left out, null ids kept. Repeated rows count each time. Only the two columns are looked at. Without
    kept vectors both results are empty. A distance or an inertia that doesn't fit 64 bits is null; the assignment is right all the same.
    """
    spark = vectors.sparkSession
    tune(spark)
    kind = vectors.schema[id_col].dataType.simpleString()
    kept = vectors.where(_valid(vector_col)).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    seen = Observation()
    spread = [F.var_pop(F.element_at("v", i + 1).cast("double")).alias(f"d{i}") for i in range(DIMENSIONS)]
    kept = materialise(kept.observe(seen, F.count(F.lit(1)).alias("rows"), *spread), "vectors")
    got = seen.get
    variance = np.nan_to_num(np.array([got[f"d{i}"] or 0.0 for i in range(DIMENSIONS)], np.float64))
    order = np.argsort(-variance, kind="stable").tolist()
    now = _start(kept, clusters, got["rows"], seed)
    if now:
        for _ in range(rounds):
            sums = kept.mapInArrow(_sums(now, order), "cluster int, share int, n bigint, sums string")
            sums = sums.repartition(SHARES, "share", "cluster").mapInArrow(_fold, "cluster int, share int, n bigint, sums string")
            total: dict[int, tuple[int, list[int]]] = {}
            for r in sums.collect():  # clusters * SHARES rows
                n, s = total.get(r.cluster, (0, [0] * DIMENSIONS))
                total[r.cluster] = n + r.n, [x + int(y) for x, y in zip(s, r.sums.split(","), strict=True)]
            now = [[x // total[k][0] for x in total[k][1]] if k in total else c for k, c in enumerate(now)]
    schema = f"id {kind}, cluster int, distance bigint"
    out = materialise(kept.mapInArrow(_assign(now, order), schema), "assigned") if now else spark.createDataFrame([], schema)
    wide = F.sum(F.col("distance").cast("decimal(20,0)"))
    sizes = out.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), wide.alias("total"), F.count_if(F.col("distance").isNull()).alias("nulls"))
    found = sizes.collect()  # a row a cluster
    lost, all_ = any(r.nulls for r in found), sum(int(r.total or 0) for r in found)
    whole = lambda x, nulls: int(x) if not nulls and int(x) < 1 << 63 else None
    text = [",".join(map(str, c)) for c in now]
    rows = [
        (r.cluster, r.size, whole(r.total or 0, r.nulls), whole(all_, lost), text[r.cluster], hashlib.sha256(text[r.cluster].encode()).hexdigest())
        for r in sorted(found, key=lambda r: r.cluster)
    ]
    return out, spark.createDataFrame(rows, "cluster int, size bigint, cluster_inertia bigint, inertia bigint, centroid string, centroid_sha256 string")

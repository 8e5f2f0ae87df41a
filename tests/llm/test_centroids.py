import hashlib
import math
import random

import numpy as np
import pytest

from newsloom.llm import centroids
from newsloom.llm.centroids import centroid_clusters

SCHEMA = "vec_id long, embedding array<double>, cluster string"


def brute(rows, clusters=40, rounds=5):
    """Python integers throughout; rows (id, vector)."""
    kept = [(i, [centroids._whole(x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    raw = {id(t): t for t in kept}
    assert len(raw) == len(kept)
    start = sorted(kept, key=lambda t: (t[0] is None, hashlib.sha256(f"2:{t[0]}".encode()).hexdigest(), t[1]))[:clusters]
    now = [list(v) for _, v in start]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), k) for k, c in enumerate(now)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for k in range(len(now)):
            own = [v for (_, v), (_, at) in zip(kept, found, strict=True) if at == k]
            if own:
                now[k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = assign()
    total = sum(d for d, _ in found)
    inertia = {}
    for d, k in found:
        inertia[k] = inertia.get(k, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return sorted(((i, k, d, inertia[k], total, sha[k]) for (i, _), (d, k) in zip(kept, found, strict=True)), key=str)


def got(df, **options):
    out, info = centroid_clusters(df, **options)
    return sorted((tuple(r) for r in out.join(info, "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


def rows_of(seed, n):
    rng = np.random.default_rng(seed)
    mids = rng.normal(0, 0.3, (7, 64))
    return [(i, (mids[rng.integers(7)] + rng.normal(0, 0.2, 64)).tolist()) for i in range(n)]


@pytest.mark.parametrize("seed,n", [(1, 300), (2, 25), (3, 1)])
def test_equal_to_integer_k_means(spark, seed, n):
    rows = rows_of(seed, n)
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA).repartition(5)
    assert got(df) == brute(rows)


def test_invalid_vectors_are_left_out(spark):
    rows = rows_of(4, 60)
    bad = [(900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 65), (904, [None] + [0.5] * 63), (905, [float("nan")] + [0.5] * 63), (906, [float("inf")] + [0.5] * 63)]
    odd = [(None, [0.25] * 64), (None, [0.5] * 64), (3, rows[3][1]), (3, [0.125] * 64)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + bad + odd], SCHEMA)
    assert got(df) == brute(rows + odd)
    assert got(df, clusters=70) == brute(rows + odd, clusters=70)


def test_empty_table(spark):
    out, info = centroid_clusters(spark.createDataFrame([], SCHEMA))
    assert out.count() == info.count() == 0 and out.columns == ["id", "cluster", "distance"]


def test_ties_and_many_copies(spark):
    """Vectors halfway between centroids, and one vector that half of the rows repeat."""
    rnd = random.Random(5)
    rows = [(i, [rnd.choice([0.0, 1 / 256, -1 / 256]) for _ in range(64)]) for i in range(150)]
    rows += [(1000 + i, [0.0] * 64) for i in range(200)]
    rows += [(2000, [-0.001] * 64), (2001, [0.0039] * 64)]
    assert got(spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)) == brute(rows)


@pytest.mark.parametrize("clusters", [3, 45])
def test_components_beyond_64_bits(spark, clusters):
    """Such distances are null, with their inertias; assignments stay exact."""
    rows = rows_of(6, 50) + [(700, [1e30] * 64), (701, [1e30] * 63 + [2e30]), (702, [-3e300] + [0.0] * 63), (703, [3e5] * 64)]
    fits = lambda x: x if x < 1 << 63 else None
    want = brute(rows, clusters=clusters)
    lost = {k for _, k, d, *_ in want if d >= 1 << 63}
    want = sorted(((i, k, fits(d), None if k in lost else fits(c), None if lost else fits(t), s) for i, k, d, c, t, s in want), key=str)
    assert got(spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA), clusters=clusters) == want


def test_abandoning_never_changes_the_nearest():
    rng = np.random.default_rng(8)
    v, c = rng.integers(-40, 40, (500, 64)), rng.integers(-40, 40, (33, 64))
    c[20] = c[4]
    full = ((v[:, None] - c[None]) ** 2).sum(2)
    for order in (np.arange(64), rng.permutation(64)):
        k, d = centroids.nearest(v, c, order)
        assert (k == full.argmin(1)).all() and (d == full.min(1)).all()
        k, d = centroids.nearest(v.astype(object), c, order)
        assert (k == full.argmin(1)).all() and (d == full.min(1)).all()

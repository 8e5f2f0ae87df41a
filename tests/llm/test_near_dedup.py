import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import near_dedup

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = SPACE.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    near = {i: [j for j in range(len(rows)) if j != i and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])] for i in range(len(rows))}
    out = []
    for i, (k_, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((k_, len(sets[i]), least, k_ == least))
    return sorted(out, key=str)


def rows_of(seed, groups=6, size=14, words=40):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(groups):
        base = rnd.choices(vocab, k=rnd.randint(words // 2, words))
        for _ in range(size):
            own = list(base)
            for _ in range(rnd.randint(0, 4)):
                own[rnd.randrange(len(own))] = rnd.choice(vocab)
            rows.append((len(rows), " ".join(own)))
    rows += [(500 + i, " ".join(rnd.choices(vocab, k=rnd.randint(1, 30)))) for i in range(30)]
    return rows + [(900, None), (901, ""), (902, " \n"), (None, rows[0][1]), (903, "Solo"), (904, "sOLO"), (3, rows[3][1]), (3, "other words here"), (905, "a b " * 20_000), (906, "É b"), (907, "é b")]


@pytest.mark.parametrize("seed,k,block", [(1, 2, 256), (2, 5, 3), (3, 2, 5)])
def test_components_equal_brute_force(spark, monkeypatch, seed, k, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "MEMBERS", 3)
    rows = rows_of(seed)
    docs = spark.createDataFrame([(a, t, "x", b"y") for a, t in rows], "doc_id long, text string, class string, regs binary")
    got = near_dedup.near_groups(docs, shingle=k).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, k)


def test_large_texts_use_the_estimate(spark):
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(5000)]
    rows = []
    for g in range(4):
        base = rnd.choices(vocab, k=1500)
        for edits in (0, 20, 60, 90, 130, 200, 300):
            own = list(base)
            for i in rnd.sample(range(1500), edits):
                own[i] = rnd.choice(vocab)
            rows.append((len(rows), " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_groups(docs, shingle=2).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 2)


def test_chain_without_common_leader(spark):
    words = [f"w{i}" for i in range(600)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 60])) for i in range(100)]  # neighbours alone are similar
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_groups(docs, shingle=2).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 2)


def test_regions_are_found_among_components(spark, monkeypatch):
    """Candidates within a component don't go through the rounds again, and no edge of a component does."""
    seen, found = [], []
    real = near_dedup.connected_components

    def watched(edges, u, v):
        seen.append({(r.a, r.b) for r in edges.select("a", "b").collect()})
        out = real(edges, u, v)
        found.append({r.node: r.component for r in out.collect()})
        return out

    monkeypatch.setattr(near_dedup, "connected_components", watched)
    rows = rows_of(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_groups(docs, shingle=2).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 2)
    assert len(seen) == 3 and len(found[0]) > 20 and seen[1]
    for edges in seen[1:]:
        assert all(a != b and found[0].get(a, a) == a and found[0].get(b, b) == b for a, b in edges)


def test_empty_and_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "k"), (2, "A b c d e f", None), (None, None, "z")], "doc_id long, text string, key string")
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, None]
    assert near_dedup.near_groups(docs.limit(0)).count() == 0
    again = docs.unionByName(docs.withColumn("key", F.lit("again")))
    assert sorted((r.doc_id for r in near_dedup.drop_near_duplicates(again).collect()), key=str) == [1, None, None]


def test_many_mixed_regions(spark, monkeypatch):
    """Regions joined by salted keys give the same links as broadcast ones."""
    rnd = random.Random(12)
    vocab = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(6):
        base = rnd.choices(vocab, k=400)
        for edits in (0, 10, 30, 60, 90):
            own = list(base)
            for i in rnd.sample(range(400), edits):
                own[i] = rnd.choice(vocab)
            rows.append((len(rows), " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near_dedup, "FEW_REGIONS", 0)
    got = near_dedup.near_groups(docs, shingle=2).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 2)


def test_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, "w1 w2")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.near_groups(docs).collect()} == {1: 1, 2: 1, 3: 3}


def test_register_share_estimates_jaccard():
    rng = np.random.default_rng(3)
    for a, b, both in ((3000, 2500, 2000), (700, 700, 400), (40, 50, 35)):
        shares = []
        for _ in range(30):
            h = rng.integers(0, 2**63, a + b - both, dtype=np.uint64) * np.uint64(2)
            x, y = near_dedup.registers(np.sort(h[:a])), near_dedup.registers(np.sort(h[a - both :]))
            shares.append(near_dedup.estimate(x, y, a, b))
        assert abs(np.mean(shares) - both / (a + b - both)) < 0.05
    x = [near_dedup.registers(np.sort(rng.integers(0, 2**63, 5000, dtype=np.uint64))) for _ in range(60)]
    chance = np.mean([(x[i] == x[i + 1]).mean() for i in range(59)])
    assert abs(chance - near_dedup.collision(5000, 5000)) < 5e-4

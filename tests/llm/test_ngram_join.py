import random

import numpy as np
import pytest
from test_near_dedup import brute, rows_of

from newsloom.llm import ngram_join


def got(docs, **options):
    return sorted((tuple(r) for r in ngram_join.ngram_groups(docs, **options).collect()), key=str)


def want(rows, k, percent=80):
    return sorted(((i, n, c) for i, n, c, _ in brute(rows, k, percent)), key=str)


@pytest.mark.parametrize("seed,k,percent,options", [(1, 5, 80, {}), (2, 2, 80, {"BLOCK": 3, "MEMBERS": 2}), (3, 3, 60, {"FLUSH": 300, "SLICE": 50}), (4, 2, 95, {"FEW": 0}), (5, 2, 40, {"BLOCK": 5})])
def test_components_equal_brute_force(spark, monkeypatch, seed, k, percent, options):
    """Small blocks, flushes and slices, and joins without broadcasts, give the same rows. Columns of inner names are passed over."""
    for name, value in options.items():
        monkeypatch.setattr(ngram_join, name, value)
    rows = rows_of(seed)
    docs = spark.createDataFrame([(a, t, "x", b"y") for a, t in rows], "doc_id long, text string, class string, gram binary").repartition(3)
    assert got(docs, shingle=k, percent=percent) == want(rows, k, percent)


def chains(seed, common=0):
    """Neighbours alone are similar; with a common passage each text holds more of what all hold than of its own."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    passage = " ".join(f"p{i}" for i in range(common))
    rows = [(i, " ".join(words[3 * i : 3 * i + 50]) + " " + passage) for i in range(120)]
    rows += [(200 + i, " ".join(rnd.choices(words, k=rnd.randint(1, 12))) + " " + passage) for i in range(60)]
    rows += [(300 + i, passage) for i in range(3 if common else 0)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("common,least", [(0, 4096), (60, 4096), (60, 20), (200, 2)])
def test_common_passages_and_chains(spark, monkeypatch, common, least):
    """With and without n-grams that are heavy and rank last; texts that share a passage and texts that are little else."""
    monkeypatch.setattr(ngram_join, "HEAVY_LEAST", least)
    monkeypatch.setattr(ngram_join, "HEAVY_LOCAL", min(least, 4))
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    rows = chains(common + least, common)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), shingle=2) == want(rows, 2)


def test_heads_that_collide(spark, monkeypatch):
    """Short heads collide within and between texts: sizes, positions and links stay those of whole hashes."""
    monkeypatch.setattr(ngram_join, "BITS", 6)
    rows = chains(9, 20)[:90]
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2) == want(rows, 2)


def test_filters_never_drop_a_link(spark):
    """Pairs right at the threshold, of many sizes."""
    rows = []
    for n in (5, 9, 10, 18, 27, 45, 90):
        for d in range(n // 9 + 2):  # of n words, d at the end differ
            base = [f"v{n}x{i}" for i in range(n)]
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(base[: n - d] + [f"q{n}x{d}x{i}" for i in range(d)]))]
    for k in (1, 2):
        assert got(spark.createDataFrame(rows, "doc_id long, text string"), shingle=k) == want(rows, k)


def test_empty_and_long(spark):
    schema = "doc_id long, text string, n long"
    assert got(spark.createDataFrame([], schema)) == []
    assert got(spark.createDataFrame([(1, None, 1), (2, "", 1), (3, " \t", 1)], schema)) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    long = " ".join(f"w{i}" for i in range(300_000))
    rows = [(3, long, 1), (2, long + " end", 1), (1, "w1 w2", 1), (4, long[: len(long) // 2], 1)]
    assert {r[0]: r[2] for r in got(spark.createDataFrame(rows, schema))} == {1: 1, 2: 2, 3: 2, 4: 4}


def test_prefix_lengths():
    for percent in (1, 40, 80, 100):
        for n in range(1, 60):
            least = min(o for o in range(n + 1) if 100 * o >= percent * n)
            assert ngram_join.prefix_length(n, percent) == n - least + 1
    full, short = ngram_join.grams_of(b"a b c d e f a b", 2)
    assert len(full) == len(short) == 6 and (short == np.unique(full >> np.uint64(16))).all()

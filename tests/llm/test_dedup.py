import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from newsloom.llm import exact_dedup, queries, substring_dedup

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute_substring(rows, width):
    words = [SPACE.findall(t or "") for _, t in rows]
    n = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (k, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if n[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((k, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


def texts(seed, n, vocab=6):
    rnd = random.Random(seed)
    pool = [f"w{i}é"[: 2 + i % 3] for i in range(vocab)]
    shared = [" ".join(rnd.choices(pool, k=12)) for _ in range(3)]
    out = []
    for i in range(n):
        t = rnd.choice([" ", "\n", " \t"]).join(rnd.choices(pool, k=rnd.randint(0, 30)))
        out.append((i, t + " " + rnd.choice(shared) if i % 3 else t))
    return out + [(900, None), (901, ""), (None, "a b"), (902, " \n "), (7, out[7][1]), (903, "b " * 4000)]


def test_substring_dedup_equals_brute_force(spark, monkeypatch):
    for seed, width, heavy in ((1, 5, 20_000), (2, 8, 2), (3, 3, 1)):
        monkeypatch.setattr(substring_dedup, "HEAVY_LEAST", heavy)
        rows = texts(seed, 60, vocab=4 + 8 * (seed == 2))
        docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, n_words int, digest string")
        got = substring_dedup.substring_dedup(docs, width=width).select("doc_id", "n_words", "n_removed", "kept_text").collect()
        assert sorted(map(tuple, got), key=str) == brute_substring(rows, width)
    assert substring_dedup.substring_dedup(docs.limit(0)).count() == 0


def test_long_texts_are_cut_without_loss(monkeypatch):
    monkeypatch.setattr(substring_dedup, "SLICE", 200)
    rnd = random.Random(5)
    text = " ".join(rnd.choices([b.decode() for b in (b"aa", b"bb", b"ccc")], k=900)).encode()
    words = text.split()
    seen = []
    for base, piece in substring_dedup.slices(text, 7):
        own = piece.split()
        seen += [(base + i, tuple(own[i : i + 7])) for i in range(len(own) - 6)]
    assert seen == [(i, tuple(words[i : i + 7])) for i in range(len(words) - 6)]


def test_equal_hashes_of_different_windows_are_told_apart(monkeypatch):
    monkeypatch.setattr(substring_dedup, "sliding_hash", lambda h, w: np.zeros(max(0, len(h) - w + 1), np.uint64))
    own, a, b = substring_dedup.repeated_windows(b"a b c d\nx b c y\nq r s t\n", np.array([1, 1, 1]), 2)
    assert list(zip(own.tolist(), a.tolist(), b.tolist())) == [(0, 1, 2), (1, 1, 2)]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_exact_groups_heavy_and_light(spark):
    rnd = random.Random(2)
    pool = ["", None, "Hot", "hOT", "É", "é", "x"] + [f"T{i}" for i in range(40)]
    rows = [(i, rnd.choice(pool + ["hot"] * 20), "a", True) for i in range(400)] + [(None, "hot", "b", False), (5, "zz", None, None), (5, "zz", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, kept boolean")
    groups = {}
    for k, t, *_ in rows:
        groups.setdefault(lower(t), []).append(k)
    want = []
    for k, t, *_ in rows:
        g = groups[lower(t)]
        keep = max((x for x in g if x is not None), default=None)
        want.append((k, keep, len(g), k == keep, hashlib.sha256(lower(t).encode()).digest()))
    for counters, least in ((8, 10), (1024, 64), (2, 1)):
        got = exact_dedup.exact_groups(docs, counters=counters, least=least)
        got = got.select("doc_id", "keep_id", "group_size", "kept", "digest").collect()
        assert sorted(((*r[:4], bytes(r[4])) for r in got), key=str) == sorted(want, key=str)
    left = exact_dedup.drop_exact_duplicates(docs, counters=4, least=5)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({w[0] for w in want if w[3]})
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


def test_very_long_texts(spark):
    long = "Wort\u00e9 " * 400_000
    docs = spark.createDataFrame([(1, long), (2, long.lower()), (3, long + "x")], "doc_id long, text string")
    got = {r.doc_id: r for r in exact_dedup.exact_groups(docs).collect()}
    assert [got[k].keep_id for k in (1, 2, 3)] == [2, 2, 3]
    assert bytes(got[1].digest) == hashlib.sha256(lower(long).encode()).digest()


def test_misra_gries_keeps_every_frequent_digest():
    rnd = random.Random(4)
    seen = [rnd.choice([1, 1, 1, 2, *range(3, 300)]) for _ in range(5000)] + [1] * 2500
    counts = Counter()
    for i in range(0, len(seen), 97):
        counts.update(seen[i : i + 97])
        counts = exact_dedup.trim_counters(counts, 10)
    assert len(counts) <= 10 and counts[1] > 0


def test_queries_on_the_small_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = [(k, n, m, hashlib.sha256(t.encode()).hexdigest()) for k, n, m, t in brute_substring(rows, 35)]
    got = queries.op1_substring_dedup(spark, sf_dir).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert docs.where(F.col("text").isNull()).count() == 0

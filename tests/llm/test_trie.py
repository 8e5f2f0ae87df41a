import hashlib
import random
import zlib

import pytest

from newsloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes of the rebuilt conversations, by the definition."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + turns[h:]
    nodes = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    sums = {}
    for p in sorted(nodes, key=len, reverse=True):
        kids = children.get(p, [])
        leaves = sum(sums[k][0] for k in kids) or 1
        sums[p] = leaves, sum(sums[k][1] for k in kids) + ((len(nodes[p]) - 1) * len(p[-1][1]) if p else 0)
    return sorted(
        (min(cs), len(p), min(nodes[p[:-1]]) if p else None, len(cs), len(children.get(p, [])), *sums[p],
         hashlib.sha256(",".join(str(c) for c in sorted(cs) if len(full[c]) == len(p)).encode()).hexdigest())
        for p, cs in nodes.items()
    )


def got(df):
    out = trie.prefix_trie(trie.rebuilt(trie.turn_arrays(df)))
    return sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0], r[1]))


def rows_of(seed, n=120):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(0, n), *range(205, 230), *range(300, 306), -5, -100, -107]:
        for t in range(rnd.choice([1, 1, 2, 3, 4, 6, 9])):
            # few different turns, so that conversations share long prefixes and some are equal
            rows.append((c, t if rnd.random() > 0.05 else None, rnd.choice(["user", "assistant", None, ""]), rnd.choice(["a", "ab", "é𝒳", "", None, "same same"])))
    return rows


@pytest.mark.parametrize("seed,parts", [(1, 1), (2, 4), (3, 13), (4, 60), (5, 300)])
def test_nodes_equal_brute_force(spark, monkeypatch, seed, parts):
    """Many partitions hold a key or two, or none: nearly every node crosses partitions then. Segments of three ids or all."""
    monkeypatch.setattr(trie, "SEGMENT", 3 if seed % 2 else 4096)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = rows_of(seed)
        assert got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == sorted(brute(rows), key=lambda r: (r[0], r[1]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_columns_nulls_repeats_and_ties(spark):
    """Null ids belong to no conversation; repeated rows are turns of their own; equal numbers go by role and text."""
    rows = [(1, 0, "user", "x"), (1, 0, "user", "x"), (1, None, None, None), (1, 0, "assistant", "z"), (None, 0, "user", "lost"), (2, 5, "user", "late"), (2, 3, "user", "é")]
    df = spark.createDataFrame([(*r, b"n", 7) for r in rows], SCHEMA + ", key binary, node long")
    assert got(df) == sorted(brute(rows), key=lambda r: (r[0], r[1]))


def test_empty_and_turnless(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    # a conversation of one turn that loses it to a missing head is turnless, and ends at the root
    ids = [c for c in range(1, 40) if zlib.crc32(str(c).encode()) % 6 > 0]
    rows = [(c, 0, "user", "gone") for c in ids]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert len(brute(rows)) == 1


def test_many_equal_and_one_long_conversation(spark):
    rnd = random.Random(7)
    rows = [(c, t, "user", f"hot {t}") for c in range(500) for t in range(3)]
    rows += [(1000, t, "user", rnd.choice("ab") * 50) for t in range(3000)]
    rows += [(1001, t, "user", "a" * 50) for t in range(3000)]
    rows += [(1100, 0, "user", "long " * 200_000)]
    # paths of thousands of turns: recursion or squares would show
    out = got(spark.createDataFrame(rows, SCHEMA))
    assert len(out) > 3000 and max(r[1] for r in out) >= 3000
    root = next(r for r in out if r[1] == 0)
    assert root[3] == 503 and root[5] == sum(1 for r in out if r[4] == 0)


def test_common_prefix_in_turns():
    a, b = b"x" * 16, b"y" * 16
    assert trie.lcp(a * 40 + b, a * 41) == 40
    assert trie.lcp(a * 5, a * 9) == 5
    assert trie.lcp(b"", a) == 0
    assert trie.lcp(a[:15] + b"z", a) == 0

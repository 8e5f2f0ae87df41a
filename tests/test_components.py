"""Connected components against union-find."""

import random

from newsloom.operators import components
from newsloom.operators.components import connected_components


def union_find(edges):
    least = {}

    def find(x):
        while least.setdefault(x, x) != x:
            x = least[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            least[b] = a
    return {x: find(x) for x in least}


def test_components_of_random_graphs(spark):
    rnd = random.Random(6)
    graphs = [[(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(60)] + [(5, 5), (None, 4), (4, None)]]
    graphs += [[(i, i + 1) for i in rnd.sample(range(40), 40)], [(1, 2), (3, 4), (2, 1)], [(9, i) for i in range(9)] + [(9, 20), (20, 19)], []]
    for edges in graphs:
        rows = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
        assert {r.node: r.component for r in rows} == union_find(edges)
        assert len(rows) == len({r.node for r in rows})


def test_a_round_writes_four_tables(spark, monkeypatch):
    """The table of nodes tells whether the edges are stars, and is the result where they are."""
    written = []
    real = components.materialise
    monkeypatch.setattr(components, "materialise", lambda df, label: written.append(label) or real(df, label))
    rows = connected_components(spark.createDataFrame([(1, 2), (1, 3), (4, 5)], "u long, v long")).collect()
    assert {r.node: r.component for r in rows} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    assert written == ["edges", "nodes"]
    written.clear()
    rows = connected_components(spark.createDataFrame([(1, 2), (2, 3)], "u long, v long")).collect()
    assert {r.node: r.component for r in rows} == {1: 1, 2: 1, 3: 1}
    assert written == ["edges", "nodes", "large", "least", "edges", "nodes"]

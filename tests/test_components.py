import random

from ambitus.operators.components import connected_components


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(200 + rng.randrange(40), 200 + rng.randrange(40)) for _ in range(30)] + [(500, 500), (None, 3), (600, 601), (600, 601)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_empty(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []

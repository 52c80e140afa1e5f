import random

from auricle.llm.common import components


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 140)]  # a path
    edges += [(200, 200 + k) for k in range(1, 50)]  # a star
    edges += [(7, 7), (9, None), (-5, 3), (3, -8)]
    edges += [(rng.randint(300, 340), rng.randint(300, 340)) for _ in range(25)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(v):
        root.setdefault(v, v)
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {v: find(v) for v in root}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []

import random

import pytest

from askframe.llm.components import components


def by_hand(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("kind", ["random", "chain", "star"])
@pytest.mark.parametrize("large", [False, True])
def test_components(spark, kind, large, request):
    if large:
        request.getfixturevalue("small_bounds_off")
    rng = random.Random(3)
    edges = {
        "random": [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(1, None), (None, None), (7, 7)],
        "chain": [(i, i + 1) for i in range(30)],
        "star": [(500, i) for i in range(100)] * 2,
    }[kind]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == by_hand(edges)
    assert len(found) == len(by_hand(edges))


def test_no_edges(spark):
    assert components(spark.createDataFrame([(None, 1), (2, 2)], "a long, b long")).collect() == []

"""Connected components against union-find."""

from __future__ import annotations

import random

import pytest

from parcelmart.llm.staging import components


def least_reachable(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {(x, find(x)) for x in list(root)}


def graphs():
    rnd = random.Random(4)
    path = rnd.sample(range(10_000), 300)
    yield "path", list(zip(path, path[1:], strict=False))
    yield "star", [(500, k) for k in range(1000) if k != 500]
    yield "random", [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)]
    yield "cycle and pair", [(k, (k + 1) % 9) for k in range(9)] + [(50, 51), (51, 50), (-3, 50)]


@pytest.mark.parametrize(("name", "edges"), list(graphs()))
def test_components(spark, name, edges):
    schema = "a long, b long"
    got = {tuple(r) for r in components(spark.createDataFrame(edges, schema)).collect()}
    want = least_reachable([e for e in edges if e[0] != e[1]])
    assert got == want
    half = len(edges) // 2
    first = components(spark.createDataFrame(edges[:half], schema))
    both = components(spark.createDataFrame(edges[half:], schema), first)
    rows = both.collect()
    assert len(rows) == len({r.node for r in rows}) and {tuple(r) for r in rows} == want


def test_no_edges(spark):
    none = spark.createDataFrame([(1, 1)], "a long, b long")
    assert components(none).count() == 0
    known = spark.createDataFrame([(2, 1), (1, 1)], "node long, root long")
    assert sorted(tuple(r) for r in components(none, known).collect()) == [(1, 1), (2, 1)]

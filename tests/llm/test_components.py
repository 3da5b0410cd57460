"""Connected components against a plain walk, with blocks so small that rounds are needed."""

import random

import pytest

from rollcall.llm.components import connected_components


def plain(edges):
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    found = {}
    for start in sorted(near):
        todo = [start]
        while todo:
            node = todo.pop()
            if node not in found:
                found[node] = start
                todo += near[node]
    return found


def chain(n):
    names = list(range(n))
    random.Random(3).shuffle(names)
    return list(zip(names, names[1:]))


@pytest.mark.parametrize("block", [3, 1 << 16])
def test_as_a_plain_walk(spark, block):
    pick = random.Random(5)
    some = [(pick.randrange(300), pick.randrange(300)) for _ in range(170)]
    edges = some + some[:20] + [(1000 + a, 1000 + b) for a, b in chain(60)] + [(2000, 2000 + k) for k in range(1, 50)] + [(None, 1), (7, None), (9, 9)]
    rows = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(4), block=block).collect()
    assert len(rows) == len({r["node"] for r in rows})
    assert {r["node"]: r["component"] for r in rows} == plain(edges)


def test_strings_and_no_edges(spark):
    rows = connected_components(spark.createDataFrame([("b", "c"), ("c", "a"), ("y", "x")], "a string, b string")).collect()
    assert {r["node"]: r["component"] for r in rows} == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0

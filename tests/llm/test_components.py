"""Components against a union in plain Python."""

import random

import numpy as np
import pytest

from retally.llm import components


def brute(edges):
    least = {x: x for e in edges for x in e}
    while True:
        before = dict(least)
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
        if least == before:
            return least


def graphs():
    rnd = random.Random(8)
    path = [(i, i + 1) for i in range(300)]
    order = list(range(301))
    rnd.shuffle(order)
    yield [(order[a], order[b]) for a, b in path]                         # a long path of mixed ids
    yield [(500, i) for i in range(400)]                                  # a star whose centre is large
    yield [(0, i) for i in range(1, 400)] + [(i, i + 1000) for i in range(1, 400, 7)]
    yield [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)]  # a sparse graph with loops and repeats
    yield []


@pytest.mark.parametrize("number", range(5))
@pytest.mark.parametrize("at_once, partitions", [(2_000_000, 4), (3, 40)])
def test_components_equal_brute_force(spark, tmp_path, monkeypatch, number, at_once, partitions):
    edges = list(graphs())[number]
    linked = [(a, b) for a, b in edges if a != b]
    frame = spark.createDataFrame([*edges, (None, 1), (1, None)], "a long, b long").repartition(partitions)
    united = components._united

    def small(batches):                                                   # the limit is read where the task runs
        components.AT_ONCE = at_once
        for batch in batches:
            yield from united(batch.slice(i, 2) for i in range(0, batch.num_rows, 2))

    monkeypatch.setattr(components, "_united", small)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(at_once > 3).lower())
    try:
        got = components.components(frame, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.id: r.component for r in got} == brute(linked) and len(got) == len({x for e in linked for x in e})


def test_a_forest_is_stars():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 2000, 1500), rng.integers(0, 2000, 1500)
    node, root = components.forest(a, b)
    assert len(set(node.tolist())) == len(node) and not set(node.tolist()) & set(root.tolist()) and (node > root).all()

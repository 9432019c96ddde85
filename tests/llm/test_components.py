import random

import pytest
from tenderlake.llm import components as module
from tenderlake.llm.components import components


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_smallest_reachable_node(spark, kind):
    rng = random.Random(4)
    n = 120
    edges = {"chain": [(i + 1, i) for i in range(n)], "star": [(n, i) for i in range(n)], "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(90)]}[kind]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges + edges[:3], "a long, b long")).collect()}
    assert found == {i: find(i) for i in list(root)}


def test_no_links(spark):
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_rising_chains_and_stars_take_few_rounds(spark, monkeypatch):
    rounds = []
    followed = module._followed
    monkeypatch.setattr(module, "_followed", lambda step: rounds.append(1) or followed(step))
    chain = [(i, i + 1) for i in range(300)]
    for links, most in ((chain, 1), ([(b, a) for a, b in chain], 1), ([(i, 999) for i in range(300)], 2), ([(-1, i) for i in range(300)], 1)):
        rounds.clear()
        found = module.components(spark.createDataFrame(links, "a long, b long")).collect()
        assert {r.root for r in found} == {min(min(x) for x in links)} and len(found) == 301
        assert len(rounds) <= most

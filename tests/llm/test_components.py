"""Against union and find, with hubs above and below the bound."""

from __future__ import annotations

import random

import pytest
from orefold.llm import components


def brute(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("degree", [5, 1000])
def test_hubs_chains_and_random_links(spark, monkeypatch, degree):
    monkeypatch.setattr(components, "DEGREE", degree)
    random.seed(degree)
    links = [(500, i) for i in range(600, 900)] + [(i, 950) for i in range(600, 620)]  # a hub that is not the least of its group
    links += [(i, i + 1) for i in range(1000, 1040)]  # a chain
    links += [(random.randrange(2000, 2400), random.randrange(2000, 2400)) for _ in range(250)]
    links += [(3000, 3000 + i) for i in range(1, 1500)] + [(2999, 3700)]
    rows = [(max(x), min(x)) if random.random() < 0.5 else x for x in links] + links[:50]
    df = spark.createDataFrame(rows, "a long, b long").repartition(3)
    want = {x: r for x, r in brute([x for x in links if x[0] != x[1]]).items()}
    got = [(r.node, r.label) for r in components.components(df).collect()]
    assert dict(got) == want and len(got) == len(want)


def test_no_links(spark):
    assert components.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0

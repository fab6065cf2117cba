import random

import pytest

from lodestrata.llm import components


def brute(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            if x != y:
                up[max(x, y)] = min(x, y)
    return {x: root(x) for x in up}


def run(spark, edges):
    df = spark.createDataFrame(edges, "a string, b string")
    return {r[0]: r[1] for r in components.components(df).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_equals_union_find(spark, seed):
    r = random.Random(seed)
    edges = [(f"n{r.randrange(300):03d}", f"n{r.randrange(300):03d}") for _ in range(180)]
    edges += edges[:20] + [(b, a) for a, b in edges[:20]] + [(None, "n001"), ("n002", None), ("n003", "n003")]
    assert run(spark, edges) == brute(edges)


def test_long_chain_and_star(spark):
    chain = [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(400)]
    random.Random(1).shuffle(chain)
    star = [("z-hub", f"s{i:04d}") for i in range(500)]
    assert run(spark, chain + star) == brute(chain + star)


def test_empty(spark):
    assert run(spark, []) == {}


def test_latest_links(spark):
    rows = [
        (" x", "y ", "Same ", "2024-01-02", 1), ("y", "x", "different", "2024-01-01", 2),  # the later one counts
        ("p", "q", "same", "2024-01-01", 3), ("q", "p", "different", "2024-01-03", 4),
        ("k", "k", "same", "2024-01-01", 5), (None, "x", "same", "2024-01-01", 6), ("m", "n", None, "2024-01-01", 7),
        ("t", "u", "same", None, 8), ("v", "w", "SAME\t", "2024-01-01", 9), ("v", "w", "different", "2024-01-01", 9), (" ", "x", "same", "2024-01-01", 10),
    ]
    df = spark.createDataFrame(rows, "l string, r string, d string, t string, a int").selectExpr("*", "timestamp(t) as at", "1 as w")
    assert sorted(map(tuple, components.latest_links(df, "l", "r", "d", "at").collect())) == [("t", "u"), ("v", "w"), ("x", "y")]

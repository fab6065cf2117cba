import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from lodestrata.llm import entity_splits as es
from lodestrata.operators import forests

from .test_components import brute


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, []), ("", []), ("Unknown", []), ("The Editors", []), ("n/a", []),
        ("Anna Lund; B. Okoro", [("lund", "anna"), ("okoro", "b")]),
        ("Lund, Anna | OKORO, B. & Karl Mo", [("lund", "anna"), ("okoro", "b"), ("mo", "karl")]),
        ("Anna Lund*, B. Okoro¹² and Karl Mo†", [("lund", "anna"), ("okoro", "b"), ("mo", "karl")]),
        ("Lund, A.;et al.", [("lund", "a")]), ("Åsa Löf", [("löf", "åsa")]), ("Lund A.", [("lund", "a")]), ("Y. Chen and E. Y. Wu", [("chen", "y"), ("wu", "e y")]), ("N.N.", []), ("Anna Lund1; others", [("lund", "anna")]),
    ],
)
def test_persons(text, expected):
    assert es.persons(text) == expected


@given(st.text(max_size=60))
def test_persons_never_fails(text):
    for family, _ in es.persons(text):
        assert isinstance(family, str)


@pytest.mark.parametrize("per_task", [7, 50, 10_000])
def test_union_find_at_any_partitioning(spark, per_task):
    r = random.Random(per_task)
    edges = [(f"r{r.randrange(120)}", f"p{r.randrange(90)}") for _ in range(110)] + [("hub", f"p{i}") for i in range(0, 90, 9)]
    got = {x[0]: x[1] for x in forests.union_find(spark.createDataFrame(edges, "a string, b string").repartition(5), per_task).collect()}
    want = brute(edges)
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
    assert groups(got) == groups(want)


def test_union_find_empty(spark):
    assert forests.union_find(spark.createDataFrame([], "a string, b string")).count() == 0


ROWS = [
    ("1", "train", "Anna Lund; B. Okoro"), ("2", "Test", "OKORO, Bo"), ("3", " TRAIN", "A. Lund"), ("4", "held-out", "Zed Quux"), ("5", "Held out", "Quux, Z."),
    ("6", "train", "Unknown"), ("7", "test", None), ("7", "train", ""), (None, "test", "Mia Wu"), ("8", "train", "Mia Wu"), ("9", None, "Bo Okoro"),
]


def test_conflicts(spark):
    df = spark.createDataFrame(ROWS, "id string, split string, authors string").selectExpr("*", "1 as group_id", "'x' as node")
    got = sorted(r[0] for r in es.conflicting_records(es.record_groups(df)).collect())
    assert got == ["1", "2", "3", "7", "8", "9"]


def test_conflicts_empty(spark):
    df = spark.createDataFrame([], "id string, split string, authors string")
    assert es.conflicting_records(es.record_groups(df)).count() == 0


def naive(sizes, shares):
    total, whole = sum(s * n for s, n in sizes), sum(w for _, w in shares)
    gap = {k: total * w / whole for k, w in shares}
    got = {k: 0 for k in gap}
    for s, n in sorted(sizes, reverse=True):
        for _ in range(n):
            k = min(gap, key=lambda k: (-gap[k], k))
            gap[k] -= s
            got[k] += s
    return got


@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 60)), min_size=1, max_size=8, unique_by=lambda x: x[0]))
def test_greedy_equals_simulation(sizes):
    shares = [("a", 0.7), ("b", 0.2), ("c", 0.1)]
    got = {k: 0 for k, _ in shares}
    for size, k, low, high in es.greedy_quotas(sizes, shares):
        got[k] += size * (high - low)
    assert got == naive(sizes, shares)


def test_greedy_closed_form_is_level():
    got = {k: 0 for k in "abc"}
    for size, k, low, high in es.greedy_quotas([(1, 1_000_000), (5, 3)], [("a", 0.7), ("b", 0.2), ("c", 0.1)]):
        got[k] += size * (high - low)
    assert sum(got.values()) == 1_000_015
    assert abs(got["a"] - 700_010) <= 5 and abs(got["b"] - 200_003) <= 5


def test_assignment_keeps_groups_and_shares(spark, tables):
    groups = es.record_groups(spark.read.parquet(f"{tables}/manifest.parquet"))
    out = es.assign_splits(groups, spark.read.parquet(f"{tables}/split_policy.parquet"))
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{tables}/manifest.parquet").count()
    by = {}
    for r in rows:
        assert by.setdefault(r["group_id"], r["assigned"]) == r["assigned"]
    assert es.assign_splits(groups, spark.createDataFrame([], "split string, share double")).count() == 0


def test_first_level_forests_are_bounded():
    import pandas as pd

    edges = pd.DataFrame({"a": [f"r{i}" for i in range(40)], "b": [f"p{i // 2}" for i in range(40)]})
    parts = list(forests.local_forest(iter([edges[i : i + 5] for i in range(0, 40, 5)]), 10))
    assert all(len(p) <= 10 + 10 for p in parts) and sum(map(len, parts)) > 60 and len(parts) > 4


def test_more_splits_than_allowed(spark):
    groups = es.record_groups(spark.createDataFrame([("a", "Anna Lund", "x")], "id string, authors string, split string"))
    with pytest.raises(ValueError, match="splits"):
        es.assign_splits(groups, spark.range(1_001).selectExpr("cast(id as string) as split", "1.0D as share"))

import os
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from lodestrata.llm import packing as pk
from lodestrata.llm.queries import RANKS

needs_vocabulary = pytest.mark.skipif(not os.path.exists(RANKS), reason="the public vocabulary isn't here")


def test_hilbert_neighbours_are_adjacent():
    cells = {}
    for x in range(8):
        for y in range(8):
            cells[pk.hilbert_key([x, y], 3)] = (x, y)
    path = [cells[k] for k in range(64)]
    assert all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(path, path[1:]))


@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 8))
def test_packer_respects_capacity(sizes, most_open):
    p = pk.Packer(50, most_open)
    load = {}
    for at in range(0, len(sizes), 20):
        part = sizes[at : at + 20]
        for s, k in zip(part, p.place(part)):
            load[k] = load.get(k, 0) + s
    assert all(v <= 50 for v in load.values()) and sum(load.values()) == sum(sizes)


@needs_vocabulary
def test_contexts(spark):
    r = random.Random(0)
    rows = [(i, " ".join(r.choice(["flow", "pump", "Größe", "水厂", "🙂", "x" * 30]) for _ in range(r.randrange(1, 400)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "   "), (103, rows[0][1]), (None, "short"), (104, "z" * 30_000), (105, "水" * 3_000)]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as tokens", "'b' as budget_id", "0 as part", "0 as curve")
    budgets = spark.createDataFrame([(1, 64), (2, 1000), (3, None), (None, 50), (2, 900)], "budget_id int, capacity_tokens int")
    out = pk.fill_contexts(d, budgets, RANKS, items_per_range=60).collect()
    texts = dict(rows)
    encode = pk.tokenizer(RANKS).encode_ordinary
    load, parts = {}, {}
    for x in out:
        text = texts[x["doc_id"]][x["start_char"] : x["end_char"]]
        assert x["tokens"] == len(encode(text)) <= {1: 64, 2: 1000}[x["budget_id"]]
        load[x["context_id"]] = load.get(x["context_id"], 0) + x["tokens"]
        parts.setdefault((x["budget_id"], x["doc_id"]), []).append((x["piece"], x["start_char"], x["end_char"]))
    assert all(v <= {"1": 64, "2": 1000}[k[0]] for k, v in load.items())
    for (budget, doc), own in parts.items():
        own.sort()
        assert own[0][1] == 0 and own[-1][2] == len(texts[doc]) and all(a[2] == b[1] for a, b in zip(own, own[1:]))
        if len(encode(texts[doc])) <= {1: 64, 2: 1000}[budget]:
            assert len(own) == 1
    assert {d for b, d in parts if b == 1} == {i for i, t in rows if t}
    assert pk.fill_contexts(d.limit(0), budgets, RANKS).count() == 0
    assert pk.fill_contexts(d, budgets.limit(0), RANKS).count() == 0


def test_ranges_follow_the_curve_and_divide_full_cells():
    cells = [(1, 0, 30), (1, 1, 30), (1, 2, 60), (1, 5, 450), (1, 6, 10), (2, 0, 10), (2, 9, 250)]
    assert pk.ranges_of(cells, 100) == [(1, 0, 0, 1), (1, 1, 0, 1), (1, 2, 1, 1), (1, 5, 2, 5), (1, 6, 7, 1), (2, 0, 8, 1), (2, 9, 9, 3)]
    assert pk.ranges_of([], 100) == []


@needs_vocabulary
def test_contexts_are_full_and_named_alike_in_every_run(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    budgets = spark.read.parquet("/root/testdata/sf0.01/judge_budgets.parquet")
    runs = [pk.fill_contexts(x, budgets, RANKS, items_per_range=1_500).collect() for x in (d, d.repartition(7))]
    assert sorted(map(tuple, runs[0])) == sorted(map(tuple, runs[1]))
    capacity = dict(budgets.select("budget_id", "capacity_tokens").collect())
    for b, c in capacity.items():
        own = [r for r in runs[0] if r["budget_id"] == b]
        assert sum(r["tokens"] for r in own) / (c * len({r["context_id"] for r in own})) > 0.96


def test_more_budgets_than_allowed(spark):
    many = spark.range(1_001).selectExpr("cast(id as int) as budget_id", "10 as capacity_tokens")
    with pytest.raises(ValueError, match="budgets"):
        pk.fill_contexts(spark.createDataFrame([(1, "a")], "doc_id long, text string"), many, RANKS)

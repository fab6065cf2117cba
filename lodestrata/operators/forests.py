"""Connected groups by union-find: local forests per task, merged hierarchically over the nodes that several have.

Every task builds the forest of its own edges and keeps only the stars of that forest; nodes that occur in several
forests give the edges of a smaller graph between local roots, which is partitioned by node, solved and merged in the
same way, level by level, until one level has no such nodes. A task never holds more than about ``edges_per_task``
edges, hot nodes are spread over the tasks, and each level merges every node that still has an edge, so the graph
shrinks by at least half per level whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.skew import hot_keys, split_join
from lodestrata.sources.scratch import Scratch, rows as row_count


def local_forest(batches: Iterator[pd.DataFrame], most_nodes: int | None = None) -> Iterator[pd.DataFrame]:
    """Union-find over one partition's edges: a row for each node, with the smallest node of its local tree.

    With ``most_nodes`` a forest of so many nodes is given out and a new one begun; what both have is merged later.
    """
    ids: dict[str, int] = {}
    names: list[str] = []
    up: list[int] = []

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def grown() -> Iterator[pd.DataFrame]:
        for at in range(0, len(names), 50_000):
            part = range(at, min(at + 50_000, len(names)))
            yield pd.DataFrame({"node": [names[i] for i in part], "root": [names[root(i)] for i in part]})

    for b in batches:
        for x, y in zip(b["a"], b["b"]):
            pair = []
            for z in (x, y):
                if (i := ids.get(z)) is None:
                    i = ids[z] = len(names)
                    names.append(z)
                    up.append(i)
                pair.append(root(i))
            i, j = pair
            if i != j:
                if names[i] < names[j]:
                    up[j] = i
                else:
                    up[i] = j
            if most_nodes and len(names) >= most_nodes:
                yield from grown()
                ids.clear()
                names.clear()
                up.clear()
    yield from grown()


def union_find(edges: DataFrame, edges_per_task: int = 200_000) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is one node of the component, the same for all of it.

    Local forests merged hierarchically; see the module. Rows with a null end are ignored.
    """
    scratch = Scratch(edges.sparkSession, "forest")
    graph = scratch.put(edges.select("a", "b").where("a is not null and b is not null"))
    levels: list[tuple[DataFrame, int]] = []
    while n := row_count(graph):
        tasks = -(-n // edges_per_task)
        if levels:
            hot = hot_keys(graph, "a", n)
            salt = F.when(F.col("a").isin(hot), F.pmod(F.xxhash64("b"), F.lit(tasks))).otherwise(F.lit(0)) if hot else F.lit(0)
            graph = graph.repartition(tasks, F.col("a"), salt) if tasks > 1 else graph.coalesce(1)
        # The first level takes the edges where they lie, in forests of bounded size, without a shuffle.
        grow = local_forest if levels else partial(local_forest, most_nodes=edges_per_task)
        local = scratch.put(graph.mapInPandas(grow, "node string, root string"))
        merged = scratch.put(local.groupBy("node").agg(F.min("root").alias("least"), F.max("root").alias("most")))
        levels.append((merged.select("node", F.col("least").alias("root")), row_count(merged)))
        torn = merged.where("least <> most").select("node", "least")
        graph = scratch.put(split_join(local, torn, "node", row_count(local)).where("root <> least").select(F.col("least").alias("a"), F.col("root").alias("b")).distinct())
        scratch.forget(local)
    if not levels:
        return edges.sparkSession.createDataFrame([], "node string, root string")
    labels, _ = levels.pop()
    while levels:
        lower, n = levels.pop()
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("top"))
        labels = scratch.put(split_join(lower, up, "root", n, "left").select("node", F.coalesce("top", "root").alias("root")))
    return labels

"""Connected components for entity merges, by the forests of ``operators.forests``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.skew import split_join
from lodestrata.operators.forests import union_find
from lodestrata.sources.scratch import Scratch, rows


def connected_components(edges: DataFrame, left: str, right: str, edges_per_task: int = 200_000) -> DataFrame:
    """``(node, component)`` of every node of an edge; the component is its least node.

    Null ends, self edges and repeats are ignored; an empty table gives no rows.
    """
    pairs = edges.select(F.least(left, right).cast("string").alias("a"), F.greatest(left, right).cast("string").alias("b")).where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right))).distinct()
    scratch = Scratch(edges.sparkSession, "components")
    found = scratch.put(union_find(pairs, edges_per_task))
    least = found.groupBy("root").agg(F.min("node").alias("component"))
    return split_join(found, least, "root", rows(found)).select("node", "component")

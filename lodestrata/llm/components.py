"""Consolidating pairwise matches into groups: deterministic Borůvka hooking over string keys.

A match log is reduced to one verdict for each unordered pair (the latest review), and the linked pairs to groups.
In each round every component selects its smallest outgoing edge, the trees so formed collapse by pointer doubling,
and the edges are relabelled and deduplicated, until none remain. An edge's weight is the ordered pair of its
component labels, so weights are distinct, selected edges form trees with one mutual edge each, and the smaller end
of that edge is the smallest label of its tree: a component's label is always its smallest member.

Each round at least halves the components with edges left, so there are at most log2(vertices) rounds of at most
log2(tree depth) doublings. Every round works on the contracted graph only and is written to the shared folder; the
labels of all rounds are composed once, from the last to the first. Components that hold a large share of the edges
are joined by a bounded broadcast instead of a shuffle (``functions.skew``). Nothing is collected but row counts, which are
taken while the tables are written, and at most 256 hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.skew import split_join
from lodestrata.sources.scratch import Scratch, rows

#: Every code point of white space, and the byte-order mark that stands for one at the ends of exported ids.
_BLANKS = "".join(chr(c) for c in range(0x10000) if chr(c).isspace()) + "\ufeff"


def bare(col) -> F.Column:
    """A string without surrounding white space."""
    return F.btrim(col, F.lit(_BLANKS))


def latest_links(log: DataFrame, left: str, right: str, decision: str, at: str, same: str = "same") -> DataFrame:
    """Pairs ``a < b`` whose latest row says ``same``.

    Ids are compared without surrounding white space, decisions also without case. Rows with a null or blank id or
    twice the same id are left out; a null decision is a decision other than ``same``; a null time is older than any
    other, and of rows with equal times one that says ``same`` counts. One number per pair carries both the time and
    the decision, so the reduction is a hash aggregate with map-side combining.
    """
    a, b = bare(F.col(left)), bare(F.col(right))
    when = F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit(-(1 << 61)))
    linked = F.coalesce((F.lower(bare(F.col(decision))) == F.lit(same)).cast("long"), F.lit(0))
    return (
        log.select(a.alias("x"), b.alias("y"), (when * 2 + linked).alias("w"))
        .where("x <> y and x <> '' and y <> ''")
        .groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .agg(F.max("w").alias("w"))
        .where(F.expr("pmod(w, 2) = 1"))
        .select("a", "b")
    )


def components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(member, label)`` of every id in ``pairs``; the label is the smallest id of its group.

    Null ids and self pairs are ignored, repeated pairs in either order count once, an empty input gives no rows.
    """
    spark, scratch = pairs.sparkSession, Scratch(pairs.sparkSession, "components")
    x, y = F.col(a), F.col(b)
    edges = scratch.put(pairs.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct())
    levels: list[tuple[DataFrame, int]] = []
    while n := rows(edges):
        hooks = _hook(edges, scratch)
        parents = _collapse(hooks, scratch)
        levels.append((parents, rows(hooks)))
        there = split_join(edges.withColumnRenamed("a", "u"), parents, "u", n).select(F.col("label").alias("a"), "b")
        again = split_join(there.withColumnRenamed("b", "u"), parents, "u", n).select("a", F.col("label").alias("b"))
        again = again.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        new = scratch.put(again)
        scratch.forget(edges)
        edges = new
    if not levels:
        return spark.createDataFrame([], "member string, label string")
    labels, _ = levels.pop()
    while levels:
        parents, n = levels.pop()
        up = labels.select(F.col("u").alias("label"), F.col("label").alias("top"))
        new = scratch.put(split_join(parents, up, "label", n, "left").select("u", F.coalesce("top", "label").alias("label")))
        scratch.forget(labels, parents)
        labels = new
    return labels.select(F.col("u").alias("member"), "label")


def _hook(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(u, label)``: each component's other end of its smallest outgoing edge; of a mutual choice the smaller is root."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e"))
    return scratch.put(ends.groupBy("e.u").agg(F.min("e.v").alias("label")).select("u", "label"))


def _collapse(hooks: DataFrame, scratch: Scratch) -> DataFrame:
    """``(u, label)`` with the root of each tree, by pointer doubling; the smaller end of a mutual choice points to itself."""
    n = rows(hooks)
    back = hooks.select(F.col("u").alias("label"), F.col("label").alias("back"))
    rooted = split_join(hooks, back, "label", n)
    parents = scratch.put(rooted.select("u", F.when((F.col("back") == F.col("u")) & (F.col("u") < F.col("label")), F.col("u")).otherwise(F.col("label")).alias("label")))
    scratch.forget(hooks)
    while True:
        up = parents.select(F.col("u").alias("label"), F.col("label").alias("next"))
        new = split_join(parents, up, "label", n).select("u", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved"))
        new = scratch.put(new, moved=F.count_if("moved"))
        scratch.forget(parents)
        parents = new
        if not parents._seen["moved"]:
            out = parents.select("u", "label")
            out._scratch_path = parents._scratch_path
            return out

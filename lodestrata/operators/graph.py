"""The property graph as tables: checks, upserts by document, summaries and patterns.

Nodes are ``(entity_id, label, name)``, mentions ``(entity_id, document_id, mention_id, surface)``, edges ``(source,
predicate, target, document_id)``. A node's arrays are a view over its mentions, so replacing a document's part is a
filter and a union, never a rewrite of other documents' arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.operators.entities import PROVENANCE_LABELS, SCOPED_LABELS


def node_problems(nodes: DataFrame) -> DataFrame:
    """``(entity_id, code)``: missing ids and labels, unsafe labels, provenance labels, and names that two nodes of a label share."""
    bad = nodes.select("entity_id", F.explode(F.array_compact(F.array(
        F.when(F.coalesce("entity_id", F.lit("")) == "", F.lit("missing_id")),
        F.when(F.coalesce("label", F.lit("")) == "", F.lit("missing_label")),
        F.when(~F.col("label").rlike("^[A-Za-z_][A-Za-z0-9_]*$") & (F.col("label") != ""), F.lit("unsafe_label")),
        F.when(F.col("label").isin(*PROVENANCE_LABELS), F.lit("provenance_label")),
    ))).alias("code"))
    named = nodes.where(~F.col("label").isin(*SCOPED_LABELS)).withColumn("_n", F.lower(F.trim("name"))).where("_n <> ''")
    shared = named.groupBy("label", "_n").agg(F.count_distinct("entity_id").alias("_c")).where("_c > 1").select("label", "_n")
    return bad.unionByName(named.join(shared, ["label", "_n"], "left_semi").select("entity_id", F.lit("duplicate_name").alias("code")))


def edge_problems(edges: DataFrame, nodes: DataFrame, predicates: DataFrame) -> DataFrame:
    """``(source, predicate, target, code)``: unknown predicates and missing ends."""
    ids = nodes.select("entity_id").distinct()
    unknown = edges.join(predicates.select("predicate").distinct(), "predicate", "left_anti").select("source", "predicate", "target", F.lit("unknown_predicate").alias("code"))
    lost = [edges.join(ids.withColumnRenamed("entity_id", end), end, "left_anti").select("source", "predicate", "target", F.lit(f"missing_{end}").alias("code")) for end in ("source", "target")]
    return unknown.unionByName(lost[0]).unionByName(lost[1])


def upsert(nodes: DataFrame, mentions: DataFrame, edges: DataFrame, new_nodes: DataFrame, new_mentions: DataFrame, new_edges: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The graph after the documents of ``documents(document_id)`` were written anew.

    Their mentions and edges are replaced; nodes that only they mentioned and mention no more are deleted with their
    edges; a node that others mention keeps those mentions; a new node's label and name win over the old ones.
    Repeating an upsert changes nothing.
    """
    kept_mentions = mentions.join(documents, "document_id", "left_anti")
    all_mentions = kept_mentions.unionByName(new_mentions)
    touched = mentions.join(documents, "document_id", "left_semi").select("entity_id").distinct()
    alive = all_mentions.select("entity_id").distinct()
    gone = touched.join(alive, "entity_id", "left_anti")
    merged = nodes.withColumn("_new", F.lit(0)).unionByName(new_nodes.withColumn("_new", F.lit(1)))
    merged = merged.groupBy("entity_id").agg(F.max_by(F.struct("label", "name"), F.struct("_new", "label", "name")).alias("_v")).select("entity_id", "_v.label", "_v.name")
    all_nodes = merged.join(gone, "entity_id", "left_anti")
    all_edges = edges.join(documents, "document_id", "left_anti").unionByName(new_edges).distinct()
    for end in ("source", "target"):
        all_edges = all_edges.join(gone.withColumnRenamed("entity_id", end), end, "left_anti")
    return all_nodes, all_mentions.distinct(), all_edges.select(*edges.columns)


def align_identities(new_nodes: DataFrame, nodes: DataFrame, mentions: DataFrame) -> DataFrame:
    """``(entity_id, aligned_id)``: a new node with the label and name of an existing one takes its id, that mentioned in most documents, then the least."""
    weight = mentions.groupBy("entity_id").agg(F.count_distinct("document_id").alias("_d"))
    old = nodes.join(weight, "entity_id", "left").select("label", F.lower(F.trim("name")).alias("_n"), F.col("entity_id").alias("_id"), F.coalesce("_d", F.lit(0)).alias("_d"))
    best = old.groupBy("label", "_n").agg(F.min_by("_id", F.struct((-F.col("_d")).alias("d"), "_id")).alias("aligned_id"))
    return new_nodes.select("entity_id", "label", F.lower(F.trim("name")).alias("_n")).join(best, ["label", "_n"], "left").select("entity_id", F.coalesce("aligned_id", "entity_id").alias("aligned_id"))


def mention_surfaces(mentions: DataFrame) -> DataFrame:
    """``(entity_id, surface, mentions)``: every surface of each entity and how often it stands for it."""
    return mentions.where("surface is not null").groupBy("entity_id", "surface").agg(F.count(F.lit(1)).alias("mentions"))


def mention_arrays(mentions: DataFrame, most: int = 1000) -> DataFrame:
    """The view with parallel arrays: per entity its first ``most`` mentions in order with their documents, its first ``most`` surfaces in order, and counts of all.

    An entity that most documents mention keeps the rest in the mention table, and its surfaces in ``mention_surfaces``.
    """
    first = lambda rows, order: rows.withColumn("_n", F.row_number().over(Window.partitionBy("entity_id").orderBy(*order))).where(F.col("_n") <= most)
    order = ["document_id", "mention_id", "surface"]
    arrays = first(mentions, order).groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("_m"))
    known = mention_surfaces(mentions)
    surfaces = first(known, ["surface"]).groupBy("entity_id").agg(F.array_sort(F.collect_list("surface")).alias("_s"))
    counts = mentions.groupBy("entity_id").agg(F.count(F.lit(1)).alias("mentions"), F.count_distinct("document_id").alias("documents"), F.count_distinct("surface").alias("surface_count"))
    out = arrays.join(counts, "entity_id").join(surfaces, "entity_id", "left")
    return out.select("entity_id", F.transform("_m", lambda x: x["mention_id"]).alias("mention_ids"), F.transform("_m", lambda x: x["document_id"]).alias("document_ids"), F.coalesce("_s", F.array().cast("array<string>")).alias("surfaces"), "mentions", "documents", "surface_count")


def summary(nodes: DataFrame, mentions: DataFrame, edges: DataFrame) -> DataFrame:
    """``(label, nodes, mentions, edges_out, orphans)`` for each label."""
    m = mentions.groupBy("entity_id").agg(F.count(F.lit(1)).alias("_m"))
    out = edges.groupBy(F.col("source").alias("entity_id")).agg(F.count(F.lit(1)).alias("_o"))
    joined = edges.select(F.explode(F.array("source", "target")).alias("entity_id")).distinct().withColumn("_e", F.lit(1))
    n = nodes.join(m, "entity_id", "left").join(out, "entity_id", "left").join(joined, "entity_id", "left")
    return n.groupBy("label").agg(F.count(F.lit(1)).alias("nodes"), F.sum(F.coalesce("_m", F.lit(0))).alias("mentions"), F.sum(F.coalesce("_o", F.lit(0))).alias("edges_out"), F.count_if(F.col("_e").isNull()).alias("orphans"))


def verify(nodes: DataFrame, mentions: DataFrame, edges: DataFrame) -> DataFrame:
    """``(check, count)`` of what must be 0 after a write: nodes without mentions, mentions and edges without nodes, loops, repeated ids."""
    ids = nodes.select("entity_id").distinct()
    one = lambda name, df: df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias("check"), "count")
    ends = edges.select(F.explode(F.array("source", "target")).alias("entity_id"))
    return (
        one("nodes_without_mentions", nodes.join(mentions.select("entity_id").distinct(), "entity_id", "left_anti"))
        .unionByName(one("mentions_without_node", mentions.join(ids, "entity_id", "left_anti")))
        .unionByName(one("edge_ends_without_node", ends.join(ids, "entity_id", "left_anti")))
        .unionByName(one("loops", edges.where("source = target")))
        .unionByName(one("repeated_ids", nodes.groupBy("entity_id").count().where("count > 1")))
    )


def typed_edges(edges: DataFrame, nodes: DataFrame, predicate: str | None = None) -> DataFrame:
    """Edges with names and labels of both ends."""
    n = nodes.select("entity_id", "label", "name")
    s = n.select(F.col("entity_id").alias("source"), F.col("label").alias("source_label"), F.col("name").alias("source_name"))
    t = n.select(F.col("entity_id").alias("target"), F.col("label").alias("target_label"), F.col("name").alias("target_name"))
    e = edges.where(F.col("predicate") == predicate) if predicate else edges
    return e.join(s, "source").join(t, "target")


def neighbourhood(edges: DataFrame, nodes: DataFrame, label: str) -> DataFrame:
    """``(entity_id, neighbour, predicate)`` of every node of a label, in either direction."""
    both = edges.select(F.col("source").alias("entity_id"), F.col("target").alias("neighbour"), "predicate").unionByName(edges.select(F.col("target").alias("entity_id"), F.col("source").alias("neighbour"), "predicate"))
    return both.join(nodes.where(F.col("label") == label).select("entity_id").distinct(), "entity_id", "left_semi").distinct()


def display_properties(nodes: DataFrame, most: int = 40) -> DataFrame:
    """Adds ``display``: the name, else the id, at most ``most`` characters, underscores as blanks."""
    text = F.replace(F.coalesce(F.when(F.trim("name") != "", F.col("name")), F.col("entity_id")), F.lit("_"), F.lit(" "))
    return nodes.withColumn("display", F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most - 1)), F.lit("…"))).otherwise(text))

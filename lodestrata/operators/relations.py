"""Assertions, relationships and the ontology that permits them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.ids import stable_id
from lodestrata.operators.windows import best_per_key
from lodestrata.sources.scratch import grown


def dedupe_assertions(assertions: DataFrame, keys: list[str], confidence: str, order: str) -> DataFrame:
    """The most confident assertion of each key, of equals the first in order."""
    return best_per_key(assertions, keys, F.struct(F.col(confidence), (-F.col(order)).alias("_o")))


def endpoints(assertions: DataFrame, mention_entities: DataFrame) -> DataFrame:
    """Assertions with their entities at both ends; without those whose ends have none, and without loops."""
    m = mention_entities.select("mention_id", "entity_id").distinct()
    s = m.select(F.col("mention_id").alias("subject_mention_id"), F.col("entity_id").alias("subject_entity_id"))
    o = m.select(F.col("mention_id").alias("object_mention_id"), F.col("entity_id").alias("object_entity_id"))
    return assertions.join(s, "subject_mention_id").join(o, "object_mention_id").where("subject_entity_id <> object_entity_id")


def supporting(assertions: DataFrame, keys: list[str], evidence: str, confidence: str, assertion_id: str) -> DataFrame:
    """``(keys, evidence, assertion_id)``: the most confident assertion (then that of the largest id) of each unit of evidence."""
    return assertions.groupBy(*keys, evidence).agg(F.max_by(assertion_id, F.struct(F.col(confidence), F.col(assertion_id))).alias(assertion_id))


def materialize(assertions: DataFrame, keys: list[str], evidence: str, confidence: str, assertion_id: str, most: int = 10) -> DataFrame:
    """Relationships: how many units of evidence support each key, and the first ``most`` of their assertions in order.

    A key may hold a large part of the assertions, so the rest stays in the table that ``supporting`` gives.
    """
    unit = supporting(assertions, keys, evidence, confidence, assertion_id)
    count = unit.groupBy(*keys).agg(F.count(F.lit(1)).alias("support_count"))
    first = unit.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(assertion_id))).where(F.col("_n") <= most)
    first = first.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(assertion_id)), ",").alias("assertion_ids"))
    return count.join(first, keys).withColumn("relationship_id", stable_id("relationship", *keys))


def ancestors(parents: DataFrame, child: str = "label", parent: str = "parent") -> DataFrame:
    """``(label, ancestor)``: the reflexive closure of a hierarchy of any depth; members of a cycle are each other's ancestors."""
    edge = parents.where(F.col(child).isNotNull() & F.col(parent).isNotNull()).select(F.col(child).alias("label"), F.col(parent).alias("ancestor")).distinct()
    above = edge.select(F.col("label").alias("_l"), F.col("ancestor").alias("_a"))
    own = parents.select(F.explode(F.array(child, parent)).alias("label")).where("label is not null").select("label", F.col("label").alias("ancestor"))
    return grown(own, lambda new: new.join(above, new["ancestor"] == above["_l"]).select("label", F.col("_a").alias("ancestor")), "closure")


def domain_range_violations(edges: DataFrame, closure: DataFrame, permitted: DataFrame) -> DataFrame:
    """Edges ``(edge_id, subject_label, predicate, object_label)`` that no permitted ``(predicate, domain, range)`` covers, subclasses counting as their ancestors.

    Decided once for each distinct (label, predicate, label).
    """
    kinds = edges.select("subject_label", "predicate", "object_label").distinct()
    a, b = closure.select(F.col("label").alias("subject_label"), F.col("ancestor").alias("domain")), closure.select(F.col("label").alias("object_label"), F.col("ancestor").alias("range"))
    ok = kinds.join(a, "subject_label").join(b, "object_label").join(permitted, ["predicate", "domain", "range"]).select("subject_label", "predicate", "object_label").distinct()
    return edges.join(ok, ["subject_label", "predicate", "object_label"], "left_anti")


def eligible_predicates(labels: DataFrame, closure: DataFrame, permitted: DataFrame) -> DataFrame:
    """Predicates that some available label fits at each end."""
    have = labels.select("label").distinct().join(closure, "label").select("ancestor").distinct()
    return permitted.join(have.withColumnRenamed("ancestor", "domain"), "domain", "left_semi").join(have.withColumnRenamed("ancestor", "range"), "range", "left_semi").select("predicate").distinct()


def schema_edges(predicates: DataFrame) -> DataFrame:
    """``(predicate, domain, range)`` of predicates with arrays of domains and ranges."""
    return predicates.select("predicate", F.explode("domains").alias("domain"), "ranges").select("predicate", "domain", F.explode("ranges").alias("range")).distinct()


def ontology_tables(nodes: DataFrame, predicates: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(classes, edges, counts)`` of an ontology: its classes, the schema edges of its predicates whose ends are classes, and how many there are against what was expected."""
    classes = nodes.where(F.trim("label") != "").select("label").distinct()
    wanted = schema_edges(predicates)
    edges = wanted.join(classes.withColumnRenamed("label", "domain"), "domain", "left_semi").join(classes.withColumnRenamed("label", "range"), "range", "left_semi")
    one = lambda name, t: t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
    return classes, edges, one("classes", classes).unionByName(one("schema_edges", edges)).unionByName(one("expected_edges", wanted))


def repair_endpoints(missing: DataFrame, mentions: DataFrame, key: str, text: str) -> DataFrame:
    """Each missing endpoint with the one mention of its document whose surface or name equals its text, in any case; none if several do."""
    names = mentions.select("document_id", "mention_id", F.explode(F.array_distinct(F.array(F.lower("surface_text"), F.lower("canonical_name")))).alias("_t")).where("_t is not null")
    one = names.groupBy("document_id", "_t").agg(F.min("mention_id").alias("mention_id"), F.count_distinct("mention_id").alias("_n")).where("_n = 1").drop("_n")
    return missing.withColumn("_t", F.lower(F.trim(text))).join(one, ["document_id", "_t"], "left").select(key, "document_id", "mention_id")


def authorship(publications: DataFrame, persons: DataFrame, document: str = "document_id") -> DataFrame:
    """AUTHORED_BY edges of each document's publication to its persons; the persons of a document are few."""
    return publications.select(document, F.col("mention_id").alias("subject_mention_id")).join(persons.select(document, F.col("mention_id").alias("object_mention_id")), document).withColumn("predicate", F.lit("AUTHORED_BY"))

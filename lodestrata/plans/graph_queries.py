"""Queries of the relation, graph and evaluation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.operators import decisions, discovery, evaluation, graph, layout, relations, vector_search, windows


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _log(spark: SparkSession, sf: str) -> DataFrame:
    t = _read(spark, sf, "entity_resolution_decisions")
    strip = lambda c: F.btrim(F.col(c), F.lit(" \t\n\r"))
    return t.select("decision_id", "run_id", F.lower(strip("decision")).alias("decision"), "label", strip("left_entity_id").alias("left_id"), strip("right_entity_id").alias("right_id"), "left_name", "right_name", "reviewed_at")


_HIERARCHY = [("Tool", "Artifact"), ("AISystem", "Artifact"), ("Model", "AISystem"), ("Dataset", "Artifact"), ("Artifact", "Thing"), ("Organization", "Agent"), ("Agent", "Thing"), ("Metric", "Thing"), ("InfrastructureAsset", "Thing"), ("TreatmentProcess", "Process"), ("Process", "Thing")]
_PERMITTED = [("same", "Artifact", "Artifact"), ("same", "Agent", "Agent"), ("different", "Thing", "Artifact"), ("pending", "AISystem", "Thing"), ("unsure", "Process", "Process")]


def _ontology(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return relations.ancestors(spark.createDataFrame(_HIERARCHY, "label string, parent string")), spark.createDataFrame(_PERMITTED, "predicate string, domain string, range string")


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    """Each entity's label, that of its latest export."""
    return _read(spark, sf, "entities").where("entity_id is not null").groupBy("entity_id").agg(F.max_by("label", F.struct("updated_at", "label")).alias("label"))


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    lab = _labels(spark, sf)
    log = _log(spark, sf).where("left_id <> right_id and decision is not null")
    e = log.select(F.col("decision_id").alias("edge_id"), F.col("decision").alias("predicate"), "left_id", "right_id")
    e = e.join(lab.select(F.col("entity_id").alias("left_id"), F.col("label").alias("subject_label")), "left_id")
    return e.join(lab.select(F.col("entity_id").alias("right_id"), F.col("label").alias("object_label")), "right_id")


def domain_range_violations(spark, sf):
    closure, permitted = _ontology(spark)
    v = relations.domain_range_violations(_edges(spark, sf), closure, permitted)
    return v.groupBy("subject_label", "predicate", "object_label").agg(F.count(F.lit(1)).alias("edges"))


def eligible_predicates(spark, sf):
    closure, permitted = _ontology(spark)
    return relations.eligible_predicates(_labels(spark, sf), closure, permitted)


def ancestor_closure(spark, sf):
    return _labels(spark, sf).select("label").distinct().join(_ontology(spark)[0], "label")


def schema_edges(spark, sf):
    t = _read(spark, sf, "entities").groupBy(F.col("status").alias("predicate")).agg(F.collect_set("label").alias("domains"), F.collect_set(F.substring("label", 1, 1)).alias("ranges")).where("predicate is not null")
    return relations.schema_edges(t)


def assertion_dedupe(spark, sf):
    a = _read(spark, sf, "lineitem").withColumn("seq", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    out = relations.dedupe_assertions(a, ["l_suppkey", "l_partkey", "l_returnflag"], "l_discount", "seq")
    return out.select("l_suppkey", "l_partkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_discount")


def _assertions(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_partkey", F.col("l_orderkey").alias("evidence"), "l_discount", F.concat_ws("-", "l_orderkey", F.lpad(F.col("l_linenumber").cast("string"), 3, "0"), F.lpad(F.col("l_quantity").cast("int").cast("string"), 3, "0")).alias("assertion_id"))


def relationship_support(spark, sf):
    return relations.materialize(_assertions(spark, sf), ["l_suppkey", "l_returnflag", "l_partkey"], "evidence", "l_discount", "assertion_id")


def supporting(spark, sf):
    return relations.supporting(_assertions(spark, sf), ["l_suppkey", "l_returnflag", "l_partkey"], "evidence", "l_discount", "assertion_id")


def relationship_gates(spark, sf):
    p = _read(spark, sf, "lineitem").join(_read(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    p = p.withColumn("decision", F.when(F.col("l_returnflag") == "R", "reject").otherwise("accept")).withColumn("confidence", F.lit(1.0) - F.col("l_discount") * 4)
    g = {
        "confirmed": F.col("decision") == "accept", "endpoints_resolved": F.col("o_orderkey").isNotNull() & (F.col("l_quantity") > 2), "nodes_accepted": F.col("o_orderkey").isNotNull(),
        "endpoint_text_exact": F.col("l_tax") < 0.07, "not_self": F.col("l_partkey") != F.col("l_suppkey"), "predicate_permitted": F.col("o_orderpriority") != "5-LOW", "domain_range": F.col("o_orderstatus") != "P",
        "trigger_exact": F.col("l_linestatus").isNotNull(), "not_negated": F.col("l_tax") > 0, "not_modal": F.col("l_quantity") < 49, "not_hypothetical": F.col("l_linenumber") < 7, "attribution_accepted": F.col("l_extendedprice") > 1000,
    }
    out = decisions.relation_status(p, g)
    return out.groupBy("l_returnflag", "status").agg(F.count(F.lit(1)).alias("proposals"), F.sum(F.size("failed_gates")).alias("failed"))


def unknown_endpoints(spark, sf):
    known = _labels(spark, sf).select("entity_id")
    p = _log(spark, sf).where("left_id is not null and right_id is not null")
    p = p.join(known.select(F.col("entity_id").alias("left_id"), F.lit(True).alias("l")), "left_id", "left").join(known.select(F.col("entity_id").alias("right_id"), F.lit(True).alias("r")), "right_id", "left")
    p = p.withColumn("at", F.struct("reviewed_at", "decision_id")).where("l is null or r is null")
    roles = F.array_compact(F.array(F.when(F.col("l").isNull(), F.lit("head")), F.when(F.col("r").isNull(), F.lit("tail"))))
    return decisions.unknown_endpoints(p, roles, ["left_id", "right_id"], "at").select("left_id", "right_id", "role", "decision_id")


def endpoint_repair(spark, sf):
    e = _read(spark, sf, "entities").where("entity_id is not null").select(F.lit("all").alias("document_id"), F.col("entity_id").alias("mention_id"), F.col("canonical_name").alias("surface_text"), F.coalesce(F.try_element_at("aliases", F.lit(1)), F.col("canonical_name")).alias("canonical_name")).distinct()
    m = _log(spark, sf).where("left_id is null").select("decision_id", F.lit("all").alias("document_id"), "left_name").distinct()
    return relations.repair_endpoints(m, e, "decision_id", "left_name").select("decision_id", "mention_id")


def authorship(spark, sf):
    m = _read(spark, sf, "manifest").where("id is not null").select("id", F.col("title").alias("t"), F.explode(F.split("authors", ";")).alias("a")).select("id", "t", F.trim("a").alias("a")).where("a <> ''").distinct()
    pubs = m.select(F.col("id").alias("document_id"), F.concat(F.lit("pub:"), "id").alias("mention_id")).distinct()
    people = m.select(F.col("id").alias("document_id"), F.concat(F.lit("person:"), "a").alias("mention_id")).distinct()
    return relations.authorship(pubs, people)


def title_match(spark, sf):
    """Each section title with the expected title that shares most words; expectations are a fixed short list."""
    want = ["results and discussion", "network calibration", "limits of the study", "sensor layout"]
    t = _read(spark, sf, "documents").where("section_title is not null").select(F.lower("section_title").alias("title")).distinct()
    words = lambda c: F.array_distinct(F.split(c, " "))
    score = lambda e: F.size(F.array_intersect(words("title"), words(e))) / F.size(F.array_union(words("title"), words(e)))
    best = F.array_max(F.array(*[F.struct(score(F.lit(e)).alias("score"), F.lit(e).alias("expected")) for e in want]))
    return t.withColumn("b", best).select("title", F.col("b.expected").alias("expected"), F.round("b.score", 6).alias("score"))


def competency_questions(spark, sf):
    q = spark.createDataFrame([("tools", "Tool"), ("systems", "AISystem"), ("systems", "Model"), ("data", "Dataset"), ("metrics", "Metric"), ("limits", "Limitation")], "question string, predicate string")
    r = _log(spark, sf).select(F.col("decision_id").alias("relationship_id"), F.col("label").alias("predicate"), F.col("left_name").alias("answer"))
    e = _log(spark, sf).select(F.col("decision_id").alias("relationship_id"), F.col("right_name").alias("quote"))
    return evaluation.answer_questions(r.distinct(), e.distinct(), q)


def semantic_completeness(spark, sf):
    s = _read(spark, sf, "documents").where("text is not null")
    sig = {"introduced_system": ("(?i)\\b(introduc|propos|develop)(e|es|ed|ing)\\b", "AISystem", 1), "named_models": ("\\b(model|network|solver)\\b", "Model", 100_000), "releases": ("Release v\\d", "Tool", 5), "never": ("zzzzqq", "Tool", 1)}
    return evaluation.completeness(s, sig, _labels(spark, sf))


def orphans(spark, sf):
    log = _log(spark, sf)
    ends = log.select(F.explode(F.array("left_id", "right_id")).alias("entity_id"))
    return evaluation.orphans(_labels(spark, sf), ends, "entity_id")


def usage_rollup(spark, sf):
    e = _read(spark, sf, "events")
    return evaluation.usage_rollup(e, "event_type", {"users": F.count_distinct("user_id"), "total": F.round(F.sum("value"), 2), "largest": F.max("value")})


def status_pivot(spark, sf):
    return evaluation.status_counts(_log(spark, sf).where("label is not null"), "label", "decision", ["same", "different", "not_same", "pending", "unsure"])


def validation_codes(spark, sf):
    log = _log(spark, sf)
    checks = {"null_id": F.col("left_id").isNull() | F.col("right_id").isNull(), "self_pair": F.col("left_id") == F.col("right_id"), "no_decision": F.col("decision").isNull(), "unknown_decision": ~F.col("decision").isin("same", "different", "not_same", "pending", "unsure"), "no_label": F.col("label").isNull(), "no_time": F.col("reviewed_at").isNull()}
    return evaluation.violations(log, checks).unionByName(evaluation.duplicate_ids(log, "decision_id", "repeated_decision_id"))


def rejection_histogram(spark, sf):
    return evaluation.histogram(_read(spark, sf, "reference_resolution_ignored"), "reason")


def split_counts(spark, sf):
    m = _read(spark, sf, "manifest").withColumn("split", F.regexp_replace(F.lower("split"), "[\\s-]+", ""))
    return m.groupBy("split").agg(F.count(F.lit(1)).alias("papers"), F.count_distinct("sha256").alias("files"), F.count_if(~F.col("sha256").rlike("^[0-9a-f]{64}$")).alias("bad_checksums"))


def document_profile(spark, sf):
    p = {"simulation": "(?i)\\b(simulation|solver|calibration)\\b", "sensing": "(?i)\\b(sensor|sampling|meter)\\b", "treatment": "(?i)\\b(clarifier|osmosis|membrane|digester)\\b"}
    return evaluation.document_profile(_read(spark, sf, "documents"), "doc_id", p)


def regression_gate(spark, sf):
    e = _read(spark, sf, "entities").select(F.col("label").alias("paper"), F.col("canonical_name").alias("name"))
    r = _log(spark, sf).where("label is not null and left_name is not null").select(F.col("label").alias("paper"), F.col("left_name").alias("name"), F.when(F.col("decision") == "different", "forbidden").otherwise("required").alias("kind")).distinct()
    return evaluation.regression_gate(e, r)


def traceability(spark, sf):
    m = _read(spark, sf, "reference_resolution_ignored")
    s = F.col("source")
    return evaluation.traceability(m, s["evidence_quote"], s["start_char"], s["end_char"], s["quote"])


def channel_boundary(spark, sf):
    m = _read(spark, sf, "reference_resolution_ignored")
    s = F.col("source")
    exact = F.substr(s["evidence_quote"], s["start_char"] + 1, s["end_char"] - s["start_char"]) == s["quote"]
    m = m.withColumn("channel", F.coalesce(s["kind"], F.lit("none")))
    return evaluation.channel_boundary(m, "channel", ["sentence_span"], ["persistent_lexicon"], "status", exact)


def _graph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as nodes, their orders as mentions by nation, and the nation of each as an edge."""
    c = _read(spark, sf, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("entity_id"), F.initcap("c_mktsegment").alias("label"), F.col("c_name").alias("name"), F.concat(F.lit("d"), F.col("c_nationkey").cast("string")).alias("document_id"), "c_custkey", "c_acctbal")
    n = _read(spark, sf, "nation").select(F.concat(F.lit("d"), F.col("n_nationkey").cast("string")).alias("document_id"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("nation_id"), "n_name", "n_regionkey")
    nodes = c.select("entity_id", "label", "name").unionByName(n.select(F.col("nation_id").alias("entity_id"), F.lit("Nation").alias("label"), F.col("n_name").alias("name")))
    o = _read(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    mentions = o.select("entity_id", "document_id", F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("mention_id"), F.col("name").alias("surface")).unionByName(n.select(F.col("nation_id").alias("entity_id"), "document_id", F.concat(F.lit("m"), "nation_id").alias("mention_id"), F.col("n_name").alias("surface")))
    edges = c.join(n, "document_id").select(F.col("entity_id").alias("source"), F.lit("LOCATED_IN").alias("predicate"), F.col("nation_id").alias("target"), "document_id")
    return nodes, mentions, edges


def graph_summary(spark, sf):
    return graph.summary(*_graph(spark, sf))


def graph_verification(spark, sf):
    return graph.verify(*_graph(spark, sf))


def graph_problems(spark, sf):
    e = _read(spark, sf, "entities").select("entity_id", "label", F.col("canonical_name").alias("name"))
    return graph.node_problems(e).groupBy("code").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("entity_id").alias("nodes"))


def edge_problems(spark, sf):
    edges = _log(spark, sf).where("left_id is not null and right_id is not null and decision is not null").select(F.col("left_id").alias("source"), F.col("decision").alias("predicate"), F.col("right_id").alias("target"))
    known = spark.createDataFrame([("same",), ("different",), ("pending",)], "predicate string")
    return graph.edge_problems(edges, _labels(spark, sf), known).groupBy("code").agg(F.count(F.lit(1)).alias("edges"))


def edge_patterns(spark, sf):
    nodes, _, edges = _graph(spark, sf)
    return graph.typed_edges(edges, nodes, "LOCATED_IN").groupBy("source_label", "predicate", "target_name").agg(F.count(F.lit(1)).alias("edges"))


def neighbourhood(spark, sf):
    nodes, _, edges = _graph(spark, sf)
    return graph.neighbourhood(edges, nodes, "Nation")


def _second(spark: SparkSession, sf: str):
    """A second delivery: the documents of one region again, with the customers whose balance is positive, renamed."""
    nodes, mentions, edges = _graph(spark, sf)
    docs = _read(spark, sf, "nation").where("n_regionkey = 2").select(F.concat(F.lit("d"), F.col("n_nationkey").cast("string")).alias("document_id"))
    rich = _read(spark, sf, "customer").where("c_acctbal > 0").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("entity_id"))
    new_mentions = mentions.join(docs, "document_id", "left_semi").join(rich, "entity_id", "left_semi")
    new_nodes = nodes.join(new_mentions.select("entity_id").distinct(), "entity_id", "left_semi").withColumn("name", F.concat("name", F.lit(" II")))
    new_edges = edges.join(docs, "document_id", "left_semi").join(rich.withColumnRenamed("entity_id", "source"), "source", "left_semi")
    return graph.upsert(nodes, mentions, edges, new_nodes, new_mentions, new_edges, docs)


def graph_upsert_nodes(spark, sf):
    return _second(spark, sf)[0]


def graph_upsert_edges(spark, sf):
    return _second(spark, sf)[2].select("source", "predicate", "target", "document_id")


def mention_arrays(spark, sf):
    _, mentions, _ = _graph(spark, sf)
    out = graph.mention_arrays(mentions)
    return out.select("entity_id", F.array_join("mention_ids", ",").alias("mention_ids"), F.array_join("surfaces", "|").alias("surfaces"), "mentions", "documents", "surface_count")


def mention_surfaces(spark, sf):
    _, mentions, _ = _graph(spark, sf)
    return graph.mention_surfaces(mentions)


def identity_alignment(spark, sf):
    lex = _read(spark, sf, "lexicon").groupBy("canonical_id").agg(F.min("label").alias("label"), F.min("canonical_name").alias("name")).withColumnRenamed("canonical_id", "entity_id")
    old = _read(spark, sf, "entities").where("entity_id is not null").select("entity_id", "label", F.col("canonical_name").alias("name"), F.explode("mention_ids").alias("mention_id"))
    return graph.align_identities(lex, old.select("entity_id", "label", "name").distinct(), old.select("entity_id", F.col("mention_id").alias("document_id")))


def display_names(spark, sf):
    return graph.display_properties(_graph(spark, sf)[0]).select("entity_id", "display")


def stage_fold(spark, sf):
    """Latest report of each user's five stages: earlier ones are complete, the current one runs."""
    order = F.create_map(*[F.lit(x) for kv in (("signup", 1), ("view", 2), ("click", 3), ("purchase", 4), ("error", 5)) for x in kv])
    e = _read(spark, sf, "events").withColumn("stage", order[F.col("event_type")])
    last = windows.best_per_key(e.select("user_id", "stage", "ts", "event_id"), ["user_id"], F.struct("ts", "event_id"))
    return last.select("user_id", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("n"), "stage").select("user_id", "n", F.when(F.col("n") < F.col("stage"), "complete").when(F.col("n") == F.col("stage"), "running").otherwise("waiting").alias("status"))


def reading_columns(spark, sf):
    """Events of a user placed on a page: two-column reading order of the layout operator over all of them."""
    e = _read(spark, sf, "events")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    x0 = F.when(F.col("event_type") == "error", 40.0).when(F.col("value") > 10, 330.0).otherwise(40.0)
    x1 = F.when(F.col("event_type") == "error", 560.0).otherwise(x0 + 220.0)
    p = e.select(F.col("user_id").cast("string").alias("document_id"), F.lit(1).alias("page"), F.col("event_id").cast("string").alias("text"), n.cast("double").alias("top"), (n + 1.0).alias("bottom"), x0.alias("x0"), x1.alias("x1"))
    return layout.reading_order(p).select("document_id", "text", "seq")


def section_restriction(spark, sf):
    d = _read(spark, sf, "documents")
    r = discovery.restrict_sections(d, ["Results", "METHODS", "Discussion"])
    return r.groupBy(F.lower(F.trim("section_title")).alias("title")).agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("characters"))


def result_report(spark, sf):
    c = _labels(spark, sf).select("entity_id")
    j = _log(spark, sf).where("decision is not null").select(F.col("left_id").alias("entity_id"), "decision")
    return discovery.result_report(c, j, "entity_id")


def narrative_documents(spark, sf):
    return _read(spark, sf, "documents").select("doc_id", discovery.narrative(F.col("text")).alias("narrative"))


def heading_labels(spark, sf):
    t = _read(spark, sf, "documents").select("section_title").where("section_title is not null").distinct()
    return t.select("section_title", discovery.canonical_heading(F.col("section_title")).alias("heading"), discovery.is_back_matter(F.col("section_title")).alias("back_matter"))


def earlier_neighbours(spark, sf):
    v = _read(spark, sf, "embeddings")
    n = vector_search.neighbours(v.where("vec_id % 20 = 0"), v, "vec_id", "embedding", 5, "label", earlier=True)
    return n.select("query", "neighbour", "rank", F.round("score", 5).alias("score"))


def queries() -> dict:
    return {f.__name__: f for f in (domain_range_violations, eligible_predicates, ancestor_closure, schema_edges, assertion_dedupe, relationship_support, supporting, relationship_gates, unknown_endpoints, endpoint_repair, authorship, title_match, competency_questions, semantic_completeness, orphans, usage_rollup, status_pivot, validation_codes, rejection_histogram, split_counts, document_profile, regression_gate, traceability, channel_boundary, graph_summary, graph_verification, graph_problems, edge_problems, edge_patterns, neighbourhood, graph_upsert_nodes, graph_upsert_edges, mention_arrays, mention_surfaces, identity_alignment, display_names, stage_fold, reading_columns, section_restriction, result_report, narrative_documents, heading_labels, earlier_neighbours)}


_LOG = r"log AS (SELECT decision_id, run_id, lower(trim(decision, E' \t\n\r')) AS decision, label, trim(left_entity_id, E' \t\n\r') AS left_id, trim(right_entity_id, E' \t\n\r') AS right_id, left_name, right_name, reviewed_at FROM entity_resolution_decisions)"
_LAB = "lab AS (SELECT entity_id, arg_max(label, (updated_at, label)) AS label FROM entities WHERE entity_id IS NOT NULL GROUP BY 1)"
_values = lambda rows: ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows)
_ONT = f"""
    par AS (SELECT * FROM (VALUES {_values(_HIERARCHY)}) v(label, parent)),
    clo AS (SELECT label, parent AS ancestor FROM par UNION SELECT label, label FROM par UNION SELECT parent, parent FROM par UNION SELECT clo.label, par.parent FROM clo JOIN par ON clo.ancestor = par.label),
    perm AS (SELECT * FROM (VALUES {_values(_PERMITTED)}) v(predicate, domain, range))"""
_GRAPH = """
    c AS (SELECT 'c' || c_custkey AS entity_id, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS label, c_name AS name, 'd' || c_nationkey AS document_id, c_custkey, c_acctbal FROM customer),
    n AS (SELECT 'd' || n_nationkey AS document_id, 'n' || n_nationkey AS nation_id, n_name, n_regionkey FROM nation),
    nodes AS (SELECT entity_id, label, name FROM c UNION ALL SELECT nation_id, 'Nation', n_name FROM n),
    ment AS (SELECT entity_id, document_id, 'o' || o_orderkey AS mention_id, name AS surface FROM orders JOIN c ON o_custkey = c_custkey UNION ALL SELECT nation_id, document_id, 'm' || nation_id, n_name FROM n),
    edges AS (SELECT entity_id AS source, 'LOCATED_IN' AS predicate, nation_id AS target, document_id FROM c JOIN n USING (document_id))"""
_UP = """
    docs AS (SELECT document_id FROM n WHERE n_regionkey = 2), rich AS (SELECT entity_id FROM c WHERE c_acctbal > 0),
    nm AS (SELECT * FROM ment WHERE document_id IN (FROM docs) AND entity_id IN (FROM rich)),
    am AS (SELECT * FROM ment WHERE document_id NOT IN (FROM docs) UNION ALL FROM nm),
    gone AS (SELECT DISTINCT entity_id FROM ment WHERE document_id IN (FROM docs) AND entity_id NOT IN (SELECT entity_id FROM am)),
    nn AS (SELECT entity_id, label, name || ' II' AS name FROM nodes WHERE entity_id IN (SELECT entity_id FROM nm))"""


def oracle_sql() -> dict[str, str]:
    return {
        "domain_range_violations": f"WITH RECURSIVE {_LOG},{_LAB},{_ONT}, e AS (SELECT decision AS predicate, a.label AS subject_label, b.label AS object_label FROM log JOIN lab a ON left_id = a.entity_id JOIN lab b ON right_id = b.entity_id WHERE left_id <> right_id AND decision IS NOT NULL), ok AS (SELECT DISTINCT a.label AS s, predicate, b.label AS o FROM perm JOIN clo a ON a.ancestor = domain JOIN clo b ON b.ancestor = range) SELECT subject_label, predicate, object_label, count(*) AS edges FROM e WHERE NOT EXISTS (SELECT 1 FROM ok WHERE s = subject_label AND ok.predicate = e.predicate AND o = object_label) GROUP BY 1, 2, 3",
        "eligible_predicates": f"WITH RECURSIVE {_LAB},{_ONT}, h AS (SELECT DISTINCT ancestor FROM clo JOIN lab USING (label)) SELECT DISTINCT predicate FROM perm WHERE domain IN (FROM h) AND range IN (FROM h)",
        "ancestor_closure": f"WITH RECURSIVE {_LAB},{_ONT} SELECT DISTINCT label, ancestor FROM clo JOIN lab USING (label)",
        "schema_edges": "WITH d AS (SELECT DISTINCT status AS predicate, label AS domain FROM entities WHERE status IS NOT NULL AND label IS NOT NULL), r AS (SELECT DISTINCT status AS predicate, label[1] AS range FROM entities WHERE status IS NOT NULL AND label IS NOT NULL) SELECT predicate, domain, range FROM d JOIN r USING (predicate)",
        "assertion_dedupe": "SELECT l_suppkey, l_partkey, l_returnflag, l_orderkey, l_linenumber, l_discount FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey, l_returnflag ORDER BY l_discount DESC, l_orderkey * 100 + l_linenumber) = 1",
        "relationship_support": "WITH a AS (SELECT l_suppkey, l_returnflag, l_partkey, l_orderkey, l_discount, l_orderkey || '-' || lpad(l_linenumber::VARCHAR, 3, '0') || '-' || lpad(l_quantity::INT::VARCHAR, 3, '0') AS id FROM lineitem), u AS (SELECT l_suppkey, l_returnflag, l_partkey, l_orderkey, arg_max(id, (l_discount, id)) AS id FROM a GROUP BY 1, 2, 3, 4) SELECT l_suppkey, l_returnflag, l_partkey, count(*) AS support_count, array_to_string(list_sort(list(id))[1:10], ',') AS assertion_ids, 'relationship_' || substr(sha256(l_suppkey || chr(9247) || l_returnflag || chr(9247) || l_partkey), 1, 20) AS relationship_id FROM u GROUP BY 1, 2, 3",
        "supporting": "WITH a AS (SELECT l_suppkey, l_returnflag, l_partkey, l_orderkey AS evidence, l_discount, l_orderkey || '-' || lpad(l_linenumber::VARCHAR, 3, '0') || '-' || lpad(l_quantity::INT::VARCHAR, 3, '0') AS id FROM lineitem) SELECT l_suppkey, l_returnflag, l_partkey, evidence, arg_max(id, (l_discount, id)) AS assertion_id FROM a GROUP BY 1, 2, 3, 4",
        "relationship_gates": """
            WITH p AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 'reject' ELSE 'accept' END AS decision, 1.0 - l_discount * 4 AS confidence FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
            g AS (SELECT *, o_orderkey IS NOT NULL AND l_quantity > 2 AS er, coalesce(l_tax < 0.07, false) AS te, (
                (decision = 'accept')::INT + (o_orderkey IS NOT NULL AND l_quantity > 2)::INT + (o_orderkey IS NOT NULL)::INT + coalesce(l_tax < 0.07, false)::INT + coalesce(l_partkey <> l_suppkey, false)::INT + coalesce(o_orderpriority <> '5-LOW', false)::INT
                + coalesce(o_orderstatus <> 'P', false)::INT + (l_linestatus IS NOT NULL)::INT + coalesce(l_tax > 0, false)::INT + coalesce(l_quantity < 49, false)::INT + coalesce(l_linenumber < 7, false)::INT + coalesce(l_extendedprice > 1000, false)::INT) AS held FROM p)
            SELECT l_returnflag, CASE WHEN decision <> 'accept' THEN 'rejected' WHEN NOT er AND te THEN 'unresolved' WHEN confidence < 0.75 THEN 'review' WHEN held < 12 THEN 'rejected' ELSE 'accepted' END AS status, count(*) AS proposals, sum(12 - held)::BIGINT AS failed FROM g GROUP BY 1, 2""",
        "unknown_endpoints": f"WITH {_LOG},{_LAB}, p AS (SELECT log.*, left_id NOT IN (SELECT entity_id FROM lab) AS l, right_id NOT IN (SELECT entity_id FROM lab) AS r FROM log WHERE left_id IS NOT NULL AND right_id IS NOT NULL), x AS (SELECT *, unnest(list_filter([CASE WHEN l THEN 'head' END, CASE WHEN r THEN 'tail' END], lambda v: v IS NOT NULL)) AS role FROM p WHERE l OR r) SELECT left_id, right_id, role, arg_max(decision_id, (reviewed_at, decision_id)) AS decision_id FROM x GROUP BY 1, 2, 3",
        "endpoint_repair": f"WITH {_LOG}, m AS (SELECT DISTINCT entity_id, lower(t) AS t FROM (SELECT entity_id, unnest([canonical_name, coalesce(aliases[1], canonical_name)]) AS t FROM entities WHERE entity_id IS NOT NULL) WHERE t IS NOT NULL), o AS (SELECT t, min(entity_id) AS mention_id FROM m GROUP BY 1 HAVING count(DISTINCT entity_id) = 1) SELECT decision_id, mention_id FROM (SELECT DISTINCT decision_id, left_name FROM log WHERE left_id IS NULL) LEFT JOIN o ON lower(trim(left_name)) = t",
        "authorship": "SELECT DISTINCT id AS document_id, 'pub:' || id AS subject_mention_id, 'person:' || a AS object_mention_id, 'AUTHORED_BY' AS predicate FROM (SELECT id, trim(unnest(string_split(authors, ';'))) AS a FROM manifest WHERE id IS NOT NULL) WHERE a <> ''",
        "title_match": "WITH w AS (SELECT * FROM (VALUES ('results and discussion'), ('network calibration'), ('limits of the study'), ('sensor layout')) v(expected)), t AS (SELECT DISTINCT lower(section_title) AS title FROM documents WHERE section_title IS NOT NULL), s AS (SELECT title, expected, len(list_intersect(list_distinct(string_split(title, ' ')), string_split(expected, ' '))) / len(list_distinct(list_concat(string_split(title, ' '), string_split(expected, ' ')))) AS score FROM t, w) SELECT title, arg_max(expected, (score, expected)) AS expected, round(max(score), 6) AS score FROM s GROUP BY 1",
        "competency_questions": f"WITH {_LOG}, q AS (SELECT * FROM (VALUES ('tools','Tool'),('systems','AISystem'),('systems','Model'),('data','Dataset'),('metrics','Metric'),('limits','Limitation')) v(question, predicate)), x AS (SELECT question, count(DISTINCT left_name) AS answers, count(DISTINCT CASE WHEN trim(right_name) <> '' THEN right_name END) AS evidence FROM q LEFT JOIN log ON label = predicate GROUP BY 1) SELECT question, CASE WHEN answers > 0 AND evidence > 0 THEN 'answerable' ELSE 'not_answerable' END AS status, answers, evidence FROM x",
        "semantic_completeness": f"WITH {_LAB}, k AS (SELECT * FROM (VALUES ('introduced_system', '(?i)\\b(introduc|propos|develop)(e|es|ed|ing)\\b', 'AISystem', 1), ('named_models', '\\b(model|network|solver)\\b', 'Model', 100000), ('releases', 'Release v\\d', 'Tool', 5), ('never', 'zzzzqq', 'Tool', 1)) v(ck, p, l, n)), s AS (SELECT ck, l, n, count(*) FILTER (regexp_matches(text, p)) AS e FROM k, documents WHERE text IS NOT NULL GROUP BY 1, 2, 3) SELECT ck AS \"check\", e AS expected_signals, (SELECT count(*) FROM lab WHERE label = l) AS detected_entities, e > 0 AS applicable, e = 0 OR (SELECT count(*) FROM lab WHERE label = l) >= n AS passed FROM s",
        "orphans": f"WITH {_LOG},{_LAB} SELECT entity_id, label FROM lab WHERE entity_id NOT IN (SELECT left_id FROM log WHERE left_id IS NOT NULL UNION SELECT right_id FROM log WHERE right_id IS NOT NULL)",
        "usage_rollup": "SELECT event_type, grouping(event_type)::INT AS is_total, count(*) AS calls, count(DISTINCT user_id) AS users, round(sum(value), 2) AS total, max(value) AS largest FROM events GROUP BY ROLLUP (event_type)",
        "status_pivot": f"WITH {_LOG} SELECT label, " + ", ".join(f"count(*) FILTER (decision = '{d}') AS {d}" for d in ("same", "different", "not_same", "pending", "unsure")) + " FROM log WHERE label IS NOT NULL GROUP BY 1",
        "validation_codes": f"WITH {_LOG}, x AS (SELECT 'null_id' AS code, count(*) AS n FROM log WHERE left_id IS NULL OR right_id IS NULL UNION ALL SELECT 'self_pair', count(*) FROM log WHERE left_id = right_id UNION ALL SELECT 'no_decision', count(*) FROM log WHERE decision IS NULL UNION ALL SELECT 'unknown_decision', count(*) FROM log WHERE decision NOT IN ('same','different','not_same','pending','unsure') UNION ALL SELECT 'no_label', count(*) FROM log WHERE label IS NULL UNION ALL SELECT 'no_time', count(*) FROM log WHERE reviewed_at IS NULL UNION ALL SELECT 'repeated_decision_id', count(*) FROM (SELECT decision_id FROM log GROUP BY 1 HAVING count(*) > 1)) SELECT code, n FROM x WHERE n > 0",
        "rejection_histogram": "SELECT reason, count(*) AS n FROM reference_resolution_ignored GROUP BY 1",
        "split_counts": r"SELECT regexp_replace(lower(split), '[\s-]+', '', 'g') AS split, count(*) AS papers, count(DISTINCT sha256) AS files, count(*) FILTER (NOT regexp_matches(sha256, '^[0-9a-f]{64}$')) AS bad_checksums FROM manifest GROUP BY 1",
        "document_profile": r"WITH f AS (SELECT doc_id, coalesce(regexp_matches(text, '(?i)\b(simulation|solver|calibration)\b'), false) AS a, coalesce(regexp_matches(text, '(?i)\b(sensor|sampling|meter)\b'), false) AS b, coalesce(regexp_matches(text, '(?i)\b(clarifier|osmosis|membrane|digester)\b'), false) AS c FROM documents) SELECT doc_id, CASE WHEN a THEN 'simulation' WHEN b THEN 'sensing' WHEN c THEN 'treatment' ELSE 'other' END AS archetype, array_to_string(list_filter([CASE WHEN a THEN 'simulation' END, CASE WHEN b THEN 'sensing' END, CASE WHEN c THEN 'treatment' END], lambda x: x IS NOT NULL), ',') AS flags FROM f",
        "regression_gate": f"WITH {_LOG}, r AS (SELECT DISTINCT label AS paper, left_name AS name, CASE WHEN decision = 'different' THEN 'forbidden' ELSE 'required' END AS kind FROM log WHERE label IS NOT NULL AND left_name IS NOT NULL), h AS (SELECT DISTINCT label AS paper, lower(trim(canonical_name)) AS nm FROM entities) SELECT r.paper, name, kind, CASE WHEN kind = 'required' THEN h.nm IS NOT NULL ELSE h.nm IS NULL END AS passed FROM r LEFT JOIN h ON r.paper = h.paper AND lower(trim(name)) = h.nm",
        "traceability": "SELECT count(*) AS mentions, count(*) FILTER (trim(source.evidence_quote) <> '') AS with_evidence, count(*) FILTER (substr(source.evidence_quote, source.start_char + 1, source.end_char - source.start_char) = source.quote) AS exact FROM reference_resolution_ignored",
        "channel_boundary": "WITH m AS (SELECT coalesce(source.kind, 'none') AS channel, status, coalesce(substr(source.evidence_quote, source.start_char + 1, source.end_char - source.start_char) = source.quote, false) AS x FROM reference_resolution_ignored) SELECT channel, count(*) AS candidates, count(*) FILTER (NOT x) AS inexact, count(*) FILTER (status = 'accepted' AND channel NOT IN ('persistent_lexicon')) AS bypassed, channel IN ('sentence_span') AS declared FROM m GROUP BY channel",
        "graph_summary": f"WITH {_GRAPH} SELECT label, count(*) AS nodes, sum((SELECT count(*) FROM ment m WHERE m.entity_id = nodes.entity_id))::BIGINT AS mentions, sum((SELECT count(*) FROM edges e WHERE e.source = nodes.entity_id))::BIGINT AS edges_out, count(*) FILTER (entity_id NOT IN (SELECT source FROM edges UNION SELECT target FROM edges)) AS orphans FROM nodes GROUP BY 1",
        "graph_verification": f"WITH {_GRAPH} SELECT 'nodes_without_mentions' AS \"check\", count(*) AS count FROM nodes WHERE entity_id NOT IN (SELECT entity_id FROM ment) UNION ALL SELECT 'mentions_without_node', count(*) FROM ment WHERE entity_id NOT IN (SELECT entity_id FROM nodes) UNION ALL SELECT 'edge_ends_without_node', count(*) FROM (SELECT source AS x FROM edges UNION ALL SELECT target FROM edges) WHERE x NOT IN (SELECT entity_id FROM nodes) UNION ALL SELECT 'loops', count(*) FROM edges WHERE source = target UNION ALL SELECT 'repeated_ids', count(*) FROM (SELECT entity_id FROM nodes GROUP BY 1 HAVING count(*) > 1)",
        "graph_problems": "WITH e AS (SELECT entity_id, label, lower(trim(canonical_name)) AS n FROM entities), d AS (SELECT label, n FROM e WHERE n <> '' AND label NOT IN ('Experiment','Observation','Claim','Sample','SamplingEvent','Condition','Parameter') GROUP BY 1, 2 HAVING count(DISTINCT entity_id) > 1), x AS (SELECT entity_id, 'missing_id' AS code FROM e WHERE coalesce(entity_id, '') = '' UNION ALL SELECT entity_id, 'missing_label' FROM e WHERE coalesce(label, '') = '' UNION ALL SELECT entity_id, 'unsafe_label' FROM e WHERE label <> '' AND NOT regexp_matches(label, '^[A-Za-z_][A-Za-z0-9_]*$') UNION ALL SELECT entity_id, 'provenance_label' FROM e WHERE label IN ('EvidenceFragment','Mention') UNION ALL SELECT entity_id, 'duplicate_name' FROM e JOIN d USING (label, n)) SELECT code, count(*) AS rows, count(DISTINCT entity_id) AS nodes FROM x GROUP BY 1",
        "edge_problems": f"WITH {_LOG},{_LAB}, e AS (SELECT * FROM log WHERE left_id IS NOT NULL AND right_id IS NOT NULL AND decision IS NOT NULL), x AS (SELECT 'unknown_predicate' AS code FROM e WHERE decision NOT IN ('same','different','pending') UNION ALL SELECT 'missing_source' FROM e WHERE left_id NOT IN (SELECT entity_id FROM lab) UNION ALL SELECT 'missing_target' FROM e WHERE right_id NOT IN (SELECT entity_id FROM lab)) SELECT code, count(*) AS edges FROM x GROUP BY 1",
        "edge_patterns": f"WITH {_GRAPH} SELECT s.label AS source_label, predicate, t.name AS target_name, count(*) AS edges FROM edges JOIN nodes s ON source = s.entity_id JOIN nodes t ON target = t.entity_id GROUP BY 1, 2, 3",
        "neighbourhood": f"WITH {_GRAPH} SELECT DISTINCT target AS entity_id, source AS neighbour, predicate FROM edges",
        "graph_upsert_nodes": f"WITH {_GRAPH},{_UP} SELECT nodes.entity_id, coalesce(nn.label, nodes.label) AS label, coalesce(nn.name, nodes.name) AS name FROM nodes LEFT JOIN nn USING (entity_id) WHERE nodes.entity_id NOT IN (FROM gone)",
        "graph_upsert_edges": f"WITH {_GRAPH},{_UP} SELECT DISTINCT source, predicate, target, document_id FROM edges WHERE (document_id NOT IN (FROM docs) OR source IN (FROM rich)) AND source NOT IN (FROM gone) AND target NOT IN (FROM gone)",
        "mention_arrays": f"WITH {_GRAPH} SELECT entity_id, string_agg(mention_id, ',' ORDER BY document_id, mention_id, surface) AS mention_ids, array_to_string(list_sort(list_distinct(list(surface)))[1:1000], '|') AS surfaces, count(*) AS mentions, count(DISTINCT document_id) AS documents, count(DISTINCT surface) AS surface_count FROM ment GROUP BY 1",
        "mention_surfaces": f"WITH {_GRAPH} SELECT entity_id, surface, count(*) AS mentions FROM ment WHERE surface IS NOT NULL GROUP BY 1, 2",
        "identity_alignment": "WITH lex AS (SELECT canonical_id AS entity_id, min(label) AS label, lower(trim(min(canonical_name))) AS n FROM lexicon GROUP BY 1), o AS (SELECT entity_id, label, canonical_name, unnest(mention_ids) AS d FROM entities WHERE entity_id IS NOT NULL), w AS (SELECT entity_id, count(DISTINCT d) AS d FROM o GROUP BY 1), b AS (SELECT label, lower(trim(canonical_name)) AS n, arg_min(entity_id, (-w.d, entity_id)) AS aligned FROM (SELECT DISTINCT entity_id, label, canonical_name FROM o) x JOIN w USING (entity_id) GROUP BY 1, 2) SELECT lex.entity_id, coalesce(aligned, lex.entity_id) AS aligned_id FROM lex LEFT JOIN b USING (label, n)",
        "display_names": f"WITH {_GRAPH}, x AS (SELECT entity_id, replace(coalesce(CASE WHEN trim(name) <> '' THEN name END, entity_id), '_', ' ') AS t FROM nodes) SELECT entity_id, CASE WHEN length(t) > 40 THEN left(t, 39) || '…' ELSE t END AS display FROM x",
        "section_restriction": "SELECT lower(trim(section_title)) AS title, count(*) AS documents, sum(n_chars)::BIGINT AS characters FROM documents WHERE lower(trim(section_title)) IN ('results', 'methods', 'discussion') GROUP BY 1",
        "result_report": f"WITH {_LOG},{_LAB}, j AS (SELECT left_id, min(decision) AS d FROM log WHERE decision IS NOT NULL AND left_id IS NOT NULL GROUP BY 1) SELECT entity_id, coalesce(d, 'unjudged') AS decision FROM lab LEFT JOIN j ON entity_id = left_id",
        "narrative_documents": "SELECT doc_id, coalesce(NOT (text LIKE '%cid:%' AND len(regexp_extract_all(text, '[A-Za-z]{2,}')) < 8) AND NOT (length(text) < 60 AND len(regexp_extract_all(text, '[A-Za-z]{2,}')) < 4), false) AS narrative FROM documents",
        "earlier_neighbours": "WITH q AS (SELECT a.vec_id AS query, b.vec_id AS neighbour, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 5) AS score FROM embeddings a JOIN embeddings b ON b.vec_id < a.vec_id AND a.label = b.label WHERE a.vec_id % 20 = 0) SELECT query, neighbour, row_number() OVER (PARTITION BY query ORDER BY score DESC, neighbour)::INT AS rank, score FROM q QUALIFY rank <= 5",
        "stage_fold": "WITH l AS (SELECT user_id, arg_max(CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END, (ts, event_id)) AS stage FROM events GROUP BY 1) SELECT user_id, i::INT AS n, CASE WHEN i < stage THEN 'complete' WHEN i = stage THEN 'running' ELSE 'waiting' END AS status FROM l, range(1, 6) x(i)",
        "reading_columns": """
            WITH p AS (SELECT user_id::VARCHAR AS document_id, event_id::VARCHAR AS text, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS top, CASE WHEN event_type = 'error' THEN 's' WHEN value > 10 THEN 'r' ELSE 'l' END AS side FROM events),
            q AS (SELECT *, count(*) FILTER (side = 'l') OVER w AS l, count(*) FILTER (side = 'r') OVER w AS r, count(*) OVER w AS n, sum((side = 's')::INT) OVER (PARTITION BY document_id ORDER BY top) AS band FROM p WINDOW w AS (PARTITION BY document_id)),
            z AS (SELECT *, least(l, r) >= 4 AND l + r >= n * 0.58 AS two FROM q)
            SELECT document_id, text, (row_number() OVER (PARTITION BY document_id ORDER BY CASE WHEN two THEN band ELSE 0 END, CASE WHEN NOT two OR side = 's' THEN 0 WHEN side = 'l' THEN 1 ELSE 2 END, top) - 1)::INT AS seq FROM z""",
    }

"""Queries of the entity, vector and decision operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions.ids import name_tokens, normalized
from lodestrata.operators import components, decisions, entities, grammar, vector_search


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _entities(spark: SparkSession, sf: str) -> DataFrame:
    """Entities without the earlier of two exports."""
    e = _read(spark, sf, "entities").where("entity_id is not null")
    rest = ["label", "canonical_name", "aliases", "mention_count", "status", "updated_at"]
    return e.groupBy("entity_id").agg(F.max_by(F.struct(*rest), F.struct("updated_at", "canonical_name")).alias("e")).select("entity_id", "e.*")


def _log(spark: SparkSession, sf: str) -> DataFrame:
    t = _read(spark, sf, "entity_resolution_decisions")
    strip = lambda c: F.btrim(F.col(c), F.lit(" \t\n\r"))
    return t.select("decision_id", "resolution_id", F.lower(strip("decision")).alias("decision"), "label", strip("left_entity_id").alias("left_id"), strip("right_entity_id").alias("right_id"), "left_name", "right_name", "reviewed_at")


def _mentions(spark: SparkSession, sf: str) -> DataFrame:
    return _entities(spark, sf).select("label", F.col("canonical_name").alias("surface_text"), F.col("canonical_name"), F.lit("").alias("canonical_id"), F.lit(False).alias("from_lexicon"), F.lit(False).alias("is_reference"), F.col("status").alias("sentence_id"), F.col("entity_id").alias("seq"), F.col("entity_id").alias("mention_id"))


def canonical_entities(spark, sf):
    out = entities.canonical_entities(_mentions(spark, sf))
    return out.select("entity_id", "label", "key", "canonical_name", F.array_join("aliases", "|").alias("aliases"), "alias_count", "mention_count", F.array_join("evidence", "|").alias("evidence"))


def entity_aliases(spark, sf):
    m = _mentions(spark, sf)
    return entities.entity_aliases(m, entities.canonical_entities(m))


def lexical_pairs(spark, sf):
    return entities.similar_pairs(_entities(spark, sf), ratio=False)


def lexical_pairs_ratio(spark, sf):
    return entities.similar_pairs(_entities(spark, sf))


def alias_classes(spark, sf):
    return entities.alias_classes(_entities(spark, sf))


def name_classes(spark, sf):
    return entities.class_members(_entities(spark, sf))


def prior_catalog(spark, sf):
    lex = _read(spark, sf, "lexicon").select(F.col("canonical_id").alias("node_id"), "label", "canonical_name", "aliases")
    ent = _entities(spark, sf).select(F.col("entity_id").alias("node_id"), "label", "canonical_name", "aliases")
    return entities.prior_catalog([lex, ent]).select("node_id", "label", "key", F.array_join("aliases", "|").alias("aliases"), "alias_count")


def catalog_aliases(spark, sf):
    lex = _read(spark, sf, "lexicon").select(F.col("canonical_id").alias("node_id"), "label", "canonical_name", "aliases")
    ent = _entities(spark, sf).select(F.col("entity_id").alias("node_id"), "label", "canonical_name", "aliases")
    return entities.catalog_aliases([lex, ent]).drop("canonical_name")


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    lex = _read(spark, sf, "lexicon").select(F.col("canonical_id").alias("node_id"), "label", "canonical_name", "aliases")
    return entities.prior_catalog([lex])


def prior_catalog_topk(spark, sf):
    """Queries are the entities whose id's last digits, read as a number, are divisible by 20, against lexicon and entities as earlier nodes."""
    lex = _read(spark, sf, "lexicon").select(F.col("canonical_id").alias("node_id"), "label", "canonical_name", "aliases")
    ent = _entities(spark, sf)
    names = entities.catalog_aliases([lex, ent.select(F.col("entity_id").alias("node_id"), "label", "canonical_name", "aliases")])
    asked = ent.where("pmod(cast(conv(right(entity_id, 8), 16, 10) as bigint), 20) = 0")
    return entities.prior_top_k(asked, names, "entity_id", "label", "canonical_name")


def exact_prior_nodes(spark, sf):
    return entities.exact_prior(_entities(spark, sf).select("entity_id", "label", "canonical_name"), _catalog(spark, sf), "label", "canonical_name").select("entity_id", "matched_node_id")


def _components(spark: SparkSession, sf: str) -> DataFrame:
    return components.connected_components(_log(spark, sf).where("decision = 'same'"), "left_id", "right_id")


def merge_components(spark, sf):
    return _components(spark, sf)


def merged_entities(spark, sf):
    out = entities.merge_entities(_entities(spark, sf), _components(spark, sf))
    return out.select("entity_id", "label", "canonical_name", "mention_count", "members", F.array_join("aliases", "|").alias("aliases"))


def merged_aliases(spark, sf):
    return entities.merged_aliases(_entities(spark, sf), _components(spark, sf))


def entity_mentions(spark, sf):
    m = _mentions(spark, sf)
    return entities.entity_mentions(m, entities.canonical_entities(m))


def merged_mentions(spark, sf):
    """The exported entities are the mentions, so a decision on two of them links the canonical entities that they belong to."""
    em = entity_mentions(spark, sf).select("entity_id", "mention_id")
    left, right = (em.select(F.col("mention_id").alias(f"{s}_id"), F.col("entity_id").alias(s)) for s in ("left", "right"))
    links = _log(spark, sf).where("decision = 'same'").select("left_id", "right_id").join(left, "left_id").join(right, "right_id")
    return entities.merged_mentions(em, components.connected_components(links, "left", "right"))


def lexicon_growth(spark, sf):
    add = _log(spark, sf).where("decision = 'same' and label is not null and trim(left_name) <> ''").select("label", normalized("left_name").alias("n"), "left_name", "right_name").where("n <> ''")
    add = add.groupBy("label", "n").agg(F.min("left_name").alias("canonical_name"), F.array_sort(F.collect_set("right_name")).alias("aliases")).drop("n")
    return entities.grow_lexicon(_read(spark, sf, "lexicon"), add).groupBy("status").agg(F.count(F.lit(1)).alias("entries"), F.count("replaced_by").alias("replaced"))


def dense_typing_topk(spark, sf):
    v = _read(spark, sf, "embeddings")
    c = vector_search.class_centroids(v, "label", "embedding", 64)
    t = vector_search.type_by_vectors(v, c, "vec_id", "embedding", threshold=0.15, margin=0.01)
    return t.select("vec_id", F.col("selected_label").cast("int").alias("selected_label"), F.round("selected_score", 6).alias("selected_score"), F.round("score_margin", 6).alias("score_margin"), "applicable")


def _embedded(spark: SparkSession, sf: str, k: int, block: str | None = None) -> DataFrame:
    """The stated query set, every row whose id is divisible by 20, against all rows."""
    v = _read(spark, sf, "embeddings")
    n = vector_search.neighbours(v.where("vec_id % 20 = 0"), v, "vec_id", "embedding", k, block)
    lab = v.select(F.col("vec_id").alias("query"), F.col("label").alias("query_label")).join(n, "query")
    return lab.join(v.select(F.col("vec_id").alias("neighbour"), F.col("label").alias("neighbour_label")), "neighbour")


def embedding_topk(spark, sf):
    return _embedded(spark, sf, 12, "label").select("query", "neighbour", "rank", F.round("score", 5).alias("score"))


def resolution_bands(spark, sf):
    p = _embedded(spark, sf, 12, "label").withColumn("band", vector_search.band(F.round("score", 5), high=0.35, middle=0.2))
    return p.groupBy("query_label", "band").agg(F.count(F.lit(1)).alias("pairs"), F.max(F.round("score", 5)).alias("best"))


def review_queue(spark, sf):
    p = _log(spark, sf).where("label is not null and left_name is not null and right_name is not null").withColumn("score", F.when(F.col("decision") == "same", 0.9).when(F.col("decision") == "pending", 0.7).otherwise(0.3)).withColumn("band", vector_search.band(F.col("score")))
    return vector_search.review_queue(p, "band", "label", "left_name", "right_name", "score")


def calibration_sweep(spark, sf):
    p = _embedded(spark, sf, 40).select(F.round("score", 5).alias("score"), (F.col("query_label") == F.col("neighbour_label")).alias("same"))
    s = vector_search.threshold_sweep(p, "score", "same", [round(0.05 + 0.02 * i, 2) for i in range(21)])
    return s.select("threshold", "tp", "fp", "tn", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "balanced_accuracy")])


def tfidf_class_scores(spark, sf):
    """Classes are labels, described by all names and definitions of their entries."""
    lex = _read(spark, sf, "lexicon").where("label is not null").select("label", F.concat_ws(" ", "canonical_name", "definition").alias("t"))
    s = vector_search.tfidf_scores(_entities(spark, sf), lex, "entity_id", F.col("canonical_name"), "label", F.col("t"))
    return s.select("entity_id", "label", F.round("score", 6).alias("score"))


def _targets(spark: SparkSession, sf: str) -> DataFrame:
    m = _read(spark, sf, "reference_resolution_ignored").select("resolution_id", "surface_text", "reference_head", "candidate_targets", F.col("source.sentence_id").alias("sentence_id")).where("resolution_id is not null")
    return m.groupBy("resolution_id").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("surface_text", "reference_head", "candidate_targets", "sentence_id")])


def adjudication_outcomes(spark, sf):
    t = _targets(spark, sf)
    c = t.select(F.col("resolution_id").alias("candidate_id"), "surface_text", F.coalesce(F.try_element_at("candidate_targets", F.lit(1))["label"], F.lit("")).alias("label"), F.transform("candidate_targets", lambda x: x["label"]).alias("alternatives"), "sentence_id")
    j = t.select(F.col("resolution_id").alias("candidate_id"), F.explode("candidate_targets").alias("x"))
    j = j.select("candidate_id", F.when(F.col("x.distance") == 0, "accept").when(F.col("x.distance") == 1, "review").otherwise("reject").alias("decision"), F.col("x.label").alias("ontology_label"), F.col("x.canonical_name").alias("judged_name"))
    # The judged name of an accepted pair is the surface itself, as a judge that cleans the span would return it.
    j = j.join(c.select("candidate_id", "surface_text"), "candidate_id").withColumn("judged_name", F.when(F.col("decision") == "accept", F.col("surface_text")).otherwise(F.col("judged_name"))).drop("surface_text")
    return decisions.adjudicate(c, j).groupBy("outcome", "reason_code").agg(F.count(F.lit(1)).alias("candidates"))


def untraceable_candidates(spark, sf):
    return decisions.without_model(_targets(spark, sf)).select("resolution_id", "outcome", "reason_code")


def redundant_review(spark, sf):
    log = _log(spark, sf).where("left_id is not null and right_id is not null and left_name is not null")
    keys = ["left_id", "right_id"]
    return decisions.not_yet_trusted(log.where("decision = 'pending'"), log.where("decision = 'same'"), keys, "left_name").select("decision_id", "left_id", "right_id")


def reference_verdicts(spark, sf):
    p = _log(spark, sf).where("resolution_id is not null").withColumn("confidence", F.when(F.col("label").isNull(), 0.5).otherwise(0.9))
    return decisions.pairwise_verdict(p, "resolution_id", "decision", "confidence")


def reference_outcomes(spark, sf):
    t = _targets(spark, sf).select("resolution_id", "surface_text", F.explode("candidate_targets").alias("x"))
    c = t.select("resolution_id", F.col("x.distance").alias("distance"), F.concat_ws("/", "x.label", normalized("x.canonical_name")).alias("identity"), F.lower("surface_text").rlike("^(this|that|our|the)\\s").alias("strong"), F.lower("surface_text").rlike("(s$|they|them)").alias("plural"), F.length("surface_text").alias("gap"))
    return decisions.reference_outcome(c, "resolution_id", "distance", "identity", F.col("strong"), F.col("plural"), F.col("gap"))


def decision_replay(spark, sf):
    pairs = _log(spark, sf).where("left_id < right_id").select("left_id", "right_id").distinct().withColumn("pair", F.concat_ws("|", "left_id", "right_id"))
    rec = _log(spark, sf).where("left_id < right_id").select(F.concat_ws("|", "left_id", "right_id").alias("pair"), "decision", "decision_id", "reviewed_at")
    return decisions.replay(pairs.select("pair"), rec, "pair").select("pair", "decision", "decision_id")


def judgment_repair(spark, sf):
    expected = _read(spark, sf, "reference_resolution_ignored").where("resolution_id is not null").select(F.col("resolution_id").alias("candidate_id"))
    returned = _read(spark, sf, "reference_resolution_ignored").where("reason is not null").select(F.col("resolution_id").alias("candidate_id"), F.col("status").alias("decision"), "reason")
    return decisions.repair_judgments(expected, returned).groupBy("decision", "repair").agg(F.count(F.lit(1)).alias("n"))


def observations(spark, sf):
    m = _read(spark, sf, "reference_resolution_ignored").select(F.explode("source.context_sentences").alias("s")).select(F.col("s.sentence_id").alias("sentence_id"), F.col("s.text").alias("text")).where("sentence_id is not null and text is not null").distinct()
    o = decisions.observations(m, ["sentence_id", "text"])
    return o.select("sentence_id", F.array_join("values", ",").alias("values"), F.array_join("units", ",").alias("units"))


def argument_index(spark, sf):
    return grammar.argument_index(_read(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"], "l_linestatus", "l_orderkey")


def queries() -> dict:
    return {f.__name__: f for f in (canonical_entities, entity_aliases, catalog_aliases, lexical_pairs, lexical_pairs_ratio, alias_classes, name_classes, prior_catalog, prior_catalog_topk, exact_prior_nodes, merge_components, merged_entities, merged_aliases, entity_mentions, merged_mentions, lexicon_growth, dense_typing_topk, embedding_topk, resolution_bands, review_queue, calibration_sweep, tfidf_class_scores, adjudication_outcomes, untraceable_candidates, redundant_review, reference_verdicts, reference_outcomes, decision_replay, judgment_repair, observations, argument_index)}


def _n(c: str) -> str:
    return f"trim(regexp_replace(replace(lower({c}), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g'))"


_ENT = "ent AS (SELECT entity_id, unnest(arg_max({'label': label, 'canonical_name': canonical_name, 'aliases': aliases, 'mention_count': mention_count, 'status': status}, (updated_at, canonical_name))) FROM entities WHERE entity_id IS NOT NULL GROUP BY 1)"
_SCOPED = "('Experiment','Observation','Claim','Sample','SamplingEvent','Condition','Parameter')"
_LOG = r"log AS (SELECT decision_id, resolution_id, lower(trim(decision, E' \t\n\r')) AS decision, label, trim(left_entity_id, E' \t\n\r') AS left_id, trim(right_entity_id, E' \t\n\r') AS right_id, left_name, right_name, reviewed_at FROM entity_resolution_decisions)"
_CC = """
    e AS MATERIALIZED (SELECT left_id AS u, right_id AS v FROM log WHERE decision = 'same' AND left_id <> right_id UNION SELECT right_id, left_id FROM log WHERE decision = 'same' AND left_id <> right_id),
    r AS (SELECT u AS node, u AS reach FROM e UNION SELECT r.node, e.v FROM r JOIN e ON r.reach = e.u),
    cc AS (SELECT node, min(reach) AS component FROM r GROUP BY 1)"""
_EM = f"em AS (SELECT 'entity_' || substr(sha256(label || chr(9247) || {_n('canonical_name')}), 1, 20) AS entity_id, entity_id AS mention_id, status AS sentence_id FROM ent WHERE label NOT IN ('EvidenceFragment','Mention'))"
_REPS = f"""
    live AS (SELECT *, {_n('canonical_name')} AS norm FROM ent WHERE label NOT IN {_SCOPED}),
    reps AS (SELECT label, norm, min(entity_id) AS rep, arg_min(canonical_name, (entity_id, canonical_name)) AS name FROM live WHERE norm <> '' GROUP BY 1, 2),
    ak AS (SELECT label, norm, list_distinct(list(k)) AS keys FROM (SELECT label, norm, {_n('unnest(aliases)')} AS k FROM live WHERE norm <> '') WHERE k <> '' GROUP BY 1, 2),
    r AS (SELECT reps.*, coalesce(ak.keys, []) AS keys, list_distinct(list_filter(string_split(norm, ' '), lambda t: t <> '')) AS tokens, array_to_string(regexp_extract_all(name, '\\d+(?:\\.\\d+)*'), ',') AS versions FROM reps LEFT JOIN ak USING (label, norm))"""
_CLASSES = """
    held AS (SELECT label, unnest(keys) AS alias_key, rep, versions FROM r),
    least AS (SELECT label, alias_key, versions, min(rep) AS class_rep FROM held GROUP BY 1, 2, 3),
    classes AS (SELECT label, alias_key, rep, class_rep FROM held JOIN least USING (label, alias_key, versions)
                UNION ALL SELECT v.label, v.alias_key, v.class_rep, b.class_rep FROM least v JOIN least b USING (label, alias_key) WHERE v.versions <> '' AND b.versions = '')"""
_CAT = f"""
    cat0 AS (SELECT canonical_id AS node_id, label, trim(canonical_name) AS canonical_name, aliases, 0 AS source FROM lexicon
             UNION ALL SELECT entity_id, label, trim(canonical_name), aliases, 1 FROM ent WHERE {{ent}}),
    cat1 AS (SELECT *, {_n('canonical_name')} AS key FROM cat0 WHERE canonical_name <> '' AND label NOT IN {_SCOPED}),
    cat2 AS (SELECT label, key, list_sort(list_distinct(list(a))) AS aliases FROM (SELECT label, key, unnest(list_prepend(canonical_name, coalesce(aliases, []))) AS a FROM cat1) WHERE a IS NOT NULL GROUP BY 1, 2),
    cat AS (SELECT arg_min(node_id, (source, node_id, canonical_name)) AS node_id, label, key, any_value(cat2.aliases) AS aliases FROM cat1 JOIN cat2 USING (label, key) GROUP BY label, key)"""
_TGT = "t AS (SELECT resolution_id, any_value(surface_text) AS surface_text, any_value(candidate_targets) AS ct, any_value(source.sentence_id) AS sentence_id FROM reference_resolution_ignored WHERE resolution_id IS NOT NULL GROUP BY 1)"
_EMB = "q AS (SELECT a.vec_id AS query, b.vec_id AS neighbour, a.label AS ql, b.label AS nl, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 5) AS score FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND {cond} WHERE a.vec_id % 20 = 0), k AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, neighbour)::INT AS rank FROM q QUALIFY rank <= {k})"
_GENERIC = "('model','method','system','agent','data','result','study','approach','tool','task','framework','process','technology','technique','analysis','this model','the model','our model','this method','the method','this system','the system','this platform','the platform','new platform','current system','this approach','the approach','it','they','these results','llm based','llmbased','ai based','aibased')"


def oracle_sql() -> dict[str, str]:
    return {
        "entity_aliases": f"WITH {_ENT} SELECT DISTINCT 'entity_' || substr(sha256(label || chr(9247) || {_n('canonical_name')}), 1, 20) AS entity_id, canonical_name AS alias FROM ent WHERE canonical_name IS NOT NULL",
        "canonical_entities": f"WITH {_ENT}, m AS (SELECT *, {_n('canonical_name')} AS key FROM ent), g AS (SELECT label, key, arg_min(canonical_name, (-length(canonical_name), entity_id)) AS canonical_name, array_to_string(list_sort(list_distinct(list(canonical_name)))[1:200], '|') AS aliases, count(DISTINCT canonical_name) AS alias_count, count(*)::INT AS mention_count, array_to_string(list_sort(list(entity_id))[1:5], '|') AS evidence FROM m GROUP BY 1, 2) SELECT 'entity_' || substr(sha256(label || chr(9247) || key), 1, 20) AS entity_id, * FROM g",
        "alias_classes": f"WITH {_ENT},{_REPS},{_CLASSES} SELECT * FROM classes",
        "lexical_pairs": f"WITH {_ENT},{_REPS},{_CLASSES}, star AS (SELECT DISTINCT least(rep, class_rep) AS x, greatest(rep, class_rep) AS y, true AS star FROM classes WHERE rep <> class_rep), p0 AS (SELECT a.rep AS x, b.rep AS y, a.label, len(list_intersect(a.tokens, b.tokens)) / greatest(len(list_distinct(list_concat(a.tokens, b.tokens))), 1) AS j, list_has_any(a.keys, b.keys) AS alias_overlap, (contains(a.norm, b.norm) OR contains(b.norm, a.norm)) AND least(length(a.norm), length(b.norm)) >= 4 AS containment FROM r a JOIN r b ON a.label = b.label AND a.rep < b.rep WHERE NOT (a.versions <> '' AND b.versions <> '' AND a.versions <> b.versions)), p AS (SELECT p0.*, coalesce(star, false) AS star FROM p0 LEFT JOIN star USING (x, y)) SELECT x AS left_id, y AS right_id, label, CAST(round_even(CAST(j AS DECIMAL(18,10)), 4) AS DOUBLE) AS jaccard, containment, alias_overlap, CAST(round_even(CAST(greatest(CASE WHEN alias_overlap THEN 0.995 ELSE 0 END, CASE WHEN containment THEN 0.88 ELSE 0 END, j) AS DECIMAL(18,10)), 4) AS DOUBLE) AS score FROM p WHERE star OR containment OR j >= 0.64",
        "name_classes": f"WITH {_ENT},{_REPS} SELECT entity_id AS entity, rep FROM live JOIN reps USING (label, norm)",
        "prior_catalog": f"WITH {_ENT},{_CAT.format(ent='true')} SELECT node_id, label, key, array_to_string(aliases[1:200], '|') AS aliases, len(aliases) AS alias_count FROM cat",
        "catalog_aliases": f"WITH {_ENT},{_CAT.format(ent='true')} SELECT node_id, label, key, unnest(aliases) AS alias FROM cat",
        "exact_prior_nodes": f"WITH {_ENT},{_CAT.format(ent='false')}, o AS (SELECT label, key, min(node_id) AS node_id FROM cat GROUP BY 1, 2 HAVING count(DISTINCT node_id) = 1) SELECT entity_id, o.node_id AS matched_node_id FROM ent LEFT JOIN o ON ent.label = o.label AND {_n('ent.canonical_name')} = o.key",
        "merge_components": f"WITH RECURSIVE {_LOG},{_CC} SELECT node, component FROM cc",
        "merged_entities": f"WITH RECURSIVE {_ENT},{_LOG},{_CC}, x AS (SELECT ent.*, coalesce(component, entity_id) AS c FROM ent LEFT JOIN cc ON entity_id = node), a AS (SELECT c, array_to_string(list_sort(list_distinct(list(a)))[1:200], '|') AS aliases FROM (SELECT c, unnest(aliases) AS a FROM x) WHERE a IS NOT NULL GROUP BY 1) SELECT x.c AS entity_id, arg_min(label, (entity_id, label)) AS label, arg_max(canonical_name, (length(canonical_name), canonical_name)) AS canonical_name, sum(coalesce(mention_count, 0))::BIGINT AS mention_count, count(DISTINCT entity_id) AS members, any_value(a.aliases) AS aliases FROM x LEFT JOIN a ON x.c = a.c GROUP BY x.c",
        "merged_aliases": f"WITH RECURSIVE {_ENT},{_LOG},{_CC} SELECT DISTINCT coalesce(component, entity_id) AS entity_id, a AS alias FROM (SELECT entity_id, unnest(list_prepend(canonical_name, coalesce(aliases, []))) AS a FROM ent) LEFT JOIN cc ON entity_id = node WHERE a IS NOT NULL",
        "entity_mentions": f"WITH {_ENT},{_EM} SELECT * FROM em",
        "merged_mentions": f"WITH RECURSIVE {_ENT},{_LOG},{_EM}, s AS (SELECT a.entity_id AS u, b.entity_id AS v FROM log JOIN em a ON left_id = a.mention_id JOIN em b ON right_id = b.mention_id WHERE decision = 'same' AND a.entity_id <> b.entity_id), e AS MATERIALIZED (SELECT u, v FROM s UNION SELECT v, u FROM s), r AS (SELECT u AS node, u AS reach FROM e UNION SELECT r.node, e.v FROM r JOIN e ON r.reach = e.u), cc AS (SELECT node, min(reach) AS component FROM r GROUP BY 1) SELECT coalesce(component, entity_id) AS entity_id, mention_id FROM em LEFT JOIN cc ON entity_id = node",
        "embedding_topk": f"WITH {_EMB.format(cond='a.label = b.label', k=12)} SELECT query, neighbour, rank, score FROM k",
        "resolution_bands": f"WITH {_EMB.format(cond='a.label = b.label', k=12)} SELECT ql AS query_label, CASE WHEN score >= 0.35 THEN 'high' WHEN score >= 0.2 THEN 'middle' ELSE 'low' END AS band, count(*) AS pairs, max(score) AS best FROM k GROUP BY 1, 2",
        "review_queue": f"WITH {_LOG}, p AS (SELECT *, CASE decision WHEN 'same' THEN 0.9 WHEN 'pending' THEN 0.7 ELSE 0.3 END::DOUBLE AS score FROM log WHERE label IS NOT NULL AND left_name IS NOT NULL AND right_name IS NOT NULL) SELECT CASE WHEN score >= 0.82 THEN 'high' WHEN score >= 0.63 THEN 'middle' ELSE 'low' END AS band, label, least(lower(left_name), lower(right_name)) AS name_a, greatest(lower(left_name), lower(right_name)) AS name_b, count(*) AS pairs, max(score) AS best_score, min(score) AS least_score FROM p GROUP BY 1, 2, 3, 4",
        "calibration_sweep": f"WITH {_EMB.format(cond='true', k=40)}, t AS (SELECT round(0.05 + 0.02 * i, 2)::DOUBLE AS threshold FROM range(21) x(i)), c AS (SELECT threshold, count_if(score >= threshold AND ql = nl)::BIGINT AS tp, count_if(score >= threshold AND ql <> nl)::BIGINT AS fp, count_if(score < threshold AND ql <> nl)::BIGINT AS tn, count_if(score < threshold AND ql = nl)::BIGINT AS fn FROM t, k GROUP BY 1), d AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM c) SELECT threshold, tp, fp, tn, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1, round((r + CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END) / 2, 6) AS balanced_accuracy FROM d",
        "dense_typing_topk": "WITH c AS (SELECT label, list(m ORDER BY i) AS v FROM (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE label IS NOT NULL) GROUP BY 1, 2) GROUP BY 1), s AS (SELECT vec_id, c.label, list_cosine_similarity(embedding::DOUBLE[], c.v) AS s FROM embeddings, c), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS k, lead(s) OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS s2 FROM s) SELECT vec_id, label AS selected_label, round(s, 6) AS selected_score, round(s - s2, 6) AS score_margin, s >= 0.15 AND s - s2 >= 0.01 AS applicable FROM r WHERE k = 1",
        "tfidf_class_scores": rf"""
            WITH {_ENT}, b AS (SELECT 0 AS side, label AS k, regexp_extract_all(replace(lower(concat_ws(' ', canonical_name, definition)), 'ß', 'ss'), '[a-z0-9]+') AS words FROM lexicon WHERE label IS NOT NULL
                               UNION ALL SELECT DISTINCT 1, canonical_name, regexp_extract_all(replace(lower(canonical_name), 'ß', 'ss'), '[a-z0-9]+') FROM ent WHERE canonical_name IS NOT NULL),
            f AS (SELECT side, k, 'w:' || unnest(words) AS t, 1.0::DOUBLE AS w FROM b
                  UNION ALL SELECT side, k, 'c:' || substr(j, i, n), 0.35::DOUBLE FROM (SELECT side, k, j, n, unnest(range(1, length(j) - n + 2)) AS i FROM (SELECT side, k, array_to_string(words, ' ') AS j, unnest([3, 4, 5]) AS n FROM b))),
            g AS (SELECT side, k, t, sum(w) AS tf FROM f GROUP BY 1, 2, 3), n AS (SELECT count(DISTINCT k) AS n FROM g WHERE side = 0),
            idf AS (SELECT t, ln((1 + any_value(n.n)) / (1 + count(*))) + 1 AS idf FROM g, n WHERE side = 0 GROUP BY 1),
            v AS (SELECT side, k, t, tf * coalesce(idf, 1) AS w FROM g LEFT JOIN idf USING (t)), z AS (SELECT side, k, sqrt(sum(w * w)) AS z FROM v GROUP BY 1, 2),
            d AS (SELECT x.k AS name, c.k AS label, sum(x.w * c.w) AS d FROM v x JOIN v c USING (t) WHERE x.side = 1 AND c.side = 0 GROUP BY 1, 2)
            SELECT entity_id, d.label, round(d / (zc.z * zx.z), 6) AS score FROM ent JOIN d ON d.name = canonical_name JOIN z zc ON zc.side = 0 AND zc.k = d.label JOIN z zx ON zx.side = 1 AND zx.k = d.name""",
        "redundant_review": f"WITH {_LOG}, l AS (SELECT *, {_n('left_name')} AS s FROM log WHERE left_id IS NOT NULL AND right_id IS NOT NULL AND left_name IS NOT NULL) SELECT decision_id, left_id, right_id FROM l a WHERE decision = 'pending' AND NOT EXISTS (SELECT 1 FROM l b WHERE b.decision = 'same' AND b.left_id = a.left_id AND b.right_id = a.right_id AND b.s = a.s)",
        "reference_verdicts": f"WITH {_LOG}, g AS (SELECT resolution_id, count(*) AS pairs, count(*) FILTER (upper(decision) = 'SAME' AND label IS NOT NULL) AS same, count(*) FILTER (upper(decision) = 'DIFFERENT') AS different FROM log WHERE resolution_id IS NOT NULL GROUP BY 1) SELECT *, CASE WHEN same = 1 AND different = pairs - 1 THEN 'resolved' WHEN different = pairs THEN 'ignored' ELSE 'pending' END AS status FROM g",
        "decision_replay": f"WITH {_LOG} SELECT left_id || '|' || right_id AS pair, arg_max({{'d': decision}}, (reviewed_at, decision_id)).d AS decision, arg_max(decision_id, (reviewed_at, decision_id)) AS decision_id FROM log WHERE left_id < right_id GROUP BY 1",
        "judgment_repair": "WITH e AS (SELECT DISTINCT resolution_id AS id FROM reference_resolution_ignored WHERE resolution_id IS NOT NULL), g AS (SELECT resolution_id AS id, min(status) AS d, count(*) AS n FROM reference_resolution_ignored WHERE reason IS NOT NULL GROUP BY 1) SELECT coalesce(d, 'review') AS decision, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'repeated' ELSE 'none' END AS repair, count(*) AS n FROM e LEFT JOIN g USING (id) GROUP BY 1, 2",
        "argument_index": "SELECT l_suppkey, l_returnflag, array_to_string(list_sort(list_distinct(list(l_linestatus))), ',') AS roles, count(DISTINCT l_orderkey) AS triples FROM lineitem GROUP BY 1, 2",
        "untraceable_candidates": f"WITH {_TGT} SELECT resolution_id, CASE WHEN coalesce(trim(sentence_id), '') = '' THEN 'reject' ELSE 'review' END AS outcome, CASE WHEN coalesce(trim(sentence_id), '') = '' THEN 'untraceable' ELSE 'unjudged' END AS reason_code FROM t",
        "observations": r"""
            WITH m AS (SELECT DISTINCT s.sentence_id AS sentence_id, s.text AS text FROM (SELECT unnest(source.context_sentences) AS s FROM reference_resolution_ignored) WHERE s.sentence_id IS NOT NULL AND s.text IS NOT NULL),
            f AS (SELECT *, regexp_matches(text, '(?i)\b(we|our|this (study|paper|work)|the proposed|our (model|method|approach))\b') AS first FROM m)
            SELECT sentence_id, array_to_string(regexp_extract_all(text, p, 1), ',') AS values, array_to_string(regexp_extract_all(text, p, 2), ',') AS units
            FROM f, (SELECT '(?i)(\d+(?:\.\d+)?)\s*(%|percent|mg(?:N)?/L|[µu]g/L|ng/L|ppm|ppb|°C|K|h|hr|hours?|min|minutes?|days?|gCO[^\s,.;)]*)(?:$|[^A-Za-z0-9])' AS p)
            WHERE NOT regexp_matches(text, '(?i)\b(future work|will aim|will be|would|could|may|might|expected to|plans? to|aims? to|potential to)\b')
              AND NOT (regexp_matches(text, '\[[0-9,;\s-]+\]|\b[A-Z][A-Za-z-]+\s+et\s+al\.|\([A-Z][A-Za-z-]+(\s+et\s+al\.)?,\s*\d{4}[a-z,]*\)') AND regexp_matches(text, '(?i)\b(proposed|developed|used|applied|demonstrated|reported|found|showed|achieved|optimized|trained|removed)\b') AND NOT first)
              AND regexp_matches(text, '(?i)\b(remov(e|es|ed|al)|measur(e|es|ed)|observ(e|es|ed)|detect(s|ed)?|predict(s|ed|ion)?|reduc(e|es|ed|tion)|increas(e|es|ed)|decreas(e|es|ed)|achiev(e|es|ed)|efficien(cy|t)|concentration)\b')
              AND regexp_matches(text, p)""",
        "adjudication_outcomes": f"""
            WITH {_TGT}, c AS (SELECT resolution_id, surface_text, coalesce(ct[1].label, '') AS label, list_transform(ct, lambda x: x.label) AS alternatives, sentence_id FROM t),
            j0 AS (SELECT resolution_id, surface_text, unnest(ct) AS x FROM t),
            j AS (SELECT resolution_id, min({{'d': CASE WHEN x.distance = 0 THEN 'accept' WHEN x.distance = 1 THEN 'review' ELSE 'reject' END, 'l': x."label", 'n': CASE WHEN x.distance = 0 THEN surface_text ELSE x.canonical_name END}}) AS j FROM j0 GROUP BY 1),
            k AS (SELECT c.*, j.j.d AS d, j.j.l AS l, j.j.n AS n FROM c LEFT JOIN j USING (resolution_id)),
            r AS (SELECT CASE WHEN coalesce(trim(sentence_id), '') = '' THEN 'untraceable' WHEN d IS NULL THEN 'unjudged'
                  WHEN coalesce({_n('n')} IN {_GENERIC}, false) THEN 'generic_name'
                  WHEN NOT coalesce({_n('n')} <> '' AND {_n('surface_text')} <> '' AND contains({_n('surface_text')}, {_n('n')}), false) THEN 'not_grounded'
                  WHEN d = 'accept' AND (len(list_filter(list_append(coalesce(alternatives, []), label), lambda a: a IS NOT NULL AND a NOT IN ('', 'NONE'))) = 0 OR coalesce(list_contains(list_append(coalesce(alternatives, []), label), l), false)) THEN 'accepted'
                  WHEN d = 'accept' THEN 'unsupported_label' WHEN d = 'review' THEN 'judge_review' ELSE 'judge_reject' END AS reason_code FROM k)
            SELECT CASE WHEN reason_code = 'accepted' THEN 'accept' WHEN reason_code IN ('unjudged', 'unsupported_label', 'judge_review') THEN 'review' ELSE 'reject' END AS outcome, reason_code, count(*) AS candidates FROM r GROUP BY 1, 2""",
        "reference_outcomes": f"""
            WITH {_TGT}, c AS (SELECT resolution_id, surface_text, x.distance AS distance, concat_ws('/', x."label", {_n('x.canonical_name')}) AS identity FROM (SELECT resolution_id, surface_text, unnest(ct) AS x FROM t)),
            o AS (SELECT resolution_id, identity, min(distance) AS d, bool_or(regexp_matches(lower(surface_text), '^(this|that|our|the)\\s')) AS s, bool_or(regexp_matches(lower(surface_text), '(s$|they|them)')) AS p, min(length(surface_text)) AS g FROM c WHERE distance BETWEEN 0 AND 2 GROUP BY 1, 2),
            n AS (SELECT resolution_id, min(d) AS nearest, count(*) AS candidates, bool_or(s) AS s, bool_or(p) AS p FROM o GROUP BY 1),
            u AS (SELECT n.*, (SELECT count(*) FROM o WHERE o.resolution_id = n.resolution_id AND o.d = n.nearest) AS k FROM n)
            SELECT resolution_id, CASE WHEN coalesce(s, false) AND NOT coalesce(p, false) AND k = 1 AND nearest <= 1 THEN 'resolved' WHEN candidates <= 5 THEN 'review' ELSE 'ignored' END AS outcome, candidates, nearest FROM u""",
    }

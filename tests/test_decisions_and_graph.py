import pytest
from pyspark.sql import functions as F

from lodestrata.operators import decisions, evaluation, graph, relations, review

C = "candidate_id string, surface_text string, label string, alternatives array<string>, sentence_id string"
J = "candidate_id string, decision string, ontology_label string, judged_name string"


def test_adjudication(spark):
    c = [("1", "the AquaNet tool", "Tool", ["Model"], "s"), ("2", "AquaNet", "Tool", [], "s"), ("3", "AquaNet", "Tool", None, "s"), ("4", "AquaNet", "Tool", None, ""), ("5", "AquaNet", "Tool", None, "s"), ("6", "AquaNet", "", [""], "s"), ("7", "AquaNet", "Tool", None, "s"), ("8", "the model", "Model", None, "s")]
    j = [("1", "accept", "Model", "AquaNet"), ("2", "accept", "Dataset", "AquaNet"), ("3", "accept", "Tool", "HydroNet"), ("4", "accept", "Tool", "AquaNet"), ("6", "accept", "Any", "AquaNet"), ("7", "review", "NONE", "AquaNet"), ("8", "accept", "Model", "the model"), ("9", "accept", "Tool", "x")]
    out = {r.candidate_id: (r.outcome, r.reason_code, r.final_label) for r in decisions.adjudicate(spark.createDataFrame(c, C), spark.createDataFrame(j, J)).collect()}
    assert out == {
        "1": ("accept", "accepted", "Model"), "2": ("review", "unsupported_label", "Dataset"), "3": ("reject", "not_grounded", "Tool"), "4": ("reject", "untraceable", "Tool"),
        "5": ("review", "unjudged", "Tool"), "6": ("accept", "accepted", "Any"), "7": ("review", "judge_review", "Tool"), "8": ("reject", "generic_name", "Model"),
    }
    none = decisions.without_model(spark.createDataFrame(c, C))
    assert none.where("outcome = 'reject'").count() == 1


def test_repair_replay_and_references(spark):
    e = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "candidate_id string")
    r = spark.createDataFrame([("a", "accept", ""), ("b", "reject", "x"), ("b", "accept", "y"), ("z", "accept", "q")], "candidate_id string, decision string, reason string")
    assert sorted((x.candidate_id, x.decision, x.repair) for x in decisions.repair_judgments(e, r).collect()) == [("a", "accept", "no_reason"), ("b", "accept", "repeated"), ("c", "review", "missing")]
    v = spark.createDataFrame([("1", "SAME", 0.9), ("1", "DIFFERENT", 0.9), ("2", "same ", 0.5), ("3", "DIFFERENT", 0.1), ("4", "SAME", 0.9), ("4", "SAME", 0.9)], "k string, d string, c double")
    assert {x.k: x.status for x in decisions.pairwise_verdict(v, "k", "d", "c").collect()} == {"1": "resolved", "2": "pending", "3": "ignored", "4": "pending"}
    t = spark.createDataFrame([("a", 1, "x", True, False, 0), ("a", 2, "y", True, False, 0), ("b", 1, "x", True, False, 0), ("b", 1, "y", True, False, 0), ("c", 2, "x", True, False, 0), ("d", 0, "x", True, False, 900)] + [("e", 1, f"i{n}", True, False, 0) for n in range(7)], "k string, d int, i string, s boolean, p boolean, g int")
    out = decisions.reference_outcome(t, "k", "d", "i", F.col("s"), F.col("p"), F.col("g"))
    assert {x.k: x.outcome for x in out.collect()} == {"a": "resolved", "b": "review", "c": "review", "d": "review", "e": "ignored"}


def test_relation_gates(spark):
    base = {g: F.lit(True) for g in decisions.RELATION_GATES}
    p = spark.createDataFrame([("accept", 0.9), ("reject", 0.9), ("accept", 0.5), (None, 0.9)], "decision string, confidence double")
    assert [r.status for r in decisions.relation_status(p, base).collect()] == ["accepted", "rejected", "review", "rejected"]
    lost = {**base, "endpoints_resolved": F.lit(None).cast("boolean")}
    assert decisions.relation_status(p, lost).first().status == "unresolved"
    assert decisions.relation_status(p, {**base, "not_negated": F.lit(False)}).first().failed_gates == ["not_negated"]
    with pytest.raises(ValueError):
        decisions.relation_status(p, {"confirmed": F.lit(True)})


def test_observations(spark):
    s = [("1", "We measured a removal of 45.5 % and 3 mg/L."), ("2", "It would remove 4 %."), ("3", "Lund et al. reported removal of 4 %."), ("4", "No numbers were observed."), ("5", "Removal rose by 3°C."), ("6", None)]
    out = decisions.observations(spark.createDataFrame(s, "sid string, text string"), ["sid"], known=spark.createDataFrame([("5",)], "sid string"))
    assert [(r.sid, list(r["values"]), r.units) for r in out.collect()] == [("1", ["45.5", "3"], ["%", "mg/L"])]


def test_relations(spark):
    a = spark.createDataFrame([("a1", "m1", "REMOVES", "m2", "e1", 0.8), ("a2", "m1", "REMOVES", "m2", "e1", 0.9), ("a3", "m3", "REMOVES", "m2", "e2", 0.7), ("a4", "m1", "REMOVES", "m3", "e9", 0.7), ("a5", "m1", "REMOVES", "mX", "e9", 0.7)], "assertion_id string, subject_mention_id string, predicate string, object_mention_id string, evidence string, confidence double")
    me = spark.createDataFrame([("m1", "E1"), ("m3", "E1"), ("m2", "E2")], "mention_id string, entity_id string")
    e = relations.endpoints(a, me)
    r = relations.materialize(e, ["subject_entity_id", "predicate", "object_entity_id"], "evidence", "confidence", "assertion_id").collect()
    assert [(x.support_count, x.assertion_ids) for x in r] == [(2, "a2,a3")]
    d = relations.dedupe_assertions(a.withColumn("n", F.monotonically_increasing_id()), ["subject_mention_id", "evidence"], "confidence", "n")
    assert {x.assertion_id for x in d.collect()} == {"a2", "a3", "a4"}
    o = spark.createDataFrame([("Model", "Tool"), ("Tool", "Thing"), ("Loop", "Loop2"), ("Loop2", "Loop")], "label string, parent string")
    clo = relations.ancestors(o)
    assert {x.ancestor for x in clo.where("label = 'Model'").collect()} == {"Model", "Tool", "Thing"}
    perm = spark.createDataFrame([("USES", "Tool", "Thing")], "predicate string, domain string, range string")
    edges = spark.createDataFrame([("1", "Model", "USES", "Model"), ("2", "Thing", "USES", "Model"), ("3", "Model", "EATS", "Model")], "edge_id string, subject_label string, predicate string, object_label string")
    assert {x.edge_id for x in relations.domain_range_violations(edges, clo, perm).collect()} == {"2", "3"}
    assert relations.eligible_predicates(spark.createDataFrame([("Model",)], "label string"), clo, perm).count() == 1
    assert relations.eligible_predicates(spark.createDataFrame([("Thing",)], "label string"), clo, perm).count() == 0
    m = spark.createDataFrame([("d", "m1", "Aqua", "AquaNet"), ("d", "m2", "Hydro", "Hydro"), ("d", "m3", "hydro", "X")], "document_id string, mention_id string, surface_text string, canonical_name string")
    x = spark.createDataFrame([("1", "d", "aquanet "), ("2", "d", "HYDRO"), ("3", "e", "Aqua")], "k string, document_id string, t string")
    assert {r.k: r.mention_id for r in relations.repair_endpoints(x, m, "k", "t").collect()} == {"1": "m1", "2": None, "3": None}


def test_graph_upsert_is_idempotent(spark):
    n = spark.createDataFrame([("e1", "Tool", "A"), ("e2", "Tool", "B"), ("e3", "Tool", "C")], "entity_id string, label string, name string")
    m = spark.createDataFrame([("e1", "d1", "m1", "a"), ("e1", "d2", "m2", "a"), ("e2", "d1", "m3", "b"), ("e3", "d2", "m4", "c")], "entity_id string, document_id string, mention_id string, surface string")
    e = spark.createDataFrame([("e1", "USES", "e2", "d1"), ("e1", "USES", "e3", "d2")], "source string, predicate string, target string, document_id string")
    d = spark.createDataFrame([("d1",)], "document_id string")
    new = (spark.createDataFrame([("e1", "Tool", "A2"), ("e4", "Tool", "D")], n.schema), spark.createDataFrame([("e1", "d1", "m9", "a"), ("e4", "d1", "m8", "d")], m.schema), spark.createDataFrame([("e1", "USES", "e4", "d1")], e.schema))
    once = graph.upsert(n, m, e, *new, d)
    twice = graph.upsert(*once, *new, d)
    rows = lambda g: [sorted(map(tuple, t.collect())) for t in g]
    assert rows(once) == rows(twice)
    assert sorted((r.entity_id, r.name) for r in once[0].collect()) == [("e1", "A2"), ("e3", "C"), ("e4", "D")]
    assert sorted(map(tuple, once[2].collect())) == [("e1", "USES", "e3", "d2"), ("e1", "USES", "e4", "d1")]
    assert {r["check"]: r["count"] for r in graph.verify(*once).collect()} == {"nodes_without_mentions": 0, "mentions_without_node": 0, "edge_ends_without_node": 0, "loops": 0, "repeated_ids": 0}
    bad = spark.createDataFrame([(None, "Tool", "x"), ("1", "Bad label", "y"), ("2", "Mention", "z"), ("3", "Tool", "Same"), ("4", "Tool", "same"), ("5", "Claim", "k"), ("6", "Claim", "k")], n.schema)
    assert sorted((r.entity_id or "", r.code) for r in graph.node_problems(bad).collect()) == [("", "missing_id"), ("1", "unsafe_label"), ("2", "provenance_label"), ("3", "duplicate_name"), ("4", "duplicate_name")]
    assert {r.entity_id: r.aligned_id for r in graph.align_identities(spark.createDataFrame([("x", "Tool", "a "), ("y", "Tool", "new")], n.schema), n, m).collect()} == {"x": "e1", "y": "y"}
    assert graph.neighbourhood(e, n, "Tool").count() == 4 and graph.typed_edges(e, n, "USES").count() == 2


def test_evaluation(spark):
    q = spark.createDataFrame([("a", "P"), ("b", "Q"), ("c", "R")], "question string, predicate string")
    r = spark.createDataFrame([("1", "P", "x"), ("2", "P", "x"), ("3", "Q", "y")], "relationship_id string, predicate string, answer string")
    e = spark.createDataFrame([("1", "quote"), ("2", " ")], "relationship_id string, quote string")
    assert {x.question: (x.status, x.answers, x.evidence) for x in evaluation.answer_questions(r, e, q).collect()} == {"a": ("answerable", 1, 1), "b": ("not_answerable", 1, 0), "c": ("not_answerable", 0, 0)}
    u = evaluation.usage_rollup(spark.createDataFrame([("s", 1), ("s", 2), ("t", 3)], "stage string, n int"), "stage", {"n": F.sum("n")})
    assert sorted((x.is_total, x.calls, x.n) for x in u.collect()) == [(0, 1, 3), (0, 2, 3), (1, 3, 6)]
    g = evaluation.regression_gate(spark.createDataFrame([("p", "Aqua ")], "paper string, name string"), spark.createDataFrame([("p", "aqua", "required"), ("p", "aqua", "forbidden"), ("p", "x", "forbidden")], "paper string, name string, kind string"))
    assert sorted((x.name, x.kind, x.passed) for x in g.collect()) == [("aqua", "forbidden", False), ("aqua", "required", True), ("x", "forbidden", True)]
    with pytest.raises(RuntimeError):
        evaluation.require(False, "empty parse")


def test_review(spark):
    log = spark.createDataFrame([("p0", "same", "A", "A", "B")], "pair string, decision string, chosen_name string, left_name string, right_name string")
    new = spark.createDataFrame([("p1", "same", "A", "A", "B"), ("p2", "same", "Z", "A", "B"), ("p3", "maybe", None, "A", "B")], log.schema)
    out, refused = review.record(log, new, ["same", "distinct"], ["pair"], F.lit("2026-01-01").cast("timestamp"))
    assert out.count() == 2 and sorted(r.pair for r in refused.collect()) == ["p2", "p3"]
    pairs = spark.createDataFrame([("r1", "pending"), ("r2", "pending")], "resolution_id string, status string")
    old = spark.createDataFrame([("r1", "same"), ("r2", "pending")], pairs.schema)
    assert {r.resolution_id: r.status for r in review.carry_over(pairs, old).collect()} == {"r1": "same", "r2": "pending"}
    c = spark.createDataFrame([("1", "review"), ("2", "accept")], "candidate_id string, outcome string")
    h = spark.createDataFrame([("1", "accept", "2026-01-01"), ("2", "reject", "2026-01-01"), ("2", "accept", "2025-01-01")], "candidate_id string, decision string, reviewed_at string")
    assert {r.candidate_id: (r.outcome, r.human) for r in review.apply_node_reviews(c, h).collect()} == {"1": ("accept", True), "2": ("reject", True)}

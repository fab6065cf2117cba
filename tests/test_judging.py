import json

from pyspark.sql import functions as F

from lodestrata.operators import judging

CANDIDATES = "candidate_id string, sentence_id string, text string, label string, surface_text string, start_char int, end_char int"


def rows(spark):
    c = [(f"c{i}", "s1", "The pump ran.", "Tool", "pump", 4, 8) for i in range(4)] + [("c9", "s2", None, "Model", "x", 0, 1), ("c8", None, "t", "Tool", "y", 0, 1)]
    return spark.createDataFrame(c, CANDIDATES)


def test_requests_are_divided_and_stable(spark):
    whole = {(r.sentence_id, r.fragment): r for r in judging.requests(rows(spark)).collect()}
    assert set(whole) == {("s1", 0), ("s2", 0)} and whole["s1", 0].candidate_ids == ["c0", "c1", "c2", "c3"]
    assert json.loads(whole["s1", 0].payload)["text"] == "The pump ran."
    parts = judging.requests(rows(spark).repartition(3), most_chars=200).collect()
    assert sorted(c for r in parts for c in r.candidate_ids) == ["c0", "c1", "c2", "c3", "c9"] and len(parts) == 3
    again = {r.request_hash for r in judging.requests(rows(spark).repartition(5), most_chars=200).collect()}
    assert again == {r.request_hash for r in parts}


def test_cache_calls_and_parsing(spark):
    asked = judging.requests(rows(spark))
    answer = json.dumps({"judgments": [{"candidate_id": "c0", "decision": "accept"}], "discoveries": [{"label": "Tool", "surface_text": "pump"}]})

    def backend(payload, attempt):
        if '"s2"' in payload:
            raise ValueError("down")
        return answer if attempt else "[1]"

    got = {r.attempts: (r.response, r.error) for r in judging.call(asked, backend).collect()}
    assert len(got) == 1 and judging.call(asked, backend).where("response is null").first().error == "ValueError: down"
    h = asked.where("sentence_id = 's1'").first().request_hash
    cache = spark.createDataFrame([(h, answer), (h, "nonsense"), ("other", answer)], "request_hash string, response string")
    known = judging.answered(asked, cache)
    assert {(r.sentence_id, r.cached) for r in known.collect()} == {("s1", True), ("s2", False)}
    judged, found = judging.parsed(known)
    assert [(r.sentence_id, r.candidate_id, r.decision) for r in judged.collect()] == [("s1", "c0", "accept")] and found.count() == 1


def test_clean_up(spark):
    returned = spark.createDataFrame([("s2", "wrong", "accept"), ("s1", "c0", "accept"), ("s1", "zz", "accept")], "sentence_id string, candidate_id string, decision string")
    got = {tuple(r) for r in judging.restored_ids(rows(spark), returned).collect()}
    assert got == {("s2", "c9", "accept"), ("s1", "c0", "accept"), ("s1", "zz", "accept")}
    pairs = spark.createDataFrame([("a",), ("b",), (None,)], "pair_id string")
    back = spark.createDataFrame([("a",), ("a",), ("x",)], "pair_id string")
    assert {tuple(r) for r in judging.faults(pairs, back).collect()} == {("b", "missing"), ("x", "unknown"), ("a", "repeated")}
    assert judging.faults(pairs, pairs.dropna()).count() == 0
    d = spark.createDataFrame([("s1", "Tool", "PUMP", 20, 24), ("s1", "Model", "other", 4, 8), ("s1", "Model", "pump", 30, 34), ("s1", "Model", "pump", 30, 34)], "sentence_id string, label string, surface_text string, start_char int, end_char int")
    assert [(r.label, r.start_char) for r in judging.new_discoveries(d, rows(spark)).collect()] == [("Model", 30)]


def test_mentions_of_entities(spark):
    e = spark.createDataFrame([("e1", "Tool", ["m1", "m2", "m1"]), ("e2", "Tool", ["m1", "m3"]), ("e3", None, None)], "entity_id string, label string, mention_ids array<string>")
    m = spark.createDataFrame([("m1", "Tool"), ("m3", "Model")], "mention_id string, label string")
    got = {(r.entity_id, r.position): r.fault for r in judging.mentions_of(e, m).collect()}
    assert got == {("e1", 0): None, ("e1", 1): "missing", ("e1", 2): "claimed_twice", ("e2", 0): "claimed_twice", ("e2", 1): "other_label"}
    assert judging.mentions_of(e.where(F.lit(False)), m).count() == 0

from pyspark.sql import functions as F

from lodestrata.operators import decisions, discovery, relations

from .test_layout import LINES, line


def test_described_systems_share_a_name(spark):
    rows = [("d", "1", "We propose a leak detection framework for plants."), ("d", "2", "This paper presents a leak localisation system."), ("d", "3", "We develop a dosing assistant."), ("e", "4", "We propose a leak framework."), ("e", "5", None)]
    s = spark.createDataFrame(rows, "document_id string, sid string, text string")
    got = {r.sid: (r.surface_text, r.canonical_name) for r in discovery.described_systems(s, "document_id", "sid").collect()}
    assert got["1"][1] == got["2"][1] and got["3"][1] == "dosing assistant" and got["4"][1] == "leak framework"
    assert all(dict((b, c) for _, b, c in rows)[k].find(v[0]) > 0 for k, v in got.items())


def test_names_and_datasets(spark):
    x = spark.createDataFrame([("GPT-4",), ("LLM",), ("ABCD",), ("May-2024",), ("Fe/Cu",), ("CoderAgent",), ("XGBoost",)], "n string")
    ok = [r.n for r in x.where(discovery.valid_model_name(F.col("n"), ["llm"])).collect()]
    assert ok == ["GPT-4", "XGBoost"]
    d = spark.createDataFrame([("d", "120 papers"), ("d", "corpus of 120 recent studies"), ("d", "40 data points"), ("d", "40 raw data points"), ("d", "L-Town")], "document_id string, surface_text string")
    assert sorted({r.canonical_name for r in discovery.counted_datasets(d, "document_id").collect()}) == ["120-paper corpus", "40 raw data points", "L-Town"]
    n = spark.createDataFrame([("Tool", "epa net", "EPANET")], "label string, pattern_text string, canonical_name string")
    s = spark.createDataFrame([("Tool", "EPA-NET"), ("Tool", "Other")], "label string, surface_text string")
    assert sorted(r.canonical_name for r in discovery.with_canonical_names(s, n).collect()) == ["EPANET", "Other"]


def test_front_matter(spark):
    rows = [line("A study of", 10.0, seq=0, size=20.0), line("tanks", 32.0, seq=1, size=20.0), line("Ann Lee, Bo Wu", 60.0, seq=2), line("Abstract", 80.0, seq=3), line("We ran it.", 95.0, seq=4), line("Only title", 1.0, seq=0, size=18.0, doc="e"), line("text", 20.0, seq=1, doc="e")]
    got = {r.document_id: (r.title, r.authors_text, r.body_seq) for r in discovery.front_matter(spark.createDataFrame(rows, LINES)).collect()}
    assert got == {"d": ("A study of tanks", "Ann Lee, Bo Wu", 3), "e": ("Only title", "", 1)}


def test_headings_and_prose(spark):
    t = spark.createDataFrame([("I. I NTRODUCTION",), ("8. References",), ("ABSTRACT",), ("short",)], "t string")
    rows = t.select(discovery.canonical_heading(F.col("t")).alias("h"), discovery.is_back_matter(F.col("t")).alias("b"), discovery.narrative(F.col("t")).alias("n")).collect()
    assert [r.h for r in rows] == ["I. INTRODUCTION", "References", "Abstract", "short"] and [r.b for r in rows] == [False, True, False, False] and not rows[3].n


def test_windows_reports_and_ontology(spark):
    e = spark.createDataFrame([("w1",), ("w2",)], "window_id string")
    r = spark.createDataFrame([("w1", "USES"), ("w1", "USES"), ("w9", "USES")], "window_id string, predicate string")
    assert sorted((x.window_id, x.predicate or "", x.answered) for x in decisions.normalize_windows(e, r).collect()) == [("w1", "USES", True), ("w2", "", False)]
    c = spark.createDataFrame([("a",), ("b",)], "k string")
    j = spark.createDataFrame([("a", "reject"), ("a", "accept"), (None, "x")], "k string, decision string")
    assert sorted((x.k, x.decision) for x in discovery.result_report(c, j, "k").collect()) == [("a", "accept"), ("b", "unjudged")]
    n = spark.createDataFrame([("Tool",), ("Model",), (" ",)], "label string")
    p = spark.createDataFrame([("USES", ["Tool", "Gone"], ["Model"])], "predicate string, domains array<string>, ranges array<string>")
    classes, edges, counts = relations.ontology_tables(n, p)
    assert {x.what: x.n for x in counts.collect()} == {"classes": 2, "schema_edges": 1, "expected_edges": 2}
    assert discovery.restrict_sections(spark.createDataFrame([("Results",), (None,)], "section_title string"), ["results "]).count() == 1

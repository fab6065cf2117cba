from pyspark.sql import functions as F

from lodestrata.operators import audit, paragraphs

LINES = "document_id string, pos int, text string, page int, top double, bottom double, x0 double, size double, bold boolean, italic boolean, body_size double, heading_line boolean"


def line(pos, text, top, x0=50.0, page=1, size=10.0, bold=False, heading=False, doc="d"):
    return (doc, pos, text, page, top, top + 10, x0, size, bold, False, 10.0, heading)


def parts(spark, rows):
    got = paragraphs.paragraph_lines(spark.createDataFrame(rows, LINES)).orderBy("document_id", "pos").collect()
    return [(r.text, r.section, r.paragraph) for r in got], got


def test_unfinished_sentence_across_columns_is_one_paragraph(spark):
    rows = [line(0, "The pump ran at the plant and", 700.0), line(1, "then it stopped.", 60.0, 320.0), line(2, "A new one began", 80.0, 332.0), line(3, "on Monday.", 92.0, 320.0)]
    got, _ = parts(spark, rows)
    assert [p for _, _, p in got] == [1, 1, 2, 2]


def test_breaks_need_layout_and_grammar(spark):
    rows = [line(0, "It ended.", 10.0), line(1, "No gap here.", 21.0), line(2, "A gap here.", 40.0), line(3, "12, 13", 60.0), line(4, "no stop before", 62.0), line(5, "1. an item", 90.0), line(6, "Next page.", 10.0, page=2), line(7, "Last page.", 10.0, page=3)]
    assert [p for _, _, p in parts(spark, rows)[0]] == [1, 1, 2, 2, 3, 4, 4, 5]


def test_wrapped_headings(spark):
    head = dict(size=12.0, bold=True)
    rows = [line(0, "Before it.", 0.0), line(1, "2 A long heading", 20.0, heading=True, **head), line(2, "that goes on", 31.0, **head), line(3, "and on", 42.0, **head), line(4, "Bold text of its own.", 53.0, **head), line(5, "More text.", 64.0), line(6, "8. References", 100.0, heading=True, bold=True)]
    got, full = parts(spark, rows)
    assert [(s, p) for _, s, p in got] == [(0, 1), (1, 0), (1, 0), (1, 0), (1, 1), (1, 1), (2, 0)]
    assert [r.heading for r in full] == [None] + ["2 A long heading that goes on and on"] * 5 + ["References"]


def test_reconstruction(spark):
    rows = [line(0, "1 Results", 0.0, heading=True), line(1, "The flow fell and", 20.0), line(2, "3.1 % 4", 40.0), line(3, "Received: May 3.", 60.0), line(4, "(with pumps) it rose.", 80.0), line(5, "These count:", 100.0), line(6, "1) one item.", 120.0), line(7, "Unfinished end", 140.0)]
    lines = paragraphs.paragraph_lines(spark.createDataFrame(rows, LINES)).withColumn("paragraph", F.when(F.col("is_heading"), 0).otherwise(F.col("pos")))
    got = paragraphs.reconstructed_paragraphs(lines, F.col("text").rlike("^Received:")).orderBy("paragraph").collect()
    assert [(r.heading, r.paragraph, r.text, r.pages, r.lines) for r in got] == [("1 Results", 0, "The flow fell and (with pumps) it rose.", [1], 2), ("1 Results", 1, "These count:", [1], 1), ("1 Results", 2, "1) one item.", [1], 1)]
    assert paragraphs.reconstructed_paragraphs(lines.limit(0)).count() == 0


def test_page_summary(spark):
    pages = spark.createDataFrame([("a", 20, 90_000, 0), ("b", 2, 100, 3), ("c", 0, 0, None)], "document_id string, pages int, characters int, discarded int")
    paras = spark.createDataFrame([("a", [1, 2]), ("a", [2, 4]), ("b", [1, 2])], "document_id string, pages array<int>")
    got = {r.document_id: r for r in audit.page_summary(paras, pages).collect()}
    assert got["a"].warnings == ["early_cutoff"] and got["a"].narrative_page_ratio == 0.15 and got["a"].last_narrative_page == 4
    assert got["b"].warnings == ["low_text_density", "discarded_fragments"] and got["c"].narrative_page_ratio == 0


def test_parse_issues(spark):
    docs = spark.createDataFrame([("a", "T", "A B, University of C", 20, 0.9, 4), ("b", None, None, 2, None, None)], "document_id string, title string, authors_text string, pages int, narrative_page_ratio double, last_narrative_page int")
    sections = spark.createDataFrame([("a", "Abstract"), ("a", "1 Introduction"), ("a", "Odd title.")], "document_id string, title string")
    rows = [("a", i, f"One stop {i}. Two stops. Three. Four.", ["One stop %d." % i, "Two stops.", "Three.", "Four."]) for i in range(5)] + [("a", 5, "References " + "x" * 40 + " et al.2 cid:4", [])]
    got = {r.document_id: r.issues for r in audit.parse_issues(docs, sections, spark.createDataFrame(rows, "document_id string, ordinal int, text string, sentences array<string>")).collect()}
    assert got["a"] == ["author_affiliation_leakage", "early_narrative_cutoff", "suspicious_section_title", "paragraph_without_sentences", "encoding_or_formula_artifact", "possible_reference_leakage", "sentence_coverage_mismatch"]
    assert got["b"] == ["missing_title", "missing_authors", "too_few_sections", "too_few_paragraphs", "too_few_sentences", "low_narrative_page_coverage", "missing_abstract_section", "missing_introduction_section"]


def test_parse_integrity(spark):
    sections = spark.createDataFrame([("d", "s1"), ("d", "s1")], "document_id string, section_id string")
    paras = spark.createDataFrame([("d", "s1", "p1", 0, "A stop. " * 20 + "End."), ("d", "s1", "p2", 2, "no stop")], "document_id string, section_id string, paragraph_id string, ordinal int, text string")
    sents = spark.createDataFrame([("d", "p2", "t1", 0, "no stop")], "document_id string, paragraph_id string, sentence_id string, ordinal int, text string")
    got = {(r.code, r.unit): r.n for r in audit.parse_integrity(sections, paras, sents).collect()}
    assert got == {("duplicate_ids", "id"): 1, ("ordinal_errors", "paragraph"): 1, ("grammar_errors", "paragraph"): 1, ("grammar_errors", "sentence"): 1, ("sentence_coverage_mismatch", "paragraph"): 1, ("suspicious_paragraph", "paragraph"): 1}


def test_run_codes(spark):
    make = spark.createDataFrame
    units = make([("d", "section", "s"), ("d", "paragraph", "p"), ("d", "paragraph", "p"), ("d", "sentence", "t"), ("e", "sentence", "t"), ("f", "section", "z")], "document_id string, kind string, unit_id string")
    sentences = make([("t", "The pump ran.")], "sentence_id string, text string")
    m = make([("m1", "Tool", "sentence_span", "t", 4, 8, "pump", "pump", "p", "s"), ("m1", "Tool", "sentence_span", "t", 4, 9, "pump", "pump", "p", "s"), ("m2", "Odd", "sentence_span", "t", 4, 99, "pump", "pump", "p", "q"), ("m3", "Tool", "sentence_span", "u", 0, 1, "x", "x", "p", "s"), ("m4", "Tool", "metadata", None, None, None, None, "x", None, None)], "mention_id string, label string, kind string, sentence_id string, start_char int, end_char int, quote string, surface_text string, paragraph_id string, section_id string")
    a = make([("a1", "d", "m1", "uses", "m3", True, ["t", "v"]), ("a1", "d", "m1", "uses", "m9", True, ["t"]), ("a2", "d", "m2", "uses", "m1", True, None), ("a3", "d", "m1", "uses", "m3", False, [])], "assertion_id string, document_id string, subject_mention_id string, predicate string, object_mention_id string, ontology_valid boolean, evidence_sentence_ids array<string>")
    r = make([("r1", "m1", "m9", True), ("r1", "m1", "m2", None)], "resolution_id string, left_mention_id string, right_mention_id string, auto_merged boolean")
    codes = audit.unit_codes(units, 1).unionByName(audit.mention_codes(m, sentences, make([("Tool",)], "label string"), units.select("unit_id")))
    codes = codes.unionByName(audit.assertion_codes(a, m, make([("uses", "Tool", "Tool")], "predicate string, domain string, range string"), sentences)).unionByName(audit.resolution_codes(r, m))
    expected = make([("d", 0.9, ["Tool", "Model"]), ("e", 0.1, None)], "document_id string, title_score double, labels array<string>")
    codes = codes.unionByName(audit.expectation_codes(expected, make([("d", "Tool")], "document_id string, label string"), a, 0.6)).unionByName(audit.artifact_codes(make([("a.json",)], "name string"), ["a.json", "b.json"]))
    got = sorted((x.code, x.id, x.n) for x in codes.collect())
    assert got == sorted([
        ("duplicate_source_id", "p", 1), ("duplicate_source_id", "t", 1), ("too_few_sentences", "f", 1), ("duplicate_mention_id", "m1", 1), ("unknown_node_label", "m2", 1), ("missing_sentence_reference", "m3", 1),
        ("invalid_character_span", "m2", 1), ("evidence_quote_mismatch", "m1", 1), ("missing_parent_reference", "m2", 1), ("duplicate_assertion_id", "a1", 1), ("missing_assertion_endpoint", "a1", 1),
        ("domain_range_violation", "a2", 1), ("domain_range_violation", "a3", 1), ("missing_assertion_evidence", "a1", 1), ("duplicate_resolution_id", "r1", 1), ("missing_resolution_endpoint", "r1", 1),
        ("unexpected_automatic_merge", "r1", 1), ("node_coverage_below_threshold", "d", 1), ("node_coverage_below_threshold", "e", 1), ("no_relationships_extracted", "e", 1), ("weak_expectation_title_match", "e", 1), ("missing_artifact", "b.json", 1),
    ])
    assert tuple(audit.run_status(codes).first()) == ("fail", 21, 1) and tuple(audit.run_status(codes.limit(0)).first()) == ("pass", 0, 0)
    assert {x[0] for x in got} == set(audit.RUN_CODES)

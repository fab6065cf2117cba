from pyspark.sql import functions as F

from lodestrata.operators import layout, structure

WORDS = "document_id string, page int, text string, x0 double, x1 double, top double, bottom double, size double, fontname string"


def test_lines_split_at_wide_gaps(spark):
    words = [("d", 1, "left", 10.0, 30.0, 100.0, 110.0, 10.0, "A-Bold"), ("d", 1, "text", 33.0, 50.0, 100.4, 110.4, 10.0, "A-Bold"), ("d", 1, "right", 70.0, 90.0, 100.0, 110.0, 10.0, "A"), ("d", 1, "next", 10.0, 30.0, 130.0, 140.0, 10.0, "A-Italic"), ("d", 1, None, 1.0, 2.0, 1.0, 2.0, 9.0, "A")]
    rows = layout.lines_from_words(spark.createDataFrame(words, WORDS)).orderBy("seq").collect()
    assert [r.text for r in rows] == ["left text", "right", "next"]
    assert [r.bold for r in rows] == [True, False, False] and rows[2].italic


LINES = layout.LINE_SCHEMA


def line(text, top, x0=50.0, x1=250.0, page=1, seq=0, size=10.0, doc="d"):
    return (doc, page, seq, text, top, top + 10, x0, x1, size, False, False)


def test_boxes(spark):
    lines = spark.createDataFrame([line("in", 105.0), line("out", 300.0), line("other page", 105.0, page=2)], LINES)
    boxes = spark.createDataFrame([("d", 1, 40.0, 260.0, 90.0, 150.0)], "document_id string, page int, x0 double, x1 double, top double, bottom double")
    assert sorted(r.text for r in layout.outside_boxes(lines, boxes).collect()) == ["other page", "out"]
    near = spark.createDataFrame([("d", 1, 42.0, 262.0, 92.0, 155.0), ("d", 1, 42.0, 262.0, 200.0, 255.0)], boxes.schema)
    assert layout.new_boxes(near, boxes).count() == 1


def test_ruled_tables(spark):
    rules = [("d", 1, 50.0, 250.0, 100.0), ("d", 1, 50.0, 250.0, 160.0), ("d", 1, 330.0, 560.0, 100.0), ("d", 1, 10.0, 600.0, 50.0)]
    t = layout.ruled_tables(spark.createDataFrame(rules, "document_id string, page int, x0 double, x1 double, top double")).collect()
    assert [(r.x0, r.top, r.bottom) for r in t] == [(50.0, 97.0, 194.0)]


def test_reading_order(spark):
    rows = [line("title", 10.0, 50.0, 560.0)] + [line(f"l{i}", 30.0 + 20 * i, 50.0, 280.0) for i in range(4)] + [line(f"r{i}", 30.0 + 20 * i, 330.0, 560.0) for i in range(4)]
    got = layout.reading_order(spark.createDataFrame(rows, LINES)).orderBy("seq").collect()
    assert [r.text for r in got] == ["title", "l0", "l1", "l2", "l3", "r0", "r1", "r2", "r3"]


def test_narrow_columns_by_the_fixed_bounds(spark):
    """Lines that end before 56 % are left, that begin after 44 % right; a page of too few in columns is read by height."""
    rows = [line(f"l{i}", 30.0 + 20 * i, 50.0, 341.0) for i in range(4)] + [line(f"r{i}", 30.0 + 20 * i, 270.0, 560.0) for i in range(4)] + [line("across", 60.0, 50.0, 560.0)]
    got = [r.text for r in layout.reading_order(spark.createDataFrame(rows, LINES)).orderBy("seq").collect()]
    assert got == ["l0", "l1", "r0", "r1", "across", "l2", "l3", "r2", "r3"]
    few = [r.text for r in layout.reading_order(spark.createDataFrame([r for r in rows if r[3] != "r3"], LINES)).orderBy("seq").collect()]
    assert few == ["l0", "r0", "l1", "r1", "across", "l2", "r2", "l3"]


def test_style_of_half_the_words_and_clean_text(spark):
    words = [("d", 1, "Eﬃcient", 10.0, 30.0, 100.0, 110.0, None, "X-Bold"), ("d", 1, "\u00ad", 31.0, 32.0, 130.0, 140.0, 9.0, "X"), ("d", 1, "pumps", 33.0, 50.0, 100.4, 110.4, 10.0, "X-Oblique"), ("d", 1, "more", 52.0, 60.0, 100.2, 110.2, 10.0, None)]
    rows = layout.lines_from_words(spark.createDataFrame(words, WORDS)).collect()
    assert [(r.text, r.size, r.bold, r.italic) for r in rows] == [("Efficient pumps more", 10.0, True, True)]


def test_furniture_and_kinds(spark):
    rows = [line("Journal", 60.0, page=p, seq=0) for p in (1, 2, 3)] + [line("Body repeats", 300.0, page=p, seq=1) for p in (1, 2, 3)]
    rows += [line("Figure 1: A tank", 400.0, seq=2), line("with two pumps", 412.0, seq=3), line("and valves", 424.0, seq=4), line("Body text goes here", 500.0, seq=20), line("A (1)", 520.0, 5.0, 40.0, seq=21), line("p. 7", 770.0, seq=22)]
    rows += [("d", 1, 23, "slanted words", 600.0, 610.0, 50.0, 250.0, 10.0, False, True), ("d", 1, 24, "2.1 Slanted words", 620.0, 630.0, 50.0, 250.0, 10.0, False, True)]
    lines = spark.createDataFrame(rows, LINES)
    f = layout.repeated_furniture(lines, margin=0.09)
    assert [(r.text, r.pages) for r in f.collect()] == [("journal", 3)]
    kinds = {(r.page, r.text): r.kind for r in layout.classify_lines(lines, f).collect()}
    assert kinds[1, "Journal"] == kinds[1, "A (1)"] == kinds[1, "p. 7"] == "furniture" and kinds[1, "Body text goes here"] == kinds[1, "Body repeats"] == kinds[1, "2.1 Slanted words"] == "text"
    assert kinds[1, "with two pumps"] == kinds[1, "and valves"] == "caption" and kinds[1, "slanted words"] == "formula"


def test_profile_and_body(spark):
    one = lambda *texts: layout.detect_profile(spark.createDataFrame([line(t, 10.0 * i, seq=i) for i, t in enumerate(texts)], LINES)).first().profile
    assert layout.body_size(spark.createDataFrame([line("x" * 50, 10.0, size=9.0), line("short", 30.0, size=30.0)], LINES)).first().body_size == 9.0
    assert one("Environ. Sci. Technol. 2024") == "acs_est" and one("Water", "Research 12") == "elsevier_water_research" and one("Open access", "Edited by A", "Reviewed by B") == "frontiers_open_access"
    assert one("I. I NTRODUCTION") == "ieee_arxiv_preprint" and one("ABSTRACT", "text", "INTRODUCTION") == "conference_preprint" and one("A paper") == "generic_research_paper"


def test_headings_of_profiles_and_back_matter(spark):
    rows = [("RESULTS", "acs_est", 9.0, False, 3), ("RESULTS", "generic_research_paper", 9.0, False, 3), ("I. I NTRODUCTION", "ieee_arxiv_preprint", 10.0, True, 1), ("Some Larger Words", "conference_preprint", 12.0, False, 3), ("Some larger words.", "conference_preprint", 12.0, False, 3), ("Reference", "generic_research_paper", 10.0, False, 14), ("References", "generic_research_paper", 10.0, True, 29), ("8. References", "generic_research_paper", 10.0, False, 29), ("Author information", "acs_est", 10.0, True, 20)]
    df = spark.createDataFrame(rows, "text string, profile string, size double, bold boolean, page int").selectExpr("*", "10.0D as body_size", "false as italic")
    got = df.select("text", layout.profile_heading(F.col("profile")).alias("h"), layout.back_matter_heading(F.col("profile"), F.lit(34), F.lit(False)).alias("b")).collect()
    assert [r.h for r in got] == [True, False, True, True, False, False, False, False, False]
    assert [r.b for r in got] == [False] * 5 + [False, True, True, True]


def test_paragraphs_and_sections(spark):
    docs = spark.createDataFrame([(1, "2 Methods\n\nThe pump ran.\r\n\r\nIt \r\n stopped.\n\n2.1 Deep part\n\nThe flow fell."), (2, None), (3, " \n\n ")], "doc_id long, text string")
    p = structure.paragraphs_of_text(docs)
    assert [r.text for r in p.orderBy("ordinal").collect()] == ["2 Methods", "The pump ran.", "It stopped.", "2.1 Deep part", "The flow fell."]
    s = structure.assign_sections(p)
    h = structure.section_hierarchy(s.where("is_heading").select("doc_id", "section", "section_title")).orderBy("section").collect()
    assert [(r.section, r.level, r.parent) for r in h] == [(1, 1, None), (2, 2, 1)]
    assert structure.chunks(s).groupBy("type").count().orderBy("type").collect()[0]["count"] == 3
    assert structure.plain_text(docs).where("doc_id = 1").first().text.startswith("2 Methods\n\nThe pump")


def test_grouping_and_merging(spark):
    lines = [(1, 0, "The pump ran and"), (1, 1, "then stopped."), (1, 2, "A new one began."), (1, 3, "1. item one."), (1, 4, "12 34")]
    g = structure.group_lines(spark.createDataFrame(lines, "doc_id long, seq int, text string"), ["doc_id"], ["seq"])
    assert [r.paragraph for r in g.orderBy("seq").collect()] == [1, 1, 2, 3, 4]
    assert [r.text for r in structure.merge_paragraphs(g, ["doc_id"]).orderBy("paragraph").collect()] == ["The pump ran and then stopped.", "A new one began.", "1. item one."]


def test_integrity_and_issues(spark):
    rows = spark.createDataFrame([("d", "a", 0), ("d", "a", 2)], "k string, u string, o int")
    r = structure.integrity(rows, "k", "u", "o").first()
    assert (r.duplicate_ids, r.gaps) == (1, True)
    q = structure.quality_issues(spark.createDataFrame([(1, None), (2, "cid:12  x")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.issues for r in q] == [["empty_text"], ["double_blank", "glyph_codes", "no_stop", "short_text"]]
    assert structure.inspect_lines(spark.createDataFrame([line("abc", 1.0)], LINES), "b", 1, 1).count() == 1

import hashlib

from pyspark.sql import functions as F

from lodestrata.functions import ids, similarity, text


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


def test_ids(spark):
    assert one(spark, "a", ids.stable_id("node", "x", F.lit("b"))) == "node_" + hashlib.sha256("a␟b".encode()).hexdigest()[:20]
    assert one(spark, "a", ids.parser_id("sec", "x", F.lit(3))) == "sec_" + hashlib.sha1(b"a|3").hexdigest()[:12]
    assert one(spark, None, ids.core_id("c", "x", F.lit("b"))) == "c_" + hashlib.sha256(b"|b").hexdigest()[:16]


def test_names(spark):
    assert one(spark, "Straße–MAS 2.0", ids.normalized("x")) == "strasse mas 2 0"
    assert one(spark, "水厂", ids.normalized("x")) == ""
    assert one(spark, None, ids.normalized("x")) is None
    assert one(spark, "Deep Water-Model", ids.acronym("x")) == "DWM"
    assert one(spark, "a b a", ids.name_tokens("x")) == ["a", "b"]


def test_normalize_text(spark):
    assert one(spark, "ﬁlter - bed ­x ’s . where it", text.normalize_text("x")) == "filter - bed x's. Where it"
    assert one(spark, "long ‐ term", text.normalize_text("x")) == "long-term"
    assert one(spark, None, text.normalize_text("x")) is None


def test_join_lines(spark):
    lines = ["The mem-", "brane and real-", "time data", "of Lund-", "Berg"]
    assert one(spark, lines, text.join_lines("x"), "array<string>") == "The membrane and real-time data of Lund- Berg"


def test_sentences(spark):
    got = one(spark, "See Fig. 2, e.g. the pump. It ran! Was it e.g. late? no stop", text.split_sentences("x"))
    assert got == ["See Fig. 2, e.g. the pump.", "It ran!", "Was it e.g. late?"]
    assert one(spark, "It fell. 12, 13", text.split_sentences("x")) == ["It fell. 12, 13"]
    assert one(spark, "", text.split_sentences("x")) == []


def test_line_predicates(spark):
    rows = [("2.1 Pilot plant", True), ("Results", True), ("The pump ran.", False), ("12 pumps were used in the plant and ran for many days over the year", False), ("", False)]
    df = spark.createDataFrame(rows, "x string, want boolean").select(text.looks_like_heading("x").alias("got"), "want")
    assert all(r.got == r.want for r in df.collect())
    assert one(spark, "Figure 3: Tank", text.looks_like_caption("x")) and one(spark, "• item", text.begins_list_item("x")) and one(spark, "a = b + c", text.looks_like_formula("x"))
    assert one(spark, "2.1.3 Deep", text.heading_depth("x")) == 3 and one(spark, "Deep", text.heading_depth("x")) == 1


def test_similarity(spark):
    df = spark.createDataFrame([("abcd", "bcde"), (None, "x")], "a string, b string")
    got = [r[0] for r in df.select(similarity.sequence_ratio("a", "b")).collect()]
    assert got == [0.75, None]
    v = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert [round(r[0], 6) for r in v.select(similarity.cosine(F.col("a"), F.col("b"))).collect()] == [0.707107, 0.0]
    assert one(spark, "GPT-4.5 v2", similarity.version_of(F.col("x"))) == "4.5,2"

import pytest
from pyspark.sql import functions as F

from lodestrata.pipeline import KnowledgePipeline
from lodestrata.sources import files
from lodestrata.streaming import ingest

DOCS = [("d1", "1 Methods\n\nWe ran Dekrox at the plant. It removed nitrate by 40 %.\n\n2 Results\n\nDekrox was fast."), ("d2", "The DKX tool ran. GPT-9 helped Dekrox."), ("d3", None)]
LEX = [("lex_d", "Tool", "Dekrox", ["DKX"], "seeded"), ("lex_n", "Contaminant", "nitrate", None, None)]


def test_end_to_end(spark):
    docs = spark.createDataFrame(DOCS, "document_id string, text string")
    lex = spark.createDataFrame(LEX, "canonical_id string, label string, canonical_name string, aliases array<string>, status string")
    p = KnowledgePipeline(docs, lex, patterns=[("Model", r"\bGPT-\d\b", "rule")])
    assert p.sentences.count() == 5
    rows = p.candidates.collect()
    assert all(r.evidence_quote[r.start_char : r.end_char] == r.surface_text for r in rows) and len(rows) == 6
    assert {(r.outcome, r.reason_code): r.candidates for r in p.run_report().collect()} == {("accept", "lexicon"): 5, ("review", "unjudged"): 1}
    ents = {r.entity_id: r for r in p.entities.collect()}
    assert ents["lex_d"].mention_count == 4 and ents["lex_d"].aliases == ["DKX", "Dekrox"] if "DKX" in ents["lex_d"].aliases else ents["lex_d"].mention_count == 4
    judged = spark.createDataFrame([(r.candidate_id, "accept", "Model", r.surface_text) for r in rows if r.method == "rule"], "candidate_id string, decision string, ontology_label string, judged_name string")
    q = KnowledgePipeline(docs, lex, judged, patterns=p.patterns)
    assert q.mentions.count() == 6 and q.uncached(p.candidates.where("method = 'rule'")).count() == 0
    m = {r.surface_text: r.mention_id for r in q.mentions.where("document_id = 'd2'").collect()}
    a = spark.createDataFrame([("a1", m["GPT-9"], "HELPS", m["Dekrox"], "e", 0.9)], "assertion_id string, subject_mention_id string, predicate string, object_mention_id string, evidence string, confidence double")
    assert q.relationships(a).first().support_count == 1
    assert q.merged.count() == 3
    q.register("kp_")
    assert spark.sql("select count(*) from kp_mentions where label = 'Tool'").first()[0] == 4


def test_merged_stages(spark):
    docs = spark.createDataFrame(DOCS, "document_id string, text string")
    lex = spark.createDataFrame(LEX, "canonical_id string, label string, canonical_name string, aliases array<string>, status string")
    same = spark.createDataFrame([("lex_d", "lex_n", " Same ")], "left_id string, right_id string, decision string")
    p = KnowledgePipeline(docs, lex, pair_decisions=same)
    p.register("km_")
    assert spark.sql("select mention_count, members from km_merged").collect() == [(5, 2)]
    assert {tuple(r) for r in spark.table("km_merged_aliases").collect()} == {("lex_d", "Dekrox"), ("lex_d", "DKX"), ("lex_d", "nitrate")}
    assert spark.sql("select count(*), count(distinct mention_id), min(entity_id) from km_merged_mentions").first() == (5, 5, "lex_d")
    assert spark.table("km_entity_mentions").count() == 5
    m = {r.entity_id: r.mention_id for r in p.entity_mentions.collect()}
    a = spark.createDataFrame([(f"a{i:02d}", m["lex_d"], "REMOVES", m["lex_n"], f"e{i}", 0.9) for i in range(12)], "assertion_id string, subject_mention_id string, predicate string, object_mention_id string, evidence string, confidence double")
    assert p.relationships(a).first().support_count == 12 and p.supporting(a).count() == 12


def test_replace_by_document(spark, tmp_path):
    out, src = str(tmp_path / "out"), str(tmp_path / "in")
    schema = "document_id string, v int"
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], schema).write.parquet(f"{src}/1")
    for n, rows in ((1, None), (2, [("a", 9)]), (3, [("a", 9)])):
        if rows:
            spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{src}/{n}")
        ingest.drain(ingest.stream_table(spark, f"{src}/{n}", schema), ingest.replace_by_document(out), str(tmp_path / f"c{n}"))
    assert sorted((r.document_id, r.v) for r in spark.read.parquet(out).collect()) == [("a", 9), ("b", 3)]


def test_stage_fold_as_a_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    df = spark.createDataFrame([("j", "parse", "2026-01-01 00:00:00"), ("j", "judge", "2026-01-01 00:05:00"), ("k", "parse", "2026-01-01 00:01:00")], "job_id string, stage string, t string").select("job_id", "stage", F.col("t").cast("timestamp").alias("ts"))
    df.write.parquet(src)
    q = ingest.fold_stages(ingest.stream_table(spark, src, "job_id string, stage string, ts timestamp")).writeStream.format("memory").queryName("folded").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.job_id, r.stage) for r in spark.table("folded").collect()} == {("j", "judge"), ("k", "parse")}


def test_files(spark, tmp_path):
    p = str(tmp_path / "x.jsonl")
    assert files.read_jsonl(spark, p, "a int, b string").count() == 0
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    files.write_jsonl(df, p)
    files.write_jsonl(df, p, append=True)
    assert files.read_jsonl(spark, p, "a int, b string").count() == 4
    files.write_report(df.withColumn("l", F.array(F.lit("u"), F.lit("v"))), str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).where("l = 'u;v'").count() == 2
    d = tmp_path / "docs"
    d.mkdir()
    (d / "a.pdf").write_bytes(b"%PDF1")
    (d / "b.pdf").write_bytes(b"%PDF1")
    (d / "c.txt").write_bytes(b"text")
    f = files.read_documents(spark, str(d))
    assert f.where("is_pdf").count() == 2 and files.read_documents(spark, str(d), 1).count() == 1
    u = files.distinct_contents(f)
    assert sorted(r.copies for r in u.collect()) == [1, 2]
    assert files.unparsed(f, f.where("is_pdf").select("sha256")).count() == 1 and files.checksums(f).count() == 3
    runs = tmp_path / "runs"
    for name, scope, merged in (("r1", "full_paper", True), ("r2", "full_paper", False), ("r3", "part", True)):
        (runs / name).mkdir(parents=True)
        (runs / name / "manifest.json").write_text(f'{{"run_id": "{name}", "test_scope": "{scope}"}}')
        (runs / name / "entities.jsonl").write_text('{"id": "plain"}\n')
        if merged:
            (runs / name / "merged.jsonl").write_text('{"id": "merged"}\n')
    c = files.run_catalog(spark, str(runs), "entities.jsonl", "merged.jsonl", "id string")
    assert sorted((r.run_folder, r.id) for r in c.collect()) == [("r1", "merged"), ("r2", "plain")]
    assert files.run_catalog(spark, str(tmp_path / "none"), "a", "b", "id string").count() == 0
    log = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b"), ("m", None, "c"), (None, 5, "d")], "k string, at int, t string")
    assert sorted((r.k, r.t) for r in files.latest_per_key(log, "k", "at", "t").collect()) == [("k", "b"), ("m", "c")]


def test_replacing_survives_a_cut_off_batch(spark, tmp_path):
    """A batch that stopped while it replaced buckets is finished from its staged rows; other documents keep theirs."""
    import shutil

    out = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "document_id string, n int")
    ingest.replace_by_document(out, buckets=1)(make([("a", 1), ("b", 2)]), 0)
    staged = f"{out}-staged-1"
    full = make([("a", 1), ("b", 3)]).withColumn("bucket", F.lit(0))
    full.write.partitionBy("bucket").parquet(staged)
    shutil.rmtree(f"{out}/bucket=0")  # the old bucket is gone, the new one not there yet
    ingest.replace_by_document(out, buckets=1)(make([("b", 3)]), 1)
    assert sorted((r.document_id, r.n) for r in spark.read.parquet(out).collect()) == [("a", 1), ("b", 3)]
    with pytest.raises(ValueError, match="buckets"):
        ingest.replace_by_document(out, buckets=2)(make([("b", 3)]), 2)


def test_one_json_row(spark, tmp_path):
    with pytest.raises(ValueError, match="more than one row"):
        files.write_json(spark.range(2).toDF("a"), str(tmp_path / "x"))
    files.write_json(spark.range(1).toDF("a"), str(tmp_path / "x"))
    assert spark.read.schema("a long").json(str(tmp_path / "x")).count() == 1

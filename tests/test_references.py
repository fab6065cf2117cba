from pyspark.sql import functions as F

from lodestrata.operators import references
from lodestrata.sources import files, pdf


def test_rules(spark):
    rows = [("1", "The system uses EPANET and epanet; lead was absent."), ("2", "A lead concentration of 3 mg/L."), ("3", "We use RAG with human-in-the-loop oversight."), ("4", "HydroRAG and GPT-4o beat openai/gpt - 4."), ("5", None), ("6", "Thomas leads the benchmark.")]
    s = spark.createDataFrame(rows, "sid string, text string")
    got = sorted((r.sid, r.label, r.surface_text, r.canonical_name) for r in references.rule_spans(s, ["sid"]).collect())
    assert ("1", "Tool", "epanet", "EPANET") in got and not any(g[0] == "1" and g[1] == "Contaminant" for g in got)
    assert ("2", "Contaminant", "lead", "lead") in got and ("3", "Method", "RAG", "retrieval-augmented generation") in got
    assert ("3", "Method", "human-in-the-loop oversight", "human-in-the-loop") in got and ("4", "AISystem", "HydroRAG", "HydroRAG") in got and ("4", "Model", "openai/gpt - 4", "openai/gpt-4") in got
    assert not any(g[0] == "6" for g in got)
    assert all(dict(rows)[g[0]].count(g[2]) for g in got)


S = "document_id string, section int, pos int, text string"


def resolved(spark, sentences, mentions):
    s = spark.createDataFrame([("d", 1, i, t) for i, t in enumerate(sentences)], S)
    keys = ["document_id", "section", "pos"]
    r = references.reference_spans(s, keys).withColumn("reference_id", F.concat_ws("-", "pos", "start_char")).join(s, keys)
    m = spark.createDataFrame([(f"m{k}", "d", 1, p, sentences[p].index(n), sentences[p].index(n) + len(n), label, n, "") for k, (p, n, label) in enumerate(mentions)], "mention_id string, document_id string, section int, pos int, start_char int, end_char int, label string, canonical_name string, canonical_id string")
    src = s.select("document_id", "section", F.col("pos").alias("_p"), F.col("text").alias("_st"))
    c = references.antecedents(r, m)
    c = c.withColumn("_p", F.col("pos") - F.col("distance")).join(src, ["document_id", "section", "_p"])
    out = references.resolve(r, c, F.col("text"), F.col("_st").rlike("(?i)\\b(introduc|propos|present)"))
    return {x.surface_text: (x.outcome, x.target, x.candidates) for x in out.collect()}


def test_resolution(spark):
    assert resolved(spark, ["AquaNet ran.", "This model was fast."], [(0, "AquaNet", "Model")]) == {"This model": ("resolved", "m0", 1)}
    assert resolved(spark, ["AquaNet and HydroNet ran.", "This model was fast."], [(0, "AquaNet", "Model"), (0, "HydroNet", "Model")]) == {"This model": ("review", None, 2)}
    assert resolved(spark, ["AquaNet ran.", "Next.", "This model was fast."], [(0, "AquaNet", "Model")]) == {"This model": ("review", None, 1)}
    assert resolved(spark, ["Dekrox ran.", "This model was fast."], [(0, "Dekrox", "Tool")]) == {"This model": ("ignored", None, 0)}
    assert resolved(spark, ["AquaNet ran and it stopped."], [(0, "AquaNet", "Model")]) == {"it": ("resolved", "m0", 1)}
    assert resolved(spark, ["AquaNet ran.", "These models were fast."], [(0, "AquaNet", "Model")]) == {"These models": ("review", None, 1)}
    assert resolved(spark, ["We propose AquaRAG.", "The framework ran."], [(0, "AquaRAG", "AISystem")]) == {"The framework": ("resolved", "m0", 1)}
    assert resolved(spark, ["AquaRAG ran.", "The framework ran."], [(0, "AquaRAG", "AISystem")]) == {"The framework": ("review", None, 1)}
    assert resolved(spark, ["AquaRAG and EPANET ran.", "Fine.", "This system has agents."], [(0, "AquaRAG", "AISystem"), (0, "EPANET", "Tool")])["This system"] == ("resolved", "m0", 1)
    assert resolved(spark, ["Results suggest that model capability matters.", "These approaches and processes ended."], [(0, "Results", "Model")]).keys() == {"These approaches"}


def test_words(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF one two")
    (tmp_path / "b.pdf").write_bytes(b"%PDF")
    (tmp_path / "c.txt").write_bytes(b"text")
    (tmp_path / "d.pdf").write_bytes(b"%PDF boom")

    def extract(content):
        if b"boom" in content:
            raise ValueError("broken")
        return [{"text": w.decode(), "page": 1, "x0": 1.0, "x1": 2.0, "top": 1.0, "bottom": 2.0, "size": 9.0, "fontname": "A"} for w in content.split()[1:]]

    rows = pdf.words_of(files.read_documents(spark, str(tmp_path)), extract).collect()
    assert sorted(r.text for r in rows if r.text) == ["one", "two"]
    assert sorted(r.parse_error for r in rows if r.parse_error) == ["ValueError: broken", "no_words", "not_a_pdf"]
    runs = tmp_path / "runs"
    for n, t in (("a", "2026-01-01"), ("b", "2026-02-01")):
        (runs / n).mkdir(parents=True)
        (runs / n / "manifest.json").write_text(f'{{"run_id": "{n}", "created_at": "{t}"}}')
    assert [r.run_id for r in files.job_list(spark, str(runs)).collect()] == ["b", "a"]
    files.write_json(spark.createDataFrame([("r",)], "run_id string"), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).first().run_id == "r"

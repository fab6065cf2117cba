from pyspark.sql import functions as F

from lodestrata.operators import grammar, spans, windows


def test_patterns_are_exact(spark):
    s = spark.createDataFrame([("s1", "🙂 The EPANET tool and epanet."), ("s2", None), ("s3", "")], "sid string, text string")
    rows = spans.pattern_spans(s, [("Tool", r"\bEPANET\b", "rule"), ("Named", r"The (?P<name>\w+)", "rule")], ["sid"]).collect()
    text = "🙂 The EPANET tool and epanet."
    assert sorted((r.label, r.start_char) for r in rows) == [("Named", 6), ("Tool", 6), ("Tool", 22)]
    assert all(text[r.start_char : r.end_char] == r.surface_text for r in rows)


LEX = [("a", "Tool", "Dekrox", ["DKX", "Dekrox Kit"], "seeded"), ("b", "Model", "Dekrox", None, None), ("c", "Tool", "Old", ["Gone"], "deprecated"), ("d", "Tool", "C++ lib", [], "seeded")]
LEX_SCHEMA = "canonical_id string, label string, canonical_name string, aliases array<string>, status string"


def test_lexicon(spark):
    lex = spark.createDataFrame(LEX, LEX_SCHEMA)
    s = spark.createDataFrame([("s1", "A dekrox kit by DKX, not DKXY; Gone C++ lib."), ("s2", None)], "sid string, text string")
    for chars in (5, 1000):
        rows = spans.lexicon_spans(s, lex, ["sid"], block_chars=chars).collect()
        assert sorted((r.surface_text, r.canonical_id, r.method) for r in rows) == [("C++ lib", "d", "persistent_lexicon"), ("DKX", "a", "persistent_lexicon"), ("dekrox", "a", "persistent_lexicon_ambiguous"), ("dekrox", "b", "persistent_lexicon_ambiguous"), ("dekrox kit", "a", "persistent_lexicon")]
    v = spark.createDataFrame([(1, "dkx", "Tool"), (2, "DEKROX", "Model"), (3, "DEKROX", None), (4, "gone", "Tool")], "i int, v string, l string")
    assert [(r.i, r.canonical_id) for r in spans.find_entries(v, lex, "v").collect()] == [(1, "a")]
    assert sorted((r.i, r.canonical_id) for r in spans.find_entries(v, lex, "v", "l").collect()) == [(1, "a"), (2, "b")]
    assert spans.lexicon_spans(s, lex.limit(0), ["sid"]).count() == 0


def test_guards_of_tools_and_models(spark):
    lex = spark.createDataFrame([("t", "Tool", "EPANET", [], None), ("m", "Model", "GPT-4", ["QX", "é2", "x", "kxx"], None)], LEX_SCHEMA)
    s = spark.createDataFrame([("1", "EPANET ran; pre-EPANET and EPANET-MSX did not."), ("2", "GPT-4 and GPT-4.5, GPT-4o, GPT-4 Search, gpt-4-turbo."), ("3", "QX_QX中QX aQX É2."), ("4", "EPANET \u212aXX eXX.")], "sid string, text string")
    got = sorted((r.sid, r.start_char, r.surface_text) for r in spans.lexicon_spans(s, lex, ["sid"]).collect())
    assert got == [("1", 0, "EPANET"), ("2", 0, "GPT-4"), ("2", 41, "gpt-4"), ("3", 0, "QX"), ("3", 3, "QX"), ("3", 6, "QX"), ("3", 13, "É2"), ("4", 0, "EPANET"), ("4", 7, "\u212aXX")]


def test_propagation_in_any_case_and_spelling(spark):
    s = spark.createDataFrame([("d", "1", "AQUA NET, aquanet; aqua-nets AI ai."), ("d", "1", "AQUA NET, aquanet; aqua-nets AI ai."), (None, "2", "Aqua-Net"), ("d", "3", None)], "document_id string, sid string, text string")
    n = spark.createDataFrame([("d", "Aqua-Net"), ("d", "AI"), ("d", "--"), ("d", None), (None, "x")], "document_id string, surface_text string")
    got = sorted((r.name, r.start_char, r.surface_text) for r in spans.propagate_names(s, n, "document_id", ["document_id", "sid"]).collect())
    assert got == [("AI", 29, "AI"), ("AI", 32, "ai"), ("Aqua-Net", 0, "AQUA NET"), ("Aqua-Net", 10, "aquanet")]


def test_alternative_candidates(spark):
    s = spark.createDataFrame([("1", "The (EPANET) tool reached 5 mg/L, a lack of data; we argue so."), ("2", None)], "sid string, text string")
    patterns = [("Tool", r"\bEPANET\b", "specific_lexicon"), ("Model", r"The \(EPANET\)", "rule_candidate"), ("Tool", "tool", "rule_candidate"), ("Agent", "tool", "rule_candidate"), ("Challenge", "lack of (?P<value>data)", "challenge_candidate"), ("Unit", "a", "rule_candidate")]
    chosen, rejected = spans.alternative_candidates(s, patterns, ["sid"], quantity=r"\d+\s*(?P<unit>mg/L)?", result="reached", claim="we argue", leading=r"the\s+")
    got = sorted((r.label, r.surface_text, r.method) for r in chosen.collect())
    text = "The (EPANET) tool reached 5 mg/L, a lack of data; we argue so."
    assert got == [("Challenge", "data", "challenge_candidate"), ("Condition", "5 mg/L", "quantity_candidate"), ("Observation", text, "result_candidate"), ("Tool", "EPANET", "specific_lexicon"), ("Tool", "tool", "rule_candidate")]
    assert sorted((r.label, r.chosen_label) for r in rejected.collect()) == [("Agent", "Tool"), ("Claim", "Observation"), ("Model", "Tool")]


def test_distinct_mentions(spark):
    rows = [("d", "Person", "document_metadata", "authors", None, "Ann Lee", None, None, None, 1), ("d", "Person", "document_metadata", "authors", "ann  LEE", "x", None, None, None, 2), ("d", "Person", "document_metadata", "authors", "Bo Wu", "x", None, None, None, 3), ("d", "Tool", "sentence_span", None, "A", "A", "s", 1, 2, 5), ("d", "Tool", "sentence_span", None, "B", "B", "s", 1, 2, 4), ("d", None, None, None, None, None, None, None, None, 6)]
    df = spark.createDataFrame(rows, "document_id string, label string, kind string, field string, canonical_name string, surface_text string, sentence_id string, start_char int, end_char int, arrival int")
    assert sorted(r.arrival for r in spans.distinct_mentions(df).collect()) == [1, 3, 4, 6]


def test_selection_keeps_the_most_trusted(spark):
    rows = [("s", 0, 6, "Tool", "Dekrox", "rule", 1), ("s", 0, 6, "Tool", "Dekrox", "lex", 2), ("s", 0, 10, "Tool", "Dekrox Kit", "rule", 3), ("s", 3, 4, "Tool", "x", "lex", 4)]
    df = spark.createDataFrame(rows, "sentence_id string, start_char int, end_char int, label string, surface_text string, method string, arrival int")
    got = spans.select_spans(df, "sentence_id", F.when(F.col("method") == "lex", 6).otherwise(4), "arrival").orderBy("end_char").collect()
    assert [(r.surface_text, r.method) for r in got] == [("Dekrox", "lex"), ("Dekrox Kit", "rule")]
    merged = spans.merge_channels([df.where("method = 'lex'"), df.where("method = 'rule'")], ["sentence_id", "start_char", "end_char", "label"])
    assert sorted((r.start_char, r.end_char, r.method) for r in merged.collect()) == [(0, 6, "lex"), (0, 10, "rule"), (3, 4, "lex")]


def test_introductions(spark):
    s = spark.createDataFrame([("1", "We propose HydroRAG, a multi-agent framework for plants."), ("2", "Smith et al. propose a system."), ("3", "AquaNet was introduced as a platform."), ("4", "We present Method, a framework.")], "sid string, text string")
    assert sorted((r.sid, r.surface_text) for r in spans.introduced_systems(s, ["sid"]).collect()) == [("1", "HydroRAG"), ("3", "AquaNet")]


def test_propagation_and_realignment(spark):
    s = spark.createDataFrame([("d", "1", "Aqua-Net ran."), ("d", "2", "Then Aqua Net and AquaNetX."), ("e", "3", "Aqua Net")], "document_id string, sid string, text string")
    n = spark.createDataFrame([("d", "Aqua-Net")], "document_id string, surface_text string")
    assert sorted((r.sid, r.surface_text) for r in spans.propagate_names(s, n, "document_id", ["document_id", "sid"]).collect()) == [("1", "Aqua-Net"), ("2", "Aqua Net")]
    m = spark.createDataFrame([("a b a", "a", 3), ("a b a", "a", 2), ("abc", "x", 0), (None, "x", 0)], "text string, surface_text string, start_char int").withColumn("end_char", F.lit(0))
    assert [(r.start_char, r.aligned) for r in spans.realign(m).collect()] == [(4, True), (2, False), (0, False), (0, False)]


def test_families_cues_and_people(spark):
    s = spark.createDataFrame([("d", "1", "Aqua", "Planner"), ("d", "1", "Aqua", "Coder"), ("d", "2", "Hydro", "Planner")], "document_id string, sid string, p string, r string")
    assert [r.prefix for r in spans.enumerated_families(s, "sid", "document_id", F.col("p"), F.col("r")).collect()] == ["Aqua"]
    a = spark.createDataFrame([("1", 0, 5, "GPTX9"), ("1", 200, 204, "ABCD")], "sid string, start_char int, end_char int, surface_text string")
    c = spark.createDataFrame([("1", 10, 15)], "sid string, start_char int, end_char int")
    assert [(r.surface_text, r.distance) for r in spans.near_cue(a, c, "sid").collect()] == [("GPTX9", 5)]
    x = spark.createDataFrame([("Ann Lee1*; Bo Wu and Cy Ek, et al.",)], "a string").select(spans.person_names(F.col("a"))).first()[0]
    assert x == ["Ann Lee", "Bo Wu", "Cy Ek, et al."]


TOKENS = [
    # The pump moves water and feeds tanks into the basin
    ("s", 0, "The", "the", "DET", "det", 1, 0, 3), ("s", 1, "pump", "pump", "NOUN", "nsubj", 2, 4, 8), ("s", 2, "moves", "move", "VERB", "ROOT", 2, 9, 14), ("s", 3, "water", "water", "NOUN", "dobj", 2, 15, 20),
    ("s", 4, "and", "and", "CCONJ", "cc", 2, 21, 24), ("s", 5, "feeds", "feed", "VERB", "conj", 2, 25, 30), ("s", 6, "tanks", "tank", "NOUN", "dobj", 5, 31, 36), ("s", 7, "into", "into", "ADP", "prep", 5, 37, 41), ("s", 8, "the", "the", "DET", "det", 9, 42, 45), ("s", 9, "basin", "basin", "NOUN", "pobj", 7, 46, 51),
]


def test_triples(spark):
    t = spark.createDataFrame(TOKENS, "sentence_id string, index int, text string, lemma string, pos string, dep string, head_index int, start_char int, end_char int")
    assert sorted((r.subject_index, r.predicate, r.object_index) for r in grammar.triples(t).collect()) == [(1, "feed", 6), (1, "feed into", 9), (1, "move", 3)]
    ext = {r["index"]: (r.start_char, r.end_char) for r in grammar.argument_spans(t).collect()}
    assert ext[1] == (0, 8) and ext[9] == (42, 51)
    a = spark.createDataFrame([("the pump,",)], "a string").select(grammar.clean_argument(F.col("a"))).first()[0]
    assert a == "pump"


def test_windows(spark):
    s = spark.createDataFrame([("d", 1, i, f"s{i}") for i in range(3)], "doc string, sec int, pos int, text string")
    w = windows.context_windows(s, ["doc", "sec"], "pos", fields=("text",)).orderBy("pos").collect()
    assert [len(r.context) for r in w] == [2, 3, 2] and [x.role for x in w[1].context] == ["previous", "target", "next"]
    t = spark.createDataFrame([("g", 5, "t")], "g string, pos int, target_id string")
    c = spark.createDataFrame([("g", 4, "a"), ("g", 3, "b"), ("g", 1, "x"), ("g", 6, "y"), ("h", 4, "z")], "g string, pos int, candidate_id string")
    n = windows.nearest_before(t, c, "g", "pos").orderBy("rank").collect()
    assert [(r.candidate_id, r.distance, r.nearest_unique) for r in n] == [("a", 1, True), ("b", 2, True)]
    assert windows.top_k(c, ["g"], ["candidate_id"], 1).count() == 2
    assert windows.batches(c, ["candidate_id"], 2).count() == 5


def test_long_chains_are_followed_to_their_end(spark):
    """Seven coordinated subjects, ten levels of dependents, a preposition of an object and an agent."""
    t = [("s", 0, "A", "a", "NOUN", "nsubj", 20, 0, 1)] + [("s", i, "X", "x", "NOUN", "conj", i - 1, 2 * i, 2 * i + 1) for i in range(1, 7)]
    t += [("s", 20, "removes", "remove", "VERB", "ROOT", 20, 40, 47), ("s", 21, "things", "thing", "NOUN", "dobj", 20, 50, 56), ("s", 22, "from", "from", "ADP", "prep", 21, 57, 61), ("s", 23, "water", "water", "NOUN", "pobj", 22, 62, 67), ("s", 24, "by", "by", "ADP", "agent", 20, 70, 72), ("s", 25, "pumps", "pump", "NOUN", "pobj", 24, 73, 78)]
    t += [("s", 30 + i, "of", "of", "ADP", "prep", 29 + i if i else 25, 80 + 2 * i, 81 + 2 * i) for i in range(10)]
    df = spark.createDataFrame(t, "sentence_id string, index int, text string, lemma string, pos string, dep string, head_index int, start_char int, end_char int")
    got = {(r.subject_index, r.predicate, r.object_index) for r in grammar.triples(df).collect()}
    assert got == {(i, p, o) for i in range(7) for p, o in (("remove", 21), ("remove from", 23), ("remove by", 25))}
    ext = {r["index"]: r.end_char for r in grammar.argument_spans(df).collect()}
    assert ext[25] == 99 and ext[21] == 67

import random

from pyspark.sql import functions as F

from lodestrata.operators import components, entities, nested, vector_search
from lodestrata.functions.skew import hot_keys, positions, split_join


def brute(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            if x != y:
                up[max(x, y)] = min(x, y)
    return {x: root(x) for x in up}


def test_components(spark):
    r = random.Random(4)
    edges = [(f"n{r.randrange(150)}", f"n{r.randrange(150)}") for _ in range(110)] + [("n1", "n1"), (None, "n2")] + [("hub", f"n{i}") for i in range(0, 150, 15)]
    got = components.connected_components(spark.createDataFrame(edges, "a string, b string"), "a", "b")
    assert {x[0]: x[1] for x in got.collect()} == brute(edges)
    again = components.connected_components(spark.createDataFrame(edges, "a string, b string").repartition(3), "a", "b", edges_per_task=5)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))
    assert components.connected_components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_split_join_with_a_hot_key(spark):
    left = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 1000 == 1, None).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") + 1).alias("w"))
    assert hot_keys(left, "k", 200_000) == [0]
    for how in ("inner", "left"):
        a, b = split_join(left, right, "k", 200_000, how), left.join(right, "k", how)
        key = lambda d: tuple(d.agg(F.count(F.lit(1)), F.sum("v"), F.sum("w")).first())
        assert key(a) == key(b)


def test_positions(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.when(F.col("id") % 5 == 0, F.col("id") % 7).otherwise(99)).alias("k"), (F.col("id") * 7 % 3001).alias("o"))
    got = {}
    for r in positions(df, "k", ["o"], tasks=7).collect():
        got.setdefault(r.k, []).append((r.o, r.pos))
    assert sum(map(len, got.values())) == 3000
    assert all([p for _, p in sorted(v)] == list(range(len(v))) for v in got.values())


M = "mention_id string, label string, surface_text string, canonical_name string, canonical_id string, from_lexicon boolean, is_reference boolean, sentence_id string, seq int"


def test_canonical_entities(spark):
    rows = [("m1", "Tool", "Aqua Net", "Aqua Net", "", False, False, "s1", 1), ("m2", "Tool", "aqua-net", "aqua-net", "lex_1", True, False, "s2", 2), ("m3", "Tool", "this tool", "Aqua Net", "", False, True, "s3", 3), ("m4", "Claim", "x", "x", "c1", False, False, "s1", 4), ("m5", "Claim", "x", "x", "c2", False, False, "s1", 5), ("m6", "Mention", "x", "x", "", False, False, "s1", 6), ("m7", "Tool", "Other", None, None, None, None, None, 7)]
    got = {(r.label, r.key): r for r in entities.canonical_entities(spark.createDataFrame(rows, M)).collect()}
    tool = got["Tool", "aqua net"]
    assert (tool.entity_id, tool.canonical_name, tool.aliases, tool.mention_count, tool.evidence) == ("lex_1", "Aqua Net", ["Aqua Net", "aqua-net"], 3, ["m1", "m2", "m3"])
    assert {k for k in got} == {("Tool", "aqua net"), ("Claim", "c1"), ("Claim", "c2"), ("Tool", "other")}


E = "entity_id string, label string, canonical_name string, aliases array<string>"


def test_similar_pairs_equal_all_pairs(spark):
    from difflib import SequenceMatcher

    r = random.Random(2)
    words = ["aqua", "net", "flow", "model", "hydro", "pump", "v2", "v3", "kit"]
    rows = [(f"e{i:03d}", r.choice(["Tool", "Model"]), " ".join(r.sample(words, r.randrange(1, 4))), r.choice([None, [], ["AQ"], ["Zed one"]])) for i in range(60)] + [("z1", "Tool", "superaquanet", None), ("z2", "Tool", "aquanet", None), ("z3", "Claim", "aquanet", None), ("z4", "Tool", "  ", None)]
    df = spark.createDataFrame(rows, E)
    reps = {x.rep: x for x in entities.representatives(df).collect()}
    members = {}
    for x in entities.alias_classes(df).collect():
        members.setdefault(x.rep, set()).add((x.label, x.alias_key))
    want, by_alias = set(), set()
    for a in reps.values():
        for b in reps.values():
            if a.rep < b.rep and a.label == b.label and not (a.versions and b.versions and a.versions != b.versions):
                j = len(set(a.tokens) & set(b.tokens)) / len(set(a.tokens) | set(b.tokens))
                s = max(0.88 if (a.norm in b.norm or b.norm in a.norm) and min(len(a.norm), len(b.norm)) >= 4 else 0, 0.55 * j + 0.45 * SequenceMatcher(None, a.norm, b.norm).ratio())
                if s >= 0.64:
                    want.add((a.rep, b.rep))
                if members.get(a.rep, set()) & members.get(b.rep, set()):
                    by_alias.add((a.rep, b.rep))
    rows = entities.similar_pairs(df).collect()
    got = {(x.left_id, x.right_id) for x in rows}
    assert want <= got and got - want <= by_alias and {(x.left_id, x.right_id) for x in rows if x.alias_overlap} == got & by_alias
    near = {}
    for x, y in got & by_alias:
        near.setdefault(x, set()).add(y)
        near.setdefault(y, set()).add(x)
    for x, y in by_alias - got:  # linked by the class's representatives
        seen, todo = {x}, [x]
        while todo:
            todo += [z for z in near.get(todo.pop(), ()) if z not in seen and not seen.add(z)]
        assert y in seen
    assert ("z1", "z2") in got
    assert entities.class_members(df).count() == 62


def test_one_alias_on_very_many_entities(spark):
    """An alias that 100,000 names have makes a pair for each, not for every two."""
    df = spark.range(100_000).selectExpr("printf('e%06d', id) as entity_id", "'Tool' as label", "concat('q', hex(id * 7919 + 1048576), 'z') as canonical_name", "array('same') as aliases").withColumn("canonical_name", F.translate("canonical_name", "0123456789", "ghijklmnop"))
    classes = entities.alias_classes(df)
    assert classes.count() == 100_000 and classes.where("class_rep = 'e000000'").count() == 100_000
    star = entities.similar_pairs(df, 0.99, ratio=False).where("alias_overlap and left_id = 'e000000'")
    assert star.count() == 99_999


def test_merge_and_catalog(spark):
    df = spark.createDataFrame([("a", "Tool", "Aqua", ["A"]), ("b", "Tool", "Aqua Net", None), ("c", "Model", "X", [])], E).withColumn("mention_count", F.lit(2))
    cc = spark.createDataFrame([("a", "a"), ("b", "a")], "node string, component string")
    got = {r.entity_id: r for r in entities.merge_entities(df, cc).collect()}
    assert got["a"].canonical_name == "Aqua Net" and got["a"].mention_count == 4 and got["a"].members == 2 and got["a"].aliases == ["A"] and "c" in got
    lex = spark.createDataFrame([("l1", "Tool", "aqua", ["AQ"])], "node_id string, label string, canonical_name string, aliases array<string>")
    cat = entities.prior_catalog([lex, df.select(F.col("entity_id").alias("node_id"), "label", "canonical_name", "aliases")])
    assert {(r.node_id, r.key) for r in cat.collect()} == {("l1", "aqua"), ("b", "aqua net"), ("c", "x")}
    top = entities.prior_top_k(df, cat.select("*", F.explode("aliases").alias("alias")), "entity_id", "label", "canonical_name", 1).collect()
    assert {(r.entity_id, r.node_id) for r in top} == {("a", "l1"), ("b", "b"), ("c", "c")}
    one = entities.exact_prior(df, cat, "label", "canonical_name").collect()
    assert {(r.entity_id, r.matched_node_id) for r in one} == {("a", "l1"), ("b", "b"), ("c", "c")}


def test_prior_nodes_by_ratio_equal_brute_force(spark):
    import random
    import re
    from difflib import SequenceMatcher

    r = random.Random(3)
    words = ["flow", "flows", "pump", "pumping", "aqua", "aquanet", "net", "ph", "x1", "sensor"]
    name = lambda: " ".join(r.choice(words) for _ in range(r.randrange(1, 4)))
    cat = [(f"n{i:03d}", r.choice(["Tool", "Model"]), name().title(), [name() for _ in range(r.randrange(3))] or None) for i in range(150)] + [("n900", "Tool", "--", None), ("n901", None, "flow", [])]
    cand = [(f"c{i}", r.choice(["Tool", "Model", None]), name(), r.choice([None, ["Tool"], ["Model", "Other"]])) for i in range(40)] + [("c90", "Tool", "!!", None), ("c91", "Tool", None, None)]
    got = {}
    df = spark.createDataFrame(cand, "cid string, label string, name string, alternatives array<string>")
    c = spark.createDataFrame(cat, "node_id string, label string, canonical_name string, aliases array<string>").select("*", F.explode(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array()))).alias("alias")).repartition(5)
    for x in entities.prior_top_k(df, c, "cid", "label", "name", 5, "alternatives", block_rows=7).collect():
        got.setdefault(x.cid, []).append((x["rank"], x.node_id, x.score))
    norm = lambda t: re.sub("[^a-z0-9]+", " ", (t or "").lower()).strip()
    for cid, label, text, more in cand:
        want = []
        for node, own, shown, aliases in cat:
            names = [n for n in map(norm, [shown, *(aliases or [])]) if n]
            if own and own in {label, *(more or [])} and names and norm(text):
                want.append((-max(round(SequenceMatcher(None, norm(text), n).ratio(), 4) for n in names), shown.lower(), node))
        assert sorted(got.get(cid, [])) == [(i + 1, n, -s) for i, (s, _, n) in enumerate(sorted(want)[:5])]


def test_aliases_are_whole_as_rows(spark):
    rows = [(f"m{i:04d}", "Tool", f"Aqua {'x' * (i % 3)}", "Aqua", "", False, i % 2 == 0, "s", i) for i in range(3)] + [(f"n{i:04d}", "Tool", f"S{i:03d}", "Aqua", "", False, False, "s", 10 + i) for i in range(300)]
    m = spark.createDataFrame(rows, "mention_id string, label string, surface_text string, canonical_name string, canonical_id string, from_lexicon boolean, is_reference boolean, sentence_id string, seq int")
    e = entities.canonical_entities(m)
    one = e.first()
    assert one.alias_count == 302 and len(one.aliases) == 200 and one.aliases == sorted(one.aliases)
    assert entities.entity_aliases(m, e).count() == 302


def test_keys_of_neighbours_keep_their_type(spark):
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.9, 0.1]), ("c", [0.0, 1.0])], "id string, v array<float>")
    n = vector_search.neighbours(v, v, "id", "v", 1, block_rows=1).orderBy("query").collect()
    assert [(r.query, r.neighbour) for r in n] == [("a", "b"), ("b", "a"), ("c", "b")]
    assert [(r.query, r.neighbour) for r in vector_search.neighbours(v, v, "id", "v", 2, earlier=True).orderBy("query", "rank").collect()] == [("b", "a"), ("c", "b"), ("c", "a")]
    assert vector_search.neighbours(v.limit(0), v, "id", "v").count() == 0 and vector_search.neighbours(v, v.limit(0), "id", "v").count() == 0


def test_merged_rows_are_whole(spark):
    df = spark.createDataFrame([("a", "Tool", "Aqua", [f"A{i:03d}" for i in range(300)]), ("b", "Tool", "Aqua Net", None), ("c", "Model", "X", ["Y"])], E)
    cc = spark.createDataFrame([("a", "a"), ("b", "a")], "node string, component string")
    got = {tuple(r) for r in entities.merged_aliases(df, cc).collect()}
    assert got == {("a", f"A{i:03d}") for i in range(300)} | {("a", "Aqua"), ("a", "Aqua Net"), ("c", "X"), ("c", "Y")}
    bounded, whole = df.withColumn("aliases", F.slice("aliases", 1, 5)).withColumn("mention_count", F.lit(1)), df.select("entity_id", F.explode("aliases").alias("alias"))
    assert {tuple(r) for r in entities.merged_aliases(bounded, cc, aliases=whole).collect()} == got
    assert {(r.entity_id, r.alias_count, len(r.aliases)) for r in entities.merge_entities(bounded, cc, aliases=whole).collect()} == {("a", 300, 200), ("c", 1, 1)}
    assert entities.alias_classes(bounded, aliases=whole).count() == 301
    em = spark.createDataFrame([("a", "m1", "s1"), ("b", "m2", "s2"), ("c", "m3", "s3"), ("b", "m4", None)], "entity_id string, mention_id string, sentence_id string")
    assert {tuple(r) for r in entities.merged_mentions(em, cc).collect()} == {("a", "m1"), ("a", "m2"), ("a", "m4"), ("c", "m3")}


def test_lexicon_growth(spark):
    lex = spark.createDataFrame([("l1", "Tool", "Aqua", ["AQ"], "seeded", None), ("l2", "Tool", "Aqua Net", [], "seeded", None), ("l3", "Model", "Aqua", [], None, None)], "canonical_id string, label string, canonical_name string, aliases array<string>, status string, replaced_by string")
    add = spark.createDataFrame([("Tool", "aqua net", ["AQ", "new"]), ("Tool", "Fresh", None)], "label string, canonical_name string, aliases array<string>")
    got = {r.canonical_id: r for r in entities.grow_lexicon(lex, add).collect()}
    assert got["l2"].status == "human_reviewed" and set(got["l2"].aliases) == {"AQ", "Aqua", "Aqua Net", "aqua net", "new"}
    assert got["l1"].status == "deprecated" and got["l1"].replaced_by == "l2" and got["l3"].status is None and len(got) == 4


def test_vectors(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [0.9, 0.1], "a"), (3, [0.0, 1.0], "b"), (4, None, "b"), (5, [0.0, 0.0], "b")], "id long, v array<float>, l string")
    n = vector_search.neighbours(v, v, "id", "v", 1).orderBy("query").collect()
    assert [(r.query, r.neighbour) for r in n] == [(1, 2), (2, 1), (3, 2), (5, 1)]
    assert {(r.query, r.neighbour) for r in vector_search.neighbours(v, v, "id", "v", 3, "l", block_rows=1).collect()} == {(1, 2), (2, 1), (3, 5), (5, 3)}
    c = vector_search.class_centroids(v.where("v is not null"), "l", "v", 2)
    t = {r.id: (r.selected_label, r.applicable) for r in vector_search.type_by_vectors(v.where("v is not null"), c, "id", "v", label="l").collect()}
    assert t[1] == ("a", True) and t[3] == ("b", True) and t[5][1] is False
    s = spark.createDataFrame([(0.9, True), (0.2, False), (0.7, False)], "s double, t boolean")
    w = vector_search.threshold_sweep(s, "s", "t", [0.5, 0.8]).orderBy("threshold").collect()
    assert [(r.tp, r.fp, r.tn, r.fn) for r in w] == [(1, 1, 1, 0), (1, 0, 2, 0)]


NESTED = "id string, s struct<a:string,page:array<int>,ctx:array<struct<sid:string,pages:array<int>,deep:array<struct<x:int>>>>>"


def test_interval_labels(spark):
    rows = [("r1", ("u", [7, 8], [("s1", [1, None], [(5,)]), None, ("s2", None, []), (None, [], None)])), ("r2", None), ("r3", (None, None, None)), ("r1", ("u", [7, 8], [("s1", [1, None], [(5,)])]))]
    df = spark.createDataFrame(rows, NESTED).repartition(1)
    assert nested.node_paths(df, "s") == ["", "page", "ctx", "ctx.pages", "ctx.deep"]
    tables = {p: nested.node_table(df, "id", "s", p).collect() for p in nested.node_paths(df, "s")}
    assert {p: len(t) for p, t in tables.items()} == {"": 4, "page": 4, "ctx": 5, "ctx.pages": 4, "ctx.deep": 2}
    first = sorted([(r.pre, r.post) for p in tables for r in tables[p] if r.record == "r1"])
    assert first and max(p for p, _ in first) == 9
    got = {(r.record, r.parent_pos, r.parent_sid, r.child_pos, r.child_value) for r in nested.contained(df, "id", "s", "ctx", "ctx.pages").collect()}
    assert got == {("r1", 0, "s1", 0, 1), ("r1", 0, "s1", 1, None), ("r1", 1, None, None, None), ("r1", 2, "s2", None, None), ("r1", 3, None, None, None)}
    deep = {(r.record, r.child_x) for r in nested.contained(df, "id", "s", "", "ctx.deep").collect()}
    assert deep == {("r1", 5), ("r2", None), ("r3", None)}
    one = df.where("s.a = 'u' and size(s.ctx) > 1")
    j = nested.within(nested.node_table(one, "id", "s", "ctx"), nested.node_table(one, "id", "s", "ctx.pages"))
    assert sorted((r.parent_sid, r.pos) for r in j.collect()) == [("s1", 0), ("s1", 1)]
    assert nested.node_table(df.limit(0), "id", "s", "ctx").count() == 0


def test_nested_long_arrays(spark):
    df = spark.createDataFrame([("r", (None, None, [(f"s{i}", [i], None) for i in range(30_000)]))], NESTED)
    got = nested.contained(df, "id", "s", "ctx", "ctx.pages")
    assert got.count() == 30_000 and got.where("parent_pos <> child_value").count() == 0


def test_nested_clashing_names(spark):
    df = spark.createDataFrame([("r", ([(1, 2, [3]), (4, None, None)],))], "record string, s struct<ctx:array<struct<pos:int,pre:int,level:array<int>>>>")
    assert node_columns(nested.node_table(df, "record", "s", "ctx")) == ["record", "pre", "post", "level", "pos", "pos_", "pre_"]
    got = nested.contained(df, "record", "s", "ctx", "ctx.level")
    assert [tuple(r) for r in got.collect()] == [("r", 0, 1, 2, 0, 3), ("r", 1, 4, None, None, None)]


def node_columns(df):
    df.collect()
    return df.columns


def test_scratch_tables(spark):
    from lodestrata.sources.scratch import Scratch, scratch_root

    s = Scratch(spark, "test")
    a = s.put(spark.range(3))
    assert a.count() == 3 and s.base.startswith(scratch_root(spark))
    s.forget(a, None, spark.range(1))
    import os

    assert not os.path.exists(a._scratch_path.removeprefix("file://"))

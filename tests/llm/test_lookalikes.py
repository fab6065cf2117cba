import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from lodestrata.llm import lookalikes as la

#: Hangul syllables and letters, Thai, Devanagari, marks of several classes in any order, a blank with a mark.
SCRIPTS = "모델한각\u1112\u1161\u11abกำแ้ี" + "\u0915\u093f\u0902\u0958\u0915\u093c\u094d" + "aấậ\u0323\u0302\u0308\u0344\u0345\u034f\u00a8\u0f71\u0f72\u0f73 \u200b"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=SCRIPTS, min_size=1, max_size=6), min_size=1, max_size=8), st.sampled_from(["NFC", "NFD", "NFKC"]))
def test_trie_equals_comparing_forms_in_other_scripts(words, form):
    words = [*words, *(w for w in (unicodedata.normalize(form, w) for w in words) if w)]
    trie = la.Trie(words)
    for t in words:
        got = {trie.words[i] for i in trie.match(t)}
        assert t in got and got == {w for w in words if la.table_form(w) == la.table_form(t)}


def test_hangul_and_unordered_marks():
    assert la.Trie(["모델"]).match("모델") == la.Trie(["모델"]).match(unicodedata.normalize("NFD", "모델")) == [0]
    assert la.Trie(["a\u0302\u0323"]).match("ậ") == la.Trie(["a\u0302\u0323"]).match("a\u0302\u0323") == [0]


def test_one_alias_of_many_entries(spark):
    """An alias that all entries hold pairs none of them; another spelling meets each that lacks it."""
    n = 20_000
    lex = spark.range(n).selectExpr("concat('c', id) as canonical_id", "array('Dekrox') as aliases").unionByName(spark.createDataFrame([("a", ["Dekrоx"]), ("b", ["Dekrоx", "Dekrox"])], "canonical_id string, aliases array<string>"))
    m = spark.createDataFrame([("r1", "Dekrox"), ("r2", "Dekrоx")], "resolution_id string, surface_text string")
    got = la.same_looking(m, lex)
    assert got.count() == n + 1 + n  # a with each c; r1 with a; r2 with each c
    assert got.where("key_a = 'a'").count() == n + 1 and got.where("key_b = 'r2'").count() == n and got.where("key_a = 'b' or key_b = 'b'").count() == 0


ODD = "abcÅÄéоаа​­  　ﬁｆ－-‑Á̊KÅµμ₂2"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=ODD, min_size=1, max_size=6), min_size=1, max_size=12), st.text(alphabet=ODD, max_size=6))
def test_trie_equals_comparing_forms(words, text):
    trie = la.Trie(words)
    for t in [text, *words]:
        want = {w for w in words if la.table_form(w) == la.table_form(t)}
        assert {trie.words[i] for i in trie.match(t)} == want


def test_what_looks_the_same():
    same = [("Ｄｅｋｒｏｘ", "Dekrox"), ("Dekrоx", "Dekrox"), ("De​krox", "Dekrox"), ("Århus", "Århus"), ("Krone", "Krone"), ("µX", "μX"), ("a b ", "a b"), ("ﬁlter", "filter"), ("a‑b", "a-b")]
    other = [("Dekrox", "dekrox"), ("CO₂", "CO2"), ("Århus", "Arhus"), ("a-b", "a b"), ("ÃrsmÃ¸de", "Årsmøde")]
    assert all(la.table_form(a) == la.table_form(b) for a, b in same)
    assert not any(la.table_form(a) == la.table_form(b) for a, b in other)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abc", min_size=1, max_size=5), min_size=1, max_size=8), st.text(alphabet="abc", min_size=1, max_size=5), st.integers(0, 2))
def test_weighted_edits(words, text, most):
    trie = la.Trie(words)
    assert {trie.words[i] for i in trie.match(text, most)} == {w for w in words if levenshtein(text, w) <= most}


LEX = [("b_one", ["Dekrox", "Dekrox Kit", None, " "]), ("b_one", ["DKX"]), ("c_two", ["Dekrоx"]), ("d_three", None), ("e_four", []), (None, ["Solo"]), ("a_five", ["DKX", "Ｄekrox"])]
MENTIONS = [("r1", "Ｄｅｋｒｏｘ"), ("r2", "Dekrox"), ("r3", None), ("r4", ""), (None, "Ｄｅｋｒｏｘ"), ("r5", "DKX​"), ("r5", "DKX​"), ("r6", "other"), ("r7", "x" * 5000)]


def test_same_looking(spark):
    lex = spark.createDataFrame(LEX, "canonical_id string, aliases array<string>").selectExpr("*", "1 as entry", "2 as alias")
    m = spark.createDataFrame(MENTIONS, "resolution_id string, surface_text string").selectExpr("*", "'k' as key", "'t' as text", "'a' as alias")
    got = sorted(map(tuple, la.same_looking(m, lex).collect()))
    assert got == [("a_five", "c_two"), ("a_five", "r1"), ("a_five", "r2"), ("a_five", "r5"), ("b_one", "c_two"), ("b_one", "r1"), ("b_one", "r5"), ("c_two", "r1"), ("c_two", "r2")]
    sharded = sorted({(min(r["text"], r["alias"]), max(r["text"], r["alias"])) for r in la.matches(m, lex, "surface_text", shard_chars=10).selectExpr("surface_text as text", "alias").collect()})
    whole = sorted({(min(r["text"], r["alias"]), max(r["text"], r["alias"])) for r in la.matches(m, lex, "surface_text").selectExpr("surface_text as text", "alias").collect()})
    assert sharded == whole


def test_same_looking_empty(spark):
    lex = spark.createDataFrame([], "canonical_id string, aliases array<string>")
    m = spark.createDataFrame(MENTIONS, "resolution_id string, surface_text string")
    assert la.same_looking(m, lex).count() == 0
    assert la.same_looking(m.limit(0), spark.createDataFrame(LEX, "canonical_id string, aliases array<string>")).count() == 3 - 1


def test_consistent_form(spark):
    lex = spark.createDataFrame(LEX, "canonical_id string, aliases array<string>")
    m = spark.createDataFrame(MENTIONS, "resolution_id string, surface_text string").selectExpr("*", "'f' as form")
    for chars in (8, 1_000_000):
        got = {(r["resolution_id"], r["form"]) for r in la.consistent_form(m, lex, "surface_text", shard_chars=chars).collect()}
        assert {("r1", "Dekrox"), ("r2", "Dekrox"), ("r3", None), ("r4", ""), ("r5", "DKX"), ("r6", "other")} <= got

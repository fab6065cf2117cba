import random
import re

import pytest

from lodestrata.llm import leakage as lk

WORDS = "the flow of tank pump at site was lower than plan after new valve test in may over all nodes with gauge read out by crew who log each step then".split()


def brute(doc, item, words=12, chars=30):
    spaced, patterns = lk.item_patterns(item, words, chars)
    if not spaced:
        return any(p in lk.stream(doc) for p in patterns)
    a, b = (re.findall(r"[^\W_]+", lk.folded(lk._HIDDEN.sub("", t))) for t in (doc, item))
    runs = {tuple(b[i : i + words]) for i in range(len(b) - words + 1)}
    return any(tuple(a[i : i + words]) in runs for i in range(len(a) - words + 1))


@pytest.mark.parametrize("seed", range(20))
def test_equals_brute_force(seed):
    r = random.Random(seed)
    items = [(i, " ".join(r.choice(WORDS) for _ in range(r.randrange(8, 40)))) for i in range(8)]
    m = lk._Matcher(items, 12, 30)
    for _ in range(25):
        words = [r.choice(WORDS) for _ in range(r.randrange(5, 60))]
        i, t = r.choice(items)
        own = t.split()
        n = r.randrange(9, 16)
        at = r.randrange(max(1, len(own) - n))
        k = r.randrange(len(words))
        words[k:k] = own[at : at + n]
        doc = " ".join(words)
        assert m.items_in(doc) == [j for j, x in items if brute(doc, x)]


def test_wu_manber_finds_all():
    r = random.Random(3)
    text = "".join(r.choice("ab") for _ in range(3000))
    patterns = list({text[i : i + r.randrange(5, 9)] for i in range(0, 2000, 97)})
    want = {(i, p) for p in patterns for i in range(len(text)) if text.startswith(p, i)}
    assert set(lk.WuManber(patterns).find(text)) == want


ITEM = "The crew of the new plant read each gauge by hand, and the pump at Velo-3 was off for 12 days."
ZH = "第二个小组把Naram放在进水口旁，并让它学习夜间规律，然后才切换到新的计划，所有的读数都被记录下来了。"


def test_what_does_not_matter(spark):
    docs = [
        (1, "x " + ITEM.upper() + " y"), (2, ITEM.replace(" ", "\r\n")), (3, re.sub(r"(?<=[a-z])(?=[aeiou])", "­", ITEM)), (4, ITEM.replace(",", "").replace("-", " ")),
        (5, "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in ITEM)), (6, " ".join(ITEM.split()[:11])), (7, " ".join(ITEM.split()[:12])), (8, None), (9, ""), (10, "x" * 200_000 + " " + ITEM), (11, "z" + ITEM[0:50] + "q"),
        (12, "前面" + ZH[5:40].replace("，", "、 ") + "后面"), (13, ZH[:28]), (None, ITEM), (1, ITEM),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'a' as item_id", "1 as lang")
    items = spark.createDataFrame([(1, ITEM), (2, ITEM), (3, "too short"), (4, None), (5, ZH)], "item_id long, text string").selectExpr("*", "2 as doc_id")
    got = sorted((r[0], r[1] or 0) for r in lk.leaked_items(d, items).collect())
    want = sorted([(i, k) for i in (1, 2) for k in (0, 1, 1, 2, 3, 4, 5, 7, 10)] + [(5, 12)])
    assert got == want
    assert sorted((r[0], r[1] or 0) for r in lk.leaked_items(d, items, block_chars=60).collect()) == want


def test_empty(spark):
    d = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    assert lk.leaked_items(d, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert lk.leaked_items(d.limit(0), spark.createDataFrame([(1, ITEM)], "item_id long, text string")).count() == 0
    assert lk.leaked_items(d, d, doc_col="doc_id", item_col="doc_id").columns == ["item_doc_id", "doc_doc_id"]

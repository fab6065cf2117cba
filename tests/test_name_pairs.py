import random
from decimal import ROUND_HALF_EVEN, Decimal
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import functions as F

from lodestrata.operators import entities

E = "entity_id string, label string, canonical_name string, aliases array<string>"


def rounded(x):
    """Four digits, as Spark rounds what it shows."""
    return float(Decimal(repr(x)).quantize(Decimal("0.0001"), ROUND_HALF_EVEN))


def shuffled_records(spark, run):
    """Records that all stages of ``run`` write to the shuffle."""
    sc = spark.sparkContext
    sc.setJobGroup("shuffled", "")
    before = set(sc.statusTracker().getJobIdsForGroup("shuffled"))
    run()
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = {s for j in set(sc.statusTracker().getJobIdsForGroup("shuffled")) - before for s in sc.statusTracker().getJobInfo(j).stageIds}
    sc.setLocalProperty("spark.jobGroup.id", None)
    store, n = sc._jsc.sc().statusStore(), 0
    for s in stages:
        n += store.lastStageAttempt(s).shuffleWriteRecords()
    return n


def test_common_words_shuffle_names_and_no_pairs(spark):
    """2,000 names of two common words make two million pairs that meet; none of them is shuffled, similar or not."""
    r = random.Random(3)
    middle = sorted({"".join(r.choice("bcdfghklmnprstvz") + r.choice("aeiou") for _ in range(4)) for _ in range(2000)})
    df = spark.createDataFrame([(f"e{i:05d}", "Tool", f"the {m} agent", None) for i, m in enumerate(middle)], E).cache()
    found = []
    n = shuffled_records(spark, lambda: found.append(entities.similar_pairs(df).where("score >= 0.64").agg(F.count("left_id"), F.count_distinct("left_id")).collect()[0]))
    assert found[0][0] > 5_000 and found[0][1] > 1_000
    assert n < 100 * len(middle)


def test_pairs_of_divided_words_equal_all_pairs(spark, monkeypatch):
    from lodestrata.operators import name_pairs

    monkeypatch.setattr(name_pairs, "PART", 60)
    r = random.Random(8)
    syllable = lambda: r.choice("bdkrst") + r.choice("aei")
    made = lambda: "".join(syllable() for _ in range(3))
    names = [f"{r.choice(['the ', ''])}{made()}{r.choice([' agent', ' agent', ' net', '', '-7', '-8'])}" for _ in range(330)]
    long = [made() for _ in range(60)]
    names += [" ".join(long[k : k + 40]) for k in range(6)] + ["a" * 210 + " agent", "the " + "a" * 205 + " agent", " ".join(long[:11]), " ".join(long[1:12])]
    df = spark.createDataFrame([(f"e{i:03d}", "Tool", n, r.choice([None, None, ["one"], ["two", "one"], [n.upper()]])) for i, n in enumerate(names)], E)
    reps = sorted(entities.representatives(df).collect(), key=lambda x: x.rep)
    held, star = {}, set()
    for x in entities.alias_classes(df).collect():
        held.setdefault(x.rep, set()).add(x.alias_key)
        star.add((min(x.rep, x.class_rep), max(x.rep, x.class_rep)))
    want = {}
    for i, a in enumerate(reps):
        for b in reps[i + 1 :]:
            if not (a.versions and b.versions and a.versions != b.versions):
                j = len(set(a.tokens) & set(b.tokens)) / len(set(a.tokens) | set(b.tokens))
                inside = (a.norm in b.norm or b.norm in a.norm) and min(len(a.norm), len(b.norm)) >= 4
                least = 0.55 * j + 0.45 * 2 * min(len(a.norm), len(b.norm)) / (len(a.norm) + len(b.norm))
                if inside or least >= 0.64 or (a.rep, b.rep) in star:
                    own = rounded(max(0.88 if inside else 0, 0.55 * j + 0.45 * SequenceMatcher(None, a.norm, b.norm).ratio()))
                    if own >= 0.64 or (a.rep, b.rep) in star:
                        alias = bool(held.get(a.rep, set()) & held.get(b.rep, set()))
                        want[a.rep, b.rep] = (rounded(j), inside, alias, max(own, 0.995 if alias else 0))
    rows = entities.similar_pairs(df).collect()
    got = {(x.left_id, x.right_id): (x.jaccard, x.containment, x.alias_overlap, x.score) for x in rows}
    assert len(got) == len(rows) and got == want and any(v[2] for v in want.values())


def test_matched_characters_equal_sequence_matcher():
    from lodestrata.functions.similarity import matched_characters

    r = random.Random(5)
    names = ["".join(r.choice("ab c") for _ in range(r.randrange(0, 14))) for _ in range(60)] + ["".join(r.choice("abcd ") for _ in range(r.randrange(20, 260))) for _ in range(12)]
    x, y = (v.ravel() for v in np.meshgrid(np.arange(len(names)), np.arange(len(names))))
    want = np.array([sum(m.size for m in SequenceMatcher(None, names[a], names[b]).get_matching_blocks()) for a, b in zip(x, y)])
    assert (matched_characters(names, x, y, np.zeros(len(x))) == want).all()
    need = np.array([r.randrange(20) for _ in x])
    assert (matched_characters(names, x, y, need) == np.where(want >= need, want, -1)).all()


def test_pairs_of_no_names_and_short_names(spark):
    df = spark.createDataFrame([("e1", "Tool", "ab", None), ("e2", "Tool", "ab c", []), ("e3", "Tool", "--", ["x"]), ("e4", "Model", "ab", None)], E)
    assert [(r.left_id, r.right_id, r.containment, r.score) for r in entities.similar_pairs(df, 0.55).collect()] == [("e1", "e2", False, 0.575)]
    assert not entities.similar_pairs(df.where("entity_id > 'e4'")).collect() and not entities.similar_pairs(df.where("entity_id = 'e3'")).collect()

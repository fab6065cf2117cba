import pytest

from lodestrata.llm import encodings as en

CLEAN = [
    "Die Größenordnung der Messwerte bestätigte die Prüfung.", "Während der Prüfung fiel die Größe aus.", "Grâce à la méthode, le système coûte moins.", "L’opérateur préfère été après été.",
    "На станции система не менялась семь дней.", "По данным станции она даёт сбой.", "El año pasado la solución dañó la red.", "Flow fell below 3.2 m³/h – it’s “no drift”.", "在水厂，该系统运行了天。", "The café-scale pilot.", "±5 % and 40 µg/L at 3 °C",
]
TEXTS = CLEAN * 40


@pytest.fixture(scope="module")
def model(spark):
    return en.train(spark.createDataFrame([(t,) for t in TEXTS], "t string"))


@pytest.mark.parametrize(("wrong", "right"), [("cp1252", "utf_8"), ("cp1251", "utf_8"), ("cp437", "utf_8"), ("mac_roman", "utf_8"), ("cp850", "utf_8")])
def test_round_trip(model, wrong, right):
    texts = [t for t in CLEAN if not t.isascii()]
    spoilt = [en.garble(t, wrong, right) for t in texts]
    r = en.Restorer(model, 4.0)
    r.learn([*texts, *spoilt])
    assert [r.restore(t) for t in texts] == [None] * len(texts)
    assert [r.restore(s)[1] for s in spoilt] == texts


@pytest.mark.parametrize(("wrong", "right", "text"), [("cp1251", "koi8_r", CLEAN[4]), ("cp1252", "cp1251", CLEAN[5]), ("cp1252", "gb18030", "在水厂，该系统运行了天。")])
def test_other_chains(model, wrong, right, text):
    spoilt = en.garble(text, wrong, right)
    r = en.Restorer(model, 4.0)
    r.learn([spoilt])
    assert r.restore(spoilt)[1] == text


@pytest.mark.parametrize(("wrong", "right", "word"), [("gbk", "utf_8", "café"), ("cp1252", "big5", "功"), ("gbk", "utf_8", "Größe")])
def test_wide_chains_of_one_character(wrong, right, word):
    spoilt = en.garble(word, wrong, right)
    assert len(en._HIGH.findall(spoilt)) == 1 or word == "Größe"
    assert word in [got for k, got in en._readings(spoilt) if en.CHAINS[k] == (wrong, right)]


LONG = {
    "zh": "在水厂，该系统运行了天。功能水压模型预测出水氨氮",
    "ja": "水道の管網は夜間に圧力が下がり、ポンプが停止しました。",
    "ko": "정수장의모델은암모니아를예측하고압력을낮추었다",
    "ru": "Настанциисистеманеменяласьсемьднейподаннымонадаётсбой",
}
WRITES = {"utf_8": LONG, "gb18030": ("zh", "ru"), "big5": ("zh_hant",), "shift_jis": ("ja",), "euc_jp": ("ja",), "euc_kr": ("ko",)}


@pytest.fixture(scope="module")
def long_model(spark):
    """Knows each language of unspaced texts in many orders."""
    texts = [*TEXTS]
    for own in (*LONG.values(), "在水廠，該系統運行了天。功能水壓模型預測出水氨氮"):
        texts += [own[k:] + own[:k] for k in range(len(own))] * 8
    return en.train(spark.createDataFrame([(t,) for t in texts], "t string"))


@pytest.mark.parametrize("chain", [c for c in en.CHAINS_OF_TWO if c[1] in WRITES])
def test_thousand_unspaced_characters_behind_a_letter(long_model, chain):
    """Words are never cut, so a sequence across any place comes back whole, for every multi-byte chain."""
    wrong, right = chain
    tried = 0
    for name in WRITES[right]:
        own = "在水廠，該系統運行了天。功能水壓模型預測出水氨氮" if name == "zh_hant" else LONG[name]
        text = "x" + (own * (1_000 // len(own) + 1))[:1_000]
        spoilt = en.garble(text, wrong, right)
        if spoilt is None or spoilt == text:
            continue
        tried += 1
        assert en.apply_chain(spoilt, chain) == text
        r = en.Restorer(long_model, 4.0)
        r.learn([spoilt, text])
        assert r.restore(text) is None and r.restore(spoilt)[1] == text
    assert tried or wrong in ("gbk", "shift_jis")


def test_long_words_score_as_short_ones(model, monkeypatch):
    texts = [en.garble(t, w, "utf_8") for t in CLEAN if not t.isascii() for w in ("cp1252", "cp1251")] + CLEAN
    short, long = en.Restorer(model, 4.0), en.Restorer(model, 4.0)
    short.learn(texts)
    monkeypatch.setattr(en, "_LONG", 1)
    monkeypatch.setattr(en, "_SPAN", 7)
    long.learn(texts)
    for t in texts:
        a, b = short.reading(t), long.reading(t)
        assert (a and a[:2]) == (b and b[:2]) and short.best(t)[1] == pytest.approx(long.best(t)[1])


def test_one_accent_read_as_gbk(model):
    text = "The caf茅-scale pilot."
    r = en.Restorer(model, 4.0)
    r.learn([text, CLEAN[8]])
    assert r.restore(text) == ("gbk>utf_8", "The café-scale pilot.") and r.restore(CLEAN[8]) is None


def test_unseen_characters_are_scored(model):
    rare = "The Čapek pilot 😀."  # no clean value has these
    spoilt = rare.encode("utf_8").decode("cp1252")
    clean = ["Բարեւ Ձեզ", "ข้อความภาษาไทย", "Łódź", "日本語", rare]
    r = en.Restorer(model, 4.0)
    r.learn([spoilt, *clean])
    assert r.restore(spoilt) == ("cp1252>utf_8", rare)
    assert [r.restore(t) for t in clean] == [None] * len(clean)


def test_twice_partly_and_lost(model):
    twice = en.garble(en.garble(CLEAN[2], "cp1252", "utf_8"), "cp1252", "utf_8")
    part = "Die Größenordnung der Messwerte bestÃ¤tigte die Prüfung."
    lost = "Die Gr��enordnung der Messwerte"
    r = en.Restorer(model, 4.0)
    r.learn([twice, part, lost])
    assert r.restore(twice)[1] == CLEAN[2]
    assert r.restore(part)[1] == CLEAN[0]
    assert r.restore(lost) == (None, None)


def test_margin_is_validated(model):
    margin, found = en.validated_margin(model, [t for t in CLEAN if not t.isascii()])
    assert margin >= 3.5 and found > 0.95


def test_margin_covers_all_rows(spark, model):
    """Rows beyond the first 4,000 decide too, and where they lie does not matter."""
    first, rest = "Flow fell below 3.2 m³/h – café.", [f"Ñandú {a}ł{b}ő ß{b}ü{a}ж" for a in "aeioubcdf" for b in "aeioulmnr"]
    clean = [first] * 4_000 + rest * 4
    rows = [(i, t) for i, t in enumerate([*clean, en.garble(CLEAN[0], "cp1252", "utf_8")])]
    want, recall = en.validated_margin(model, clean)
    few = en.validated_margin(model, clean[:4_000])[0]
    r = en.Restorer(model, 0.0)
    r.learn(rest)
    gain = max(r.best(t)[1] for t in rest)
    assert recall > 0.9 and want > few
    assert gain > few  # by the first rows alone, clean ones would be hits
    for part in (rows, rows[::-1]):
        got = en.restore(spark.createDataFrame(part, "id int, t string").repartition(3), ["t"], model).collect()
        assert [(x.id, x.original) for x in got] == [(len(clean), CLEAN[0])]


def test_recall_chooses_the_margin():
    gains, found = en.new_histogram(), en.new_histogram()
    gains[[0, 100]] = 980, 20  # a fiftieth of the clean texts gain 5
    found[[110, 400]] = 50, 50
    assert en.chosen_margin(gains, found) == (pytest.approx(5.05), 1.0)
    gains[[0, 100]], found[[90, 110, 400]] = (999, 1), (50, 0, 50)  # one text in 1,000 is not worth half of the garbled ones
    assert en.chosen_margin(gains, found) == (pytest.approx(3.5), 1.0)


def test_restore_keeps_other_columns(spark, model):
    rows = [("a", en.garble(CLEAN[0], "cp1252", "utf_8"), CLEAN[1], "x"), ("b", None, "", "y"), ("c", CLEAN[2], "Gr�n", "z"), (None, en.garble(CLEAN[2], "cp437", "utf_8"), None, None), ("d", "plain", "é" * 20_000, "w")]
    df = spark.createDataFrame(rows, "id string, one string, two string, field string")
    got = sorted(((r["id"] or "", r["field"], r["original"]) for r in en.restore(df, ["one", "two"], model, 4.0).collect()))
    assert got == [("", "one", CLEAN[2]), ("a", "one", CLEAN[0]), ("c", "two", None)]
    assert en.restore(df.limit(0), ["one", "two"]).count() == 0

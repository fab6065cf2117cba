import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestrata.llm import sentences as se


@pytest.fixture(scope="module")
def model(spark):
    return se.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def cut(model, text):
    return [text[a:b] for a, b in model.sentences(text)]


CASES = [
    ["Dr. Drano and Prof. M. Fobre checked nodal pressure during wet weather.", "The reading at Tethuzon was 2,100.1 kWh on Jan. 10 and 48.3 m on Feb. 5.", "Nobody knew why effluent ammonia fell…", "Results for Nabrirv were robust, e.g. when flow exceeded 9.1 °C."],
    ["Fuvaum ran for 8 h... and then the solver tracked peak demand.", "This agrees with earlier work on peak demand.[4]", "What if Stotakrald fails?!", "pH was held at 29.1 while the clarifier reduced flow."],
    ["Mr. Dripluld asked, “Who shut the valve?” and left Pautreis.", "(Data for Kreibrau are site-specific.)", "Samples were taken at 4 a.m. and 5 p.m. near the intake.", "Sampling stopped at 7 p.m.", "The reservoir rose."],
    ["The logbook of Pimam says: “Valve shut at 10 p.m. Flow fell to 57.97 kWh.”", "The panel listed Draust, Sokeint, etc.", "Although flow was robust, the team kept the dose."],
    ["Nach Rutrei u. a. ist Stataner z. B. für Bezirk Nr. 6 geeignet.", "Der 9. Versuch mit Sasteld dauerte 69,2 Std. und erfasste die Trübung.", "Prof. Zubrem fragte: „Wer hat Sezagask abgeschaltet?“", "„Das genügt nicht“, schrieb Dr. Brauzam über Daufaunt."],
    ["Le coût de Sisteil, env. 2.11 M€, réduit le débit résiduel.", "Cf. p. 2 pour les mesures de Mifapa sans réglage manuel.", "« Qui a fermé Rezur ? » demande Mme Nosestau.", "Selon M. Vasom, Drekre prévoit la turbidité."],
    ["«Кто закрыл задвижку?» — спросил проф. Krause.", "Опыт Pibrenox длился 66,5 ч, т. е. дольше плана."],
]


@pytest.mark.parametrize("case", CASES)
def test_known_cases(model, case):
    assert cut(model, " ".join(case)) == case
    wrapped = " ".join(case).replace(" the ", "\nthe ").replace(" und ", "\nund ")
    assert [x.replace("\n", " ") for x in cut(model, wrapped)] == case


def test_scripts_without_spaces(model):
    zh = ["在冬季运行中，本模型预测了出水氨氮。", "（Zupum的数据见表10.3。）", "“管网压力还会上升吗？”值班员问Thausko。", "Patrausk说：“不行！”", "Medro在雨季表现最好！"]
    assert cut(model, "".join(zh)) == zh
    th = ["แบบจำลองลดแรงดันได้ 79.68 เปอร์เซ็นต์", "ปั๊มน้ำลดการรั่วไหล"]
    assert cut(model, " ".join(th)) == th


def test_no_space_after_a_stop(model):
    assert cut(model, "The flow fell in the cold months.Fig. 2 shows that the clarifier reduced inflow.The pump ran.") == ["The flow fell in the cold months.", "Fig. 2 shows that the clarifier reduced inflow.", "The pump ran."]


def test_blank_lines_and_headings(model):
    assert cut(model, "2.1 Pilot plant\r\n\r\nThe flow\r\nfell\n \nFigure 2: Tank\n\n\n") == ["2.1 Pilot plant", "The flow\r\nfell", "Figure 2: Tank"]
    assert cut(model, "") == cut(model, " \n\n ") == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab AB.!?…。“”«»„()[]1,\n\r ก中", max_size=80))
def test_spans_are_whole(model, text):
    spans = model.sentences(text)
    assert all(a < b and text[a:b] == text[a:b].strip() for a, b in spans)
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    covered = "".join(text[a:b] for a, b in spans)
    assert "".join(covered.split()) == "".join(text.split())


def test_held_out_boundaries(spark, model):
    """Ends of units and the starts that follow, joined by a blank: a boundary that the texts themselves show."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en' and text is not null").select("text").limit(150).collect()
    right = total = 0
    for (t,) in rows:
        body = [t[a:b] for a, b in se.units(t) if t[b - 1] in ".!?"]
        for x, y in zip(body, body[1:]):
            ends = {b for _, b in model.sentences(f"{x} {y}")}
            right += len(x) in ends
            total += 1
    assert total > 300 and right / total > 0.98


def test_frames(spark, model):
    rows = [(1, "One stop. Two stops."), (2, None), (3, "  "), (1, "One stop. Two stops."), (None, "Alone."), (4, "A long text ran on. " * 5000)]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start_char", "2 as end_char")
    got = [tuple(r) for r in se.sentences(d, model).collect()]
    assert sorted((a or 0, b, c) for a, b, c in got if a != 4) == [(0, 0, 6), (1, 0, 9), (1, 0, 9), (1, 10, 20), (1, 10, 20)]
    assert sum(a == 4 for a, _, _ in got) == 5000
    assert se.sentences(d.limit(0)).count() == 0


def test_every_token_with_evidence_is_kept(spark):
    """More tokens than 30,000, and the rarest of them is an abbreviation."""
    letters = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    rows = [("\n\n".join(f"The pump ran with q{letters(i)}." for i in range(at, at + 1_000)),) for at in range(0, 31_000, 1_000)] * 4
    rows += [("By the zzabb. Smith report it ran.\n\nNo more.",)] * 3
    m = se.train(spark.createDataFrame(rows, "text string"))
    assert len(m.before) > 31_000 and m.before.get("zzabb", 4) < m.before.get("q" + letters(30_999)) == 4 and "none such" not in m.before


def test_stops_before_letters_without_case_are_candidates():
    for unit, end in (("هطل المطر.ثم توقف", 10), ("पानी गिरा!फिर रुका", 10), ("水位下降.水泵停止", 5), ("น้ำลดลง.ปั๊มหยุด", 8), ("نزل الماء؟نعم", 10)):
        flat, mixed, quoted = se._views(unit)
        found = se._candidates(unit, flat, se._script(unit), quoted)
        assert [(j, at, k[6]) for j, at, k in found if j < len(unit)] == [(end, end, True)]
    assert [j for j, _, _ in se._candidates("run in v.2 or a.b", "run in v.2 or a.b", "l", False)] == []


def test_no_window_hides_a_token_or_a_quotation(model):
    long = "x" * 5_000 + "Y"
    found = se._candidates(f"It was {long}. {long}y ran on.", f"It was {long}. {long}y ran on.", "l", False)
    assert found[0][2][:2] == (long, f"{long}y")
    deep = "„" * 30 + "a. b" + "“" * 30
    assert se._quotations(deep) == [(0, len(deep) - 1)]
    lead = f"Shut it.{' ' * 400}“Now!” he said."
    end = lambda t: [k[4] for j, _, k in se._candidates(t, t, "l", True) if t[j - 1] == "”"]
    assert end(lead) == [True] and end(lead.replace("it.", "it")) == [False]


def test_the_pass_over_texts_and_the_one_with_a_model_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    own = se.train(docs)
    assert sorted(map(tuple, se.sentences(docs, own).collect())) == sorted(map(tuple, se.sentences(docs).collect()))


@given(st.text(alphabet="aB.\x1e\x1f\x0b 中。", max_size=30))
def test_kinds_survive_writing(text):
    flat, mixed, quoted = se._views(text)
    for a, b in se.units(text):
        for _, _, kind in se._candidates(text[a:b], flat[a:b], "l", quoted):
            assert se.unwritten(se.written(kind)) == kind and "\x1e" not in se.written(kind)

"""Checks of parsed documents and of whole runs, as rows of codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.text import has_terminal_punctuation

#: Limits of a parse that looks complete (fixed values).
LEAST_SECTIONS, LEAST_PARAGRAPHS, LEAST_SENTENCES, LEAST_PAGE_RATIO = 3, 5, 20, 0.45
MIDPOINT_PAGES, CHARACTERS_PER_PAGE = 6, 250
LONGEST_TITLE, LONGEST_PARAGRAPH, TAIL = 160, 6_000, 8_000
#: What a long author line or text holds that belongs to the publisher or to a reference list (fixed values).
AUTHOR_FURNITURE = "(?i)(published as part of|special issue|cite this|@)"
AFFILIATIONS = "(?i)\\b(university|department|institute|laboratory)\\b"
PUBLISHER_FURNITURE = "(?i)\\b(journal homepage|available online at|contents lists available)\\b"
REFERENCE_LIST = "(?is)\\b(references|bibliography)\\b.{0,80}\\bet al\\.\\b"


def _yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def early_cutoff(pages: Column, last_page: Column) -> Column:
    """Whether the text of a paper of six pages or more ends before its midpoint."""
    return _yes((pages >= MIDPOINT_PAGES) & (last_page < pages * 0.5))


def page_summary(paragraphs: DataFrame, pages: DataFrame, key: str = "document_id") -> DataFrame:
    """``(key, pages, narrative_page_ratio, last_narrative_page, warnings)`` from ``paragraphs(key, pages)`` and ``pages(key, pages, characters, discarded)``.

    Warnings: ``low_text_density`` below 250 characters a page, ``discarded_fragments``, and ``early_cutoff`` where six
    pages or more end before the midpoint.
    """
    told = paragraphs.select(key, F.explode("pages").alias("_p")).groupBy(key).agg(F.count_distinct("_p").alias("_told"), F.max("_p").alias("last_narrative_page"))
    out = pages.join(told, key, "left").withColumns({"_told": F.coalesce("_told", F.lit(0)), "last_narrative_page": F.coalesce("last_narrative_page", F.lit(0))})
    ratio = F.when(F.col("pages") > 0, F.col("_told") / F.col("pages")).otherwise(F.lit(0.0))
    warnings = F.array_compact(F.array(
        F.when(_yes(F.col("characters") < F.col("pages") * CHARACTERS_PER_PAGE), F.lit("low_text_density")),
        F.when(_yes(F.col("discarded") > 0), F.lit("discarded_fragments")),
        F.when(_yes((F.col("pages") >= MIDPOINT_PAGES) & (F.col("last_narrative_page") < F.ceil(F.col("pages") * 0.5))), F.lit("early_cutoff")),
    ))
    return out.select(key, "pages", ratio.alias("narrative_page_ratio"), "last_narrative_page", warnings.alias("warnings"))


def parse_issues(documents: DataFrame, sections: DataFrame, paragraphs: DataFrame, key: str = "document_id") -> DataFrame:
    """``(key, issues)``: which of eighteen codes hold for each parsed document, in order.

    ``documents(key, title, authors_text, pages, narrative_page_ratio, last_narrative_page)``, ``sections(key, title)``,
    ``paragraphs(key, ordinal, text, sentences)`` with the sentences as an array of texts. Counts are taken here; a
    document without sections or paragraphs has none. Only the ends of texts (``TAIL`` characters of the last
    paragraphs) are gathered for the search for reference lists, which may lie across paragraphs.
    """
    low = F.lower("title")
    s = sections.groupBy(key).agg(
        F.count(F.lit(1)).alias("_sections"), F.max(F.contains(low, F.lit("abstract"))).alias("_abstract"), F.max(F.contains(low, F.lit("intro"))).alias("_intro"),
        F.max((F.length("title") > LONGEST_TITLE) | F.col("title").rlike("[.,;]$")).alias("_odd_title"),
    )
    text, n = F.col("text"), F.coalesce(F.size("sentences"), F.lit(0))
    p = paragraphs.withColumn("_end", F.sum(F.length("text") + 1).over(_from_end(key)))
    p = p.groupBy(key).agg(
        F.count(F.lit(1)).alias("_paragraphs"), F.sum(F.greatest(n, F.lit(0))).alias("_sentences"), F.max(F.length(text) > LONGEST_PARAGRAPH).alias("_large"), F.max(n <= 0).alias("_bare"),
        F.max(F.contains(F.lower(text), F.lit("cid:")) | F.contains(text, F.lit("�"))).alias("_artifact"), F.max(text.rlike(PUBLISHER_FURNITURE)).alias("_publisher"),
        F.max(_yes(F.array_join("sentences", " ") != text)).alias("_mismatch"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_end") - F.length(text) <= TAIL + 1, F.struct("ordinal", "text")))), lambda x: x["text"]), "\n").alias("_tail"),
    )
    d = documents.join(s, key, "left").join(p, key, "left")
    authors = F.coalesce("authors_text", F.lit(""))
    none = lambda c: F.coalesce(c, F.lit(0))
    codes = {
        "missing_title": F.coalesce("title", F.lit("")) == "",
        "missing_authors": authors == "",
        "author_furniture_leakage": authors.rlike(AUTHOR_FURNITURE),
        "author_affiliation_leakage": authors.rlike(AFFILIATIONS),
        "too_few_sections": none(F.col("_sections")) < LEAST_SECTIONS,
        "too_few_paragraphs": none(F.col("_paragraphs")) < LEAST_PARAGRAPHS,
        "too_few_sentences": none(F.col("_sentences")) < LEAST_SENTENCES,
        "low_narrative_page_coverage": F.coalesce("narrative_page_ratio", F.lit(0.0)) < LEAST_PAGE_RATIO,
        "early_narrative_cutoff": early_cutoff(F.col("pages"), none(F.col("last_narrative_page"))),
        "missing_abstract_section": ~_yes(F.col("_abstract")),
        "missing_introduction_section": ~_yes(F.col("_intro")),
        "suspicious_section_title": F.col("_odd_title"),
        "oversized_paragraph": F.col("_large"),
        "paragraph_without_sentences": F.col("_bare"),
        "encoding_or_formula_artifact": F.col("_artifact"),
        "possible_reference_leakage": F.right("_tail", F.lit(TAIL)).rlike(REFERENCE_LIST),
        "publisher_furniture_leakage": F.col("_publisher"),
        "sentence_coverage_mismatch": F.col("_mismatch"),
    }
    return d.select(key, F.array_compact(F.array(*[F.when(_yes(c), F.lit(k)) for k, c in codes.items()])).alias("issues"))


def _from_end(key: str):
    return Window.partitionBy(key).orderBy(F.desc("ordinal")).rowsBetween(Window.unboundedPreceding, 0)


def parse_integrity(sections: DataFrame, paragraphs: DataFrame, sentences: DataFrame, key: str = "document_id") -> DataFrame:
    """``(key, code, unit, n)`` for each document with faults: ids that repeat, ordinals that do not count from 0, texts without a final stop, paragraphs that their sentences do not give back, and suspicious ones.

    ``sections(key, section_id)``, ``paragraphs(key, section_id, paragraph_id, ordinal, text)``,
    ``sentences(key, paragraph_id, sentence_id, ordinal, text)``.
    """
    ids = sections.select(key, F.col("section_id").alias("id")).unionByName(paragraphs.select(key, F.col("paragraph_id").alias("id"))).unionByName(sentences.select(key, F.col("sentence_id").alias("id")))
    repeated = ids.groupBy(key).agg((F.count("id") - F.count_distinct("id")).alias("n")).select(key, F.lit("duplicate_ids").alias("code"), F.lit("id").alias("unit"), "n")
    out = [repeated]
    for unit, rows, parent in (("paragraph", paragraphs, "section_id"), ("sentence", sentences, "paragraph_id")):
        g = rows.groupBy(key, parent).agg(((F.min("ordinal") != 0) | (F.max("ordinal") + 1 != F.count("ordinal")) | (F.count_distinct("ordinal") != F.count("ordinal"))).alias("bad"))
        out.append(g.where("bad").groupBy(key).agg(F.count(F.lit(1)).alias("n")).select(key, F.lit("ordinal_errors").alias("code"), F.lit(unit).alias("unit"), "n"))
        bare = rows.where(~has_terminal_punctuation("text"))
        out.append(bare.groupBy(key).agg(F.count(F.lit(1)).alias("n")).select(key, F.lit("grammar_errors").alias("code"), F.lit(unit).alias("unit"), "n"))
    joined = sentences.groupBy(key, "paragraph_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "text"))), lambda x: x["text"]), " ").alias("_joined"))
    torn = paragraphs.join(joined, [key, "paragraph_id"], "left").where(F.coalesce("_joined", F.lit("")) != F.col("text"))
    out.append(torn.groupBy(key).agg(F.count(F.lit(1)).alias("n")).select(key, F.lit("sentence_coverage_mismatch").alias("code"), F.lit("paragraph").alias("unit"), "n"))
    letters, digits = F.regexp_count("text", F.lit("[A-Za-z]")), F.regexp_count("text", F.lit("\\d"))
    odd = paragraphs.where((F.length("text") < 80) | (digits > letters * 0.22) | F.contains("text", F.lit("cid:")))
    out.append(odd.groupBy(key).agg(F.count(F.lit(1)).alias("n")).select(key, F.lit("suspicious_paragraph").alias("code"), F.lit("paragraph").alias("unit"), "n"))
    return reduce(DataFrame.unionByName, out).where("n > 0")


#: Codes of a run in the order in which they are reported (fixed values); the last is a warning.
RUN_CODES = (
    "missing_artifact", "duplicate_source_id", "too_few_sentences", "duplicate_mention_id", "unknown_node_label", "missing_sentence_reference",
    "invalid_character_span", "evidence_quote_mismatch", "missing_parent_reference", "duplicate_assertion_id", "missing_assertion_endpoint",
    "domain_range_violation", "missing_assertion_evidence", "duplicate_resolution_id", "missing_resolution_endpoint", "unexpected_automatic_merge",
    "node_coverage_below_threshold", "no_relationships_extracted", "weak_expectation_title_match",
)


def _repeats(rows: DataFrame, column: str, code: str) -> DataFrame:
    """One row for each repetition of an id, as ``id`` and ``n`` repetitions."""
    return rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("id")).agg((F.count(F.lit(1)) - 1).alias("n")).where("n > 0").select(F.lit(code).alias("code"), F.col("id").cast("string").alias("id"), "n")


def _coded(rows: DataFrame, condition: Column, code: str, column: str) -> DataFrame:
    return rows.where(_yes(condition)).select(F.lit(code).alias("code"), F.col(column).cast("string").alias("id"), F.lit(1).cast("long").alias("n"))


def unit_codes(units: DataFrame, least_sentences: int) -> DataFrame:
    """Codes of ``units(document_id, kind, unit_id)``, where kind is section, paragraph or sentence: ids that repeat within a document or, for sentences, anywhere; documents of too few sentences."""
    within = units.where("kind <> 'sentence'").groupBy("document_id", "unit_id").agg((F.count(F.lit(1)) - 1).alias("n")).where("n > 0").select(F.lit("duplicate_source_id").alias("code"), F.col("unit_id").alias("id"), "n")
    sentences = units.where("kind = 'sentence'")
    counts = units.select("document_id").distinct().join(sentences.groupBy("document_id").agg(F.count(F.lit(1)).alias("_n")), "document_id", "left")
    few = counts.where(F.coalesce("_n", F.lit(0)) < least_sentences).select(F.lit("too_few_sentences").alias("code"), F.col("document_id").alias("id"), F.lit(1).cast("long").alias("n"))
    return within.unionByName(_repeats(sentences, "unit_id", "duplicate_source_id")).unionByName(few)


def mention_codes(mentions: DataFrame, sentences: DataFrame, labels: DataFrame | None = None, parents: DataFrame | None = None) -> DataFrame:
    """Codes of ``mentions(mention_id, label, kind, sentence_id, start_char, end_char, quote, surface_text, paragraph_id, section_id)`` against ``sentences(sentence_id, text)``.

    Only mentions of the kind ``sentence_span`` refer to text. ``labels(label)`` are those of the ontology, ``parents(unit_id)`` the ids of sections and paragraphs. Each sentence id is taken once.
    """
    one = sentences.where("sentence_id is not null").groupBy("sentence_id").agg(F.min("text").alias("_text"))
    spans = mentions.where("kind = 'sentence_span'").join(one.withColumn("_there", F.lit(True)), "sentence_id", "left")
    a, b, t = F.col("start_char"), F.col("end_char"), F.col("_text")
    there = F.col("_there").isNotNull()
    inside = _yes((a >= 0) & (a < b) & (b <= F.length(t)))
    quoted = _yes(F.substr(t, a + 1, b - a) == F.col("quote")) & _yes(F.col("quote") == F.col("surface_text"))
    out = [
        _repeats(mentions, "mention_id", "duplicate_mention_id"), _coded(spans, ~there, "missing_sentence_reference", "mention_id"),
        _coded(spans, there & ~inside, "invalid_character_span", "mention_id"), _coded(spans, there & inside & ~quoted, "evidence_quote_mismatch", "mention_id"),
    ]
    if labels is not None:
        out.append(_coded(mentions.join(labels.select("label").distinct(), "label", "left_anti"), F.lit(True), "unknown_node_label", "mention_id"))
    if parents is not None:
        ids = parents.select("unit_id").distinct()
        lost = spans.where(there).join(ids.withColumnRenamed("unit_id", "paragraph_id").withColumn("_p", F.lit(True)), "paragraph_id", "left").join(ids.withColumnRenamed("unit_id", "section_id").withColumn("_s", F.lit(True)), "section_id", "left")
        out.append(_coded(lost, F.col("_p").isNull() | F.col("_s").isNull(), "missing_parent_reference", "mention_id"))
    return reduce(DataFrame.unionByName, out)


def assertion_codes(assertions: DataFrame, mentions: DataFrame, valid: DataFrame, sentences: DataFrame) -> DataFrame:
    """Codes of ``assertions(assertion_id, document_id, subject_mention_id, predicate, object_mention_id, ontology_valid, evidence_sentence_ids)``.

    ``mentions(mention_id, label)``, ``valid(predicate, domain, range)`` with the labels that a predicate permits, closed over ancestors, ``sentences(sentence_id)``.
    """
    one = mentions.groupBy("mention_id").agg(F.min("label").alias("_label"))
    ends = assertions.join(one.select(F.col("mention_id").alias("subject_mention_id"), F.col("_label").alias("_s")), "subject_mention_id", "left")
    ends = ends.join(one.select(F.col("mention_id").alias("object_mention_id"), F.col("_label").alias("_o")), "object_mention_id", "left")
    there = F.col("_s").isNotNull() & F.col("_o").isNotNull()
    known = valid.select("predicate", F.col("domain").alias("_s"), F.col("range").alias("_o")).distinct().withColumn("_valid", F.lit(True))
    judged = ends.where(there).join(known, ["predicate", "_s", "_o"], "left")
    evidence = ends.where(there).select("assertion_id", F.explode(F.array_distinct("evidence_sentence_ids")).alias("sentence_id"))
    lost = evidence.join(sentences.select("sentence_id").distinct(), "sentence_id", "left_anti").groupBy("assertion_id").agg(F.count(F.lit(1)).alias("n"))
    out = [
        _repeats(assertions, "assertion_id", "duplicate_assertion_id"), _coded(ends, ~there, "missing_assertion_endpoint", "assertion_id"),
        _coded(judged, F.col("_valid").isNull() | ~_yes(F.col("ontology_valid")), "domain_range_violation", "assertion_id"),
        lost.select(F.lit("missing_assertion_evidence").alias("code"), F.col("assertion_id").cast("string").alias("id"), "n"),
    ]
    return reduce(DataFrame.unionByName, out)


def resolution_codes(resolutions: DataFrame, mentions: DataFrame) -> DataFrame:
    """Codes of ``resolutions(resolution_id, left_mention_id, right_mention_id, auto_merged)`` against ``mentions(mention_id)``."""
    ids = mentions.select("mention_id").distinct()
    ends = resolutions.join(ids.select(F.col("mention_id").alias("left_mention_id"), F.lit(True).alias("_l")), "left_mention_id", "left").join(ids.select(F.col("mention_id").alias("right_mention_id"), F.lit(True).alias("_r")), "right_mention_id", "left")
    out = [
        _repeats(resolutions, "resolution_id", "duplicate_resolution_id"), _coded(ends, F.col("_l").isNull() | F.col("_r").isNull(), "missing_resolution_endpoint", "resolution_id"),
        _coded(resolutions, F.col("auto_merged"), "unexpected_automatic_merge", "resolution_id"),
    ]
    return reduce(DataFrame.unionByName, out)


def expectation_codes(expected: DataFrame, mentions: DataFrame, edges: DataFrame, least_recall: float, need_edges: bool = True) -> DataFrame:
    """Codes of ``expected(document_id, title_score, labels)``: documents whose labels are found too rarely, without relationships, or, as a warning, with a weak title match."""
    own = mentions.select("document_id", "label").distinct().withColumn("_have", F.lit(True))
    want = expected.select("document_id", "title_score", F.explode_outer(F.array_distinct("labels")).alias("label")).join(own, ["document_id", "label"], "left")
    found = want.groupBy("document_id").agg(F.max("title_score").alias("title_score"), (F.count("_have") / F.greatest(F.count("label"), F.lit(1))).alias("_recall"))
    found = found.join(edges.groupBy("document_id").agg(F.count(F.lit(1)).alias("_edges")), "document_id", "left")
    out = [_coded(found, F.col("_recall") < least_recall, "node_coverage_below_threshold", "document_id"), _coded(found, F.coalesce("title_score", F.lit(0.0)) < 0.35, "weak_expectation_title_match", "document_id")]
    if need_edges:
        out.append(_coded(found, F.coalesce("_edges", F.lit(0)) == 0, "no_relationships_extracted", "document_id"))
    return reduce(DataFrame.unionByName, out)


def artifact_codes(found: DataFrame, required: list[str]) -> DataFrame:
    """A code for each required artifact that ``found(name)`` lacks."""
    want = found.sparkSession.createDataFrame([(n,) for n in sorted(set(required))], "name string")
    return _coded(want.join(found.select("name").distinct(), "name", "left_anti"), F.lit(True), "missing_artifact", "name")


def run_status(codes: DataFrame) -> DataFrame:
    """``(status, errors, warnings)`` of a run from its codes; a run without errors passes."""
    warning = F.col("code") == RUN_CODES[-1]
    counts = codes.agg(F.coalesce(F.sum(F.when(~warning, F.col("n"))), F.lit(0)).alias("errors"), F.coalesce(F.sum(F.when(warning, F.col("n"))), F.lit(0)).alias("warnings"))
    return counts.select(F.when(F.col("errors") == 0, "pass").otherwise("fail").alias("status"), "errors", "warnings")

"""References such as "this model" or "it": found, joined with what they may refer to, and resolved where one choice is certain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions import catalog
from lodestrata.functions.ids import normalized, stable_id
from lodestrata.operators.decisions import no
from lodestrata.operators.spans import GENERIC_TERMS, pattern_spans


def rule_spans(sentences: DataFrame, keys: list[str], text: str = "text", patterns: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Spans of the rule catalog with canonical names; surfaces that are generic, refused, or lack the context they need are left out."""
    rules = [(label, p, "rule") for label, ps in (patterns or catalog.RULE_PATTERNS).items() for p in ps]
    width = max([8, *(w for *_, w in catalog.RULE_CONTEXT)])
    s = pattern_spans(sentences, rules, keys, text, context=width)
    norm, surface = normalized("surface_text"), F.trim("surface_text")
    keep = ~norm.isin(*GENERIC_TERMS)
    for label, refused in catalog.RULE_REFUSED:
        keep = keep & ~((F.col("label") == label) & surface.rlike(refused))
    keep = keep & ~((F.col("label") == "Model") & (norm == "deepseek") & F.col("after_text").rlike("(?i)^[- ]AI\\b"))
    for label, which, context, width in catalog.RULE_CONTEXT:
        near = F.concat(F.right("before_text", F.lit(width)), "surface_text", F.left("after_text", F.lit(width)))
        keep = keep & (~((F.col("label") == label) & surface.rlike(which)) | near.rlike(context))
    names = F.create_map(*[F.lit(x) for label, own in catalog.RULE_NAMES.items() for k, v in own.items() for x in (f"{label}/{k}", v)])
    tight = F.when((F.col("label") == "Model") & surface.contains("/"), F.regexp_replace(surface, "\\s*-\\s*", "-"))
    out = s.where(keep).withColumn("canonical_name", F.coalesce(F.try_element_at(names, F.concat_ws("/", "label", norm)), tight, surface))
    return out.select(*keys, "label", "start_char", "end_char", surface.alias("surface_text"), "canonical_name", stable_id("entity", "label", normalized("canonical_name")).alias("canonical_id"), "method")


def reference_spans(sentences: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``(keys, start_char, end_char, surface_text, determiner, head, is_pronoun, is_plural)`` of each reference.

    "That" after a verb of saying and before a property is no reference ("results suggest that model capability").
    """
    s = pattern_spans(sentences, [("reference", catalog.REFERENCE_PATTERN, "reference")], keys, text, context=28)
    low = F.lower("surface_text")
    pronoun = low.isin("it", "they", "them")
    determiner = F.when(pronoun, "").otherwise(F.regexp_extract(low, "^(\\w+)", 1))
    noun = F.when(pronoun, low).otherwise(F.regexp_extract(low, "(\\w+)$", 1))
    head = F.when(noun == "approaches", "approach").when(noun == "processes", "process").when(noun == "technologies", "technology").when(noun.endswith("s") & (noun != "process"), F.regexp_replace(noun, "s$", "")).otherwise(noun)
    clause = (determiner == "that") & F.col("before_text").rlike("(?i)\\b(suggest|show|indicate|reveal|confirm)(s|ed)?\\s*$") & F.col("after_text").rlike("(?i)^\\s+(capabilit|performance|behaviou?r|selection|choice|output)")
    out = s.where(~clause).withColumn("determiner", determiner).withColumn("head", head).withColumn("is_pronoun", pronoun)
    return out.withColumn("is_plural", F.col("head").isin("they", "them") | (~F.col("is_pronoun") & noun.endswith("s") & (noun != "process"))).select(*keys, "start_char", "end_char", "surface_text", "determiner", "head", "is_pronoun", "is_plural")


def antecedents(references: DataFrame, mentions: DataFrame, most: int = 2) -> DataFrame:
    """Each reference with the mentions it may refer to: in its section, at most ``most`` sentences before, earlier in its own sentence, with a label that its head allows.

    ``references(reference_id, document_id, section, pos, start_char, head, ...)``; ``mentions(mention_id, document_id,
    section, pos, start_char, end_char, label, canonical_name, canonical_id)``. The distance is an equality: a mention is
    sent to the sentences it can serve. Several mentions of one identity are one choice, the nearest.
    """
    m = mentions.where(~F.col("label").isin(*catalog.REFERENCE_EXCLUDED)).select("document_id", "section", F.col("pos").alias("_from"), F.col("start_char").alias("m_start"), F.col("end_char").alias("m_end"), "mention_id", "label", "canonical_name", "canonical_id", F.explode(F.sequence(F.col("pos"), F.col("pos") + most)).alias("pos"))
    met = references.join(m, ["document_id", "section", "pos"]).withColumn("distance", (F.col("pos") - F.col("_from")).cast("int"))
    met = met.where((F.col("distance") > 0) | (F.col("m_end") <= F.col("start_char")))
    allowed = F.create_map(*[x for k, v in catalog.REFERENCE_LABELS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    labels = F.try_element_at(allowed, "head")
    met = met.where(labels.isNull() | F.array_contains(labels, F.col("label")))
    sure = F.create_map(*[F.lit(x) for kv in catalog.ANTECEDENT_CONFIDENCE.items() for x in kv])
    met = met.withColumn("confidence", F.coalesce(F.try_element_at(sure, "distance"), F.lit(0.7))).withColumn("identity", F.concat_ws("/", "label", F.coalesce(F.when(F.col("canonical_id") != "", F.col("canonical_id")), normalized("canonical_name"))))
    w = Window.partitionBy("reference_id", "identity").orderBy("distance", F.desc("confidence"), "m_start", "mention_id")
    return met.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_from")


def resolve(references: DataFrame, candidates: DataFrame, sentence_text: Column | None = None, introduced: Column | None = None, automatic: int = 1, most: int = 2, most_candidates: int = 5) -> DataFrame:
    """References with ``outcome`` (resolved, review, ignored), ``target`` and ``candidates``.

    ``sentence_text`` is a column of the references, ``introduced`` a condition on candidates: that their sentence
    introduces them. Resolved are: a strong singular noun phrase with one nearest choice at most ``automatic``
    sentences before (``most`` if the sentence speaks of an architecture and one AI system is in reach), a definite
    one right after an introduction, and "it" with one choice in its own sentence; never over a gap of more than 250
    (200) characters.
    """
    c = candidates
    if sentence_text is not None:
        talk = F.col("head").isin("system", "platform") & sentence_text.rlike("(?i)\\b(agents?|agentic|orchestrator|architecture|LLM|function-call|workflow|limited|limitation|predefined|offline)\\b")
        c = c.join(references.select("reference_id", no(talk).alias("_talk")), "reference_id")
        ai = c.where(F.col("_talk") & (F.col("label") == "AISystem")).groupBy("reference_id").agg(F.count_distinct("identity").alias("_ai"))
        c = c.join(ai, "reference_id", "left").withColumn("_over", no(F.col("_ai") == 1)).where(~F.col("_over") | (F.col("label") == "AISystem"))
    else:
        c = c.withColumn("_over", F.lit(False))
    c = c.withColumn("_intro", no(introduced) if introduced is not None else F.lit(False))
    first = F.min(F.struct("distance", (-F.col("confidence")).alias("_c"), F.lower("canonical_name").alias("_k"), "mention_id", "m_end", "_intro"))
    a = c.groupBy("reference_id").agg(first.alias("_f"), F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("distance") == 0).alias("_n0"), F.count_if(F.col("distance") == 1).alias("_n1"), F.count_if(F.col("distance") > 1).alias("_n2"), F.max("_over").alias("_over"))
    r = references.join(a, "reference_id", "left")
    near, gap = F.col("_f.distance"), F.col("start_char") - F.col("_f.m_end")
    one = F.when(near == 0, F.col("_n0")).when(near == 1, F.col("_n1")).otherwise(F.col("_n2")) == 1
    strong = F.col("determiner").isin(*catalog.STRONG_DETERMINERS) | ((F.col("determiner") == "the") & F.col("head").isin("framework", "system", "platform") & (near == 1) & F.col("_f._intro"))
    noun = ~F.col("is_plural") & ~F.col("is_pronoun") & strong & one & (near <= F.when(F.col("_over"), most).otherwise(automatic)) & ((near > 0) | (gap <= 250))
    it = (F.col("head") == "it") & (F.col("candidates") == 1) & (near == 0) & (gap <= 200)
    auto = no(noun | it)
    outcome = F.when(auto, "resolved").when(no((F.col("candidates") <= most_candidates) & (near <= most)), "review").otherwise("ignored")
    return r.withColumn("outcome", outcome).withColumn("target", F.when(auto, F.col("_f.mention_id"))).withColumn("candidates", F.coalesce("candidates", F.lit(0))).drop("_f", "_n0", "_n1", "_n2", "_over")

"""Channels that discover names a lexicon does not have, and what precedes them: front matter, narrative text, sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.ids import compact_label, name_tokens, normalized, stable_id
from lodestrata.operators.components import connected_components
from lodestrata.operators.spans import pattern_spans

#: A construction that introduces a described system (a fixed value); the named group is the description.
DESCRIBED_SYSTEM = r"\b(?:(?:here|(?:in\s+)?this\s+(?:study|paper|work))\s*,?\s*)?(?:we\s+)?(?:introduc(?:e|es|ed|ing)|propos(?:e|es|ed|ing)|present(?:s|ed|ing)?|develop(?:s|ed|ing)?)\s+an?\s+(?P<name>(?-i:[a-z])[^.;]{2,115}?\b(?:system|framework|platform|assistant|agent|pipeline))(?=\s*(?:[.,;]|that|which|where|designed|capable|for\s|to\s|$))"
#: Words that describe no system by themselves (fixed values; callers may give their own).
DESCRIPTOR_STOPWORDS = ("a", "an", "the", "of", "for", "and", "to", "in", "with", "based", "new", "novel", "system", "framework", "platform", "assistant", "agent", "pipeline", "multi", "driven")
#: Headings with one spelling (fixed values).
HEADING_LABELS = {"abstract": "Abstract", "references": "References", "reference": "References", "highlights": "Highlights", "graphicalabstract": "Graphical abstract"}
#: Headings that end the text proper (fixed values).
BACK_MATTER = ("references", "reference", "creditauthorshipcontributionstatement", "declarationofcompetinginterest", "conflictofinterest", "dataavailability", "acknowledgments", "acknowledgements", "supplementarymaterials")
_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def narrative(text: Column) -> Column:
    """Whether a text is prose: not a short line of few words, not glyph codes with few words."""
    words = F.regexp_count(text, F.lit("[A-Za-z]{2,}"))
    return F.coalesce(~(text.contains("cid:") & (words < 8)) & ~((F.length(text) < 60) & (words < 4)), F.lit(False))


def canonical_heading(text: Column) -> Column:
    """A heading without leading marks and split capitals, common ones in one spelling."""
    seen = F.trim(F.regexp_replace(F.regexp_replace(text, "^[^A-Za-z0-9]+\\s*", ""), "\\b([A-Z])\\s+(?=[A-Z]{2,}\\b)", "$1"))
    bare = F.lower(F.regexp_replace(F.regexp_replace(seen, "^((\\d+(\\.\\d+)*|[IVX]+|[A-Z])\\.?)\\s+", ""), "\\s+", ""))
    out = seen
    for k, v in HEADING_LABELS.items():
        out = F.when(bare == k, v).otherwise(out)
    return out


def is_back_matter(text: Column) -> Column:
    """Whether a heading begins what follows the text proper."""
    return compact_label(F.regexp_replace(text, "^\\d+(\\.\\d+)*\\.?\\s*", "")).isin(*BACK_MATTER)


def restrict_sections(sections: DataFrame, titles: list[str], title: str = "section_title") -> DataFrame:
    """Only the sections with one of the titles, in any case."""
    return sections.where(F.lower(F.trim(title)).isin(*[t.strip().lower() for t in titles]))


def front_matter(lines: DataFrame, key: str = "document_id") -> DataFrame:
    """``(key, title, authors_text, body_seq)`` from a document's first lines.

    The title is the run of largest lines before the abstract or introduction, the authors' text what stands between
    the title and that, and the body begins there. A document without such a heading has its body after the title.
    """
    head = lines.where(F.lower(F.regexp_replace("text", "[^A-Za-z]", "")).rlike("^(abstract|introduction|iintroduction)"))
    cut = head.groupBy(key).agg(F.min("seq").alias("_cut"))
    first = lines.where("page = 1").join(cut, key, "left").where(F.col("_cut").isNull() | (F.col("seq") < F.col("_cut")))
    big = first.groupBy(key).agg(F.max("size").alias("_big"))
    t = first.join(big, key).withColumn("_title", F.col("size") >= F.col("_big") - 0.5)
    title = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_title"), F.struct("seq", "text")))), lambda x: x["text"]), " ")
    out = t.groupBy(key).agg(title.alias("title"), F.max(F.when(F.col("_title"), F.col("seq"))).alias("_end"), F.max("_cut").alias("_cut"), F.array_sort(F.collect_list(F.when(~F.col("_title"), F.struct("seq", "text")))).alias("_rest"))
    authors = F.array_join(F.transform(F.filter("_rest", lambda x: x["seq"] > F.col("_end")), lambda x: x["text"]), " ")
    return out.select(key, F.trim("title").alias("title"), F.when(F.col("_cut").isNotNull(), F.trim(authors)).otherwise("").alias("authors_text"), F.coalesce("_cut", F.col("_end") + 1).alias("body_seq"))


def described_systems(sentences: DataFrame, document: str, sentence: str, text: str = "text", stopwords: tuple[str, ...] = DESCRIPTOR_STOPWORDS) -> DataFrame:
    """Spans of introduced descriptions, with one canonical name for those of a document that share a descriptive word.

    Descriptions are few per document; they meet by (document, word), and groups are connected components. The name is
    that with most descriptive words, then the longest.
    """
    keys = [document, sentence]
    found = pattern_spans(sentences, [("AISystem", DESCRIBED_SYSTEM, "described_system")], keys, text).where(F.size(F.split("surface_text", "\\s+")) <= 14)
    found = found.withColumn("tokens", F.filter(F.array_except(name_tokens("surface_text"), F.array(*[F.lit(w) for w in stopwords])), lambda t: F.length(t) > 1))
    found = found.withColumn("node", stable_id("description", document, normalized("surface_text")))
    words = found.select(document, "node", F.explode("tokens").alias("t")).distinct()
    least = words.groupBy(document, "t").agg(F.min("node").alias("first"))
    groups = connected_components(words.join(least, [document, "t"]).select("node", "first"), "node", "first")
    named = found.join(groups.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    name = F.max_by("surface_text", F.struct(F.size("tokens"), F.length("surface_text"), F.col("surface_text")))
    best = named.groupBy("component").agg(name.alias("canonical_name"))
    return named.join(best, "component").select(*keys, "label", "start_char", "end_char", "surface_text", "canonical_name", "method", stable_id("entity", document, F.lit("AISystem"), normalized("canonical_name")).alias("canonical_id"))


def valid_model_name(name: Column, exclusions: list[str], uppercase: bool | Column = False) -> Column:
    """Whether an identifier can name a model: no excluded word, no agent or platform, no chemistry pair, no month, and no bare capitals unless allowed."""
    allowed = uppercase if isinstance(uppercase, Column) else F.lit(uppercase)
    bare = name.rlike("^[^a-z]*[A-Z][^a-z]*$") & ~name.rlike("\\d") & ~allowed
    return ~(normalized(name).isin(*exclusions) | name.rlike("(?i)(agent|framework|platform)$") | name.rlike("^[A-Z][a-z]?[/-][A-Z][a-z]?$") | bare | name.rlike(f"(?i)^({_MONTHS})-\\d{{4}}$"))


def counted_datasets(spans: DataFrame, document: str, name: str = "surface_text") -> DataFrame:
    """Dataset spans with one canonical name per document, count and kind: "120 papers" and "corpus of 120 studies" are one corpus."""
    count = F.regexp_extract(name, "(?i)^(?:corpus\\s+of\\s+)?(\\d+)\\s+.*?(papers|studies|data\\s+points)$", 1)
    kind = F.lower(F.regexp_extract(name, "(?i)^(?:corpus\\s+of\\s+)?(\\d+)\\s+.*?(papers|studies|data\\s+points)$", 2))
    s = spans.withColumn("_c", count).withColumn("_k", F.when(kind.isin("papers", "studies"), "paper corpus").otherwise("data points"))
    longest = s.where("_c <> ''").groupBy(document, "_c", "_k").agg(F.max_by(name, F.struct(F.length(name), name)).alias("_n"))
    out = s.join(longest, [document, "_c", "_k"], "left")
    canonical = F.when(F.col("_c") == "", F.col(name)).when(F.col("_k") == "paper corpus", F.concat("_c", F.lit("-paper corpus"))).otherwise(F.col("_n"))
    return out.withColumn("canonical_name", canonical).drop("_c", "_k", "_n")


def with_canonical_names(spans: DataFrame, names: DataFrame, surface: str = "surface_text") -> DataFrame:
    """Spans with the canonical name of ``names(label, pattern_text, canonical_name)`` for their normalised surface, else the surface itself."""
    n = names.select("label", normalized("pattern_text").alias("_s"), F.col("canonical_name").alias("_n")).dropDuplicates(["label", "_s"])
    out = spans.withColumn("_s", normalized(surface)).join(n, ["label", "_s"], "left")
    return out.withColumn("canonical_name", F.coalesce("_n", F.col(surface))).drop("_s", "_n")


def result_report(candidates: DataFrame, judgments: DataFrame, key: str, decision: str = "decision") -> DataFrame:
    """Candidates with their judgment, ``unjudged`` where there is none; of several the first by decision."""
    one = judgments.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(decision).alias(decision))
    return candidates.join(one, key, "left").withColumn(decision, F.coalesce(decision, F.lit("unjudged")))

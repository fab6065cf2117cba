"""The knowledge pipeline over whole corpora: every stage is a DataFrame, and nothing runs until one is asked for.

A judge is a table of recorded judgments (or None: everything stays for review), as model calls belong outside the
plan; ``uncached`` gives the requests that such a table does not answer yet.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.functions.ids import parser_id, stable_id
from lodestrata.operators import components, decisions, entities, relations, spans, structure, windows


class KnowledgePipeline:
    """Documents to sections, sentences, mentions, entities and relationships.

    ``documents(document_id, text)``; ``lexicon(canonical_id, label, canonical_name, aliases, status)``;
    ``judgments(candidate_id, decision, ontology_label, judged_name)``; ``proposals`` of relationships and
    ``pair_decisions(left_id, right_id, decision)`` are optional.
    """

    def __init__(self, documents: DataFrame, lexicon: DataFrame, judgments: DataFrame | None = None, pair_decisions: DataFrame | None = None, patterns: list[tuple[str, str, str]] | None = None):
        self.documents, self.lexicon, self.judgments, self.pair_decisions = documents, lexicon, judgments, pair_decisions
        self.patterns = patterns or []

    @property
    def spark(self) -> SparkSession:
        return self.documents.sparkSession

    @cached_property
    def sections(self) -> DataFrame:
        return structure.assign_sections(structure.paragraphs_of_text(self.documents, "document_id"), "document_id")

    @cached_property
    def sentences(self) -> DataFrame:
        body = self.sections.where("not is_heading").select("document_id", "section", "section_title", F.col("ordinal").alias("paragraph"), "text")
        s = structure.sentences_of(body, ["document_id", "section", "section_title", "paragraph"])
        s = s.withColumn("sentence_id", parser_id("sent", "document_id", "paragraph", "ordinal", "text"))
        return windows.context_windows(s.withColumn("pos", F.struct("paragraph", "ordinal")), ["document_id", "section"], "pos")

    @cached_property
    def candidates(self) -> DataFrame:
        keys = ["document_id", "sentence_id"]
        known = spans.lexicon_spans(self.sentences, self.lexicon, keys)
        found = known
        if self.patterns:
            rule = spans.pattern_spans(self.sentences, self.patterns, keys).withColumn("canonical_id", F.lit("")).withColumn("canonical_name", F.col("surface_text"))
            found = known.unionByName(rule)
        trust = F.when(F.col("method") == "persistent_lexicon", 6).when(F.col("method").startswith("persistent"), 5).otherwise(4)
        one = spans.select_spans(found, "sentence_id", trust, "start_char")
        text = self.sentences.select("sentence_id", F.col("text").alias("evidence_quote"), "context", "section_title").dropDuplicates(["sentence_id"])
        one = one.withColumn("candidate_id", stable_id("candidate", "sentence_id", "start_char", "end_char", "label"))
        return one.join(text, "sentence_id").withColumn("alternatives", F.array("label"))

    @cached_property
    def adjudicated(self) -> DataFrame:
        sure = self.candidates.where("method = 'persistent_lexicon'").withColumn("outcome", F.lit("accept")).withColumn("reason_code", F.lit("lexicon")).withColumn("final_label", F.col("label"))
        rest = self.candidates.where("method <> 'persistent_lexicon'")
        judged = decisions.adjudicate(rest, self.judgments) if self.judgments is not None else decisions.without_model(rest).withColumn("final_label", F.col("label"))
        return sure.unionByName(judged)

    @cached_property
    def mentions(self) -> DataFrame:
        m = self.adjudicated.where("outcome = 'accept'").withColumn("mention_id", stable_id("mention", "candidate_id")).withColumn("label", F.col("final_label"))
        return m.withColumn("from_lexicon", F.col("method") == "persistent_lexicon").withColumn("is_reference", F.lit(False)).withColumn("seq", F.concat_ws("/", "document_id", "sentence_id", F.lpad(F.col("start_char").cast("string"), 9, "0")))

    @cached_property
    def entities(self) -> DataFrame:
        return entities.canonical_entities(self.mentions)

    @cached_property
    def similar(self) -> DataFrame:
        return entities.similar_pairs(self.entities, aliases=self.entity_aliases)

    @cached_property
    def entity_aliases(self) -> DataFrame:
        return entities.entity_aliases(self.mentions, self.entities)

    @cached_property
    def entity_mentions(self) -> DataFrame:
        return entities.entity_mentions(self.mentions, self.entities)

    @cached_property
    def groups(self) -> DataFrame:
        """``(node, component)`` of the entities that pair decisions merge."""
        if self.pair_decisions is None:
            return self.spark.createDataFrame([], "node string, component string")
        return components.connected_components(self.pair_decisions.where("lower(trim(decision)) = 'same'"), "left_id", "right_id")

    @cached_property
    def merged(self) -> DataFrame:
        return entities.merge_entities(self.entities.drop("evidence", "sentences", "key"), self.groups, aliases=self.entity_aliases)

    @cached_property
    def merged_aliases(self) -> DataFrame:
        return entities.merged_aliases(self.entities, self.groups, aliases=self.entity_aliases)

    @cached_property
    def merged_mentions(self) -> DataFrame:
        return entities.merged_mentions(self.entity_mentions, self.groups)

    def _ends(self, assertions: DataFrame) -> DataFrame:
        return relations.endpoints(assertions, self.entity_mentions)

    def relationships(self, assertions: DataFrame) -> DataFrame:
        """Supported relationships between entities from ``assertions(assertion_id, subject_mention_id, predicate, object_mention_id, evidence, confidence)``."""
        return relations.materialize(self._ends(assertions), ["subject_entity_id", "predicate", "object_entity_id"], "evidence", "confidence", "assertion_id")

    def supporting(self, assertions: DataFrame) -> DataFrame:
        """The assertion of every unit of evidence of ``relationships``."""
        return relations.supporting(self._ends(assertions), ["subject_entity_id", "predicate", "object_entity_id"], "evidence", "confidence", "assertion_id")

    def uncached(self, requests: DataFrame, key: str = "candidate_id") -> DataFrame:
        """Requests that no recorded judgment answers."""
        return requests if self.judgments is None else requests.join(self.judgments.select(key).distinct(), key, "left_anti")

    def register(self, prefix: str = "") -> None:
        """All stages as views, for SQL; with pair decisions, their components are made first."""
        for name in ("sections", "sentences", "candidates", "adjudicated", "mentions", "entities", "entity_mentions", "entity_aliases", "merged", "merged_aliases", "merged_mentions"):
            getattr(self, name).createOrReplaceTempView(prefix + name)

    def run_report(self) -> DataFrame:
        """``(outcome, reason_code, candidates)`` of the run."""
        return self.adjudicated.groupBy("outcome", "reason_code").agg(F.count(F.lit(1)).alias("candidates"))


def numbered_sections(sections: DataFrame, key: str = "document_id") -> DataFrame:
    """Sections in order with their level and parent."""
    heads = sections.where("is_heading").select(key, "section", "section_title")
    return structure.section_hierarchy(heads, key).withColumn("ordinal", F.row_number().over(Window.partitionBy(key).orderBy("section")) - 1)

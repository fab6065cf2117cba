"""Questions, completeness, diagnostics, validation codes and regression gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Competency questions: id and the predicates that answer it (fixed values).
QUESTIONS = (
    ("system", ("PROPOSES",)), ("agents", ("HAS_AGENT",)), ("models", ("USES_MODEL",)), ("tasks", ("PERFORMS",)), ("tools", ("USES_TOOL",)),
    ("methods", ("USES_METHOD",)), ("benchmarks", ("EVALUATED_ON",)), ("metrics", ("EVALUATED_BY", "MEASURES")), ("results", ("REPORTS",)), ("limitations", ("HAS_LIMITATION",)),
)


def answer_questions(relationships: DataFrame, evidence: DataFrame, questions: DataFrame) -> DataFrame:
    """``(question, status, answers, evidence)``: how many distinct answers and distinct quotes there are for each ``questions(question, predicate)``.

    ``relationships(relationship_id, predicate, answer)``; ``evidence(relationship_id, quote)``. A question is
    answerable with one fact and one quote at least. Distinct values are counted by partial aggregates.
    """
    r = questions.join(relationships, "predicate", "left")
    answers = r.where("answer is not null").groupBy("question").agg(F.count_distinct("answer").alias("answers"))
    quotes = r.join(evidence.where("trim(quote) <> ''"), "relationship_id").groupBy("question").agg(F.count_distinct("quote").alias("evidence"))
    out = questions.select("question").distinct().join(answers, "question", "left").join(quotes, "question", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select("question", F.when((n("answers") > 0) & (n("evidence") > 0), "answerable").otherwise("not_answerable").alias("status"), n("answers").alias("answers"), n("evidence").alias("evidence"))


def completeness(sentences: DataFrame, signals: dict[str, tuple[str, str, int]], entities: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """``(check, expected_signals, detected_entities, applicable, passed)``: a check applies if any sentence meets its pattern and passes if enough entities of its label were found.

    ``signals`` maps a check to (pattern, label, least number). One pass over the sentences counts all signals.
    """
    counts = sentences.agg(*[F.count_if(F.col(text).rlike(p)).alias(k) for k, (p, _, _) in signals.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.lit(lab).alias("_l"), F.lit(n).alias("_n"), F.col(k).alias("expected_signals")) for k, (_, lab, n) in signals.items()])).alias("r")
    have = entities.groupBy(F.col(label).alias("_l")).agg(F.count(F.lit(1)).alias("detected_entities"))
    out = counts.select(rows).select("r.*").join(have, "_l", "left").withColumn("detected_entities", F.coalesce("detected_entities", F.lit(0)))
    applies = F.col("expected_signals") > 0
    return out.select("check", "expected_signals", "detected_entities", applies.alias("applicable"), (~applies | (F.col("detected_entities") >= F.col("_n"))).alias("passed"))


def orphans(nodes: DataFrame, ends: DataFrame, key: str) -> DataFrame:
    """Nodes that no edge touches."""
    return nodes.join(ends.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def usage_rollup(calls: DataFrame, stage: str, measures: dict[str, Column]) -> DataFrame:
    """Measures by stage, and over all stages in a row with ``is_total`` 1."""
    return calls.rollup(stage).agg(F.grouping(stage).cast("int").alias("is_total"), F.count(F.lit(1)).alias("calls"), *[c.alias(k) for k, c in measures.items()])


def status_counts(rows: DataFrame, by: str, status: str, values: list[str]) -> DataFrame:
    """One column of counts per status, 0 where there is none."""
    return rows.groupBy(by).agg(*[F.count_if(F.col(status) == v).alias(v) for v in values])


def histogram(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def violations(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``(code, n)`` of rows that break each check, in one pass; codes with none are left out."""
    counts = rows.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in checks.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("code"), F.col(k).alias("n")) for k in checks])).alias("r")).select("r.code", "r.n").where("n > 0")


def duplicate_ids(rows: DataFrame, key: str, code: str) -> DataFrame:
    """``(code, n)``: how many keys occur more than once."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(F.lit(code).alias("code"), "n")


def document_profile(texts: DataFrame, key: str, patterns: dict[str, str], text: str = "text") -> DataFrame:
    """``(key, archetype, flags)``: the first pattern that a document's text meets, in order, and all of them."""
    flags = {k: F.coalesce(F.col(text).rlike(p), F.lit(False)) for k, p in patterns.items()}
    first = F.coalesce(*[F.when(c, F.lit(k)) for k, c in flags.items()], F.lit("other"))
    return texts.select(F.col(key), first.alias("archetype"), F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in flags.items()])), ",").alias("flags"))


def regression_gate(entities: DataFrame, requirements: DataFrame) -> DataFrame:
    """``(paper, name, kind, passed)`` of ``requirements(paper, name, kind)``: a required name must be an entity of the paper, a forbidden one must not. Names are compared in lower case."""
    have = entities.select("paper", F.lower(F.trim("name")).alias("_n")).distinct().withColumn("_h", F.lit(True))
    r = requirements.withColumn("_n", F.lower(F.trim("name"))).join(have, ["paper", "_n"], "left")
    found = F.coalesce("_h", F.lit(False))
    return r.select("paper", "name", "kind", F.when(F.col("kind") == "required", found).otherwise(~found).alias("passed"))


def traceability(mentions: DataFrame, evidence: Column, start: Column, end: Column, surface: Column) -> DataFrame:
    """One row: mentions, how many have evidence, and for how many the evidence has the surface exactly at its place."""
    exact = F.substr(evidence, start + 1, end - start) == surface
    return mentions.agg(F.count(F.lit(1)).alias("mentions"), F.count_if(F.coalesce(F.trim(evidence) != "", F.lit(False))).alias("with_evidence"), F.count_if(F.coalesce(exact, F.lit(False))).alias("exact"))


def channel_boundary(candidates: DataFrame, channel: str, declared: list[str], trusted: list[str], outcome: str, exact: Column) -> DataFrame:
    """``(channel, candidates, inexact, declared, bypassed)``: per channel, whether it is declared, spans that are not exact, and acceptances by a channel that is not trusted."""
    c = F.col(channel)
    return candidates.groupBy(channel).agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(~F.coalesce(exact, F.lit(False))).alias("inexact"),
        F.count_if((F.col(outcome) == "accepted") & ~c.isin(*trusted)).alias("bypassed"),
    ).withColumn("declared", c.isin(*declared))


def require(condition: bool, message: str) -> None:
    """Stops a run whose required stage failed."""
    if not condition:
        raise RuntimeError(message)

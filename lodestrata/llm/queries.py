"""Queries of the training-data operators, one module per problem in this package."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import components, encodings, entity_splits, leakage, lookalikes, packing, sentences


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return entity_splits.conflicting_records(entity_splits.record_groups(_read(spark, sf, "manifest")))


def p1_splits(spark: SparkSession, sf: str) -> DataFrame:
    return entity_splits.assign_splits(entity_splits.record_groups(_read(spark, sf, "manifest")), _read(spark, sf, "split_policy"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return lookalikes.same_looking(_read(spark, sf, "reference_resolution_ignored"), _read(spark, sf, "lexicon"))


def p2_forms(spark: SparkSession, sf: str) -> DataFrame:
    return lookalikes.consistent_form(_read(spark, sf, "reference_resolution_ignored").select("resolution_id", "surface_text"), _read(spark, sf, "lexicon"), "surface_text")


def p3_restored(spark: SparkSession, sf: str) -> DataFrame:
    t = _read(spark, sf, "reference_resolution_ignored")
    return encodings.restore(t.select("resolution_id", "surface_text", F.col("source.evidence_quote").alias("evidence_quote")), ["surface_text", "evidence_quote"])


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return p3_restored(spark, sf).select("resolution_id", "field").distinct()


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    log = _read(spark, sf, "entity_resolution_decisions")
    links = components.latest_links(log, "left_entity_id", "right_entity_id", "decision", "reviewed_at")
    return components.components(links).where("member <> label").select(F.col("label").alias("group_id"), F.col("member").alias("entity_id"))


#: A public vocabulary, read where it lies; another can be named by the environment.
RANKS = os.environ.get("LODESTRATA_RANKS", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


def p6_contexts(spark: SparkSession, sf: str) -> DataFrame:
    return packing.fill_contexts(_read(spark, sf, "documents"), _read(spark, sf, "judge_budgets"), RANKS)


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaked_items(_read(spark, sf, "documents"), _read(spark, sf, "heldout_items")).select("item_id", "doc_id")


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return sentences.sentences(_read(spark, sf, "documents")).select("doc_id", "start_char", "end_char")


def queries() -> dict:
    return {"p1_found": p1_found, "p1_splits": p1_splits, "p2_found": p2_found, "p2_forms": p2_forms, "p3_found": p3_found, "p3_restored": p3_restored, "p4_found": p4_found, "p6_contexts": p6_contexts, "p7_found": p7_found, "p8_found": p8_found}


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": r"""
            WITH RECURSIVE pairs AS (
              SELECT least(x, y) AS a, greatest(x, y) AS b,
                     arg_max(same, (reviewed_at, same)) AS linked
              FROM (SELECT trim(left_entity_id, E' \t\n\r') AS x, trim(right_entity_id, E' \t\n\r') AS y, reviewed_at,
                           coalesce(lower(trim(decision, E' \t\n\r')) = 'same', false) AS same
                    FROM entity_resolution_decisions)
              WHERE x <> y GROUP BY 1, 2),
            e AS MATERIALIZED (SELECT a AS u, b AS v FROM pairs WHERE linked UNION SELECT b, a FROM pairs WHERE linked),
            r AS (
              SELECT u AS entity_id, u AS reach FROM e
              UNION
              SELECT r.entity_id, e.v FROM r JOIN e ON r.reach = e.u WHERE e.v < r.entity_id OR true)
            SELECT min(reach) AS group_id, entity_id FROM r GROUP BY entity_id HAVING min(reach) <> entity_id""",
    }

"""Queries of the nested-record operator (problem 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.operators.nested import contained, node_table


def _contexts(spark: SparkSession, sf: str) -> DataFrame:
    """The part of the records that the page tables need; only these two leaves are read."""
    t = spark.read.parquet(f"{sf}/reference_resolution_ignored.parquet")
    pairs = F.arrays_zip(F.col("source.context_sentences.sentence_id").alias("sentence_id"), F.col("source.context_sentences.pages").alias("pages"))
    kind = "array<struct<sentence_id:string,pages:array<int>>>"
    return t.select("resolution_id", F.struct(pairs.cast(kind).alias("context_sentences")).alias("source"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = contained(_contexts(spark, sf), "resolution_id", "source", "context_sentences", "context_sentences.pages")
    page = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(-1)).alias(c.removeprefix("child_").replace("pos", "page_pos").replace("value", "page"))
    return rows.select(F.col("record").alias("resolution_id"), F.col("parent_pos").cast("int").alias("context_pos"), F.coalesce("parent_sentence_id", F.lit("")).alias("sentence_id"), page("child_pos"), page("child_value")).distinct()


def _source(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/reference_resolution_ignored.parquet").select("resolution_id", "source")


def p5_references(spark: SparkSession, sf: str) -> DataFrame:
    return node_table(_source(spark, sf), "resolution_id", "source", "")


def p5_context_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return node_table(_source(spark, sf), "resolution_id", "source", "context_sentences")


def p5_pages(spark: SparkSession, sf: str) -> DataFrame:
    return node_table(_source(spark, sf), "resolution_id", "source", "pages")


def queries() -> dict:
    return {"p5_found": p5_found, "p5_references": p5_references, "p5_context_sentences": p5_context_sentences, "p5_pages": p5_pages}


_N = "coalesce(len({0}), 0)"
_CONTEXT_SIZE = "coalesce(list_sum(list_transform(source.context_sentences, lambda c: 1 + coalesce(len(c.pages), 0))), 0)"


def oracle_sql() -> dict[str, str]:
    scalars = "kind, field, sentence_id, paragraph_id, section_id, section_title, start_char, end_char, quote, evidence_quote, context_policy".split(", ")
    return {
        "p5_references": f"""
            SELECT resolution_id AS record, 0::BIGINT AS pre, ({_N.format('source.pages')} + {_N.format('source.context_sentence_ids')} + {_CONTEXT_SIZE})::BIGINT AS post,
                   0::BIGINT AS level, 0::BIGINT AS pos, {', '.join(f'source."{c}" AS "{c}"' for c in scalars)}
            FROM reference_resolution_ignored""",
        "p5_pages": """
            SELECT resolution_id AS record, i AS pre, i - 1 AS post, 1::BIGINT AS level, i - 1 AS pos, value FROM (
              SELECT resolution_id, unnest(source.pages) AS value, generate_subscripts(source.pages, 1)::BIGINT AS i FROM reference_resolution_ignored)""",
        "p5_context_sentences": f"""
            WITH r AS (SELECT *, row_number() OVER () AS rn FROM reference_resolution_ignored),
            c AS (SELECT rn, resolution_id, 1 + {_N.format('source.pages')} + {_N.format('source.context_sentence_ids')} AS first,
                         unnest(source.context_sentences) AS c, generate_subscripts(source.context_sentences, 1)::BIGINT AS i FROM r),
            n AS (SELECT *, coalesce(len(c.pages), 0) AS k FROM c),
            p AS (SELECT *, first + coalesce(sum(1 + k) OVER (PARTITION BY rn ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre FROM n)
            SELECT resolution_id AS record, pre::BIGINT AS pre, (pre + k - 1)::BIGINT AS post, 1::BIGINT AS level, i - 1 AS pos,
                   c.sentence_id AS sentence_id, c.paragraph_id AS paragraph_id, c."role" AS "role", c."text" AS "text" FROM p""",
        "p5_found": """
            WITH s AS (
              SELECT resolution_id, unnest(source.context_sentences) AS c,
                     generate_subscripts(source.context_sentences, 1) - 1 AS context_pos
              FROM reference_resolution_ignored),
            p AS (
              SELECT resolution_id, context_pos, coalesce(c.sentence_id, '') AS sentence_id,
                     CASE WHEN c.pages IS NULL OR len(c.pages) = 0 THEN [NULL]::INT[] ELSE c.pages END AS pages,
                     c.pages IS NULL OR len(c.pages) = 0 AS bare
              FROM s),
            u AS (
              SELECT resolution_id, context_pos, sentence_id, bare, unnest(pages) AS page, generate_subscripts(pages, 1) - 1 AS page_pos FROM p)
            SELECT DISTINCT resolution_id, CAST(context_pos AS INT) AS context_pos, sentence_id,
                   CAST(CASE WHEN bare THEN -1 ELSE page_pos END AS INT) AS page_pos, CAST(coalesce(page, -1) AS INT) AS page
            FROM u""",
    }

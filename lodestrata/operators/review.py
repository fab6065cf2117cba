"""Recorded human decisions and what follows from them: everything downstream is a function of the decision log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.ids import stable_id


def record(log: DataFrame, new: DataFrame, allowed: list[str], keys: list[str], at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``(log, refused)``: the log with the valid new decisions appended, and those that are not allowed or chose a name that is not one of the two.

    ``new`` has the keys, ``decision``, ``chosen_name``, ``left_name`` and ``right_name``. Nothing is overwritten.
    """
    named = F.col("chosen_name").isNull() | (F.col("chosen_name") == F.col("left_name")) | (F.col("chosen_name") == F.col("right_name"))
    ok = F.col("decision").isin(*allowed) & named
    marked = new.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    when = at if at is not None else F.current_timestamp()
    rows = marked.where("_ok").drop("_ok").withColumn("reviewed_at", when).withColumn("decision_id", stable_id("decision", *keys, "decision", "reviewed_at"))
    return log.unionByName(rows, allowMissingColumns=True), marked.where("not _ok").drop("_ok")


def carry_over(pairs: DataFrame, earlier: DataFrame, key: str = "resolution_id", open_status: str = "pending") -> DataFrame:
    """Recomputed pairs with the decisions that were made on the same pairs before."""
    old = earlier.where(F.col("status") != open_status).groupBy(key).agg(F.max("status").alias("_old"))
    return pairs.join(old, key, "left").withColumn("status", F.coalesce("_old", "status")).drop("_old")


def apply_node_reviews(candidates: DataFrame, reviews: DataFrame, key: str = "candidate_id") -> DataFrame:
    """Candidates with the latest human verdict on them, which wins over any gate."""
    latest = reviews.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by("decision", F.struct("reviewed_at", "decision")).alias("_h"))
    out = candidates.join(latest, key, "left")
    return out.withColumn("outcome", F.coalesce(F.when(F.col("_h").isin("accept", "reject"), F.col("_h")), F.col("outcome"))).withColumn("human", F.col("_h").isNotNull()).drop("_h")

"""Joins and numbering that survive a key holding a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.sources.scratch import Scratch

#: A key is hot from this share of the rows on; there can be no more than its inverse of them.
HOT_SHARE = 1 / 256


def hot_keys(df: DataFrame, key: str, rows: int, share: float = HOT_SHARE) -> list:
    """Keys of ``df[key]`` with more than ``share`` of ``rows``: at most ``1/share`` values, so the driver may hold them."""
    if rows < 50_000:
        return []
    counts = df.where(F.col(key).isNotNull()).groupBy(key).count()
    return [r[0] for r in counts.where(F.col("count") > F.lit(rows * share)).select(key).collect()]


def split_join(left: DataFrame, right: DataFrame, key: str, rows: int, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which has one row per ``key``; ``how`` is inner or left.

    Rows of hot keys meet a broadcast of at most ``1/HOT_SHARE`` rows of ``right`` and are never shuffled; all
    others take the ordinary join. Rows with a null key are kept by a left join and never meet in one task.
    """
    hot = hot_keys(left, key, rows)
    if not hot:
        return left.join(right, key, how)
    is_hot = F.col(key).isin(hot)
    cold = left.where(~is_hot | F.col(key).isNull()).join(right.where(~is_hot), key, how)
    warm = left.where(is_hot).join(F.broadcast(right.where(is_hot)), key, how)
    return cold.unionByName(warm)


def positions(df: DataFrame, key: str, order: list[str], name: str = "pos", tasks: int | None = None, wide: bool = False) -> DataFrame:
    """Rows numbered from 0 within each key, in the order given (columns that together are unique within a key).

    Rows are range-sorted by key and order, so a key with very many rows is divided over tasks; each part of a key is
    numbered on its own, and what its earlier parts hold is added. Only the counts of parts are gathered.
    """
    scratch = Scratch(df.sparkSession, "positions")
    n = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = scratch.put(df.repartitionByRange(n, key, *order).withColumn("_part", F.spark_partition_id()))
    counts = parts.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_c"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_c").over(Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = parts.withColumn("_row", F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) - 1)
    out = numbered.join(before.drop("_c").withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key")) & (numbered["_part"] == before["_part"]))
    return out.select(*df.columns, (F.col("_row") + F.col("_before")).cast("long" if wide else "int").alias(name))

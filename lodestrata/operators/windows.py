"""Context windows, nearest antecedents and first-wins or best-wins reductions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.skew import positions


def context_windows(sentences: DataFrame, partition: list[str], order: str, before: int = 1, after: int = 1, fields: tuple[str, ...] = ("sentence_id", "text")) -> DataFrame:
    """Adds ``context``: the sentences around each one in its section, in order, with their role.

    With one sentence before and after, a sentence at the edge of its section has two in its window if the section
    has two; antecedent windows take two before and none after. A section is part of one document, so the window's
    partitions are bounded by documents.
    """
    w = Window.partitionBy(*partition).orderBy(order)
    near = F.collect_list(F.struct(F.col(order).alias("at"), *[F.col(c) for c in fields])).over(w.rowsBetween(-before, after))
    role = lambda x: F.when(x["at"] < F.col(order), "previous").when(x["at"] > F.col(order), "next").otherwise("target")
    out = sentences.withColumn("_near", near)
    return out.withColumn("context", F.transform("_near", lambda x: F.struct(x["at"].alias("at"), role(x).alias("role"), *[x[c].alias(c) for c in fields]))).drop("_near")


def context_arrays(documents: DataFrame, sentences: str, before: int = 1, after: int = 1) -> DataFrame:
    """One row per sentence of the array column ``sentences``: ``pos``, the element as ``sentence``, and ``context``, the elements around it with ``at`` and their role.

    As ``context_windows`` where all sentences of a document are in one row: nothing is shuffled or sorted.
    """
    a = F.col(sentences)

    def near(x: Column, i: Column) -> Column:
        first = F.greatest(i - before, F.lit(0))
        own = F.slice(a, first + 1, F.least(i + after, F.size(a) - 1) - first + 1)
        role = lambda at: F.when(at < i, "previous").when(at > i, "next").otherwise("target")
        return F.struct(i.alias("pos"), x.alias("sentence"), F.transform(own, lambda s, k: F.struct((first + k).alias("at"), role(first + k).alias("role"), s.alias("sentence"))).alias("context"))

    rest = [c for c in documents.columns if c != sentences]
    return documents.where(F.size(a) > 0).select(*rest, F.explode(F.transform(a, near)).alias("_s")).select(*rest, "_s.*")


def nearest_before(targets: DataFrame, candidates: DataFrame, partition: str, position: str, most: int = 2, target_key: str = "target_id", candidate_key: str = "candidate_id", keep: int | None = None) -> DataFrame:
    """Each target with the candidates at most ``most`` positions before it in its partition.

    The distance is made an equality: a candidate is sent to the positions it can serve, so the join is on
    (partition, position) and a partition with very many rows is divided by its positions. Adds ``distance``,
    ``rank`` by (distance, candidate key) and ``nearest_unique``: whether just one candidate has the least distance.
    """
    t = targets.select(F.col(partition).alias("_p"), F.col(position).alias("_at"), F.col(target_key))
    c = candidates.select(F.col(partition).alias("_p"), F.explode(F.sequence(F.col(position), F.col(position) + most)).alias("_at"), F.col(position).alias("_from"), F.col(candidate_key))
    met = t.join(c, ["_p", "_at"]).where(F.col(target_key) != F.col(candidate_key)).withColumn("distance", (F.col("_at") - F.col("_from")).cast("int"))
    w = Window.partitionBy(target_key)
    met = met.withColumn("rank", F.row_number().over(w.orderBy("distance", candidate_key)).cast("int"))
    met = met.withColumn("_least", F.min("distance").over(w)).withColumn("candidates", F.count(F.lit(1)).over(w))
    met = met.withColumn("nearest_unique", F.count_if(F.col("distance") == F.col("_least")).over(w) == 1)
    out = met.drop("_least", "_at", "_from").withColumnRenamed("_p", partition)
    return out.where(F.col("rank") <= keep) if keep is not None else out


def best_per_key(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row of each key with the largest ``order`` (a struct with a unique last field), by a partial aggregate: a key with very many rows is reduced before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def top_k(rows: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """The first ``k`` rows of each key, ranked from 1; Spark limits each group before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("int")).where(F.col("rank") <= k)


def batches(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """Adds ``batch``, from 0: rows in groups of ``size`` in the order given (columns that together are unique); only the last is smaller.

    Rows are range-sorted, numbered within each range, and what the earlier ranges hold is added; only the counts of
    ranges are gathered.
    """
    return positions(rows.withColumn("_all", F.lit(0)), "_all", order, "_pos", wide=True).withColumn("batch", F.floor(F.col("_pos") / size)).drop("_all", "_pos")

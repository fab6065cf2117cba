"""Vectors: typing against classes, exact nearest neighbours of stated queries, bands and calibration."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.sources.scratch import Scratch, read_block


def class_centroids(vectors: DataFrame, label: str, vector: str, dimensions: int) -> DataFrame:
    """``(label, centroid)``: the mean vector of each class; one partial aggregate per dimension, so a class with most rows is reduced before the shuffle."""
    means = [F.avg(F.col(vector)[i].cast("double")).alias(f"_{i}") for i in range(dimensions)]
    return vectors.where(F.col(label).isNotNull()).groupBy(label).agg(*means).select(label, F.array(*[f"_{i}" for i in range(dimensions)]).alias("centroid"))


def type_by_vectors(rows: DataFrame, classes: DataFrame, key: str, vector: str, label: str = "label", class_vector: str = "centroid", threshold: float = 0.25, margin: float = 0.015, most_classes: int = 10_000) -> DataFrame:
    """``(key, selected_label, selected_score, score_margin, applicable)`` from the cosines to all classes.

    Classes are an ontology: after a check that there are no more than ``most_classes`` their vectors go to the
    executors as one matrix, and every batch of rows is typed by one product, without a join or a shuffle. The best
    label applies if its score reaches the threshold and leads by the margin; equal scores fall to the first label,
    with a single class the margin is its score. A null vector, or one of no length, scores 0 everywhere.
    """
    own = classes.where(F.col(class_vector).isNotNull()).select(F.col(label).cast("string").alias("l"), F.col(class_vector).cast("array<double>").alias("v"))
    if own.count() > most_classes:
        raise ValueError(f"more than {most_classes} classes; use neighbours()")
    found = own.orderBy("l").toPandas()
    sent = rows.sparkSession.sparkContext.broadcast((found["l"].tolist(), _unit(found["v"])))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, m = sent.value
        for b in batches:
            vectors = [v if v is not None else [0.0] * m.shape[1] for v in b.column(1).to_pylist()]
            s = np.round(_unit(pd.Series(vectors, dtype=object)) @ m.T, 12) if vectors and labels else np.zeros((len(vectors), 0))
            best = s.argmax(axis=1) if s.shape[1] else np.zeros(len(vectors), dtype=int)
            at = np.arange(len(vectors))
            first = s[at, best] if s.shape[1] else np.zeros(len(vectors))
            second = np.partition(s, -2, axis=1)[:, -2] if s.shape[1] > 1 else np.zeros(len(vectors))
            gap = first - second
            names = pa.array([labels[i] for i in best] if labels else [None] * len(vectors), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), names, pa.array(first, pa.float64()), pa.array(gap, pa.float64()), pa.array((first >= threshold) & (gap >= margin))], [key, "selected_label", "selected_score", "score_margin", "applicable"])

    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, selected_label string, selected_score double, score_margin double, applicable boolean"
    return rows.select(F.col(key), F.col(vector).cast("array<double>")).mapInArrow(emit, schema)


def neighbours(queries: DataFrame, rows: DataFrame, key: str, vector: str, k: int = 12, block: str | None = None, block_rows: int = 20_000, earlier: bool = False) -> DataFrame:
    """``(query, neighbour, score, rank)``: the ``k`` rows of largest cosine for each query, exactly, not counting itself; keys keep their type.

    ``block`` names a column that must agree; with ``earlier`` only rows of a smaller key count. Queries are written to
    the shared folder in blocks of ``block_rows``. A task holds as many of its rows at once and reads the blocks one
    after another; it keeps ``k`` rows per query by matrix products, and only these are shuffled. Rows are read once,
    and nothing passes through the driver. Vectors that are null or of no length are left out.
    """
    spark = rows.sparkSession
    cols = [F.col(key).alias("key"), F.col(vector).cast("array<float>").alias("v"), (F.col(block).cast("string") if block else F.lit("")).alias("b")]
    q, r = (t.select(*cols).where("key is not null and v is not null and b is not null") for t in (queries, rows))
    files = Scratch(spark, "queries").put_blocks(q, block_rows)

    def best(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        v, ids = _unit(part["v"]), part["key"].to_numpy()
        groups = part.groupby("b", sort=False).indices
        for file in files:
            own = read_block(file).to_pandas()
            keys, blocks, m = own["key"].to_numpy(), own["b"].to_numpy(), _unit(own["v"])
            for name, group in groups.items():
                at = np.flatnonzero(blocks == name)
                for lo in range(0, len(at), 1_000):
                    rows_of = at[lo : lo + 1_000]
                    s = m[rows_of] @ v[group].T
                    s[(keys[rows_of][:, None] <= ids[group][None, :]) if earlier else (keys[rows_of][:, None] == ids[group][None, :])] = -2
                    n = min(k, s.shape[1])
                    near = np.argpartition(-s, n - 1, axis=1)[:, :n]
                    score = np.take_along_axis(s, near, 1)
                    out = pd.DataFrame({"query": np.repeat(keys[rows_of], n), "neighbour": ids[group][near].ravel(), "score": score.ravel().astype("float64")})
                    yield out[out["score"] > -1.5]

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += len(b)
            if n >= block_rows:
                yield from best(pd.concat(held, ignore_index=True))
                held, n = [], 0
        if n:
            yield from best(pd.concat(held, ignore_index=True))

    out = r.mapInPandas(emit, f"query {q.schema['key'].dataType.simpleString()}, neighbour {r.schema['key'].dataType.simpleString()}, score double")
    w = Window.partitionBy("query").orderBy(F.desc(F.round("score", 5)), "neighbour")
    return out.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)


def _unit(vectors) -> np.ndarray:
    m = np.array(vectors.tolist(), dtype=np.float64) if len(vectors) else np.zeros((0, 1))
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n > 0, n, 1)


def band(score: Column, scoped: Column | None = None, high: float = 0.82, middle: float = 0.63) -> Column:
    """``high``, ``middle`` or ``low``; pairs of things that occur once each are always ``low``."""
    out = F.when(score >= high, "high").when(score >= middle, "middle").otherwise("low")
    return F.when(scoped, "low").otherwise(out) if scoped is not None else out


def review_queue(pairs: DataFrame, band_col: str, label: str, left: str, right: str, score: str) -> DataFrame:
    """Pairs collapsed by band, label and unordered names: how many, and their best, least and mean score."""
    a, b = F.lower(F.col(left)), F.lower(F.col(right))
    return pairs.groupBy(band_col, label, F.least(a, b).alias("name_a"), F.greatest(a, b).alias("name_b")).agg(F.count(F.lit(1)).alias("pairs"), F.max(score).alias("best_score"), F.min(score).alias("least_score"))


def threshold_sweep(scored: DataFrame, score: str, truth: str, thresholds: list[float]) -> DataFrame:
    """``(threshold, tp, fp, tn, fn, precision, recall, f1, balanced_accuracy)`` for each threshold, in one pass over the pairs.

    Pairs are first counted by the number of thresholds they reach, so nothing is multiplied by the sweep. No pairs give
    no rows.
    """
    reached = sum((F.col(score) >= t).cast("int") for t in thresholds)
    counts = scored.where(F.col(score).isNotNull() & F.col(truth).isNotNull()).groupBy(reached.alias("reached"), F.col(truth).alias("same")).agg(F.count(F.lit(1)).alias("n"))
    steps = F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.lit(i + 1).alias("step")) for i, t in enumerate(sorted(thresholds))]))
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    up = F.col("reached") >= F.col("step")
    out = counts.select("*", steps.alias("_s")).select("*", "_s.*").groupBy("threshold").agg(n(up & F.col("same")).alias("tp"), n(up & ~F.col("same")).alias("fp"), n(~up & ~F.col("same")).alias("tn"), n(~up & F.col("same")).alias("fn"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    out = out.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    out = out.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    return out.withColumn("balanced_accuracy", (F.col("recall") + ratio(F.col("tn"), F.col("tn") + F.col("fp"))) / 2)


#: Lengths of the character n-grams of names and what one counts against a word (fixed values).
GRAMS, GRAM_WEIGHT = (3, 4, 5), 0.35


def _grams(text: Column, n: int) -> Column:
    places = F.sequence(F.lit(1), F.length(text) - (n - 1))
    return F.when(F.length(text) >= n, F.transform(places, lambda i: F.concat(F.lit("c:"), F.substr(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def name_features(text: Column) -> Column:
    """The words of a text (``w:``) and the character n-grams of the words joined by blanks (``c:``), repeated as often as they stand in it."""
    words = F.regexp_extract_all(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), F.lit("[a-z0-9]+"), F.lit(0))
    whole = F.array_join(words, " ")
    grams = [_grams(whole, n) for n in GRAMS]
    return F.concat(F.transform(words, lambda w: F.concat(F.lit("w:"), w)), *grams)


def tfidf_scores(texts: DataFrame, classes: DataFrame, key: str, text: Column, label: str, class_text: Column) -> DataFrame:
    """``(key, label, score)``: cosine of tf-idf vectors of each text and each class that share a feature of ``name_features``.

    A word counts 1, an n-gram 0.35; weights are ``tf * (ln((1+N)/(1+df)) + 1)`` over the N classes, and a feature that
    no class has weighs 1 in its text. Distinct texts are scored once. Classes meet texts by feature; the classes' side has one row
    per feature and class.
    """
    weight = F.when(F.startswith("t", F.lit("w:")), 1.0).otherwise(GRAM_WEIGHT)
    c = classes.where(F.col(label).isNotNull()).select(F.col(label).alias("label"), F.explode(name_features(class_text)).alias("t")).groupBy("label", "t").agg(F.sum(weight).alias("tf"))
    c = Scratch(classes.sparkSession, "features").put(c)
    n = c.select("label").distinct().count()
    idf = c.groupBy("t").agg(F.count(F.lit(1)).alias("df")).select("t", (F.log(F.lit(1 + n) / (1 + F.col("df"))) + 1).alias("idf"))
    cw = c.join(idf, "t").select("label", "t", (F.col("tf") * F.col("idf")).alias("w"), "idf")
    cn = cw.groupBy("label").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("cn"))
    keyed = texts.select(F.col(key).alias("key"), text.alias("text")).where("text is not null")
    x = keyed.select("text").distinct().select("text", F.explode(name_features(F.col("text"))).alias("t")).groupBy("text", "t").agg(F.sum(weight).alias("tf"))
    xw = x.join(idf, "t", "left").select("text", "t", (F.col("tf") * F.coalesce("idf", F.lit(1.0))).alias("xw"))
    xn = xw.groupBy("text").agg(F.sqrt(F.sum(F.col("xw") * F.col("xw"))).alias("xn"))
    dots = xw.join(cw.drop("idf"), "t").groupBy("text", "label").agg(F.sum(F.col("xw") * F.col("w")).alias("d"))
    scored = dots.join(cn, "label").join(xn, "text").select("text", "label", (F.col("d") / (F.col("cn") * F.col("xn"))).alias("score"))
    return keyed.join(scored, "text").select(F.col("key").alias(key), "label", "score")

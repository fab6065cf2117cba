"""Requests to judges and their answers as tables: payloads, a cache by content, parsing, completeness and clean-up.

A judge is any function from a request to an answer; the engine makes the requests, skips those that are answered
already, and checks what comes back. Nothing here depends on a model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.ids import normalized

ANSWER = "judgments array<struct<candidate_id: string, decision: string, ontology_label: string, judged_name: string, reason: string, confidence: double>>, discoveries array<struct<label: string, surface_text: string, start_char: int, end_char: int>>"


def requests(candidates: DataFrame, most_chars: int = 60_000, key: str = "candidate_id", sentence: str = "sentence_id", text: str = "text", fields: tuple[str, ...] = ("label", "surface_text", "start_char", "end_char")) -> DataFrame:
    """``(sentence, fragment, candidate_ids, payload, request_hash)``: one request for each sentence, or several where its candidates exceed ``most_chars``.

    The payload is JSON of the sentence's text and its candidates in order of their key; the hash is that of the payload, so
    equal requests are equal in every run. Candidates of a sentence are divided by the running size of what they send,
    and each goes whole. Candidates without a sentence have no request.
    """
    item = F.struct(F.col(key).alias("candidate_id"), *[F.col(f) for f in fields])
    rows = candidates.where(F.col(sentence).isNotNull()).select(sentence, F.col(text).alias("_text"), F.col(key).alias("_key"), item.alias("_item"))
    size = F.sum(F.length(F.to_json("_item")) + 1).over(Window.partitionBy(sentence).orderBy("_key").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("fragment", F.floor((size - 1) / most_chars).cast("int"))
    out = rows.groupBy(sentence, "fragment").agg(F.min("_text").alias("_text"), F.array_sort(F.collect_list(F.struct("_key", "_item"))).alias("_l"))
    payload = F.to_json(F.struct(F.transform("_l", lambda x: x["_item"]).alias("candidates"), F.col(sentence).cast("string").alias("sentence_id"), F.col("_text").alias("text")))
    out = out.select(sentence, "fragment", F.transform("_l", lambda x: x["_key"]).alias("candidate_ids"), payload.alias("payload"))
    return out.withColumn("request_hash", F.sha2(F.col("payload").cast("binary"), 256))


def answered(asked: DataFrame, cache: DataFrame) -> DataFrame:
    """``asked`` with ``response`` and ``cached``, from ``cache(request_hash, response)``; of several responses to one request the first that can be read counts."""
    good = cache.where(F.from_json("response", ANSWER)["judgments"].isNotNull()).groupBy("request_hash").agg(F.min("response").alias("response"))
    return asked.join(good, "request_hash", "left").withColumn("cached", F.col("response").isNotNull())


def call(asked: DataFrame, backend: Callable[[str, int], str], attempts: int = 2) -> DataFrame:
    """``(request_hash, response, attempts, error)``: the answers of ``backend(payload, attempt)`` to each distinct request, in batches on the executors.

    A response that is no JSON object, and an exception, are tried again with the next attempt's number, which a backend
    may use as a seed; after the last the response is null and ``error`` says why.
    """
    import json

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for h, payload in zip(b["request_hash"], b["payload"]):
                response = error = None
                for k in range(attempts):
                    try:
                        got = backend(payload, k)
                        if not isinstance(json.loads(got), dict):
                            raise ValueError("the response is no object")
                        response, error = got, None
                        break
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"[:500]
                out.append((h, response, k + 1, error))
            yield pd.DataFrame(out, columns=["request_hash", "response", "attempts", "error"])

    return asked.select("request_hash", "payload").distinct().mapInPandas(emit, "request_hash string, response string, attempts int, error string")


def parsed(responses: DataFrame, sentence: str = "sentence_id") -> tuple[DataFrame, DataFrame]:
    """``(judgments, discoveries)`` of ``responses(sentence, response)``; unreadable responses have none, fragments of one sentence come together."""
    a = responses.select(sentence, F.from_json("response", ANSWER).alias("_a"))
    judged = a.select(sentence, F.explode("_a.judgments").alias("_j")).select(sentence, "_j.*")
    found = a.select(sentence, F.explode("_a.discoveries").alias("_d")).select(sentence, "_d.*")
    return judged, found


def restored_ids(expected: DataFrame, returned: DataFrame, sentence: str = "sentence_id", key: str = "candidate_id") -> DataFrame:
    """``returned`` judgments with the id restored where a sentence expects one candidate and got one judgment with an unknown id."""
    wanted = expected.select(sentence, key).distinct().groupBy(sentence).agg(F.min(key).alias("_only"), F.count(F.lit(1)).alias("_wanted"))
    got = returned.groupBy(sentence).agg(F.count(F.lit(1)).alias("_got"))
    single = wanted.where("_wanted = 1").join(got.where("_got = 1"), sentence).select(sentence, "_only")
    return returned.join(single, sentence, "left").withColumn(key, F.coalesce("_only", key)).select(*returned.columns)


def faults(expected: DataFrame, returned: DataFrame, key: str = "pair_id") -> DataFrame:
    """``(key, fault)`` where judgments are not one for each expected key: missing, repeated or unknown; no rows mean that an answer is complete."""
    want = expected.select(key).where(F.col(key).isNotNull()).distinct()
    got = returned.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    one = lambda df, fault: df.select(key, F.lit(fault).alias("fault"))
    missing, unknown = want.join(got, key, "left_anti"), got.join(want, key, "left_anti")
    return one(missing, "missing").unionByName(one(unknown, "unknown")).unionByName(one(got.where("_n > 1").join(want, key, "left_semi"), "repeated"))


def new_discoveries(discoveries: DataFrame, candidates: DataFrame, sentence: str = "sentence_id") -> DataFrame:
    """Discoveries without those whose place, or whose label and normalised surface, a candidate of their sentence has already; equal ones come once."""
    d = discoveries.dropDuplicates([sentence, "label", "start_char", "end_char", "surface_text"]).withColumn("_n", normalized("surface_text"))
    places = candidates.select(sentence, "start_char", "end_char").distinct()
    names = candidates.select(sentence, "label", normalized("surface_text").alias("_n")).distinct()
    return d.join(places, [sentence, "start_char", "end_char"], "left_anti").join(names, [sentence, "label", "_n"], "left_anti").drop("_n").select(*discoveries.columns)


def mentions_of(entities: DataFrame, mentions: DataFrame) -> DataFrame:
    """``(entity_id, position, mention_id, fault)``: every entry of each entity's ``mention_ids`` with what is wrong with it, null for nothing.

    Faults: ``missing`` where no mention has the id, ``other_label`` where its label is not the entity's, and
    ``claimed_twice`` where an earlier entity, or an earlier place, has it too.
    """
    rows = entities.select("entity_id", F.col("label").alias("_label"), F.posexplode("mention_ids").alias("position", "mention_id"))
    one = mentions.where("mention_id is not null").groupBy("mention_id").agg(F.min("label").alias("_own"), F.lit(True).alias("_there"))
    first = rows.groupBy("mention_id").agg(F.min(F.struct("entity_id", "position")).alias("_first"))
    met = rows.join(one, "mention_id", "left").join(first, "mention_id", "left")
    again = F.struct("entity_id", "position") != F.col("_first")
    fault = F.when(F.col("_there").isNull(), "missing").when(~F.col("_own").eqNullSafe(F.col("_label")), "other_label").when(again, "claimed_twice")
    return met.select("entity_id", "position", "mention_id", fault.alias("fault"))

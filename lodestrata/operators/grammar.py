"""Subject-predicate-object triples from dependency tokens, and the index of their arguments.

Tokens are a table (``sentence_id, index, text, lemma, pos, dep, head_index, start_char, end_char``) from any parser.
Everything is self-joins on (sentence, head); chains of conjuncts and dependents are followed until they end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.sources.scratch import grown

#: Dependency relations (fixed values).
SUBJECTS = ("nsubj", "nsubjpass", "csubj")
OBJECTS = ("dobj", "obj", "attr", "oprd", "dative")


def _tokens(t: DataFrame, name: str) -> DataFrame:
    return t.select(*[F.col(c).alias(f"{name}_{c}" if c != "sentence_id" else c) for c in ("sentence_id", "index", "text", "lemma", "pos", "dep", "head_index", "start_char", "end_char")])


def with_conjuncts(heads: DataFrame, tokens: DataFrame, column: str) -> DataFrame:
    """``heads`` and, for each, all tokens coordinated with it, directly or through others."""
    conj = tokens.where("dep = 'conj'").select("sentence_id", F.col("head_index").alias(column), F.col("index").alias("_c"))
    return grown(heads, lambda new: new.join(conj, ["sentence_id", column]).drop(column).withColumnRenamed("_c", column), "conjuncts")


def argument_spans(tokens: DataFrame) -> DataFrame:
    """``(sentence_id, index, start_char, end_char)``: each token with the extent of all that depends on it, at any depth, without clauses."""
    inner = tokens.where(~F.col("dep").isin("conj", "cc", "punct", "relcl", "acl", "advcl", "appos", *SUBJECTS, "ROOT"))
    below = inner.select("sentence_id", F.col("head_index").alias("_at"), F.col("index").alias("_child"), F.col("start_char").alias("_cs"), F.col("end_char").alias("_ce"))
    own = tokens.select("sentence_id", "index", F.col("start_char").alias("_s"), F.col("end_char").alias("_e"), F.col("index").alias("_at"))
    step = lambda new: new.join(below, ["sentence_id", "_at"]).select("sentence_id", "index", F.col("_cs").alias("_s"), F.col("_ce").alias("_e"), F.col("_child").alias("_at"))
    return grown(own, step, "extents").groupBy("sentence_id", "index").agg(F.min("_s").alias("start_char"), F.max("_e").alias("end_char"))


def triples(tokens: DataFrame) -> DataFrame:
    """``(sentence_id, subject_index, predicate_index, object_index, predicate, voice)``.

    A predicate is a verb; its objects are direct ones and those of its prepositions ("flows into", "removed by") and
    of prepositions of its direct objects ("removes contaminants from wastewater"); conjuncts of subjects and objects count, and a coordinated predicate without a subject takes that of the one before it.
    """
    verbs = tokens.where(F.col("pos").isin("VERB", "AUX") & ~F.col("dep").isin("aux", "auxpass")).select("sentence_id", F.col("index").alias("predicate_index"), "lemma", "dep", "head_index")
    subj = tokens.where(F.col("dep").isin(*SUBJECTS)).select("sentence_id", F.col("head_index").alias("predicate_index"), F.col("index").alias("subject_index"), (F.col("dep") == "nsubjpass").alias("passive"))
    own = verbs.join(subj, ["sentence_id", "predicate_index"])
    inherited = verbs.where("dep = 'conj'").join(subj.select("sentence_id", F.col("predicate_index").alias("head_index"), "subject_index", "passive"), ["sentence_id", "head_index"])
    inherited = inherited.join(own.select("sentence_id", "predicate_index"), ["sentence_id", "predicate_index"], "left_anti")
    both = own.select("sentence_id", "predicate_index", "lemma", "subject_index", "passive").unionByName(inherited.select("sentence_id", "predicate_index", "lemma", "subject_index", "passive"))
    both = with_conjuncts(both, tokens, "subject_index")
    direct = tokens.where(F.col("dep").isin(*OBJECTS)).select("sentence_id", F.col("head_index").alias("predicate_index"), F.col("index").alias("object_index"), F.lit("").alias("preposition"))
    prep = tokens.where("dep in ('prep', 'agent')").select("sentence_id", F.col("head_index").alias("predicate_index"), F.col("index").alias("_p"), F.col("lemma").alias("preposition"))
    of_object = prep.withColumnRenamed("predicate_index", "object_index").join(direct.select("sentence_id", "object_index", "predicate_index"), ["sentence_id", "object_index"]).select(*prep.columns)
    prep = prep.unionByName(of_object)
    pobj = tokens.where("dep = 'pobj'").select("sentence_id", F.col("head_index").alias("_p"), F.col("index").alias("object_index"))
    objects = with_conjuncts(direct.unionByName(prep.join(pobj, ["sentence_id", "_p"]).drop("_p")), tokens, "object_index")
    out = both.join(objects, ["sentence_id", "predicate_index"]).where("subject_index <> object_index")
    predicate = F.trim(F.concat_ws(" ", "lemma", "preposition"))
    return out.select("sentence_id", "subject_index", "predicate_index", "object_index", predicate.alias("predicate"), F.when(F.col("passive"), "passive").otherwise("active").alias("voice")).distinct()


def clean_argument(text: Column) -> Column:
    """An argument without a leading article and trailing punctuation."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), "(?i)^(a|an|the)\\s+", ""), "[\\s,.;:]+$", ""))


def argument_index(arguments: DataFrame, keys: list[str], role: str, triple: str) -> DataFrame:
    """One row per place: its sorted distinct roles and triples, joined by commas, and how many triples."""
    agg = arguments.groupBy(*keys).agg(F.array_sort(F.collect_set(role)).alias("_r"), F.count_distinct(triple).alias("triples"))
    return agg.select(*keys, F.array_join("_r", ",").alias("roles"), "triples")

"""Canonical entities, similar pairs, merges and the catalog of earlier names."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.ids import name_tokens, normalized, stable_id
from lodestrata.functions.similarity import sequence_ratio, token_jaccard, version_of
from lodestrata.operators.name_pairs import pairs_inside, word_pairs
from lodestrata.sources.scratch import Scratch, read_block

#: Labels whose things are told apart by occurrence, and labels that never become entities (fixed values).
SCOPED_LABELS = ("Experiment", "Observation", "Claim", "Sample", "SamplingEvent", "Condition", "Parameter")
PROVENANCE_LABELS = ("EvidenceFragment", "Mention")


def entity_key(label: Column, name: Column, canonical_id: Column) -> Column:
    """What makes mentions one entity: the normalised name, for labels told apart by occurrence the canonical id first."""
    return F.when(label.isin(*SCOPED_LABELS), F.coalesce(F.when(canonical_id != "", canonical_id), normalized(name))).otherwise(normalized(name))


def canonical_entities(mentions: DataFrame, seq: str = "seq", evidence: int = 5, most_aliases: int = 200) -> DataFrame:
    """One row per label and key of ``mentions(mention_id, label, surface_text, canonical_name, canonical_id, from_lexicon, is_reference, sentence_id, seq)``.

    The name is the longest, of equals the first; a reference such as "this model" is evidence but no alias; the id is
    that of a lexicon mention, else the first given, else made from label and key. Mentions and their sentences are
    counted in full, and of evidence and aliases the first few are kept, in order; ``entity_mentions`` and
    ``entity_aliases`` have all of them as rows, as an entity may hold a large part of the mentions.
    """
    rows = _keyed(mentions)
    first_id = lambda c: F.min_by(F.when(c & (F.col("canonical_id") != ""), F.col("canonical_id")), F.when(c & (F.col("canonical_id") != ""), F.col(seq)))
    agg = rows.groupBy("label", "key").agg(
        F.min_by("_name", F.struct((-F.length("_name")).alias("l"), F.col(seq), F.col("_name"))).alias("canonical_name"),
        first_id(F.coalesce("from_lexicon", F.lit(False))).alias("_lex"), first_id(F.lit(True)).alias("_any"),
        F.count(F.lit(1)).cast("int").alias("mention_count"),
        F.count_distinct("sentence_id").alias("sentences"),
    )
    w = Window.partitionBy("label", "key").orderBy(seq, "mention_id")
    kept = rows.select("label", "key", seq, "mention_id").withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= evidence)
    kept = kept.groupBy("label", "key").agg(F.transform(F.array_sort(F.collect_list(F.struct(seq, "mention_id"))), lambda x: x["mention_id"]).alias("evidence"))
    out = agg.join(kept, ["label", "key"]).join(_first_aliases(_aliases(rows), ["label", "key"], most_aliases), ["label", "key"])
    return out.select(F.coalesce("_lex", "_any", stable_id("entity", "label", "key")).alias("entity_id"), "label", "key", "canonical_name", "aliases", "alias_count", "mention_count", "sentences", "evidence")


def _keyed(mentions: DataFrame) -> DataFrame:
    name = F.coalesce(F.when(F.col("canonical_name") != "", F.col("canonical_name")), F.col("surface_text"))
    rows = mentions.where(~F.col("label").isin(*PROVENANCE_LABELS)).withColumn("_name", name)
    return rows.withColumn("key", entity_key(F.col("label"), F.col("_name"), F.coalesce("canonical_id", F.lit(""))))


def _aliases(rows: DataFrame) -> DataFrame:
    """``(label, key, alias)``: distinct names and surfaces but for references."""
    surface = F.when(~F.coalesce("is_reference", F.lit(False)), F.col("surface_text"))
    return rows.select("label", "key", F.explode(F.array(surface, F.col("_name"))).alias("alias")).where("alias is not null").distinct()


def _first_aliases(aliases: DataFrame, keys: list[str], most: int) -> DataFrame:
    """``aliases`` (the first ``most`` in order) and ``alias_count`` of each key; Spark limits each group before its sort is shuffled."""
    first = aliases.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("alias"))).where(F.col("_n") <= most)
    return first.groupBy(*keys).agg(F.array_sort(F.collect_list("alias")).alias("aliases")).join(aliases.groupBy(*keys).agg(F.count(F.lit(1)).alias("alias_count")), keys)


def entity_aliases(mentions: DataFrame, entities: DataFrame) -> DataFrame:
    """``(entity_id, alias)``: every alias of each entity of ``canonical_entities``."""
    return _aliases(_keyed(mentions)).join(entities.select("label", "key", "entity_id"), ["label", "key"]).select("entity_id", "alias")


def entity_mentions(mentions: DataFrame, entities: DataFrame) -> DataFrame:
    """``(entity_id, mention_id, sentence_id)``: every mention with its entity of ``canonical_entities``."""
    return _keyed(mentions).select("label", "key", "mention_id", "sentence_id").join(entities.select("label", "key", "entity_id"), ["label", "key"]).select("entity_id", "mention_id", "sentence_id")


def word_frequency(*names: DataFrame) -> DataFrame:
    """``(label, t, df)``: how many names of a label have a word."""
    out = None
    for n in names:
        w = n.select("label", F.explode("tokens").alias("t"))
        out = w if out is None else out.unionByName(w)
    return out.groupBy("label", "t").agg(F.count(F.lit(1)).alias("df"))


def similar_pairs(entities: DataFrame, threshold: float = 0.64, ratio: bool = True, id_col: str = "entity_id", aliases: DataFrame | None = None) -> DataFrame:
    """Pairs of entities with one label and similar names: ``left_id, right_id, label, jaccard, containment, alias_overlap, score``.

    Names are compared once: entities with one label and normalised name are one representative each (see
    ``representatives`` and ``class_members``), so copies make no pairs. Representatives meet if one is inside the other
    (then it shares its rarest run of four characters), or by ``word_pairs`` for the least word Jaccard with which the
    threshold can be reached at a character ratio of 1. Those that share an alias are a class (``alias_classes`` has its
    members), and each is paired with the class's representative only, so an alias that very many have makes no more
    pairs than it has members. Conflicting version numbers score nothing. The character ratio is computed only for pairs
    whose bound on it allows the threshold. Each pair is found in one way only and scored where its names meet, with
    all that its row needs, so only pairs with a class's representative, no more than aliases, are shuffled. Where the
    entities' own arrays of aliases are bounded, ``aliases(id, alias)`` are the rows beside them.
    """
    scratch = Scratch(entities.sparkSession, "names")
    known = [c for c in ("label", "canonical_name", "aliases") if c in entities.columns and (c != "aliases" or aliases is None)]
    entities = scratch.put(entities.select(id_col, *known))
    reps = scratch.put(representatives(entities, id_col).select("label", "norm", "rep", "versions"))
    classes = scratch.put(alias_classes(entities, id_col, aliases, reps))
    scratch.forget(entities)
    own = classes.select("label", "rep", "alias_key").distinct()
    several = own.groupBy("label", "alias_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    shared = own.join(several, ["label", "alias_key"]).groupBy("label", "rep").agg(F.collect_list("alias_key").alias("shared"))
    linked = classes.where("rep <> class_rep")
    stars = linked.groupBy("label", "rep").agg(F.collect_set("class_rep").alias("stars"))
    r = reps.join(shared, ["label", "rep"], "left").join(stars, ["label", "rep"], "left")
    r = scratch.put(r.select("label", "rep", "norm", "versions", "shared", "stars"))
    scratch.forget(reps)
    least = max(0.05, (threshold - 0.45) / 0.55) if ratio else threshold
    named = r.withColumn("tokens", name_tokens("norm"))
    words = word_pairs(named, word_frequency(named), least, threshold, ratio)
    words = words.select("x", "y", "label", F.col("j").alias("jaccard"), F.lit(False).alias("containment"), F.col("overlap"), (0.55 * F.col("j") + 0.45 * F.col("q") if ratio else F.col("j")).alias("_own"), F.lit(False).alias("_star"))

    held = ["rep", "norm", "versions", "shared", "stars"]
    side = lambda p: F.struct(*[F.col(c) for c in held]).alias(p)
    link = linked.select("label", F.least("rep", "class_rep").alias("x"), F.greatest("rep", "class_rep").alias("y")).distinct()
    star = link.join(r.select(F.col("rep").alias("x"), "label", side("l")), ["label", "x"]).join(r.select(F.col("rep").alias("y"), "label", side("r")), ["label", "y"])
    inner = pairs_inside(r, held)
    x, y = F.col("a.rep"), F.col("b.rep")
    inner = inner.where(~F.array_contains(F.coalesce("a.stars", F.array().cast(r.schema["stars"].dataType)), y) & ~F.array_contains(F.coalesce("b.stars", F.array().cast(r.schema["stars"].dataType)), x))
    inner = inner.select("label", F.when(x < y, F.col("a")).otherwise(F.col("b")).alias("l"), F.when(x < y, F.col("b")).otherwise(F.col("a")).alias("r"), F.lit(False).alias("_star"))
    p = star.select("label", "l", "r", F.lit(True).alias("_star")).unionByName(inner)
    shorter = F.least(F.length("l.norm"), F.length("r.norm"))
    p = p.where((F.col("l.versions") == "") | (F.col("r.versions") == "") | (F.col("l.versions") == F.col("r.versions"))).withColumns({
        "jaccard": token_jaccard(name_tokens("l.norm"), name_tokens("r.norm")),
        "containment": (F.contains("l.norm", "r.norm") | F.contains("r.norm", "l.norm")) & (shorter >= 4),
        "overlap": F.col("_star") | F.coalesce(F.arrays_overlap("l.shared", "r.shared"), F.lit(False)),
    })
    alike = 0.55 * F.col("jaccard") + 0.45 * sequence_ratio(F.col("l.norm"), F.col("r.norm")) if ratio else F.col("jaccard")
    p = p.select(F.col("l.rep").alias("x"), F.col("r.rep").alias("y"), "label", "jaccard", "containment", "overlap", F.greatest(F.when(F.col("containment"), 0.88).otherwise(0.0), alike).alias("_own"), "_star")
    p = words.unionByName(p).withColumn("_own", F.bround("_own", 4)).where(F.col("_star") | (F.col("_own") >= threshold))
    score = F.greatest(F.when(F.col("overlap"), 0.995).otherwise(0.0), F.col("_own"))
    return p.select(F.col("x").alias("left_id"), F.col("y").alias("right_id"), "label", F.bround("jaccard", 4).alias("jaccard"), "containment", F.col("overlap").alias("alias_overlap"), score.alias("score"))


def _live(entities: DataFrame) -> DataFrame:
    return entities.where(~F.col("label").isin(*SCOPED_LABELS)).withColumn("norm", normalized("canonical_name")).where("norm <> ''")


def representatives(entities: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """One row per label and normalised name: the least id, the spelling of that row, tokens and versions; ``members`` says for how many entities."""
    own = _live(entities).groupBy("label", "norm").agg(F.min(id_col).alias("rep"), F.min_by("canonical_name", F.struct(id_col, "canonical_name")).alias("name"), F.count_distinct(id_col).alias("members"))
    return own.withColumn("tokens", name_tokens("norm")).withColumn("versions", version_of(F.col("name")))


def alias_classes(entities: DataFrame, id_col: str = "entity_id", aliases: DataFrame | None = None, reps: DataFrame | None = None) -> DataFrame:
    """``(label, alias_key, rep, class_rep)``: representatives that share a normalised alias, with the one that stands for the class.

    Names with different version numbers conflict, so the members of an alias are classes by version, each with its
    least member, and that of a
    class with a version is tied to that of the class without version by a row of its own. ``reps`` are the
    ``representatives`` where these are at hand.
    """
    r = (representatives(entities, id_col) if reps is None else reps).select("label", "norm", "rep", "versions")
    if aliases is None:
        named = _live(entities).select("label", "norm", F.explode("aliases").alias("alias"))
    else:
        named = _live(entities).select("label", "norm", id_col).distinct().join(aliases.select(id_col, "alias"), id_col)
    named = named.select("label", "norm", normalized("alias").alias("alias_key")).where("alias_key <> ''").distinct()
    held = named.join(r, ["label", "norm"]).select("label", "alias_key", "rep", "versions")
    least = held.groupBy("label", "alias_key", "versions").agg(F.min("rep").alias("class_rep"))
    bare = least.where("versions = ''").select("label", "alias_key", F.col("class_rep").alias("_bare"))
    tied = least.where("versions <> ''").join(bare, ["label", "alias_key"]).select("label", "alias_key", F.col("class_rep").alias("rep"), F.col("_bare").alias("class_rep"))
    return held.join(least, ["label", "alias_key", "versions"]).select("label", "alias_key", "rep", "class_rep").unionByName(tied)


def class_members(entities: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """``(entity, rep)``: which representative stands for each entity."""
    live = _live(entities)
    reps = live.groupBy("label", "norm").agg(F.min(id_col).alias("rep"))
    return live.select("label", "norm", F.col(id_col).alias("entity")).distinct().join(reps, ["label", "norm"]).select("entity", "rep")


def _alias_rows(entities: DataFrame, aliases: DataFrame | None, id_col: str) -> DataFrame:
    """``(id_col, alias)`` from the row table, or from the arrays where these are whole."""
    return aliases.select(id_col, "alias") if aliases is not None else entities.select(id_col, F.explode("aliases").alias("alias"))


def merge_entities(entities: DataFrame, components: DataFrame, id_col: str = "entity_id", most_aliases: int = 200, aliases: DataFrame | None = None) -> DataFrame:
    """Entities of one component as one row: ``entity_id`` (the component), label, the longest name, counts, and aliases in order.

    ``alias_count`` counts all distinct aliases; the array holds the first ``most_aliases`` of them, as a component may
    hold a large part of the entities. ``merged_aliases`` and ``merged_mentions`` have all of them as rows. Where the
    entities' own arrays are bounded, ``aliases(id, alias)`` are the rows beside them.
    """
    rows = entities.join(components.select(F.col("node").alias(id_col), "component"), id_col, "left").withColumn("component", F.coalesce("component", id_col))
    out = rows.groupBy("component").agg(
        F.min_by("label", F.struct(id_col, "label")).alias("label"),
        F.max_by("canonical_name", F.struct(F.length("canonical_name"), "canonical_name")).alias("canonical_name"),
        F.sum(F.coalesce("mention_count", F.lit(0))).cast("long").alias("mention_count"),
        F.count_distinct(id_col).alias("members"),
    )
    names = _to_components(_alias_rows(entities, aliases, id_col), components, id_col, ["alias"]).where("alias is not null").distinct()
    return out.withColumnRenamed("component", "entity_id").join(_first_aliases(names, ["entity_id"], most_aliases), "entity_id", "left")


def merged_aliases(entities: DataFrame, components: DataFrame, id_col: str = "entity_id", aliases: DataFrame | None = None) -> DataFrame:
    """``(entity_id, alias)``: every distinct alias and canonical name of the entities of each component of ``merge_entities``; ``aliases`` as there."""
    names = _alias_rows(entities, aliases, id_col).unionByName(entities.select(id_col, F.col("canonical_name").alias("alias"))).where("alias is not null")
    return _to_components(names, components, id_col, ["alias"]).distinct()


def merged_mentions(mentions: DataFrame, components: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """``(entity_id, mention_id)``: every mention of ``entity_mentions`` with its component of ``merge_entities``."""
    return _to_components(mentions, components, id_col, ["mention_id"])


def _to_components(rows: DataFrame, components: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """Rows with the component of their entity, or the entity itself if it has none."""
    found = rows.join(components.select(F.col("node").alias(id_col), "component"), id_col, "left")
    return found.select(F.coalesce("component", id_col).alias("entity_id"), *columns)


def prior_catalog(sources: list[DataFrame], most_aliases: int = 200) -> DataFrame:
    """Earlier names from ``(node_id, label, canonical_name, aliases)`` tables, the first table first: one row per label and normalised name with the first id, the first aliases in order and their number.

    ``catalog_aliases`` has all aliases as rows.
    """
    out = _sources(sources)
    first = out.groupBy("label", "key").agg(F.min(F.struct("source", "node_id", "canonical_name")).alias("f"))
    names = _first_aliases(_source_aliases(out), ["label", "key"], most_aliases)
    return first.join(names, ["label", "key"]).select(F.col("f.node_id").alias("node_id"), "label", "key", F.col("f.canonical_name").alias("canonical_name"), "aliases", "alias_count")


def catalog_aliases(sources: list[DataFrame]) -> DataFrame:
    """``(node_id, label, key, canonical_name, alias)``: every alias and name of each node of ``prior_catalog``."""
    out = _sources(sources)
    first = out.groupBy("label", "key").agg(F.min(F.struct("source", "node_id", "canonical_name")).alias("f"))
    return _source_aliases(out).join(first, ["label", "key"]).select(F.col("f.node_id").alias("node_id"), "label", "key", F.col("f.canonical_name").alias("canonical_name"), "alias")


def _source_aliases(out: DataFrame) -> DataFrame:
    return out.select("label", "key", F.explode(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("alias")).where("alias is not null").distinct()


def _sources(sources: list[DataFrame]) -> DataFrame:
    out = None
    for k, s in enumerate(sources):
        s = s.select("node_id", "label", F.trim("canonical_name").alias("canonical_name"), "aliases", F.lit(k).alias("source"))
        out = s if out is None else out.unionByName(s)
    return out.where((F.col("canonical_name") != "") & ~F.col("label").isin(*SCOPED_LABELS)).withColumn("key", normalized("canonical_name"))


def exact_prior(rows: DataFrame, catalog: DataFrame, label: str, name: str) -> DataFrame:
    """Each row with the one earlier name of its label that is equal after normalisation; none if several are."""
    one = catalog.groupBy(F.col("label").alias("_l"), F.col("key").alias("_k")).agg(F.min("node_id").alias("matched_node_id"), F.count_distinct("node_id").alias("_n")).where("_n = 1").drop("_n")
    keyed = rows.withColumn("_l", F.col(label)).withColumn("_k", normalized(name))
    return keyed.join(one, ["_l", "_k"], "left").drop("_l", "_k")


def prior_top_k(candidates: DataFrame, names: DataFrame, key: str, label: str, name: str, k: int = 12, alternatives: str | None = None, block_rows: int = 5_000) -> DataFrame:
    """``(key, node_id, score, rank)``: the ``k`` earlier nodes of a candidate's labels with the best ratio of characters over ``names(node_id, label, canonical_name, alias)``, the rows of ``catalog_aliases``.

    A candidate's labels are its own and those of the array ``alternatives``. The score is the Ratcliff-Obershelp ratio
    of the normalised names, at four digits; equal scores fall to the first name without case, then to the least id.
    Every node of a label is compared, by this search: distinct names are written to the shared folder in blocks, a task
    holds a part of the catalog and reads the blocks one after another, bounds all ratios at once by the characters that
    both names have, and computes them from the largest bound down until no further one can be among its best ``k``. Only
    these are shuffled. Candidates with an empty name, and nodes without any, have none.
    """
    own = F.array(F.col(label)) if alternatives is None else F.concat(F.array(F.col(label)), F.coalesce(alternatives, F.array().cast("array<string>")))
    c = candidates.select(F.col(key), F.explode(F.array_distinct(own)).alias("label"), normalized(name).alias("norm")).where("norm <> '' and label <> ''")
    files = Scratch(candidates.sparkSession, "names").put_blocks(c.select("label", "norm").distinct(), block_rows)
    nodes = names.select("node_id", "label", F.lower("canonical_name").alias("shown"), normalized("alias").alias("name")).where("label is not null and name <> ''")

    def best(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        held = {label: _Names(rows) for label, rows in part.groupby("label", sort=False)}
        for file in files:
            rows = [(label, norm, *hit) for label, norm in read_block(file).select(["label", "norm"]).to_pandas().itertuples(index=False) if label in held for hit in held[label].nearest(norm, k)]
            if rows:
                yield pd.DataFrame(rows, columns=["label", "norm", "node_id", "shown", "score"])

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += len(b)
            if n >= 4 * block_rows:
                yield from best(pd.concat(held, ignore_index=True))
                held, n = [], 0
        if n:
            yield from best(pd.concat(held, ignore_index=True))

    found = nodes.mapInPandas(emit, f"label string, norm string, node_id {names.schema['node_id'].dataType.simpleString()}, shown string, score double")
    found = found.groupBy("label", "norm", "node_id").agg(F.max("score").alias("score"), F.min("shown").alias("shown"))
    # The labels of one candidate share its k places, so nodes are ranked for each candidate, after the k of each label.
    first = lambda rows, keys: rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "shown", "node_id")).cast("int")).where(F.col("rank") <= k)
    found = first(found, ["label", "norm"]).drop("rank")
    return first(c.join(found, ["label", "norm"]), [key]).select(key, "node_id", "score", "rank")


class _Names:
    """Names of nodes with the counts of their characters, for bounds on ratios with all of them at once."""

    def __init__(self, rows: pd.DataFrame):
        place = {n: i for i, n in enumerate(dict.fromkeys(rows["node_id"]))}
        self.nodes, self.shown = list(place), dict(zip((place[n] for n in rows["node_id"]), rows["shown"]))
        self.names = list(dict.fromkeys((name, place[n]) for name, n in zip(rows["name"], rows["node_id"])))
        self.lengths = np.array([len(n) for n, _ in self.names])
        self.counts = np.stack([_characters(n) for n, _ in self.names])

    def nearest(self, norm: str, k: int) -> list[tuple]:
        """The ``k`` best ``(node_id, shown, score)``."""
        bound = 2.0 * np.minimum(self.counts, _characters(norm)).sum(axis=1) / (self.lengths + len(norm))
        score: dict[int, float] = {}
        least = -1.0  # the k-th best score so far
        match = SequenceMatcher(None)
        for at in np.argsort(-bound, kind="stable").tolist():
            if len(score) >= k and round(float(bound[at]), 4) < least:
                break
            other, node = self.names[at]
            match.set_seqs(norm, other)
            got = round(match.ratio(), 4)
            if got > score.get(node, -1.0):
                score[node] = got
                if len(score) >= k:
                    least = sorted(score.values(), reverse=True)[k - 1]
        order = sorted(score, key=lambda i: (-score[i], self.shown[i] or "", self.nodes[i]))
        return [(self.nodes[i], self.shown[i], score[i]) for i in order[:k]]


def _characters(name: str) -> np.ndarray:
    """How often each of a-z, 0-9 and the blank stands in a normalised name."""
    return np.bincount(np.frombuffer(name.encode("ascii"), dtype=np.uint8) - 32, minlength=91)[_PLACES]


_PLACES = np.array([0, *range(16, 26), *range(65, 91)])


def grow_lexicon(lexicon: DataFrame, additions: DataFrame) -> DataFrame:
    """The lexicon after reviewed ``additions(label, canonical_name, aliases)``, one per label and name.

    Live entries of the label that share a normalised name or alias with an addition are merged into the one with its
    name, else the least id, else a new one; the others are deprecated and point to it.
    """
    keys = lambda n, a: F.array_distinct(F.filter(F.transform(F.concat(F.array(n), F.coalesce(a, F.array().cast("array<string>"))), lambda x: normalized(x)), lambda x: x != ""))
    live = lexicon.where((F.col("status") != "deprecated") | F.col("status").isNull())
    e = live.select("canonical_id", "label", F.explode(keys(F.col("canonical_name"), F.col("aliases"))).alias("k"), normalized("canonical_name").alias("norm"))
    add = additions.withColumn("add_norm", normalized("canonical_name")).select("label", "add_norm", F.col("canonical_name").alias("add_name"), F.col("aliases").alias("add_aliases"))
    x = add.select("label", "add_norm", F.explode(keys(F.col("add_name"), F.col("add_aliases"))).alias("k"))
    hit = x.join(e, ["label", "k"]).select("label", "add_norm", "canonical_id", (F.col("norm") == F.col("add_norm")).alias("same")).groupBy("label", "add_norm", "canonical_id").agg(F.max("same").alias("same"))
    chosen = hit.groupBy("label", "add_norm").agg(F.min_by("canonical_id", F.struct((~F.col("same")).alias("s"), "canonical_id")).alias("into"))
    moved = hit.join(chosen, ["label", "add_norm"]).select("canonical_id", F.col("into")).groupBy("canonical_id").agg(F.min("into").alias("into"))
    target = add.join(chosen, ["label", "add_norm"], "left").withColumn("into", F.coalesce("into", stable_id("lex", "label", "add_norm")))
    old = lexicon.select("canonical_id", "label", "canonical_name", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), "status", "replaced_by").groupBy("canonical_id").agg(F.first("label").alias("label"), F.max("canonical_name").alias("canonical_name"), F.array_distinct(F.flatten(F.collect_list("aliases"))).alias("aliases"), F.max("status").alias("status"), F.max("replaced_by").alias("replaced_by"))
    merged = old.join(moved, "canonical_id").groupBy(F.col("into").alias("canonical_id")).agg(F.array_distinct(F.flatten(F.collect_list(F.concat(F.array("canonical_name"), "aliases")))).alias("more"))
    new = target.join(merged, target["into"] == merged["canonical_id"], "left").select(target["into"].alias("canonical_id"), target["label"], F.col("add_name").alias("canonical_name"), F.array_sort(F.array_distinct(F.concat(F.array("add_name"), F.coalesce("add_aliases", F.array().cast("array<string>")), F.coalesce("more", F.array().cast("array<string>"))))).alias("aliases"), F.lit("human_reviewed").alias("status"), F.lit(None).cast("string").alias("replaced_by"))
    gone = old.join(moved.where("canonical_id <> into"), "canonical_id").select("canonical_id", "label", "canonical_name", "aliases", F.lit("deprecated").alias("status"), F.col("into").alias("replaced_by"))
    touched = new.select("canonical_id").unionByName(gone.select("canonical_id")).distinct()
    return old.join(touched, "canonical_id", "left_anti").unionByName(new).unionByName(gone.join(new.select("canonical_id").distinct(), "canonical_id", "left_anti"))

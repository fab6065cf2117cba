"""Exact spans in text: patterns, lexicons, introduced names and their propagation.

Offsets count code points, half open, so that ``text[start:end]`` is the surface; they come from one Arrow-batched
pass per channel. A lexicon is held by each task as one word index, whatever the number of its aliases; it is cut into
blocks of bounded size, and each block is a pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.functions.ids import normalized
from lodestrata.operators.windows import best_per_key

#: Channels from the most to the least trusted (fixed values).
METHOD_PRIORITY = {"persistent_lexicon": 6, "introduced_system": 5, "document_alias": 5, "rule": 4}

#: Names that stand for a class and never for one thing (fixed values).
GENERIC_TERMS = (
    "model", "method", "system", "agent", "data", "result", "study", "approach",
    "tool", "task", "framework", "process", "technology", "technique", "analysis",
    "this model", "the model", "our model", "this method", "the method", "this system",
    "the system", "this platform", "the platform", "new platform", "current system",
    "this approach", "the approach", "it", "they", "these results",
    "llm based", "llmbased", "ai based", "aibased",
)

SPAN = "label string, start_char int, end_char int, surface_text string, method string"


def pattern_spans(sentences: DataFrame, patterns: list[tuple[str, str, str]], keys: list[str], text: str = "text", context: int = 0) -> DataFrame:
    """All matches of ``(label, pattern, method)`` in each sentence; a pattern's first named group is the span, else the match.

    Null texts have none. Patterns ignore case unless they say otherwise. With ``context`` the characters before and
    after each span come out too, as ``before_text`` and ``after_text``, so that no join back to the text is needed.
    """
    schema = _schema(sentences, keys) + ", " + SPAN + ", before_text string, after_text string" * bool(context)
    names = ["label", "start_char", "end_char", "surface_text", "method"] + ["before_text", "after_text"] * bool(context)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(label, re.compile(p, re.I), method) for label, p, method in patterns]
        for b in batches:
            at, rows = [], []
            for i, t in enumerate(b.column(len(keys)).to_pylist()):
                for label, p, method in compiled if t else ():
                    for m in p.finditer(t):
                        a, e = m.span(next(iter(p.groupindex), 0))
                        if a < e:
                            at.append(i)
                            near = (t[max(0, a - context) : a], t[e : e + context]) if context else ()
                            rows.append((label, a, e, t[a:e], method, *near))
            yield _beside(b, keys, at, rows, names, "siissss"[: len(names)])

    return sentences.select(*keys, text).mapInArrow(emit, schema)


def _schema(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)


def _beside(batch: pa.RecordBatch, keys: list[str], at: list[int], rows: list[tuple], names: list[str], kinds: str) -> pa.RecordBatch:
    """The key columns of the rows ``at`` with new columns beside them; kinds are s for strings and i for integers."""
    where = pa.array(at, pa.int64())
    new = list(zip(*rows)) or [()] * len(names)
    types = {"s": pa.string(), "i": pa.int32()}
    return pa.RecordBatch.from_arrays([batch.column(i).take(where) for i in range(len(keys))] + [pa.array(c, types[k]) for c, k in zip(new, kinds)], [*keys, *names])


def alias_index(lexicon: DataFrame) -> DataFrame:
    """``(alias_key, canonical_id, label, canonical_name, alias)`` of each entry that is not deprecated, aliases and name alike, with ``entries``: how many entries share the normalised alias."""
    live = lexicon.where((F.col("status") != "deprecated") | F.col("status").isNull()).where("canonical_id is not null")
    rows = live.select("canonical_id", "label", "canonical_name", F.explode(F.array_distinct(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("alias"))
    rows = rows.withColumn("alias_key", normalized("alias")).where("alias_key <> ''").distinct()
    shared = rows.groupBy("alias_key").agg(F.count_distinct("canonical_id").alias("entries"))
    return rows.join(shared, "alias_key")


def find_entries(values: DataFrame, lexicon: DataFrame, value: str, label: str | None = None) -> DataFrame:
    """Each value with the one entry that has it as an alias (and the label, if one is given); values with none or several are left out."""
    index = alias_index(lexicon).select("alias_key", "canonical_id", F.col("label").alias("entry_label"), F.col("canonical_name").alias("entry_name")).distinct()
    keyed = values.withColumn("alias_key", normalized(value)).where("alias_key <> ''")
    if label:
        index = index.withColumnRenamed("entry_label", "_l")
        one = index.groupBy("alias_key", "_l").agg(F.min("canonical_id").alias("canonical_id"), F.count_distinct("canonical_id").alias("_n")).where("_n = 1").drop("_n")
        return keyed.join(one, (keyed["alias_key"] == one["alias_key"]) & (F.col(label) == F.col("_l"))).drop(one["alias_key"]).drop("_l", "alias_key")
    one = index.groupBy("alias_key").agg(F.min("canonical_id").alias("canonical_id"), F.count_distinct("canonical_id").alias("_n")).where("_n = 1").drop("_n")
    return keyed.join(one, "alias_key").drop("alias_key")


_RUNS = re.compile("[A-Za-z0-9\u017f\u212a]+")  # with the two other characters that are ASCII letters in another case
#: What makes a name of a label another one (fixed values): a hyphen on either side of a tool, a version or a following word after a model.
HYPHEN_LABEL, VERSION_LABEL = "Tool", "Model"
_VERSION = re.compile(r"(?:\.\d+|o\b|\s+Search\b)", re.I)


class _AliasMatcher:
    """Aliases by their first run of ASCII letters and digits, or by their first character if that is another; matched at boundaries of such runs."""

    def __init__(self, aliases: list[str]):
        self.by_run: dict[str, list[tuple[str, re.Pattern]]] = {}
        self.by_character: dict[str, list[tuple[str, re.Pattern]]] = {}
        for a in sorted(set(aliases)):
            p = re.compile(rf"(?<![A-Za-z0-9]){re.escape(a)}(?![A-Za-z0-9])", re.I)
            first = _RUNS.match(a)
            if first:
                self.by_run.setdefault(first[0].casefold(), []).append((a, p))
            else:
                self.by_character.setdefault(a[0].lower(), []).append((a, p))

    def find(self, text: str) -> Iterator[tuple[str, int, int, bool, bool]]:
        """Alias, start, end, whether a hyphen is beside it, and whether a version follows."""
        starts = [(m.start(), own) for m in _RUNS.finditer(text) if (own := self.by_run.get(m[0].casefold()))]
        if self.by_character:
            starts += [(i, own) for i, c in enumerate(text) if (own := self.by_character.get(c.lower()))]
        for at, own in starts:
            for alias, p in own:
                if m := p.match(text, at):
                    e = m.end()
                    yield alias, at, e, text[at - 1 : at] == "-" or text[e : e + 1] == "-", _VERSION.match(text, e) is not None


def lexicon_spans(sentences: DataFrame, lexicon: DataFrame, keys: list[str], text: str = "text", block_chars: int = 1_000_000) -> DataFrame:
    """Spans of every alias of two characters or more in each sentence, with the entries that have it; ``method`` says whether the alias is unambiguous.

    Matching ignores case; no ASCII letter or digit may stand at either end. A tool's name with a hyphen beside it and a
    model's name that a version follows ("GPT-4" in "GPT-4.5") are other names and left out. Each further block of
    aliases is a further pass over the sentences; a block takes about 1 kB an alias in a worker.
    """
    index = alias_index(lexicon).where(F.length("alias") >= 2).select("alias", "canonical_id", "label", "canonical_name", "entries").distinct()
    words = index.select("alias").distinct()
    blocks = max(1, -(-(words.agg(F.sum(F.length("alias") + 1)).first()[0] or 0) // block_chars))
    schema = _schema(sentences, keys) + ", alias string, start_char int, end_char int, surface_text string, _hyphen int, _version int"
    found = None
    for k in range(blocks):
        sent = sentences.sparkSession.sparkContext.broadcast([r[0] for r in words.where(F.pmod(F.xxhash64("alias"), F.lit(blocks)) == k).collect()])

        def emit(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = _AliasMatcher(sent.value)
            for b in batches:
                at, rows = [], []
                for i, t in enumerate(b.column(len(keys)).to_pylist()):
                    for alias, a, e, hyphen, version in matcher.find(t) if t else ():
                        at.append(i)
                        rows.append((alias, a, e, t[a:e], int(hyphen), int(version)))
                yield _beside(b, keys, at, rows, ["alias", "start_char", "end_char", "surface_text", "_hyphen", "_version"], "siisii")

        part = sentences.select(*keys, text).mapInArrow(emit, schema)
        found = part if found is None else found.unionByName(part)
    label = F.coalesce("label", F.lit(""))
    out = found.join(index, "alias").where(~((label == HYPHEN_LABEL) & (F.col("_hyphen") == 1)) & ~((label == VERSION_LABEL) & (F.col("_version") == 1)))
    method = F.when(F.col("entries") == 1, "persistent_lexicon").otherwise("persistent_lexicon_ambiguous")
    return out.select(*keys, "label", "start_char", "end_char", "surface_text", "canonical_id", "canonical_name", method.alias("method"))


def select_spans(spans: DataFrame, sentence: str, priority: Column, arrival: str) -> DataFrame:
    """One span per sentence, place and label: of the most trusted channel, then the first; shorter ones than two characters are left out, overlapping ones are kept."""
    known = spans.where(F.length(F.trim("surface_text")) >= 2)
    ranked = known.withColumn("_priority", priority)
    return best_per_key(ranked, [sentence, "start_char", "end_char", "label"], F.struct(F.col("_priority"), (-F.col(arrival)).alias("a"))).drop("_priority")


def merge_channels(channels: list[DataFrame], keys: list[str]) -> DataFrame:
    """The union of channels, each key from the first channel that has it."""
    out = None
    for k, c in enumerate(channels):
        c = c.withColumn("_channel", F.lit(-k))
        out = c if out is None else out.unionByName(c, allowMissingColumns=True)
    rest = [c for c in out.columns if c not in keys and c != "_channel"]
    return out.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("_channel", F.to_json(F.struct(*rest)))).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


#: Constructions that introduce a named system (fixed values); the named group is the name.
INTRODUCTIONS = (
    r"\b(?:(?:This|The)\s+(?:study|paper|work)\s+|We\s+)?(?:introduc(?:e|es|ed|ing)|propos(?:e|es|ed|ing)|present(?:s|ed|ing)?|develop(?:s|ed|ing)?)\s+(?:an?\s+|the\s+)?(?P<name>(?-i:[A-Z])[A-Za-z0-9]*(?:-[A-Za-z0-9]+)*)\s*,?\s+(?:an?\s+|the\s+)?[^.;]{0,65}\b(?:framework|architecture|system|platform|pipeline)\b",
    r"\b(?P<name>(?-i:[A-Z])[A-Za-z0-9]*(?:-[A-Za-z0-9]+)*)\s*,?\s+(?:is|was)\s+(?:introduced|proposed|presented|developed|described)\s+as\s+(?:an?\s+|the\s+)?[^.;]{0,55}\b(?:framework|architecture|system|platform|pipeline)\b",
)


def specific_name(name: Column) -> Column:
    """Whether a name can stand for one thing: four characters or more, not generic, with a hyphen or a capital beyond the first."""
    return (F.length(name) >= 4) & ~normalized(name).isin(*GENERIC_TERMS) & (name.contains("-") | F.substring(name, 2, 200).rlike("[A-Z]"))


def introduced_systems(sentences: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Spans of the names that a sentence introduces as a system and that are specific; a name before "et al" is an author's."""
    spans = pattern_spans(sentences, [("AISystem", p, "introduced_system") for p in INTRODUCTIONS], keys, text, context=8)
    named = specific_name(F.col("surface_text")) & ~F.col("after_text").rlike("(?i)^\\s+et\\s+al\\b")
    return spans.where(named).drop("before_text", "after_text").distinct()


def propagate_names(sentences: DataFrame, names: DataFrame, document: str, keys: list[str], text: str = "text", name: str = "surface_text") -> DataFrame:
    """Every occurrence, in each document, of the names found in it, in any case; a hyphen, a blank and nothing stand for each other.

    Names meet sentences by document and by their letters and digits up to the first blank or hyphen, so a document
    with many sentences is divided by words. Only keys and words are joined for that; the text of a sentence that may
    have names is fetched once, and what remains is checked in place. Occurrences may overlap. Names without a letter
    or digit, and null keys, have none.
    """
    run = "[\\p{L}\\p{N}_]+"
    n = names.select(F.col(document), F.col(name).alias("name")).distinct().withColumn("_w", F.lower(F.regexp_extract("name", run, 0))).where("_w <> ''")
    rows = sentences.select(*dict.fromkeys([document, *keys, text])).where(F.col(text).isNotNull())
    ids = [F.col(k) for k in dict.fromkeys([document, *keys])]
    # A name's parts may be joined in the text, so its first part meets every word that begins with it: by length of the part.
    sizes = n.select(document, F.length("_w").alias("_z")).distinct()
    words = rows.select(*ids, F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(run), F.lit(0)))).alias("_t")).distinct()
    met = words.join(sizes, document).where(F.length("_t") >= F.col("_z")).select(*ids, F.expr("left(_t, _z)").alias("_w")).distinct().join(n, [document, "_w"])
    met = met.groupBy(*ids).agg(F.collect_set("name").alias("_names"))
    kept = rows.join(met, list(dict.fromkeys([document, *keys])))
    schema = _schema(kept, keys) + ", name string, start_char int, end_char int, surface_text string"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, out = [], []
            for i, (t, own) in enumerate(zip(b.column(len(keys)).to_pylist(), b.column(len(keys) + 1).to_pylist())):
                for x in own:
                    body = "[- ]?".join(map(re.escape, filter(None, re.split("[- ]+", x))))
                    for m in re.finditer(rf"(?<!\w)(?=({body})(?!\w))", t, re.I):
                        at.append(i)
                        out.append((x, m.start(), m.end(1), m[1]))
            yield _beside(b, keys, at, out, ["name", "start_char", "end_char", "surface_text"], "siis")

    return kept.select(*keys, text, "_names").mapInArrow(emit, schema).distinct()


def realign(spans: DataFrame, text: str = "text", surface: str = "surface_text", start: str = "start_char") -> DataFrame:
    """Moves each span to the nearest place where its surface really stands; ``aligned`` is false where there is none or two are as near."""

    @F.pandas_udf(T.IntegerType())
    def nearest(texts: pd.Series, surfaces: pd.Series, starts: pd.Series) -> pd.Series:
        out = []
        for t, s, at in zip(texts, surfaces, starts):
            places = [m.start() for m in re.finditer(f"(?={re.escape(s)})", t)] if t is not None and s else []
            best = sorted((abs(p - (0 if pd.isna(at) else at)), p) for p in places)
            out.append(best[0][1] if best and (len(best) == 1 or best[0][0] != best[1][0]) else None)
        return pd.Series(out, dtype="Int32")

    at = nearest(F.col(text), F.col(surface), F.col(start))
    moved = spans.withColumn("_at", at)
    return moved.withColumn("aligned", F.col("_at").isNotNull()).withColumn(start, F.coalesce("_at", start)).withColumn("end_char", F.col(start) + F.length(surface)).drop("_at")


def enumerated_families(spans: DataFrame, sentence: str, document: str, prefix: Column, role: Column, at_least: int = 2) -> DataFrame:
    """``(document, prefix)`` of name families: a sentence names two or more roles with one prefix."""
    one = spans.select(F.col(document), F.col(sentence), prefix.alias("prefix"), role.alias("role")).distinct()
    return one.groupBy(document, sentence, "prefix").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= at_least).select(document, "prefix").distinct()


def near_cue(spans: DataFrame, cues: DataFrame, sentence: str, most: int = 55) -> DataFrame:
    """Spans with the distance to the nearest cue of their sentence, within ``most`` characters."""
    c = cues.select(F.col(sentence), F.col("start_char").alias("_cs"), F.col("end_char").alias("_ce"))
    gap = F.greatest(F.col("start_char") - F.col("_ce"), F.col("_cs") - F.col("end_char"), F.lit(0))
    met = spans.join(c, sentence).withColumn("_gap", gap).where(F.col("_gap") <= most)
    return met.groupBy(sentence, "start_char", "end_char", "surface_text").agg(F.min("_gap").alias("distance"))


def person_names(authors: Column) -> Column:
    """An author string as an array of names without marks and digits; entries without two letters are left out."""
    clean = F.regexp_replace(authors, "[\\d*†‡§¶⁰¹²³⁴⁵⁶⁷⁸⁹]+", "")
    parts = F.split(clean, "\\s*(?:[;|&]|\\band\\b)\\s*")
    names = F.transform(parts, lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, "\\s+", " "), "[,\\s]+$", "")))
    return F.array_distinct(F.filter(names, lambda p: p.rlike("\\p{L}{2}") & ~F.lower(p).rlike("^(et al\\.?|others)$")))


def metadata_mentions(documents: DataFrame, key: str, title: str, authors: str) -> DataFrame:
    """``(key, label, surface_text, confidence)``: the publication and each person of a document's metadata."""
    pub = documents.where(F.trim(title) != "").select(F.col(key), F.lit("Publication").alias("label"), F.trim(title).alias("surface_text"), F.lit(1.0).alias("confidence"))
    people = documents.select(F.col(key), F.lit("Person").alias("label"), F.explode(person_names(F.col(authors))).alias("surface_text"), F.lit(0.98).alias("confidence"))
    return pub.unionByName(people)


def mention_key(label: Column, kind: Column, field: Column, name: Column, surface: Column, sentence: Column, start: Column, end: Column) -> Column:
    """What makes two mentions of a document one: for metadata the label, field and normalised name, else the label and the exact place."""
    of_metadata = F.to_json(F.array(label, F.coalesce(field, F.lit("")), normalized(F.coalesce(F.when(name != "", name), surface, F.lit("")))))
    place = F.to_json(F.array(label, F.coalesce(sentence, F.lit("")), F.coalesce(start.cast("string"), F.lit("")), F.coalesce(end.cast("string"), F.lit(""))))
    return F.when(kind == "document_metadata", F.concat(F.lit("m"), of_metadata)).otherwise(F.concat(F.lit("s"), place))


def distinct_mentions(mentions: DataFrame, arrival: str = "arrival") -> DataFrame:
    """The first of the mentions of each document that are one by ``mention_key``, in order of ``arrival`` (unique within a document).

    ``mentions(document_id, label, kind, field, canonical_name, surface_text, sentence_id, start_char, end_char)``; distinct
    values of one metadata field stay apart.
    """
    key = mention_key(*[F.col(c) for c in ("label", "kind", "field", "canonical_name", "surface_text", "sentence_id", "start_char", "end_char")])
    rows = mentions.withColumn("_key", key)
    return best_per_key(rows, ["document_id", "_key"], F.struct((-F.col(arrival)).alias("a"))).drop("_key").select(*mentions.columns)


#: Channels of the alternative generator with their confidence, from the most to the least trusted (fixed values).
ALTERNATIVE_CHANNELS = {"specific_lexicon": 0.94, "rule_candidate": 0.72, "challenge_candidate": 0.72, "quantity_candidate": 0.72, "result_candidate": 0.72, "claim_candidate": 0.72}
_SURROUND = " ,;:()"


def alternative_candidates(sentences: DataFrame, patterns: list[tuple[str, str, str]], keys: list[str], text: str = "text", quantity: str | None = None, result: str | None = None, claim: str | None = None, leading: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(chosen, rejected)`` candidates of six channels, one label for each place.

    ``patterns`` are ``(label, pattern, channel)`` for the channels specific_lexicon, rule_candidate and
    challenge_candidate (of which only a sentence's first match counts). ``quantity`` has a named group ``unit``, whose
    matches are conditions; a sentence with any and with a match of ``result`` is an observation as a whole, one with a
    match of ``claim`` a claim. Surrounding marks, and what ``leading`` matches before a rule's match, are no part of a
    span; spans of one character are none. Of several labels for one place that of the most trusted channel is chosen,
    of equals the last by name; the others come out as rejected, with the chosen label.
    """
    schema = _schema(sentences, keys) + ", label string, start_char int, end_char int, surface_text string, method string"
    names = ["label", "start_char", "end_char", "surface_text", "method"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(label, re.compile(p, re.I), channel) for label, p, channel in patterns]
        amount, outcome, stated, lead = (re.compile(p, re.I) if p else None for p in (quantity, result, claim, leading))

        def found(t: str) -> Iterator[tuple[str, int, int, str]]:
            for label, p, channel in compiled:
                for m in p.finditer(t):
                    yield label, *m.span(next(iter(p.groupindex), 0)), channel
                    if channel == "challenge_candidate":
                        break
            amounts = list(amount.finditer(t)) if amount else []
            for m in amounts:
                if m["unit"]:
                    yield "Condition", *m.span(), "quantity_candidate"
            if amounts and outcome and outcome.search(t):
                yield "Observation", 0, len(t), "result_candidate"
            if stated and stated.search(t):
                yield "Claim", 0, len(t), "claim_candidate"

        for b in batches:
            at, rows = [], []
            for i, t in enumerate(b.column(len(keys)).to_pylist()):
                for label, a, e, channel in found(t) if t else ():
                    if lead and channel == "rule_candidate" and (m := lead.match(t[a:e])):
                        a += m.end()
                    while a < e and t[a] in _SURROUND:
                        a += 1
                    while e > a and t[e - 1] in _SURROUND:
                        e -= 1
                    if e - a >= 2:
                        at.append(i)
                        rows.append((label, a, e, t[a:e], channel))
            yield _beside(b, keys, at, rows, names, "siiss")

    spans = sentences.select(*keys, text).mapInArrow(emit, schema).distinct()
    trust = F.coalesce(*[F.when(F.col("method") == c, F.lit(v)) for c, v in ALTERNATIVE_CHANNELS.items()])
    spans = spans.withColumn("base_confidence", trust)
    place = [*keys, "start_char", "end_char"]
    best = spans.groupBy(*place).agg(F.max(F.struct("base_confidence", "label", "method")).alias("_b"))
    judged = spans.join(best, place)
    chosen = (F.col("label") == F.col("_b.label")) & (F.col("method") == F.col("_b.method"))
    return judged.where(chosen).drop("_b"), judged.where(~chosen).withColumn("chosen_label", F.col("_b.label")).withColumn("reason", F.lit("ambiguous_span_lower_ranked_label")).drop("_b")

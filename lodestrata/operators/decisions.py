"""Gates that turn judgments into accepted, reviewed and rejected rows; references; observations; replay of decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.ids import normalized
from lodestrata.operators.spans import GENERIC_TERMS
from lodestrata.operators.windows import best_per_key

#: Gates of a relationship, in the order in which they are reported (fixed values).
RELATION_GATES = ("confirmed", "endpoints_resolved", "nodes_accepted", "endpoint_text_exact", "not_self", "predicate_permitted", "domain_range", "trigger_exact", "not_negated", "not_modal", "not_hypothetical", "attribution_accepted")


def no(col: Column) -> Column:
    """A null condition is false."""
    return F.coalesce(col, F.lit(False))


def grounded(surface: Column, name: Column, prior_names: Column | None = None) -> Column:
    """Whether a name comes from its span: the normalised name is inside the normalised surface; or, for a name mapped to an earlier node, one of that node's names equals the surface or contains it or is contained, four letters at least."""
    s, n = normalized(surface), normalized(name)
    own = no((n != "") & (s != "") & F.contains(s, n))
    if prior_names is None:
        return own
    fits = F.exists(F.transform(prior_names, lambda v: normalized(v)), lambda v: (v != "") & (s != "") & ((v == s) | ((F.least(F.length(v), F.length(s)) >= 4) & (F.contains(v, s) | F.contains(s, v)))))
    return F.when(prior_names.isNotNull() & (F.size(prior_names) > 0), no(fits)).otherwise(own)


def label_supported(selected: Column, own: Column, alternatives: Column) -> Column:
    """Whether the judged label is the candidate's own or one of its alternatives; a candidate without any label passes."""
    known = F.array_except(F.array_compact(F.concat(F.array(own), F.coalesce(alternatives, F.array().cast("array<string>")))), F.array(F.lit(""), F.lit("NONE")))
    return (F.size(known) == 0) | no(F.array_contains(known, selected))


def adjudicate(candidates: DataFrame, judgments: DataFrame, key: str = "candidate_id") -> DataFrame:
    """Candidates with ``outcome`` and ``reason_code``, from ``judgments(key, decision, ontology_label, judged_name)``.

    Accepted: the judge accepts, the name is specific and grounded, the label supported. An accepted one with an
    unsupported label and a reviewed one stay for review; what is generic or not grounded is rejected. Candidates
    without a sentence are rejected before any judge sees them, candidates without a judgment stay for review.
    Of several judgments of one candidate the first by decision counts.
    """
    one = judgments.groupBy(key).agg(F.min(F.struct("decision", "ontology_label", "judged_name")).alias("_j"))
    c = candidates.join(one, key, "left")
    clear = ~no(normalized(F.col("_j.judged_name")).isin(*GENERIC_TERMS))
    real = grounded(F.col("surface_text"), F.col("_j.judged_name"))
    fits = label_supported(F.col("_j.ontology_label"), F.col("label"), F.col("alternatives"))
    decision = F.col("_j.decision")
    reason = (
        F.when(F.coalesce(F.trim("sentence_id"), F.lit("")) == "", "untraceable")
        .when(decision.isNull(), "unjudged")
        .when(~clear, "generic_name")
        .when(~real, "not_grounded")
        .when((decision == "accept") & fits, "accepted")
        .when(decision == "accept", "unsupported_label")
        .when(decision == "review", "judge_review")
        .otherwise("judge_reject")
    )
    out = c.withColumn("reason_code", reason)
    outcome = F.when(F.col("reason_code") == "accepted", "accept").when(F.col("reason_code").isin("unjudged", "unsupported_label", "judge_review"), "review").otherwise("reject")
    label = F.when(F.col("_j.ontology_label").isNotNull() & (F.col("_j.ontology_label") != "NONE"), F.col("_j.ontology_label")).otherwise(F.col("label"))
    return out.withColumn("outcome", outcome).withColumn("final_label", label).drop("_j")


def without_model(candidates: DataFrame) -> DataFrame:
    """What happens without a judge: untraceable candidates are rejected, all others stay for review."""
    lost = F.coalesce(F.trim("sentence_id"), F.lit("")) == ""
    return candidates.withColumn("outcome", F.when(lost, "reject").otherwise("review")).withColumn("reason_code", F.when(lost, "untraceable").otherwise("unjudged"))


def repair_judgments(expected: DataFrame, returned: DataFrame, key: str = "candidate_id") -> DataFrame:
    """Exactly one judgment for each expected candidate: unknown ones are dropped, repeats reduced to the first by decision, missing ones made up as ``review`` and empty reasons filled."""
    one = returned.groupBy(key).agg(F.min(F.struct("decision", "reason")).alias("_r"), F.count(F.lit(1)).alias("_n"))
    out = expected.select(key).distinct().join(one, key, "left")
    repair = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "repeated").when(F.coalesce(F.trim("_r.reason"), F.lit("")) == "", "no_reason").otherwise("none")
    return out.select(key, F.coalesce("_r.decision", F.lit("review")).alias("decision"), F.when(F.coalesce(F.trim("_r.reason"), F.lit("")) == "", "No reason was given.").otherwise(F.col("_r.reason")).alias("reason"), repair.alias("repair"))


def replay(candidates: DataFrame, recorded: DataFrame, key: str = "candidate_id", at: str = "reviewed_at", tie: str = "decision_id") -> DataFrame:
    """Candidates with their latest recorded decision: the offline judge."""
    rest = [c for c in recorded.columns if c != key]
    latest = recorded.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(at, tie)).alias("_d"))
    return candidates.join(latest.select(key, "_d.*"), key, "left")


def not_yet_trusted(review: DataFrame, trusted: DataFrame, keys: list[str], surface: str = "surface_text") -> DataFrame:
    """Candidates for review without those whose place and normalised surface are trusted already."""
    t = trusted.select(*keys, normalized(surface).alias("_s")).distinct()
    return review.withColumn("_s", normalized(surface)).join(t, [*keys, "_s"], "left_anti").drop("_s")


def reference_outcome(candidates: DataFrame, key: str, distance: str, identity: str, strong: Column, plural: Column, gap: Column, nearest_within: int = 1, most_distance: int = 2, most_candidates: int = 5) -> DataFrame:
    """``(key, outcome, candidates, nearest)``: resolved if a strong singular reference has one nearest identity close by, review if there are a few candidates, else ignored.

    Several mentions of one identity are one candidate, the nearest.
    """
    one = candidates.where(F.col(distance).between(0, most_distance)).groupBy(key, identity).agg(F.min(distance).alias("_d"), F.max(strong).alias("_s"), F.max(plural).alias("_p"), F.min(gap).alias("_g"))
    nearest = one.groupBy(key).agg(F.min("_d").alias("nearest"), F.count(F.lit(1)).alias("candidates"), F.max("_s").alias("_s"), F.max("_p").alias("_p"), F.min(F.struct("_d", "_g")).alias("_first"), F.count_if(F.col("_d") == 0).alias("_n0"), F.count_if(F.col("_d") == 1).alias("_n1"), F.count_if(F.col("_d") == 2).alias("_n2"))
    unique = F.when(F.col("nearest") == 0, F.col("_n0")).when(F.col("nearest") == 1, F.col("_n1")).otherwise(F.col("_n2")) == 1
    auto = no(F.col("_s")) & ~no(F.col("_p")) & unique & (F.col("nearest") <= nearest_within) & ((F.col("nearest") > 0) | (F.col("_first._g") <= 250))
    return nearest.select(key, F.when(auto, "resolved").when(F.col("candidates") <= most_candidates, "review").otherwise("ignored").alias("outcome"), "candidates", "nearest")


def pairwise_verdict(judged: DataFrame, key: str, decision: str, confidence: str, threshold: float = 0.8) -> DataFrame:
    """``(key, status)`` from judged pairs: resolved if just one is SAME with enough confidence and all others are DIFFERENT, ignored if all are DIFFERENT, else pending."""
    d = F.upper(F.trim(decision))
    sure = (d == "SAME") & (F.col(confidence) >= threshold)
    agg = judged.groupBy(key).agg(F.count(F.lit(1)).alias("pairs"), F.count_if(sure).alias("same"), F.count_if(d == "DIFFERENT").alias("different"))
    status = F.when((F.col("same") == 1) & (F.col("different") == F.col("pairs") - 1), "resolved").when(F.col("different") == F.col("pairs"), "ignored").otherwise("pending")
    return agg.select(key, "pairs", "same", "different", status.alias("status"))


def relation_status(proposals: DataFrame, gates: dict[str, Column], minimum: float = 0.75, decision: str = "decision", confidence: str = "confidence") -> DataFrame:
    """``status`` and ``failed_gates`` of relationship proposals.

    In order: not accepted by the judge is rejected; an endpoint that is not resolved but stands in the text is
    unresolved; low confidence is review; any failed gate is rejected; the rest is accepted.
    """
    missing = set(RELATION_GATES) - set(gates)
    if missing:
        raise ValueError(f"gates are missing: {sorted(missing)}")
    held = proposals.withColumns({f"_g_{g}": no(gates[g]) for g in RELATION_GATES})
    failed = F.array_compact(F.array(*[F.when(~F.col(f"_g_{g}"), F.lit(g)) for g in RELATION_GATES]))
    status = (
        F.when(no(F.col(decision) != "accept") | F.col(decision).isNull(), "rejected")
        .when(~F.col("_g_endpoints_resolved") & F.col("_g_endpoint_text_exact"), "unresolved")
        .when(F.coalesce(F.col(confidence), F.lit(0.0)) < minimum, "review")
        .when(F.size(failed) > 0, "rejected")
        .otherwise("accepted")
    )
    return held.withColumn("failed_gates", failed).withColumn("status", status).drop(*[f"_g_{g}" for g in RELATION_GATES])


def normalize_windows(expected: DataFrame, returned: DataFrame, key: str = "window_id") -> DataFrame:
    """One row per expected window and proposal: windows that no judge answered get an audit row, answers to unknown windows are dropped, repeats of a proposal removed."""
    known = returned.join(expected.select(key).distinct(), key, "left_semi").distinct()
    missing = expected.select(key).distinct().join(known.select(key).distinct(), key, "left_anti")
    return known.withColumn("answered", F.lit(True)).unionByName(missing.withColumn("answered", F.lit(False)), allowMissingColumns=True)


def unknown_endpoints(proposals: DataFrame, missing: Column, keys: list[str], order: str) -> DataFrame:
    """One audit row per missing role and key, the last in order."""
    rows = proposals.select("*", F.explode(missing).alias("role"))
    return best_per_key(rows, [*keys, "role"], F.struct(order))


def confidence_band(confidence: Column) -> Column:
    """An assertion's confidence, at most .99, and whether it is high."""
    c = F.least(confidence, F.lit(0.99))
    return F.struct(c.alias("confidence"), F.when(c >= 0.9, "high").otherwise("moderate").alias("band"))


#: Phrases of plans and modality, and of results (fixed values).
PLANNED = "(?i)\\b(future work|will aim|will be|would|could|may|might|expected to|plans? to|aims? to|potential to)\\b"
FIRST_PERSON = "(?i)\\b(we|our|this (study|paper|work)|the proposed|our (model|method|approach))\\b"
CITATION = "\\[[0-9,;\\s-]+\\]|\\b[A-Z][A-Za-z-]+\\s+et\\s+al\\.|\\([A-Z][A-Za-z-]+(\\s+et\\s+al\\.)?,\\s*\\d{4}[a-z,]*\\)"
ATTRIBUTED = "(?i)\\b(proposed|developed|used|applied|demonstrated|reported|found|showed|achieved|optimized|trained|removed)\\b"
RESULT = "(?i)\\b(remov(e|es|ed|al)|measur(e|es|ed)|observ(e|es|ed)|detect(s|ed)?|predict(s|ed|ion)?|reduc(e|es|ed|tion)|increas(e|es|ed)|decreas(e|es|ed)|achiev(e|es|ed)|efficien(cy|t)|concentration)\\b"
#: Units of measurements, as patterns in their order (fixed values).
UNITS = ("%", "percent", "mg(?:N)?/L", "[µu]g/L", "ng/L", "ppm", "ppb", "°C", "K", "h", "hr", "hours?", "min", "minutes?", "days?", "gCO[^\\s,.;)]*")
MEASUREMENT = f"(?i)(\\d+(?:\\.\\d+)?)\\s*({'|'.join(UNITS)})(?=$|[^A-Za-z0-9])"


def current_study(text: Column, section_title: Column | None = None) -> Column:
    """Whether a sentence reports the work at hand: no plan or modality, no cited claim of others, no section on related work unless it speaks in the first person."""
    first = text.rlike(FIRST_PERSON)
    cited = text.rlike(CITATION) & text.rlike(ATTRIBUTED) & ~first
    related = F.lit(False) if section_title is None else no(section_title.rlike("(?i)\\b(related work|literature review)\\b")) & ~first
    return no(~text.rlike(PLANNED) & ~cited & ~related)


def observations(sentences: DataFrame, keys: list[str], text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """Sentences that report a result with a measurement: ``values`` and ``units`` in order; those in ``known`` are left out."""
    t = F.col(text)
    rows = sentences.where(current_study(t) & t.rlike(RESULT) & t.rlike(MEASUREMENT))
    rows = rows.select(*keys, F.regexp_extract_all(t, F.lit(MEASUREMENT), F.lit(1)).alias("values"), F.regexp_extract_all(t, F.lit(MEASUREMENT), F.lit(2)).alias("units"))
    return rows.join(known.select(*keys).distinct(), keys, "left_anti") if known is not None else rows

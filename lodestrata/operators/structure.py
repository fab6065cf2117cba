"""Paragraphs, sections, chunks and checks of parsed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.ids import parser_id
from lodestrata.functions.text import begins_list_item, has_terminal_punctuation, heading_depth, looks_like_heading, split_sentences, starts_like_continuation

#: What divides paragraphs, once all line ends are line feeds.
_BLANK_LINE = "\n[ \t]*(?:\n[ \t]*)+"


def islands(rows: DataFrame, partition: list[str], order: list[str], starts: Column, name: str = "island") -> DataFrame:
    """Numbers from 1 the runs of rows that begin where ``starts`` holds; the first row always begins one."""
    w = Window.partitionBy(*partition).orderBy(*order)
    first = F.row_number().over(w) == 1
    return rows.withColumn(name, F.sum(F.when(first | F.coalesce(starts, F.lit(False)), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))


def paragraphs_of_text(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ordinal, text)``: the parts between blank lines, each on one line; null and blank texts have none. No shuffle."""
    return documents.select(F.col(key), F.posexplode(_paragraphs(F.col(text))).alias("ordinal", "text"))


def _paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.regexp_replace(text, "\r\n?", "\n"), _BLANK_LINE), lambda p: F.trim(F.regexp_replace(p, "\\s+", " "))), lambda p: p != "")


def sentences_of(paragraphs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``(keys, ordinal, text)`` of the sentences of each paragraph."""
    return paragraphs.select(*keys, F.posexplode(split_sentences(text)).alias("ordinal", "text"))


def sentence_arrays(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, sentences)``: each document's sentences in order as ``(paragraph, ordinal, text)``, in one row and without a shuffle."""
    in_paragraph = lambda p, i: F.transform(split_sentences(p), lambda s, k: F.struct(i.alias("paragraph"), k.alias("ordinal"), s.alias("text")))
    return documents.where(F.col(text).isNotNull()).select(key, F.flatten(F.transform(_paragraphs(F.col(text)), in_paragraph)).alias("sentences"))


def group_lines(lines: DataFrame, partition: list[str], order: list[str], text: str = "text") -> DataFrame:
    """Lines numbered by paragraph: one begins at a list item, after a line with a final stop, or where a line starts anew."""
    before = F.lag(text).over(Window.partitionBy(*partition).orderBy(*order))
    ended = has_terminal_punctuation(F.rtrim(before))
    return islands(lines, partition, order, begins_list_item(F.col(text)) | (ended & ~starts_like_continuation(F.col(text))), "paragraph")


def merge_paragraphs(groups: DataFrame, partition: list[str], paragraph: str = "paragraph", order: str = "seq", text: str = "text") -> DataFrame:
    """One row per paragraph: its lines joined in order and their number; paragraphs of digits only or without a final stop are left out."""
    joined = groups.groupBy(*partition, paragraph).agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("_l"))
    whole = F.trim(F.regexp_replace(F.array_join(F.transform("_l", lambda x: x[text]), " "), "\\s+", " "))
    out = joined.select(*partition, paragraph, whole.alias("text"), F.size("_l").alias("lines"))
    return out.where(~F.col("text").rlike("^[\\d\\s.,]*$") & has_terminal_punctuation(F.col("text")))


def assign_sections(paragraphs: DataFrame, key: str = "doc_id", order: str = "ordinal", text: str = "text") -> DataFrame:
    """Adds ``is_heading``, ``section`` (0 before the first heading) and ``section_title``; consecutive paragraphs below one heading share a section."""
    w = Window.partitionBy(key).orderBy(order)
    out = paragraphs.withColumn("is_heading", looks_like_heading(text))
    out = out.withColumn("section", F.sum(F.col("is_heading").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    title = F.last(F.when(F.col("is_heading"), F.col(text)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn("section_title", F.coalesce(title, F.lit("")))


def section_hierarchy(sections: DataFrame, key: str = "doc_id", order: str = "section", title: str = "section_title", most_levels: int = 6) -> DataFrame:
    """Adds ``level`` and ``parent``: the nearest earlier section of the document with a smaller level, null for none.

    One window pass: the last section of each level so far is kept, and the parent is the latest of those above.
    """
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = sections.withColumn("level", F.least(heading_depth(title), F.lit(most_levels)))
    last = [F.last(F.when(F.col("level") == k, F.col(order)), ignorenulls=True).over(w) for k in range(1, most_levels)]
    out = out.withColumns({f"_l{k + 1}": c for k, c in enumerate(last)})
    above = [F.when(F.col("level") > k + 1, F.coalesce(F.col(f"_l{k + 1}"), F.lit(-1))) for k in range(most_levels - 1)]
    parent = F.array_max(F.array(*[F.coalesce(c, F.lit(-1)) for c in above]))
    return out.withColumn("parent", F.when(parent >= 0, parent).cast("int")).drop(*[f"_l{k + 1}" for k in range(most_levels - 1)])


def chunks(sections: DataFrame, key: str = "doc_id") -> DataFrame:
    """Three levels in one table: ``type``, ``chunk_id``, ``parent_id``, ``ordinal``, ``character_count``.

    ``sections`` is the result of ``assign_sections``. A section's chunk is the join of its paragraphs.
    """
    body = sections.where(~F.col("is_heading"))
    section_id = parser_id("sec", key, "section", "section_title")
    paragraph_id = parser_id("para", key, "section", "ordinal")
    paras = body.select(F.lit("paragraph").alias("type"), paragraph_id.alias("chunk_id"), section_id.alias("parent_id"), F.col("ordinal").cast("int").alias("ordinal"), F.length("text").cast("int").alias("character_count"))
    secs = body.groupBy(key, "section", "section_title").agg((F.sum(F.length("text")) + F.count(F.lit(1)) - 1).cast("int").alias("character_count"))
    secs = secs.select(F.lit("section").alias("type"), section_id.alias("chunk_id"), F.col(key).cast("string").alias("parent_id"), F.col("section").cast("int").alias("ordinal"), "character_count")
    sents = sentences_of(body.select(paragraph_id.alias("pid"), "text"), ["pid"]).select(F.lit("sentence").alias("type"), parser_id("sent", "pid", "ordinal").alias("chunk_id"), F.col("pid").alias("parent_id"), F.col("ordinal").cast("int").alias("ordinal"), F.length("text").cast("int").alias("character_count"))
    return secs.unionByName(paras).unionByName(sents)


def plain_text(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text)``: the paragraphs of a document in order with blank lines between them, without a shuffle; documents without any give no row."""
    return documents.select(key, F.array_join(_paragraphs(F.col(text)), "\n\n").alias("text")).where("text <> ''")


def quality_issues(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, issues)``: codes of what looks wrong with a document's text, sorted."""
    t = F.coalesce(F.col(text), F.lit(""))
    checks = {
        "empty_text": F.trim(t) == "",
        "short_text": (F.trim(t) != "") & (F.length(t) < 80),
        "long_text": F.length(t) > 20_000,
        "no_stop": (F.trim(t) != "") & ~t.rlike("[.!?]"),
        "glyph_codes": t.contains("cid:"),
        "replacement_character": t.contains("�"),
        "soft_hyphen": t.contains("­"),
        "carriage_return": t.contains("\r"),
        "double_blank": t.contains("  "),
    }
    return documents.select(F.col(key), F.sort_array(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in checks.items()]))).alias("issues"))


def parse_summary(paragraphs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of each document after ``assign_sections``: sections, paragraphs, sentences, characters and warnings."""
    body = paragraphs.where(~F.col("is_heading")).withColumn("_n", F.size(split_sentences("text")))
    out = body.groupBy(key).agg(F.count_distinct("section").alias("sections"), F.count(F.lit(1)).alias("paragraphs"), F.sum("_n").alias("sentences"), F.sum(F.length("text")).alias("characters"))
    warnings = F.array_join(F.array_compact(F.array(F.when(F.col("characters") < 250, F.lit("low_text")), F.when(F.col("sentences") == 0, F.lit("no_sentences")))), ";")
    return out.withColumn("warnings", warnings)


def integrity(rows: DataFrame, key: str, unit_id: str, ordinal: str) -> DataFrame:
    """``(key, duplicate_ids, gaps)``: how many ids repeat within a document, and whether its ordinals count from 0 without a gap."""
    agg = rows.groupBy(key).agg(F.count(unit_id).alias("_n"), F.count_distinct(unit_id).alias("_d"), F.min(ordinal).alias("_lo"), F.max(ordinal).alias("_hi"), F.count_distinct(ordinal).alias("_o"))
    return agg.select(key, (F.col("_n") - F.col("_d")).alias("duplicate_ids"), ((F.col("_lo") != 0) | (F.col("_hi") - F.col("_lo") + 1 != F.col("_o"))).alias("gaps"))


def inspect_lines(lines: DataFrame, pattern: str | None = None, page: int | None = None, limit: int | None = None) -> DataFrame:
    """Lines that meet a pattern, on a page, the first ones of the reading order."""
    out = lines.where(F.col("text").rlike(pattern)) if pattern else lines
    out = out.where(F.col("page") == page) if page is not None else out
    return out.orderBy("document_id", "page", "seq").limit(limit) if limit is not None else out

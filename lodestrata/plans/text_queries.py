"""Queries of the parsing, structure, window and span operators over the document and mention tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.functions import ids
from lodestrata.functions.skew import positions
from lodestrata.functions.text import split_sentences
from lodestrata.operators import audit, layout, references, spans, structure, windows
from lodestrata.sources import files


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return structure.paragraphs_of_text(_read(spark, sf, "documents"))


def _sections(spark: SparkSession, sf: str) -> DataFrame:
    return structure.assign_sections(_paragraphs(spark, sf))


def _sentences(spark: SparkSession, sf: str) -> DataFrame:
    p = _paragraphs(spark, sf).withColumnRenamed("ordinal", "paragraph")
    s = structure.sentences_of(p, ["doc_id", "paragraph"])
    return s.withColumn("pos", (F.row_number().over(Window.partitionBy("doc_id").orderBy("paragraph", "ordinal")) - 1).cast("int"))


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    t = _read(spark, sf, "documents").select("doc_id", "source", F.posexplode(F.split("text", "\r\n|\r|\n")).alias("seq", "text"))
    return t.withColumn("text", F.trim(F.regexp_replace("text", "\\s+", " "))).where("text <> ''")


def sentences(spark, sf):
    p = _paragraphs(spark, sf).withColumnRenamed("ordinal", "paragraph")
    return structure.sentences_of(p, ["doc_id", "paragraph"])


def parse_audit(spark, sf):
    s = _sections(spark, sf)
    body = s.where(~F.col("is_heading")).withColumn("sentences", split_sentences("text"))
    papers = files.latest_per_key(_read(spark, sf, "manifest").select("id", "title", "authors", "added_at"), "id", "added_at", "title")
    d = _read(spark, sf, "documents").select("doc_id", F.col("paper_id").alias("id")).join(papers, "id", "left").select("doc_id", "title", F.col("authors").alias("authors_text"), F.lit(None).cast("int").alias("pages"), F.lit(1.0).alias("narrative_page_ratio"), F.lit(None).cast("int").alias("last_narrative_page"))
    heads = s.where("is_heading").select("doc_id", F.col("text").alias("title"))
    return audit.parse_issues(d, heads, body, "doc_id").select("doc_id", F.array_join("issues", ";").alias("issues"))


def mention_codes(spark, sf):
    r = _read(spark, sf, "reference_resolution_ignored")
    sentences = r.select(F.explode("source.context_sentences").alias("s")).select("s.sentence_id", "s.text")
    m = r.select(F.col("resolution_id").alias("mention_id"), F.col("reference_head").alias("label"), "source.kind", "source.sentence_id", "source.start_char", "source.end_char", "source.quote", "surface_text", "source.paragraph_id", "source.section_id")
    parents = m.select(F.col("paragraph_id").alias("unit_id")).unionByName(r.select(F.explode("source.context_sentences.paragraph_id").alias("unit_id"))).where("unit_id is not null")
    return audit.mention_codes(m, sentences, m.where("label is not null").groupBy("label").count().where("count > 5").select("label"), parents)


def resolution_codes(spark, sf):
    log = _read(spark, sf, "entity_resolution_decisions")
    r = log.select(F.col("decision_id").alias("resolution_id"), F.trim("left_entity_id").alias("left_mention_id"), F.trim("right_entity_id").alias("right_mention_id"), F.lit(False).alias("auto_merged"))
    return audit.resolution_codes(r, _read(spark, sf, "entities").select(F.col("entity_id").alias("mention_id"))).groupBy("code", "id").agg(F.sum("n").alias("n"))


def stable_ids(spark, sf):
    d = _read(spark, sf, "documents")
    return d.select("doc_id", ids.parser_id("doc", "paper_id", "section_title").alias("parser_id"), ids.stable_id("node", "document_id", "lang").alias("node_id"), ids.core_id("core", "doc_id", "source").alias("core_id"))


def normalized_names(spark, sf):
    n = _read(spark, sf, "entities").select("canonical_name").distinct()
    return n.select("canonical_name", ids.normalized("canonical_name").alias("normalized"), ids.compact_label("canonical_name").alias("compact"), ids.acronym("canonical_name").alias("acronym"))


def document_sections(spark, sf):
    s = _sections(spark, sf)
    return s.groupBy("doc_id", "section", "section_title").agg(F.count_if(~F.col("is_heading")).alias("paragraphs"), F.sum(F.when(~F.col("is_heading"), F.length("text")).otherwise(0)).cast("long").alias("characters"))


def document_chunks(spark, sf):
    c = structure.chunks(_sections(spark, sf))
    return c.groupBy("type").agg(F.count(F.lit(1)).alias("chunks"), F.count_distinct("chunk_id").alias("ids"), F.sum("character_count").alias("characters"))


def section_hierarchy(spark, sf):
    s = _sections(spark, sf).where("is_heading").select("doc_id", "section", "section_title")
    return structure.section_hierarchy(s).select("doc_id", "section", F.col("level").cast("int").alias("level"), "parent")


def repeated_furniture(spark, sf):
    d = _lines(spark, sf).where("source is not null")
    return layout.repeated_furniture(d, "source", "doc_id", "text", at_least=2, share=1 / 200)


def paragraph_islands(spark, sf):
    g = structure.group_lines(_lines(spark, sf), ["doc_id"], ["seq"])
    return g.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.max("paragraph").alias("paragraphs"))


def quality_issues(spark, sf):
    return structure.quality_issues(_read(spark, sf, "documents")).select("doc_id", F.array_join("issues", ";").alias("issues"))


def context_windows(spark, sf):
    w = windows.context_arrays(structure.sentence_arrays(_read(spark, sf, "documents")), "sentences")
    return w.select("doc_id", "pos", F.array_join(F.transform("context", lambda x: x["role"]), ",").alias("roles"), F.array_join(F.transform("context", lambda x: x["sentence"]["text"]), " | ").alias("window_text"))


def section_windows(spark, sf):
    """Windows within sections, over the rows of a shuffle."""
    s = _sentences(spark, sf).join(_sections(spark, sf).select("doc_id", F.col("ordinal").alias("paragraph"), "section"), ["doc_id", "paragraph"])
    w = windows.context_windows(s, ["doc_id", "section"], "pos", fields=())
    return w.select("doc_id", "pos", "section", F.array_join(F.transform("context", lambda x: x["at"]), ",").alias("near"))


def sentence_batches(spark, sf):
    s = structure.sentence_arrays(_read(spark, sf, "documents")).select("doc_id", F.size("sentences").alias("sentences"))
    return windows.batches(s, ["doc_id"], 50).select("doc_id", "batch")


def antecedent_windows(spark, sf):
    w = windows.context_arrays(structure.sentence_arrays(_read(spark, sf, "documents")), "sentences", before=2, after=0)
    return w.select("doc_id", "pos", F.size("context").alias("size"), F.length(F.col("context")[0]["sentence"]["text"]).cast("long").alias("first_length"))


def alias_ambiguity(spark, sf):
    return spans.alias_index(_read(spark, sf, "lexicon")).select("alias_key", "canonical_id", "entries").distinct()


def lexicon_lookup(spark, sf):
    m = _read(spark, sf, "reference_resolution_ignored").select("resolution_id", "surface_text").distinct()
    return spans.find_entries(m, _read(spark, sf, "lexicon"), "surface_text").select("resolution_id", "surface_text", "canonical_id")


def lexicon_spans(spark, sf):
    m = _read(spark, sf, "reference_resolution_ignored").select("resolution_id", F.col("source.evidence_quote").alias("text")).distinct()
    return spans.lexicon_spans(m, _read(spark, sf, "lexicon"), ["resolution_id"])


def span_selection(spark, sf):
    m = _read(spark, sf, "reference_resolution_ignored")
    s = m.select(F.col("source.sentence_id").alias("sentence_id"), F.col("source.start_char").alias("start_char"), F.col("source.end_char").alias("end_char"), F.coalesce("reference_head", F.lit("")).alias("label"), "surface_text", F.unix_micros(F.col("recorded_at").cast("timestamp")).alias("arrival")).where("sentence_id is not null and start_char is not null")
    return spans.select_spans(s, "sentence_id", F.length("surface_text"), "arrival").select("sentence_id", "start_char", "end_char", "label", F.length("surface_text").alias("surface_length"), "arrival")


def reference_words(spark, sf):
    t = _read(spark, sf, "documents").where("text is not null")
    head = "(?i)\\b(this|that|the|our|these|those) (model|method|system|platform|approach|framework|process|agent|tool|dataset|database)s?\\b"
    return t.select("doc_id", F.regexp_count("text", F.lit(head)).cast("long").alias("noun_phrases"), F.regexp_count("text", F.lit("(?i)\\b(it|they|them)\\b")).cast("long").alias("pronouns"))


def antecedent_asof(spark, sf):
    p = positions(_read(spark, sf, "events").select("user_id", "event_id", "event_type", "ts"), "user_id", ["ts", "event_id"])
    t = p.where("event_type = 'error'").withColumnRenamed("event_id", "target_id")
    c = p.where("event_type <> 'error'").withColumnRenamed("event_id", "candidate_id")
    return windows.nearest_before(t, c, "user_id", "pos").select("user_id", "target_id", "candidate_id", "distance", "rank", "nearest_unique")


def metadata_mentions(spark, sf):
    m = _read(spark, sf, "manifest").select("id", "title", "authors").distinct()
    return spans.metadata_mentions(m, "id", "title", "authors")


def content_dedupe(spark, sf):
    d = _read(spark, sf, "documents").where("text is not null").select(F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.col("document_id").alias("path"))
    return files.distinct_contents(d).select("sha256", "first_location", "locations", "copies")


def latest_run(spark, sf):
    e = _read(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return files.latest_per_key(e, "user_id", "ts", "event_id").select("user_id", "event_id", "event_type")


def parse_summary(spark, sf):
    return structure.parse_summary(_sections(spark, sf))


def plain_text(spark, sf):
    t = structure.plain_text(_read(spark, sf, "documents"))
    return t.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_hash"), F.length("text").alias("n"))


def paragraph_integrity(spark, sf):
    p = _paragraphs(spark, sf).withColumn("unit", ids.parser_id("para", "doc_id", "text"))
    return structure.integrity(p, "doc_id", "unit", "ordinal")


def name_propagation(spark, sf):
    m = _read(spark, sf, "reference_resolution_ignored").where("document_id is not null").select("document_id", "resolution_id", "surface_text", F.col("source.evidence_quote").alias("text")).distinct()
    return spans.propagate_names(m.where("text is not null"), m, "document_id", ["document_id", "resolution_id"]).select("document_id", "resolution_id", "name", "start_char", "end_char")


def distinct_mentions(spark, sf):
    m = _read(spark, sf, "reference_resolution_ignored").where("document_id is not null and resolution_id is not null")
    m = m.select("document_id", F.col("reference_head").alias("label"), "source.kind", "source.field", F.lit("").alias("canonical_name"), "surface_text", "source.sentence_id", "source.start_char", "source.end_char", "resolution_id", "recorded_at")
    numbered = m.withColumn("arrival", F.row_number().over(Window.partitionBy("document_id").orderBy("recorded_at", "resolution_id")))
    return spans.distinct_mentions(numbered).select("document_id", "resolution_id", "arrival")


def rule_spans(spark, sf):
    p = _paragraphs(spark, sf).withColumnRenamed("ordinal", "paragraph")
    return references.rule_spans(p, ["doc_id", "paragraph"]).groupBy("label", "canonical_name").agg(F.count(F.lit(1)).alias("spans"))


def reference_spans(spark, sf):
    p = _paragraphs(spark, sf).withColumnRenamed("ordinal", "paragraph")
    return references.reference_spans(p, ["doc_id", "paragraph"]).groupBy("determiner", "head", "is_plural").agg(F.count(F.lit(1)).alias("spans"))


def reference_resolution(spark, sf):
    s = _sentences(spark, sf).withColumn("section", F.lit(0)).withColumnRenamed("doc_id", "document_id")
    keys = ["document_id", "section", "pos"]
    r = references.reference_spans(s, keys).withColumn("reference_id", ids.stable_id("reference", *keys, "start_char", "end_char"))
    m = references.rule_spans(s, keys).withColumn("mention_id", ids.stable_id("mention", *keys, "start_char", "end_char", "label"))
    return references.resolve(r, references.antecedents(r, m)).groupBy("outcome").agg(F.count(F.lit(1)).alias("references"))


def realigned_spans(spark, sf):
    m = _read(spark, sf, "reference_resolution_ignored").select("resolution_id", F.col("source.evidence_quote").alias("text"), F.col("source.quote").alias("surface_text"), (F.col("source.start_char") + 2).alias("start_char"), F.col("source.end_char").alias("end_char")).distinct()
    return spans.realign(m).groupBy("aligned").agg(F.count(F.lit(1)).alias("spans"))


def queries() -> dict:
    return {f.__name__: f for f in (sentences, stable_ids, normalized_names, document_sections, document_chunks, section_hierarchy, repeated_furniture, paragraph_islands, quality_issues, context_windows, section_windows, sentence_batches, antecedent_windows, alias_ambiguity, lexicon_lookup, lexicon_spans, span_selection, reference_words, antecedent_asof, metadata_mentions, content_dedupe, latest_run, parse_summary, plain_text, paragraph_integrity, name_propagation, rule_spans, reference_spans, reference_resolution, realigned_spans, parse_audit, mention_codes, resolution_codes, distinct_mentions)}


_PARAS = r"""
    paras AS (
      SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS ordinal, unnest(l) AS text FROM (
        SELECT doc_id, list_filter(list_transform(string_split_regex(regexp_replace(text, '\r\n?', chr(10), 'g'), '\n[ \t]*(?:\n[ \t]*)+'),
               lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS l FROM documents WHERE text IS NOT NULL))"""

_SENT = r"""
    sents AS (
      SELECT doc_id, paragraph, CAST(generate_subscripts(l, 1) - 1 AS INT) AS ordinal, unnest(l) AS text FROM (
        SELECT doc_id, ordinal AS paragraph, list_filter(list_transform(string_split(
          regexp_replace(regexp_replace(regexp_replace(text,
            '(?i)(e\.g|i\.e|et al|fig|eq|dr|prof|vs|no|approx|ca|sp|spp|u\.s)\.', '\1' || chr(57344), 'g'),
            '([.!?])\s+(\d+(\s*[,–−-]\s*\d+)*)\s*$', '\1' || chr(57345) || '\2'),
            '([.!?])\s+', '\1' || chr(57346), 'g'), chr(57346)),
          lambda x: trim(replace(replace(regexp_replace(x, '\s+', ' ', 'g'), chr(57344), '.'), chr(57345), ' '))),
          lambda x: regexp_matches(x, '[.!?]["''”’)\]]*(\s*\d+(\s*[,–−-]\s*\d+)*)?$') OR regexp_matches(x, '[:;]$')) AS l FROM paras))"""

_SECTIONS = r"""
    heads AS (
      SELECT *, coalesce(length(text) > 0 AND length(text) <= 140 AND NOT regexp_matches(text, '[.;,]$') AND (
          lower(bare) IN ('abstract','introduction','background','methods','materials and methods','study area','results','discussion','results and discussion','conclusion','conclusions','limitations','acknowledgements','references')
          OR lower(regexp_replace(text, '\s+', '', 'g')) IN ('abstract','introduction','methodology','references','conclusions')
          OR (bare <> text AND coalesce(TRY_CAST(regexp_extract(text, '^\d+') AS INT), 0) <= 9 AND regexp_matches(words[1], '^[A-Z]') AND len(words) <= 14 AND NOT regexp_matches(bare, '(?i)https?://|www\.|[=#]')
              AND (len(words) <= 6 OR (len(words) <= 10 AND len(list_filter(content, lambda w: regexp_matches(w, '^[A-Z]'))) / greatest(len(content), 1) >= 0.55)))), false) AS is_heading
      FROM (SELECT *, list_filter(words, lambda w: lower(w) NOT IN ('a','an','and','as','at','for','from','in','of','on','or','the','to','with')) AS content
            FROM (SELECT *, regexp_extract_all(bare, '[A-Za-z][A-Za-z''-]*') AS words
                  FROM (SELECT *, regexp_replace(text, '^(\d{1,2}(\.\d{1,2}){0,3}\.?|[IVX]+\.)\s+', '') AS bare FROM paras)))),
    secs AS (
      SELECT doc_id, ordinal, text, is_heading, CAST(sum(is_heading::INT) OVER w AS INT) AS section,
             coalesce(last_value(CASE WHEN is_heading THEN text END IGNORE NULLS) OVER w, '') AS section_title
      FROM heads WINDOW w AS (PARTITION BY doc_id ORDER BY ordinal ROWS UNBOUNDED PRECEDING))"""

_LINES = r"""
    lines AS (
      SELECT doc_id, source, seq, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM (
        SELECT doc_id, source, generate_subscripts(l, 1) - 1 AS seq, unnest(l) AS t
        FROM (SELECT doc_id, source, string_split_regex(text, '\r\n|\r|\n') AS l FROM documents WHERE text IS NOT NULL))
      WHERE trim(regexp_replace(t, '\s+', ' ', 'g')) <> '')"""

_POS = "pos AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY paragraph, ordinal) - 1 AS INT) AS pos FROM sents)"

_NORM = "trim(regexp_replace(replace(lower({0}), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g'))"

_ALIASES = f"""
    live AS (SELECT DISTINCT canonical_id, label, canonical_name, unnest(list_prepend(canonical_name, coalesce(aliases, []))) AS alias
             FROM lexicon WHERE canonical_id IS NOT NULL AND (status <> 'deprecated' OR status IS NULL)),
    keyed AS (SELECT DISTINCT canonical_id, label, canonical_name, alias, {_NORM.format('alias')} AS alias_key FROM live WHERE {_NORM.format('alias')} <> '')"""


def oracle_sql() -> dict[str, str]:
    issues = "list_filter([{0}], lambda x: x IS NOT NULL)"
    checks = [
        ("carriage_return", "t LIKE '%' || chr(13) || '%'"), ("double_blank", "t LIKE '%  %'"), ("empty_text", "trim(t) = ''"), ("glyph_codes", "t LIKE '%cid:%'"), ("long_text", "length(t) > 20000"),
        ("no_stop", "trim(t) <> '' AND NOT regexp_matches(t, '[.!?]')"), ("replacement_character", "t LIKE '%' || chr(65533) || '%'"), ("short_text", "trim(t) <> '' AND length(t) < 80"), ("soft_hyphen", "t LIKE '%' || chr(173) || '%'"),
    ]
    return {
        "sentences": f"WITH {_PARAS},{_SENT} SELECT doc_id, paragraph, ordinal, text FROM sents",
        "stable_ids": "SELECT doc_id, 'doc_' || substr(sha1(coalesce(paper_id,'') || '|' || coalesce(section_title,'')), 1, 12) AS parser_id, 'node_' || substr(sha256(coalesce(document_id,'') || chr(9247) || coalesce(lang,'')), 1, 20) AS node_id, 'core_' || substr(sha256(CAST(doc_id AS VARCHAR) || '|' || coalesce(source,'')), 1, 16) AS core_id FROM documents",
        "normalized_names": f"SELECT DISTINCT canonical_name, {_NORM.format('canonical_name')} AS normalized, regexp_replace(lower(canonical_name), '[^a-z0-9]+', '', 'g') AS compact, upper(array_to_string(list_transform(list_filter(string_split({_NORM.format('canonical_name')}, ' '), lambda t: t <> ''), lambda t: t[1]), '')) AS acronym FROM entities",
        "document_sections": f"WITH {_PARAS},{_SECTIONS} SELECT doc_id, section, section_title, count_if(NOT is_heading)::BIGINT AS paragraphs, sum(CASE WHEN is_heading THEN 0 ELSE length(text) END)::BIGINT AS characters FROM secs GROUP BY ALL",
        "document_chunks": f"WITH {_PARAS},{_SECTIONS}, body AS (SELECT doc_id, ordinal, section, section_title, text FROM secs WHERE NOT is_heading),{_SENT.replace('FROM paras', 'FROM body')}, s AS (SELECT doc_id, section, section_title, sum(length(text)) + count(*) - 1 AS n FROM body GROUP BY 1, 2, 3) SELECT 'section' AS type, count(*) AS chunks, count(DISTINCT (doc_id, section, section_title)) AS ids, sum(n)::BIGINT AS characters FROM s UNION ALL SELECT 'paragraph', count(*), count(DISTINCT (doc_id, section, ordinal)), sum(length(text))::BIGINT FROM body UNION ALL SELECT 'sentence', count(*), count(DISTINCT (doc_id, paragraph, ordinal)), sum(length(text))::BIGINT FROM sents",
        "section_hierarchy": f"WITH {_PARAS},{_SECTIONS}, h AS (SELECT doc_id, section, CASE WHEN regexp_extract(section_title, '^(\\d{{1,2}}(\\.\\d{{1,2}}){{0,3}})\\.?\\s+\\S', 1) = '' THEN 1 ELSE len(string_split(regexp_extract(section_title, '^(\\d{{1,2}}(\\.\\d{{1,2}}){{0,3}})\\.?\\s+\\S', 1), '.')) END::INT AS level FROM secs WHERE is_heading) SELECT a.doc_id, a.section, a.level, max(b.section) AS parent FROM h a LEFT JOIN h b ON a.doc_id = b.doc_id AND b.section < a.section AND b.level < a.level GROUP BY ALL",
        "repeated_furniture": f"WITH {_LINES}, o AS (SELECT DISTINCT source, doc_id, text FROM lines WHERE source IS NOT NULL), p AS (SELECT source, count(DISTINCT doc_id) AS n FROM o GROUP BY 1), c AS (SELECT source, text, count(*) AS pages FROM o GROUP BY 1, 2) SELECT source, text, pages FROM c JOIN p USING (source) WHERE pages >= greatest(2, floor(n / 200))",
        "paragraph_islands": f"WITH {_LINES}, f AS (SELECT doc_id, seq, text, rtrim(lag(text) OVER w) AS b, row_number() OVER w AS rn FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY seq)), s AS (SELECT doc_id, seq, CASE WHEN rn = 1 OR coalesce(regexp_matches(text, '(?i)^(\\(?\\d{{1,3}}\\)?[.)]|[a-z][.)]|[•▪])\\s+') OR ((regexp_matches(b, '[.!?][\"''”’)\\]]*(\\s*\\d+(\\s*[,–−-]\\s*\\d+)*)?$') OR regexp_matches(b, '[:;]$')) AND NOT regexp_matches(regexp_replace(text, '^[\"''“‘(\\[]+', ''), '^[\\p{{Ll}},;:)\\]]')), false) THEN 1 ELSE 0 END AS st FROM f) SELECT doc_id, count(*) AS lines, sum(st)::INT AS paragraphs FROM s GROUP BY 1",
        "quality_issues": f"SELECT doc_id, array_to_string({issues.format(', '.join(f'CASE WHEN {c} THEN {chr(39)}{k}{chr(39)} END' for k, c in checks))}, ';') AS issues FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)",
        "context_windows": f"WITH {_PARAS},{_SENT},{_POS} SELECT doc_id, pos, CASE WHEN lag(pos) OVER w IS NULL THEN '' ELSE 'previous,' END || 'target' || CASE WHEN lead(pos) OVER w IS NULL THEN '' ELSE ',next' END AS roles, concat_ws(' | ', lag(text) OVER w, text, lead(text) OVER w) AS window_text FROM pos WINDOW w AS (PARTITION BY doc_id ORDER BY pos)",
        "section_windows": f"WITH {_PARAS},{_SECTIONS},{_SENT},{_POS}, j AS (SELECT p.doc_id, p.pos, s.section FROM pos p JOIN secs s ON s.doc_id = p.doc_id AND s.ordinal = p.paragraph) SELECT doc_id, pos, section, concat_ws(',', lag(pos) OVER w, pos, lead(pos) OVER w) AS near FROM j WINDOW w AS (PARTITION BY doc_id, section ORDER BY pos)",
        "sentence_batches": "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 50 AS batch FROM documents WHERE text IS NOT NULL",
        "antecedent_windows": f"WITH {_PARAS},{_SENT},{_POS} SELECT doc_id, pos, least(pos + 1, 3)::INT AS size, length(coalesce(lag(text, 2) OVER w, lag(text) OVER w, text))::BIGINT AS first_length FROM pos WINDOW w AS (PARTITION BY doc_id ORDER BY pos)",
        "alias_ambiguity": f"WITH {_ALIASES}, n AS (SELECT alias_key, count(DISTINCT canonical_id) AS entries FROM keyed GROUP BY 1) SELECT DISTINCT alias_key, canonical_id, entries FROM keyed JOIN n USING (alias_key)",
        "lexicon_lookup": f"WITH {_ALIASES}, one AS (SELECT alias_key, min(canonical_id) AS canonical_id FROM keyed GROUP BY 1 HAVING count(DISTINCT canonical_id) = 1), e AS (SELECT DISTINCT resolution_id, surface_text, {_NORM.format('surface_text')} AS alias_key FROM reference_resolution_ignored) SELECT resolution_id, surface_text, canonical_id FROM e JOIN one USING (alias_key) WHERE alias_key <> ''",
        "span_selection": "WITH s AS (SELECT source.sentence_id AS sentence_id, source.start_char AS start_char, source.end_char AS end_char, coalesce(reference_head, '') AS label, length(surface_text) AS n, epoch_us(recorded_at) AS arrival FROM reference_resolution_ignored WHERE source.sentence_id IS NOT NULL AND source.start_char IS NOT NULL AND length(trim(surface_text)) >= 2) SELECT sentence_id, start_char, end_char, label, n::INT AS surface_length, arrival FROM (SELECT *, row_number() OVER (PARTITION BY sentence_id, start_char, end_char, label ORDER BY n DESC, arrival) AS r FROM s) WHERE r = 1",
        "reference_words": r"SELECT doc_id, len(regexp_extract_all(text, '(?i)\b(this|that|the|our|these|those) (model|method|system|platform|approach|framework|process|agent|tool|dataset|database)s?\b'))::BIGINT AS noun_phrases, len(regexp_extract_all(text, '(?i)\b(it|they|them)\b'))::BIGINT AS pronouns FROM documents WHERE text IS NOT NULL",
        "antecedent_asof": "WITH p AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events), m AS (SELECT t.user_id, t.event_id AS target_id, c.event_id AS candidate_id, (t.pos - c.pos)::INT AS distance FROM p t JOIN p c ON t.user_id = c.user_id AND t.pos - c.pos BETWEEN 0 AND 2 WHERE t.event_type = 'error' AND c.event_type <> 'error'), d AS (SELECT *, min(distance) OVER (PARTITION BY target_id) AS least FROM m) SELECT user_id, target_id, candidate_id, distance, row_number() OVER (PARTITION BY target_id ORDER BY distance, candidate_id)::INT AS rank, count_if(distance = least) OVER (PARTITION BY target_id) = 1 AS nearest_unique FROM d",
        "metadata_mentions": r"WITH m AS (SELECT DISTINCT id, title, authors FROM manifest), n AS (SELECT id, list_distinct(list_filter(list_transform(string_split_regex(regexp_replace(authors, '[\d*†‡§¶⁰¹²³⁴⁵⁶⁷⁸⁹]+', '', 'g'), '\s*(?:[;|&]|\band\b)\s*'), lambda p: trim(regexp_replace(regexp_replace(p, '\s+', ' ', 'g'), '[,\s]+$', ''))), lambda p: regexp_matches(p, '\p{L}{2}') AND NOT regexp_matches(lower(p), '^(et al\.?|others)$'))) AS l FROM m) SELECT id, 'Publication' AS label, trim(title) AS surface_text, 1.0::DOUBLE AS confidence FROM m WHERE trim(title) <> '' UNION ALL SELECT id, 'Person', unnest(l), 0.98::DOUBLE FROM n",
        "content_dedupe": "SELECT sha256(text) AS sha256, min(document_id) AS first_location, count(DISTINCT document_id) AS locations, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1",
        "latest_run": "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events WHERE user_id IS NOT NULL GROUP BY 1",
        "distinct_mentions": f"""
            WITH m AS (SELECT document_id, coalesce(reference_head, chr(0)) AS label, source.kind AS kind, coalesce(source.field, '') AS field, {_NORM.format("coalesce(surface_text, '')")} AS name, coalesce(source.sentence_id, '') AS sid, coalesce(source.start_char::VARCHAR, '') AS a, coalesce(source.end_char::VARCHAR, '') AS b,
                       resolution_id, row_number() OVER (PARTITION BY document_id ORDER BY recorded_at NULLS FIRST, resolution_id) AS arrival FROM reference_resolution_ignored WHERE document_id IS NOT NULL AND resolution_id IS NOT NULL)
            SELECT document_id, resolution_id, arrival::INT AS arrival FROM m QUALIFY row_number() OVER (PARTITION BY document_id, label, coalesce(kind = 'document_metadata', false), CASE WHEN kind = 'document_metadata' THEN [field, name] ELSE [sid, a, b] END ORDER BY arrival) = 1""",
        "lexicon_spans": f"""
            WITH {_ALIASES}, al AS (SELECT DISTINCT alias, canonical_id, label, canonical_name, alias_key FROM keyed WHERE length(alias) >= 2), n AS (SELECT alias_key, count(DISTINCT canonical_id) AS entries FROM keyed GROUP BY 1),
            w AS (SELECT DISTINCT alias FROM al), t AS (SELECT DISTINCT resolution_id, source.evidence_quote AS text FROM reference_resolution_ignored WHERE source.evidence_quote IS NOT NULL), u AS (SELECT DISTINCT text FROM t),
            h AS (SELECT text, alias, unnest(range(1, length(text) - length(alias) + 2)) AS p FROM u JOIN w ON contains(lower(text), lower(alias))),
            f AS (SELECT text, alias, p, p + length(alias) AS e FROM h WHERE lower(substr(text, p, length(alias))) = lower(alias) AND NOT (p > 1 AND regexp_matches(substr(text, p - 1, 1), '[A-Za-z0-9]')) AND NOT regexp_matches(substr(text, p + length(alias), 1), '[A-Za-z0-9]'))
            SELECT resolution_id, label, (p - 1)::INT AS start_char, (e - 1)::INT AS end_char, substr(text, p, e - p) AS surface_text, canonical_id, canonical_name, CASE WHEN entries = 1 THEN 'persistent_lexicon' ELSE 'persistent_lexicon_ambiguous' END AS method
            FROM f JOIN al USING (alias) JOIN n USING (alias_key) JOIN t USING (text)
            WHERE NOT coalesce(label = 'Tool' AND ((p > 1 AND substr(text, p - 1, 1) = '-') OR substr(text, e, 1) = '-'), false) AND NOT coalesce(label = 'Model' AND regexp_matches(substr(text, e), '(?i)^(?:\\.\\d+|o\\b|\\s+Search\\b)'), false)""",
        "name_propagation": r"""
            WITH m AS (SELECT DISTINCT document_id, resolution_id, surface_text, source.evidence_quote AS text FROM reference_resolution_ignored WHERE document_id IS NOT NULL),
            n AS (SELECT DISTINCT document_id, surface_text AS name, list_filter(string_split_regex(surface_text, '[- ]+'), lambda x: x <> '') AS parts FROM m WHERE regexp_matches(surface_text, '[\p{L}\p{N}_]')),
            q AS (SELECT *, '(?is)' || array_to_string(list_transform(parts, lambda x: regexp_escape(x)), '[- ]?') AS pat, list_sum(list_transform(parts, lambda x: length(x)))::INT AS z FROM n),
            s AS (SELECT DISTINCT document_id, resolution_id, text FROM m WHERE text IS NOT NULL),
            h AS (SELECT resolution_id, s.document_id, text, name, pat, z, len(parts) AS k FROM s JOIN q USING (document_id) WHERE regexp_matches(text, pat)),
            c AS (SELECT *, unnest(range(1, length(text) - z + 2)) AS p FROM h), d AS (SELECT *, unnest(range(z, z + k)) AS l FROM c)
            SELECT DISTINCT document_id, resolution_id, name, (p - 1)::INT AS start_char, (p - 1 + l)::INT AS end_char FROM d
            WHERE p + l - 1 <= length(text) AND regexp_full_match(substr(text, p, l), pat) AND NOT (p > 1 AND regexp_matches(substr(text, p - 1, 1), '[\p{L}\p{N}_]')) AND NOT regexp_matches(substr(text, p + l, 1), '[\p{L}\p{N}_]')""",
        "parse_audit": rf"""
            WITH {_PARAS},{_SECTIONS}, body AS (SELECT doc_id, ordinal, section, text FROM secs WHERE NOT is_heading),{_SENT.replace('FROM paras', 'FROM body')},
            h AS (SELECT doc_id, count(*) AS n, bool_or(contains(lower(text), 'abstract')) AS a, bool_or(contains(lower(text), 'intro')) AS i, bool_or(length(text) > 160 OR regexp_matches(text, '[.,;]$')) AS odd FROM secs WHERE is_heading GROUP BY 1),
            sp AS (SELECT doc_id, paragraph, string_agg(text, ' ' ORDER BY ordinal) AS j, count(*) AS n FROM sents GROUP BY 1, 2),
            b AS (SELECT body.doc_id, count(*) AS n, sum(coalesce(sp.n, 0)) AS s, bool_or(length(text) > 6000) AS large, bool_or(sp.n IS NULL) AS bare, bool_or(contains(lower(text), 'cid:') OR contains(text, '�')) AS art,
                         bool_or(regexp_matches(text, '(?i)\b(journal homepage|available online at|contents lists available)\b')) AS pub, bool_or(coalesce(j, '') <> text) AS torn, right(string_agg(text, chr(10) ORDER BY ordinal), 8000) AS tail
                  FROM body LEFT JOIN sp ON sp.doc_id = body.doc_id AND sp.paragraph = body.ordinal GROUP BY 1),
            m AS (SELECT id, arg_max({{'t': title, 'a': authors}}, (added_at, title)) AS x FROM manifest WHERE id IS NOT NULL GROUP BY 1),
            d AS (SELECT doc_id, x.t AS title, coalesce(x.a, '') AS authors FROM documents LEFT JOIN m ON m.id = paper_id)
            SELECT d.doc_id, array_to_string(list_filter([
              CASE WHEN coalesce(title, '') = '' THEN 'missing_title' END, CASE WHEN authors = '' THEN 'missing_authors' END,
              CASE WHEN regexp_matches(authors, '(?i)(published as part of|special issue|cite this|@)') THEN 'author_furniture_leakage' END,
              CASE WHEN regexp_matches(authors, '(?i)\b(university|department|institute|laboratory)\b') THEN 'author_affiliation_leakage' END,
              CASE WHEN coalesce(h.n, 0) < 3 THEN 'too_few_sections' END, CASE WHEN coalesce(b.n, 0) < 5 THEN 'too_few_paragraphs' END, CASE WHEN coalesce(b.s, 0) < 20 THEN 'too_few_sentences' END,
              CASE WHEN NOT coalesce(a, false) THEN 'missing_abstract_section' END, CASE WHEN NOT coalesce(i, false) THEN 'missing_introduction_section' END, CASE WHEN odd THEN 'suspicious_section_title' END,
              CASE WHEN large THEN 'oversized_paragraph' END, CASE WHEN bare THEN 'paragraph_without_sentences' END, CASE WHEN art THEN 'encoding_or_formula_artifact' END,
              CASE WHEN regexp_matches(tail, '(?is)\b(references|bibliography)\b.{{0,80}}\bet al\.\b') THEN 'possible_reference_leakage' END, CASE WHEN pub THEN 'publisher_furniture_leakage' END, CASE WHEN torn THEN 'sentence_coverage_mismatch' END],
              lambda c: c IS NOT NULL), ';') AS issues
            FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN b ON b.doc_id = d.doc_id""",
        "mention_codes": """
            WITH s AS (SELECT x.sentence_id AS sentence_id, min(x.text) AS t FROM (SELECT unnest(source.context_sentences) AS x FROM reference_resolution_ignored) WHERE x.sentence_id IS NOT NULL GROUP BY 1),
            m AS (SELECT resolution_id AS id, reference_head AS label, source.kind AS kind, source.sentence_id AS sentence_id, source.start_char AS a, source.end_char AS b, source.quote AS q, surface_text AS f, source.paragraph_id AS p, source.section_id AS c FROM reference_resolution_ignored),
            u AS (SELECT p AS unit FROM m WHERE p IS NOT NULL UNION SELECT x.paragraph_id FROM (SELECT unnest(source.context_sentences) AS x FROM reference_resolution_ignored) WHERE x.paragraph_id IS NOT NULL),
            l AS (SELECT label FROM m WHERE label IS NOT NULL GROUP BY 1 HAVING count(*) > 5),
            j AS (SELECT m.*, s.sentence_id IS NOT NULL AS there, t, coalesce(a >= 0 AND a < b AND b <= length(t), false) AS inside FROM m LEFT JOIN s ON s.sentence_id = m.sentence_id WHERE kind = 'sentence_span')
            SELECT 'duplicate_mention_id' AS code, id, count(*) - 1 AS n FROM m WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
            UNION ALL SELECT 'missing_sentence_reference', id, 1 FROM j WHERE NOT there
            UNION ALL SELECT 'invalid_character_span', id, 1 FROM j WHERE there AND NOT inside
            UNION ALL SELECT 'evidence_quote_mismatch', id, 1 FROM j WHERE there AND inside AND NOT coalesce(substr(t, a + 1, b - a) = q AND q = f, false)
            UNION ALL SELECT 'unknown_node_label', id, 1 FROM m WHERE label IS NULL OR label NOT IN (SELECT label FROM l)
            UNION ALL SELECT 'missing_parent_reference', id, 1 FROM j WHERE there AND (p IS NULL OR c IS NULL OR p NOT IN (SELECT unit FROM u) OR c NOT IN (SELECT unit FROM u))""",
        "resolution_codes": """
            WITH r AS (SELECT decision_id AS id, trim(left_entity_id) AS l, trim(right_entity_id) AS r FROM entity_resolution_decisions), e AS (SELECT DISTINCT entity_id FROM entities WHERE entity_id IS NOT NULL),
            x AS (SELECT 'duplicate_resolution_id' AS code, id, count(*) - 1 AS n FROM r WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
                  UNION ALL SELECT 'missing_resolution_endpoint', r.id, 1 FROM r LEFT JOIN e a ON a.entity_id = r.l LEFT JOIN e b ON b.entity_id = r.r WHERE a.entity_id IS NULL OR b.entity_id IS NULL)
            SELECT code, id, sum(n)::BIGINT AS n FROM x GROUP BY 1, 2""",
        "parse_summary": f"WITH {_PARAS},{_SECTIONS}, body AS (SELECT doc_id, ordinal, section, text FROM secs WHERE NOT is_heading),{_SENT.replace('FROM paras', 'FROM body')}, n AS (SELECT doc_id, count(*) AS s FROM sents GROUP BY 1) SELECT doc_id, count(DISTINCT section) AS sections, count(*) AS paragraphs, any_value(coalesce(s, 0))::BIGINT AS sentences, sum(length(text))::BIGINT AS characters, array_to_string(list_filter([CASE WHEN sum(length(text)) < 250 THEN 'low_text' END, CASE WHEN any_value(coalesce(s, 0)) = 0 THEN 'no_sentences' END], lambda x: x IS NOT NULL), ';') AS warnings FROM body LEFT JOIN n USING (doc_id) GROUP BY 1",
        "plain_text": f"WITH {_PARAS}, t AS (SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY ordinal) AS text FROM paras GROUP BY 1) SELECT doc_id, sha256(text) AS text_hash, length(text)::INT AS n FROM t",
        "paragraph_integrity": f"WITH {_PARAS} SELECT doc_id, count(*) - count(DISTINCT text) AS duplicate_ids, min(ordinal) <> 0 OR max(ordinal) - min(ordinal) + 1 <> count(DISTINCT ordinal) AS gaps FROM paras GROUP BY 1",
    }

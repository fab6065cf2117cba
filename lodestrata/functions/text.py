"""Text cleaning, sentence splitting and line predicates; built-in expressions but for Unicode normalisation."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Abbreviations whose stops end no sentence (fixed values, without the last stop).
ABBREVIATIONS = ("e.g", "i.e", "et al", "fig", "eq", "dr", "prof", "vs", "no", "approx", "ca", "sp", "spp", "u.s")
#: Prefixes that keep their hyphen at a line's end (fixed values).
KEPT_PREFIXES = ("net", "life", "real", "high", "low", "long", "short", "state", "data", "process", "user", "domain", "top", "large", "small", "well", "self", "multi", "cross", "carbon", "time", "case", "end", "of")

_HELD, _JOIN, _CUT = "\ue000", "\ue001", "\ue002"
_ABBREVIATION = "(?i)(" + "|".join(a.replace(".", "\\.") for a in ABBREVIATIONS) + ")\\."
_TERMINAL = "[.!?][\"'\u201d\u2019)\\]]*(\\s*\\d+(\\s*[,\u2013\u2212-]\\s*\\d+)*)?$"


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode normal form KC; null stays null."""
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tidy(col) -> Column:
    """Single blanks, none before punctuation, hyphens and apostrophes tight between letters, no soft hyphens."""
    c = F.regexp_replace(_c(col), "\u00ad", "")
    c = F.regexp_replace(c, "\ufffd", "-")
    c = F.regexp_replace(c, "([A-Za-z])\\s*[\u2010\u2011\u2012\u2013]\\s*(?=[A-Za-z])", "$1-")
    c = F.regexp_replace(c, "([A-Za-z])\\s*['\u2019]\\s*(?=[A-Za-z])", "$1'")
    c = F.regexp_replace(c, "\\s+", " ")
    return F.trim(F.regexp_replace(c, "\\s+([,.;:!?])", "$1"))


def normalize_text(col) -> Column:
    """Compatibility characters in their plain form, then ``tidy``, with a capital for "where" after a stop."""
    return F.regexp_replace(tidy(nfkc(_c(col))), "([.!?]) [Ww]here\\b", "$1 Where")


def join_lines(lines) -> Column:
    """An array of lines as one text: a hyphen at a line's end goes if the next line starts lower case and its prefix is none that keeps it."""
    kept = "|".join(KEPT_PREFIXES)
    joined = F.array_join(F.transform(_c(lines), lambda x: F.trim(x)), "\n")
    joined = F.regexp_replace(joined, f"(?i)\\b({kept})[-\u2010-\u2013]\n", "$1-")
    return F.trim(F.regexp_replace(F.regexp_replace(joined, "([A-Za-z])[-\u2010-\u2013]\n(?=[a-z])", "$1"), "\n", " "))


def has_terminal_punctuation(col) -> Column:
    return _c(col).rlike(_TERMINAL) | _c(col).rlike("[:;]$")


def starts_like_continuation(col) -> Column:
    return F.regexp_replace(_c(col), "^[\"'\u201c\u2018(\\[]+", "").rlike("^[\\p{Ll},;:)\\]]")


def begins_list_item(col) -> Column:
    return _c(col).rlike("(?i)^(\\(?\\d{1,3}\\)?[.)]|[a-z][.)]|[\u2022\u25aa])\\s+")


def looks_like_caption(col) -> Column:
    return _c(col).rlike("(?i)^(fig(ure)?|table|box|plate|map)\\s*[.:]?\\s*\\d+")


def looks_like_formula(col) -> Column:
    c = _c(col)
    symbols = F.length(F.regexp_replace(c, "[\\p{L}\\p{N}\\s]+", ""))
    return c.contains("cid:") | c.rlike("^(=|[A-Za-z]\\s*=|[\u2211\u222b\u221a]|\\(?\\d+\\)?\\s*$)") | ((symbols / F.greatest(F.length(c), F.lit(1)) > 0.35) & (F.length(c) < 180))


def heading_depth(col) -> Column:
    """Depth of a numbered heading ("2.1 Methods" is 2), 1 for one without a number."""
    number = F.regexp_extract(_c(col), "^(\\d{1,2}(\\.\\d{1,2}){0,3})\\.?\\s+\\S", 1)
    return F.when(number == "", F.lit(1)).otherwise(F.size(F.split(number, "\\.")))


def heading_number(col) -> Column:
    """A heading's number, or the empty string."""
    return F.regexp_extract(_c(col), "^(\\d{1,2}(\\.\\d{1,2}){0,3})\\.?\\s+\\S", 1)


#: Headings that need no number (fixed values).
KNOWN_HEADINGS = ("abstract", "introduction", "background", "methods", "materials and methods", "study area", "results", "discussion", "results and discussion", "conclusion", "conclusions", "limitations", "acknowledgements", "references")


#: Labels that are headings whatever their spacing, words that need no capital in a title, and the largest first number of a heading (fixed values).
COMPACT_HEADINGS = ("abstract", "introduction", "methodology", "references", "conclusions")
SMALL_WORDS = ("a", "an", "and", "as", "at", "for", "from", "in", "of", "on", "or", "the", "to", "with")
LARGEST_FIRST_NUMBER = 9
#: The number of a section heading.
SECTION_NUMBER = "^(\\d{1,2}(\\.\\d{1,2}){0,3}\\.?|[IVX]+\\.)\\s+"


def letter_words(col) -> Column:
    """Runs of letters a-z."""
    return F.regexp_extract_all(_c(col), F.lit("[A-Za-z]+"), F.lit(0))


def visible_heading(col) -> Column:
    """A heading without leading marks, and with the capitals of small-caps words joined to their words."""
    return F.regexp_replace(F.trim(F.regexp_replace(_c(col), "^[^A-Za-z0-9]+\\s*", "")), "\\b([A-Z])\\s+(?=[A-Z]{2,}\\b)", "$1")


def looks_like_heading(col, styled: Column | None = None, large_enough: Column | None = None) -> Column:
    """A short line without a final stop that is a known heading, or numbered (up to 9) and capitalised and styled or like a title.

    ``styled`` says whether the line stands out, ``large_enough`` whether it is at least near the size of the text.
    """
    c = _c(col)
    bare = F.regexp_replace(c, SECTION_NUMBER, "")
    words = F.regexp_extract_all(bare, F.lit("[A-Za-z][A-Za-z'-]*"), F.lit(0))
    content = F.filter(words, lambda w: ~F.lower(w).isin(*SMALL_WORDS))
    title = F.size(F.filter(content, lambda w: w.rlike("^[A-Z]"))) / F.greatest(F.size(content), F.lit(1)) >= 0.55
    first = F.regexp_extract(c, "^(\\d+)", 1)
    low = (first == "") | (first.cast("int") <= LARGEST_FIRST_NUMBER)
    numbered = (bare != c) & low & F.coalesce(F.get(words, F.lit(0)).rlike("^[A-Z]"), F.lit(False)) & (F.size(words) <= 14) & ~bare.rlike("(?i)https?://|www\\.|[=#]")
    if large_enough is not None:
        numbered = numbered & large_enough
    shape = (styled if styled is not None else F.lit(False)) | (F.size(words) <= 6) | ((F.size(words) <= 10) & title)
    ok = (F.length(c) > 0) & (F.length(c) <= 140) & ~c.rlike("[.;,]$")
    known = F.lower(bare).isin(*KNOWN_HEADINGS) | F.lower(F.regexp_replace(c, "\\s+", "")).isin(*COMPACT_HEADINGS)
    return F.coalesce(ok & (known | (numbered & shape)), F.lit(False))


def split_sentences(col) -> Column:
    """The sentences of a paragraph as an array: cut after a stop and blanks, not after an abbreviation, a trailing citation number kept with its sentence; parts without a final stop are left out."""
    held = F.regexp_replace(_c(col), _ABBREVIATION, f"$1{_HELD}")
    held = F.regexp_replace(held, "([.!?])\\s+(\\d+(\\s*[,\u2013\u2212-]\\s*\\d+)*)\\s*$", f"$1{_JOIN}$2")
    parts = F.split(F.regexp_replace(held, "([.!?])\\s+", f"$1{_CUT}"), _CUT)
    clean = F.transform(parts, lambda p: F.trim(F.translate(F.regexp_replace(p, "\\s+", " "), f"{_HELD}{_JOIN}", ". ")))
    return F.filter(clean, lambda p: has_terminal_punctuation(p))

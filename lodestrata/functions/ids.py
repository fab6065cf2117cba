"""Content-derived identifiers and name normalisation, as Column expressions.

Nulls are written as the empty string, so a null part and an empty part give the same identifier.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "␟"


def _parts(parts: tuple) -> list[Column]:
    return [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]


def parser_id(prefix: str, *parts) -> Column:
    """Identifier of parsed units: the first 12 hexadecimal digits of SHA-1 over the parts joined by a bar."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha1(F.concat_ws("|", *_parts(parts)).cast("binary")), 1, 12))


def stable_id(prefix: str, *parts) -> Column:
    """Identifier of nodes and edges: the first 20 hexadecimal digits of SHA-256 over the parts joined by U+241F."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(F.concat_ws(SEPARATOR, *_parts(parts)).cast("binary"), 256), 1, 20))


def core_id(prefix: str, *parts) -> Column:
    """Identifier of corpus-level records: the first 16 hexadecimal digits of SHA-256 over the parts joined by a bar."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(F.concat_ws("|", *_parts(parts)).cast("binary"), 256), 1, 16))


def normalized(col) -> Column:
    """Lower case with runs of anything but a-z and 0-9 as one blank; a sharp s is two letters. Null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(F.regexp_replace(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), "[^a-z0-9]+", " "))


def compact_label(col) -> Column:
    """Lower case without anything but a-z and 0-9."""
    return F.regexp_replace(F.lower(F.col(col) if isinstance(col, str) else col), "[^a-z0-9]+", "")


def slug(col) -> Column:
    """Like ``normalized``, joined by hyphens."""
    return F.replace(normalized(col), F.lit(" "), F.lit("-"))


def name_tokens(col) -> Column:
    """Distinct words of a normalised name, as an array; none for a name without letters and digits."""
    return F.array_distinct(F.filter(F.split(normalized(col), " "), lambda t: t != ""))


def acronym(col) -> Column:
    """First letters of a name's words, in capitals."""
    return F.upper(F.array_join(F.transform(F.filter(F.split(normalized(col), " "), lambda t: t != ""), lambda t: F.substring(t, 1, 1)), ""))

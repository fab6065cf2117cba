"""Paragraphs from lines with their geometry: window expressions over the lines of a document in reading order.

A line needs only what the lines before it say: whether a heading goes on is decided within a run of lines that hang
together, and whether a paragraph begins by the last line of text in its section. So runs are numbered by running sums
(gaps and islands), and nothing is looped over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.text import begins_list_item, has_terminal_punctuation, join_lines, starts_like_continuation, visible_heading
from lodestrata.operators.structure import islands

#: Shares of the body size (fixed values): the gap within a wrapped heading, its size (0.6 points at least) and indent
#: differences, and the size from which a heading stands out; the gap and the indent that divide paragraphs.
WRAP_GAP, WRAP_SIZE, WRAP_INDENT, STANDS_OUT = 1.05, 0.08, 4, 1.12
BREAK_GAP, BREAK_INDENT = 0.35, 0.55
#: Headings that have one spelling (fixed values).
HEADING_NAMES = {"abstract": "Abstract", "references": "References", "reference": "References", "highlights": "Highlights", "graphicalabstract": "Graphical abstract"}

_NUMBERS = "^\\s*\\d+(\\s*[,\\-–−]\\s*\\d+)*\\s*$"


def canonical_heading(col: Column) -> Column:
    """A heading as it shows; one of ``HEADING_NAMES``, with or without a number, in its one spelling."""
    shown = visible_heading(col)
    bare = F.lower(F.regexp_replace(F.regexp_replace(shown, "^((\\d+(\\.\\d+)*|[IVX]+|[A-Z])\\.?)\\s+", ""), "\\s+", ""))
    return F.coalesce(*[F.when(bare == k, F.lit(v)) for k, v in HEADING_NAMES.items()], shown)


def paragraph_lines(lines: DataFrame, key: str = "document_id", order: str = "pos") -> DataFrame:
    """Lines with ``section`` (0 before the first heading), ``heading``, ``is_heading`` and ``paragraph`` (0 for headings).

    ``lines(key, order, text, page, top, bottom, x0, size, bold, italic, body_size, heading_line)`` are in reading
    order; ``heading_line`` says whether a line is a heading by itself. A line close below a heading, in its size, style
    and column, goes on with it, if the heading stands out and the line has no final stop. A paragraph begins where the
    layout breaks (a gap, an indent, a page after a finished one) and the text before is finished or a list item begins;
    a line of citation numbers alone never begins one.
    """
    w = Window.partitionBy(key).orderBy(order)
    before = lambda c: F.lag(c).over(w)
    body = F.col("body_size")
    hangs = (
        (F.col("page") == before("page")) & (F.col("top") - before("bottom") <= body * WRAP_GAP)
        & (F.abs(F.col("size") - before("size")) <= F.greatest(F.lit(0.6), body * WRAP_SIZE)) & (F.abs(F.col("x0") - before("x0")) <= body * WRAP_INDENT)
        & (F.col("bold") == before("bold")) & (F.col("italic") == before("italic")) & (before("bold") | before("italic") | (before("size") >= body * STANDS_OUT))
        & ~has_terminal_punctuation("text")
    )
    out = islands(lines.withColumn("_hangs", F.coalesce(hangs, F.lit(False))), [key], [order], ~F.col("_hangs"), "_run")
    run = Window.partitionBy(key, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    wrapped = F.coalesce(F.max("heading_line").over(run), F.lit(False))
    out = out.withColumn("_wrapped", wrapped)
    starts = F.col("heading_line") & ~F.col("_wrapped")
    to_here = w.rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumns({"is_heading": F.col("heading_line") | F.col("_wrapped"), "section": F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(to_here).cast("int")})
    part = Window.partitionBy(key, "section", "is_heading").orderBy(order)
    own = Window.partitionBy(key, "section")
    first = F.row_number().over(part) == 1
    cited = F.col("text").rlike(_NUMBERS) & ~first
    out = out.withColumns({"_first": first, "_cited": cited})
    last = F.last(F.when(~F.col("_cited"), F.struct("page", "bottom", "x0", "text")), ignorenulls=True).over(part.rowsBetween(Window.unboundedPreceding, -1))
    out = out.withColumn("_last", last)
    same_page = F.col("page") == F.col("_last.page")
    done = has_terminal_punctuation(F.col("_last.text"))
    shifted = same_page & ((F.col("top") - F.col("_last.bottom") > body * BREAK_GAP) | (F.col("x0") - F.col("_last.x0") > body * BREAK_INDENT))
    begins = F.col("_first") | (~F.col("_cited") & F.coalesce((shifted & (done | begins_list_item("text"))) | (~same_page & done), F.lit(False)))
    paragraph = F.when(F.col("is_heading"), F.lit(0)).otherwise(F.sum(begins.cast("int")).over(part.rowsBetween(Window.unboundedPreceding, 0))).cast("int")
    heading = join_lines(F.transform(F.array_sort(F.collect_list(F.when(F.col("is_heading"), F.struct(order, "text"))).over(own)), lambda x: x["text"]))
    out = out.withColumn("paragraph", paragraph).withColumn("heading", F.when(F.col("section") > 0, canonical_heading(heading)))
    return out.drop("_hangs", "_run", "_wrapped", "_first", "_cited", "_last")


def reconstructed_paragraphs(lines: DataFrame, furniture: Column | None = None, key: str = "document_id", order: str = "pos") -> DataFrame:
    """``(key, section, heading, paragraph, text, pages, lines)``: paragraphs of ``paragraph_lines``, numbered from 0 within their section.

    Those of numbers only, and those that ``furniture`` (a condition on ``text``) tells, are left out. One that starts
    like a continuation, or follows one without a final stop, goes on with it, unless that ends in a colon and a list
    item begins. What still has no final stop is left out.
    """
    whole = lambda x: join_lines(F.transform(x, lambda i: i["text"]))
    own = lines.where(~F.col("is_heading")).groupBy(key, "section", "paragraph").agg(F.first("heading").alias("heading"), F.array_sort(F.collect_list(F.struct(order, "text", "page"))).alias("_l"))
    own = own.withColumn("text", whole(F.col("_l"))).where(~F.col("text").rlike("^[\\d.%\\s,\\-–−]+$"))
    if furniture is not None:
        own = own.where(~F.coalesce(furniture, F.lit(False)))
    before = F.lag("text").over(Window.partitionBy(key, "section").orderBy("paragraph"))
    listed = F.rtrim(before).endswith(":") & F.col("text").rlike("^\\(?\\d+[.)]")
    goes_on = ~listed & (starts_like_continuation("text") | ~has_terminal_punctuation(before))
    own = islands(own, [key, "section"], ["paragraph"], ~F.coalesce(goes_on, F.lit(False)), "_n")
    out = own.groupBy(key, "section", "_n").agg(F.first("heading").alias("heading"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("paragraph", "_l"))), lambda x: x["_l"])).alias("_l"))
    out = out.withColumn("text", whole(F.col("_l"))).where(has_terminal_punctuation("text"))
    number = (F.row_number().over(Window.partitionBy(key, "section").orderBy("_n")) - 1).cast("int")
    pages = F.array_sort(F.array_distinct(F.transform("_l", lambda x: x["page"])))
    return out.select(key, "section", "heading", number.alias("paragraph"), "text", pages.alias("pages"), F.size("_l").alias("lines"))

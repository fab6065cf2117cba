"""Evaluation passages inside a training corpus: Wu-Manber search for many patterns at once.

Every run of ``words`` consecutive words of a test item (of ``characters`` consecutive characters, for items in
scripts without spaces) is a pattern over the item's stream: its letters, marks and digits in one case and width,
without blanks, punctuation and invisible characters. Each document's stream is scanned with one window of the length
``m`` of the shortest pattern: a shift table over blocks of characters says how far the window may move, and only
where that is nothing does the bucket of that block give the patterns to compare directly. With blocks of eight
characters hardly any position of an unrelated text is in the table, so a scan looks at about one position in
``m - 7``. A hit in a word pattern counts if it begins and ends at words of the document.

The corpus is never shuffled and needs no key; the result is produced in the pass that reads it. Test items are
searched in blocks of at most ``block_chars`` characters each, so what a worker holds is bounded however many items
there are: about 122 bytes a character, which is 120 MB for the default. Every further block is one more pass.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type


def _mark_ranges() -> str:
    """Combining marks as a character class, without variation selectors and the grapheme joiner, which show nothing."""
    marks = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Mn", "Mc") and not (0xFE00 <= c <= 0xFE0F or 0xE0100 <= c <= 0xE01EF or c == 0x34F)]
    out, i = [], 0
    while i < len(marks):
        j = i
        while j + 1 < len(marks) and marks[j + 1] == marks[j] + 1:
            j += 1
        out.append(f"{chr(marks[i])}-{chr(marks[j])}")
        i = j + 1
    return "".join(out)


_MARKS = _mark_ranges()
_OTHER = re.compile(rf"[^\w{_MARKS}]+")
_WORD = re.compile(rf"(?:[^\W_]|[{_MARKS}])+")
_HIDDEN = re.compile("[\u00ad\u034f\u061c\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufe00-\ufe0f\ufeff]|[\U000e0100-\U000e01ef]")
_SPACELESS = re.compile("[\u0e00-\u0e7f\u0e80-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def folded(text: str) -> str:
    """One case and width; nothing is taken out."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())


def stream(text: str) -> str:
    """The letters, marks and digits of a text in one case and width."""
    return _OTHER.sub("", folded(text).replace("_", ""))


def item_patterns(text: str, words: int, characters: int) -> tuple[bool, list[str]]:
    """Whether the item is in a script with spaces, and its patterns; none if it is too short."""
    own = _WORD.findall(_HIDDEN.sub("", folded(text)))
    whole = "".join(own)
    if len(_SPACELESS.findall(whole)) > len(_WORD.findall(_SPACELESS.sub(" ", " ".join(own)))):  # names in another script don't count for their length
        return False, [whole[i : i + characters] for i in range(len(whole) - characters + 1)]
    return True, ["".join(own[i : i + words]) for i in range(len(own) - words + 1)]


class WuManber:
    """Search for many strings at once; ``find`` gives the offset and the number of each occurrence."""

    def __init__(self, patterns: Iterable[str], block: int = 8):
        self.patterns = list(dict.fromkeys(p for p in patterns if p))
        self.m = m = min(map(len, self.patterns), default=0)
        self.b = b = max(1, min(block, (m + 1) // 2))
        self.far = m - b + 1
        self.shift: dict[str, int] = {}
        self.buckets: dict[str, list[str]] = {}
        for p in self.patterns:
            for i in range(m - b + 1):
                key, s = p[i : i + b], m - b - i
                if s < self.shift.get(key, self.far):
                    self.shift[key] = s
            self.buckets.setdefault(p[m - b : m], []).append(p)

    def find(self, text: str) -> Iterator[tuple[int, str]]:
        if not self.patterns:
            return
        m, b, far, get, buckets = self.m, self.b, self.far, self.shift.get, self.buckets
        at, last = m - b, len(text) - b
        while at <= last:
            s = get(text[at : at + b], far)
            if s:
                at += s
                continue
            start = at - (m - b)
            for p in buckets[text[at : at + b]]:
                if text.startswith(p, start):
                    yield start, p
            at += 1


class _Matcher:
    def __init__(self, items: list[tuple[int, str]], words: int, characters: int):
        self.owners: dict[str, list[tuple[int, bool]]] = {}
        for item, text in items:
            spaced, patterns = item_patterns(text, words, characters)
            for p in dict.fromkeys(patterns):
                self.owners.setdefault(p, []).append((item, spaced))
        self.search = WuManber(self.owners)

    def items_in(self, text: str) -> list[int]:
        found: set[int] = set()
        starts: set[int] | None = None
        ends: set[int] = set()
        for at, p in self.search.find(stream(text)):
            for item, spaced in self.owners[p]:
                if item in found:
                    continue
                if spaced:
                    if starts is None:
                        starts, n = set(), 0
                        for w in _WORD.finditer(_HIDDEN.sub("", folded(text))):
                            starts.add(n)
                            n += w.end() - w.start()
                            ends.add(n)
                    if at not in starts or at + len(p) not in ends:
                        continue
                found.add(item)
        return sorted(found)


def leaked_items(documents: DataFrame, items: DataFrame, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", words: int = 12, characters: int = 30, block_chars: int = 1_000_000) -> DataFrame:
    """``(item, doc)`` for every document with ``words`` consecutive words (or ``characters`` characters) of an item.

    Null, blank or shorter texts on either side match nothing; an item that is repeated under several ids gives a row
    for each; a document of several rows gives rows for each. Other columns are not read. The output columns carry
    the names of the id columns, prefixed if these are the same.
    """
    items, documents = (t.select(F.col(c), F.col(text_col).alias("text")).where("text is not null") for t, c in ((items, item_col), (documents, doc_col)))
    if item_col == doc_col:
        item_col, doc_col = f"item_{item_col}", f"doc_{doc_col}"
    items, documents = items.toDF(item_col, "text").distinct(), documents.toDF(doc_col, "text")
    blocks = max(1, -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars))
    docs = documents
    schema = f"`{item_col}` {items.schema[item_col].dataType.simpleString()}, `{doc_col}` {docs.schema[doc_col].dataType.simpleString()}"
    out = None
    for k in range(blocks):
        block = [(r[0], r[1]) for r in items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).collect()]
        sent = documents.sparkSession.sparkContext.broadcast((block, words, characters))

        def emit(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = _Matcher(*sent.value)
            for batch in batches:
                rows, of = [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    for item in matcher.items_in(text):
                        rows.append(i)
                        of.append(item)
                docs_of = batch.column(0).take(pa.array(rows, type=pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(of, type=item_type), docs_of], [item_col, doc_col])

        item_type = to_arrow_type(items.schema[item_col].dataType)
        part = docs.mapInArrow(emit, schema)
        out = part if out is None else out.unionByName(part)
    return out

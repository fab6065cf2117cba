"""Text that looks the same but differs in its characters: one consistent form by tries and an edit automaton.

Each character is a *look*: its letter, mark, digit or sign without width and encoding, by one table (``looks``).
Compatibility forms fold only where the difference can't be seen (width, ligatures, no-break variants), so raised
and lowered digits stay apart; accents become marks of their own; Greek and Cyrillic letters of the same shape
as a Latin one become that; white space of any width is one blank, and what shows nothing is ignorable.

A vocabulary is kept as a trie over its strings as written, a node per letter with its marks. A string is matched by a weighted
edit automaton that walks the trie: it may replace a character by a look-alike, skip an ignorable on either side, widen
or narrow a blank, and take an accented letter for a letter and marks, all at no cost; other substitutions,
insertions and deletions cost one each. With ``most=0`` it accepts just what looks the same. Each group of vocabulary
strings that look the same has one canonical spelling, and a string that matches nothing is normalised by the table.

The vocabulary is cut into shards of about ``shard_chars`` characters, by the form of its strings, so what is sent to
an executor at once is bounded; each shard is searched for all strings in a pass of its own, and a partition answers
each distinct string once.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.sources.scratch import Scratch

#: Letters of other scripts and the Latin letters of the same shape (fixed values), in pairs.
SAME_SHAPE = {
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y",
    "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ӏ": "I", "Ԍ": "G",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "ѕ": "s", "і": "i", "ј": "j", "ԛ": "q", "ԝ": "w", "һ": "h", "ԁ": "d", "ү": "y", "ӏ": "l", "ѵ": "v", "ɡ": "g",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J", "ι": "i", "α": "a", "ρ": "p",
    # Armenian and other single letters
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "Օ": "O", "Ս": "U", "ı": "i", "\u217c": "l",
    # Cherokee
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮐ": "G", "Ꮓ": "Z", "Ꮖ": "I", "Ꮞ": "4", "Ꮟ": "b", "Ꮢ": "R", "Ꮤ": "W", "Ꮥ": "S", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ᏼ": "B",
    # Coptic
    "Ⲁ": "A", "Ⲃ": "B", "Ⲉ": "E", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "ⲟ": "o", "Ⲣ": "P", "ⲣ": "p", "Ⲥ": "C", "ⲥ": "c", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X", "ⲭ": "x",
    # Lisu
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
    # phonetic and small capital letters
    "ɑ": "a", "ɪ": "i", "ᴄ": "c", "ᴏ": "o", "ᴜ": "u", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s", "ʋ": "u", "ɩ": "i", "ʏ": "y",
    # signs
    "‐": "-", "‑": "-", "⁃": "-", "˗": "-",
}

_UNSEEN = ("<wide>", "<narrow>", "<small>", "<noBreak>", "<compat>")


@lru_cache(maxsize=200_000)
def looks(c: str) -> str:
    """The looks of one character: none if it shows nothing, a blank for white space, else letters and marks."""
    n = ord(c)
    if n < 128 and c.isprintable():
        return c
    if c.isspace():
        return " "
    if unicodedata.category(c) in ("Cf", "Cc") or 0xFE00 <= n <= 0xFE0F or 0xE0100 <= n <= 0xE01EF or n in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0):
        return ""
    if c in SAME_SHAPE:
        return SAME_SHAPE[c]
    if 0xAC00 <= n <= 0xD7A3:
        return unicodedata.normalize("NFD", c)  # a Hangul syllable is its letters
    parts = unicodedata.decomposition(c).split()
    if parts and parts[0].startswith("<"):
        if parts[0] not in _UNSEEN:
            return c
        parts = parts[1:]
    return "".join(looks(chr(int(p, 16))) for p in parts) if parts else c


def table_form(text: str) -> str:
    """A string by the table alone: looks in canonical order of marks, single blanks, none at the ends."""
    if text.isascii() and text.isprintable():
        return " ".join(text.split(" ")).strip() if "  " not in text else " ".join(text.split())
    seen = "".join(map(looks, text))
    if not seen.isascii():
        seen = unicodedata.normalize("NFD", seen)
    return " ".join(seen.split())


def clusters(text: str) -> list[tuple[str, str]]:
    """A string in parts of a letter and what hangs on it, with the looks of each in canonical order of marks.

    A part begins where looks begin with anything but a mark, so that joined looks are those of the whole string.
    """
    if text.isascii():
        return [(c, looks(c)) for c in text]
    out: list[list[str]] = []
    for c in text:
        seen = looks(c)
        if out and (not seen or unicodedata.combining(seen[0])):
            out[-1][0] += c
            out[-1][1] += seen
        else:
            out.append([c, seen])
    return [(c, unicodedata.normalize("NFD", seen)) for c, seen in out]


class Trie:
    """Strings as written, a node for each letter with its marks, and the automaton that reads a string against them."""

    def __init__(self, words: list[str]):
        self.words = sorted(set(words))
        self.root: dict = {}
        self.looks: dict[str, str] = {}
        for i, w in enumerate(self.words):
            node = self.root
            for c, seen in clusters(w):
                self.looks[c] = seen
                node = node.setdefault(c, {})
            node.setdefault("", []).append(i)
        self.closed: dict[tuple, dict] = {}

    def _step(self, node: dict, pending: str) -> dict[str, list[tuple[dict, str]]]:
        """Next looks of a position (a node and looks not yet read), past ignorables; '' is the end."""
        key = (id(node), pending)
        if (got := self.closed.get(key)) is None:
            got = {}
            if pending:
                got.setdefault(pending[0], []).append((node, pending[1:]))
            else:
                stack = [node]
                while stack:
                    at = stack.pop()
                    for c, below in at.items():
                        if c == "":
                            got.setdefault("", []).append((at, ""))
                        elif seen := self.looks[c]:
                            got.setdefault(seen[0], []).append((below, seen[1:]))
                        else:
                            stack.append(below)
            if len(self.closed) > 200_000:
                self.closed.clear()
            self.closed[key] = got
        return got

    def match(self, text: str, most: int = 0) -> list[int]:
        """Numbers of the words within ``most`` edits of a string, look-alikes and ignorables being free."""
        wanted = table_form(text)
        # A state is a position in the trie and whether a blank was read last (or nothing yet), so that runs of
        # blanks count once and those at the ends not at all.
        states: dict[tuple, tuple] = {(id(self.root), "", True): (self.root, "", True, 0)}
        states = self._blanks(states)
        if most:
            states = self._inserted(states, most)
        for x in wanted:
            after: dict[tuple, tuple] = {}
            for node, pending, blank, cost in states.values():
                for look, nexts in self._step(node, pending).items():
                    if look == "":
                        continue
                    price = cost + (look != x)
                    if price <= most:
                        for below, rest in nexts:
                            _put(after, below, rest, look == " ", price)
                if cost < most:
                    _put(after, node, pending, blank, cost + 1)
            states = self._blanks(after)
            if most:
                states = self._inserted(states, most)
            if not states:
                return []
        found = set()
        for node, pending, _, _ in states.values():
            if not pending:
                for at, _ in self._step(node, pending).get("", []):
                    found.update(at[""])
        return sorted(found)

    def _blanks(self, states: dict) -> dict:
        """Adds what is reached by further blanks after one, or at the ends."""
        stack = list(states.values())
        while stack:
            node, pending, blank, cost = stack.pop()
            for below, rest in self._step(node, pending).get(" ", []):
                if blank or self._only_blanks(below):
                    if _put(states, below, rest, True, cost):
                        stack.append((below, rest, True, cost))
        return states

    def _only_blanks(self, node: dict) -> bool:
        """Whether a word ends here, but for blanks and ignorables."""
        return any(c == "" or (self.looks[c] in ("", " ") and self._only_blanks(below)) for c, below in node.items())

    def _inserted(self, states: dict, most: int) -> dict:
        stack = list(states.values())
        while stack:
            node, pending, blank, cost = stack.pop()
            if cost < most:
                for look, nexts in self._step(node, pending).items():
                    for below, rest in nexts if look else []:
                        if _put(states, below, rest, look == " ", cost + 1):
                            stack.append((below, rest, look == " ", cost + 1))
        return states


def _put(states: dict, node: dict, pending: str, blank: bool, cost: int) -> bool:
    key = (id(node), pending, blank)
    old = states.get(key)
    if old is None or cost < old[3]:
        states[key] = (node, pending, blank, cost)
        return True
    return False


def canonical_spelling(spellings: list[str]) -> str:
    """Of strings that look the same, the plainest: fewest characters that the table changes, then first by code."""
    return min(spellings, key=lambda s: (sum(looks(c) != c for c in unicodedata.normalize("NFC", s) if not c.isalpha()), s != unicodedata.normalize("NFC", s), not s.isascii(), s))


#: Characters of a vocabulary shard: about 200 MB in a Python worker with the automaton's memo (167 bytes a character and the answers kept).
SHARD_CHARS = 1_000_000


def _vocabulary(lexicon: DataFrame, id_col: str, aliases_col: str) -> DataFrame:
    """Distinct ``(entry, alias)``; null ids and null or blank aliases are left out."""
    return lexicon.select(F.col(id_col).alias("entry"), F.explode(aliases_col).alias("alias")).where("entry is not null and trim(alias) <> ''").distinct()


def _shards(words: DataFrame, shard_chars: int) -> list[list[str]]:
    """The distinct vocabulary strings, a list for each shard; strings that look the same share a shard, and the number of shards grows with the vocabulary."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([table_form(a) for a in b.column(0).to_pylist()], pa.string())], ["alias", "form"])

    total = words.agg(F.sum(F.length("alias") + 1)).first()[0] or 0
    n = max(1, -(-total // shard_chars))
    formed = words.mapInArrow(emit, "alias string, form string")
    return [[r[0] for r in formed.where(F.pmod(F.xxhash64("form"), F.lit(n)) == k).select("alias").collect()] for k in range(n)]


def matches(texts: DataFrame, lexicon: DataFrame, text_col: str, id_col: str = "canonical_id", aliases_col: str = "aliases", most: int = 0, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """``texts`` with ``alias``: a row for each vocabulary string that the text matches; texts without one are left out.

    Null and empty texts match nothing. A partition remembers the answers for its latest distinct texts.
    """
    words = _vocabulary(lexicon, id_col, aliases_col).select("alias").distinct()
    out = None
    kept = [c for c in texts.columns if c != "alias"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*kept).schema) + ", alias string"
    for shard in _shards(words, shard_chars):
        sent = texts.sparkSession.sparkContext.broadcast(shard)

        def emit(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            trie, known = Trie(sent.value), {}
            for b in batches:
                at, aliases = [], []
                for i, text in enumerate(b.column(kept.index(text_col)).to_pylist()):
                    if not text:
                        continue
                    if (hits := known.get(text)) is None:
                        if len(known) > 100_000:
                            known.clear()
                        hits = known[text] = [trie.words[k] for k in trie.match(text, most)]
                    at += [i] * len(hits)
                    aliases += hits
                rows = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([c.take(rows) for c in b.columns] + [pa.array(aliases, pa.string())], [*kept, "alias"])

        part = texts.select(*kept).where(F.col(text_col).isNotNull()).mapInArrow(emit, schema)
        out = part if out is None else out.unionByName(part)
    return out


def _canonical(texts: DataFrame, shards: list[list[str]], text_col: str, name: str, by_table: bool) -> DataFrame:
    """``texts`` with the canonical spelling of the vocabulary strings that look like the text; of others the table's form, or null."""
    out = texts.drop(name).withColumn(name, F.lit(None).cast("string"))
    names = out.columns
    for k, shard in enumerate(shards):
        sent = texts.sparkSession.sparkContext.broadcast(shard)

        def emit(batches: Iterator[pa.RecordBatch], sent=sent, last=by_table and k == len(shards) - 1) -> Iterator[pa.RecordBatch]:
            trie, known = Trie(sent.value), {}
            for b in batches:
                forms = []
                for text, form in zip(b.column(names.index(text_col)).to_pylist(), b.column(names.index(name)).to_pylist()):
                    if form is None and text is not None:
                        if text not in known:
                            if len(known) > 100_000:
                                known.clear()
                            hits = [trie.words[i] for i in trie.match(text)]
                            known[text] = canonical_spelling(hits) if hits else unicodedata.normalize("NFC", table_form(text)) if last else None
                        form = known[text]
                    forms.append(form)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(forms, pa.string())], names)

        out = out.mapInArrow(emit, out.schema)
    return out


def consistent_form(texts: DataFrame, lexicon: DataFrame, text_col: str, id_col: str = "canonical_id", aliases_col: str = "aliases", shard_chars: int = SHARD_CHARS) -> DataFrame:
    """``texts`` with ``form``: the canonical spelling of what the text looks like in the vocabulary, else the table's form.

    Null texts have a null form. An own column ``form`` is replaced.
    """
    shards = _shards(_vocabulary(lexicon, id_col, aliases_col).select("alias").distinct(), shard_chars)
    return _canonical(texts, shards, text_col, "form", True)


def same_looking(mentions: DataFrame, lexicon: DataFrame, mention_id: str = "resolution_id", text_col: str = "surface_text", id_col: str = "canonical_id", aliases_col: str = "aliases", shard_chars: int = SHARD_CHARS) -> DataFrame:
    """``(key_a, key_b)``: mentions and entries, and pairs of entries, that look the same without sharing a string.

    A mention meets an entry if it looks like one of the entry's aliases and equals none of them; two entries meet if
    an alias of one looks like an alias of the other and they have no alias in common. The smaller key comes first. An
    entry of several rows has the aliases of all of them. Null keys meet nothing.

    The trie gives each distinct string the canonical spelling of its class; only different spellings of a class are
    paired, so an alias that very many entries hold joins none of them with each other.
    """
    scratch = Scratch(mentions.sparkSession, "lookalikes")
    vocabulary = scratch.put(_vocabulary(lexicon, id_col, aliases_col))
    own = mentions.select(F.col(mention_id).alias("key"), F.col(text_col).alias("text")).where("key is not null and text <> ''")
    aliases = vocabulary.select("alias").distinct()
    shards = _shards(aliases, shard_chars)
    spellings = scratch.put(_canonical(aliases, shards, "alias", "look", False))
    seen = _canonical(own.select("text").distinct(), shards, "text", "look", False).where("look is not null")
    met = seen.join(spellings, "look").where("alias <> text").select("text", "alias").join(vocabulary, "alias").select("text", "entry").distinct()
    met = met.join(vocabulary.withColumnRenamed("alias", "text"), ["entry", "text"], "left_anti")
    met = own.join(met, "text").select("key", "entry")
    others = spellings.join(spellings.select("look", F.col("alias").alias("other")), "look").where("alias <> other").select("alias", "other")
    pairs = others.join(vocabulary.withColumnRenamed("entry", "key"), "alias").join(vocabulary.withColumnRenamed("alias", "other"), "other")
    pairs = scratch.put(pairs.where("key < entry").select("key", "entry").distinct())
    shared = pairs.join(vocabulary.withColumnRenamed("entry", "key"), "key").join(vocabulary, ["entry", "alias"], "left_semi")
    both = met.unionByName(pairs.join(shared.select("key", "entry").distinct(), ["key", "entry"], "left_anti"))
    return both.select(F.least("key", "entry").alias("key_a"), F.greatest("key", "entry").alias("key_b")).distinct()

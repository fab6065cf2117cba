"""Sentence boundaries across languages and scripts: candidates classified by a maximum-entropy model.

A text is cut into units at blank lines; a unit's end always ends a sentence and a single line break never does.
Inside a unit every stop mark outside a quotation, with the closing quotes and brackets and bracketed citations right
after it, is a candidate boundary. A candidate is described by the token before it, the token after it, their case,
length, digits and script, the mark and what closes after it. How often a token ends units as against standing before
a stop inside one, and how often a token begins units as against following a stop, are counted over all documents: an
abbreviation is a token that hardly ever ends a unit.

The model is trained on reliable boundaries only. Ends of units are boundaries, and so are stops after a token that ends
units as often as others and after which lower case hardly ever follows, whatever follows there; stops before a token that never begins
a unit (if the token before the stop is known to go on), and stops after a token that occurs often but never ends one, are not. Its weights come from a bounded sample
of documents (``training_documents``), the counts from all.

The corpus is read once: one pass counts the tokens and writes, for each document, where its candidates are and of what
kind, a few bytes each; when the model is fitted, these decide without the text. A decision is one dictionary lookup
for each candidate, so that the cost is that of finding the stops.

In Thai a space between two characters that are not digits ends a sentence.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.sources.scratch import Scratch

_BREAK = "(?>\r\n|[\n\r\x0b\x0c\x85\u2028])[^\\S\n\r]*"  # atomic: a carriage return and line feed are one break
_UNIT_END = re.compile(f"{_BREAK}(?:{_BREAK})+|\u2029")
_STOP = re.compile("[.!?\u2026\u3002\uff01\uff1f\uff61\u061f\u06d4\u0964\u0965]+")
_GOES_ON = frozenset("abcdefghijklmnopqrstuvwxyz0123456789,;:/-")  # after one of these a full stop ends nothing
_ODD_BREAK = re.compile("[\r\x0b\x0c\x85\u2028\u2029]|\n[^\\S\n]")
_FREE = frozenset("\u3002\uff01\uff1f\uff61\u0964\u0965\u06d4")  # marks after which no space is needed
_QUOTES = re.compile("[\u201c\u201d\u201e\u00ab\u00bb\u300c\u300d\u300e\u300f\u2039\u203a\"]")
_CLOSES = {"\u201c": "\u201d", "\u201e": "\u201c\u201d", "\u00ab": "\u00bb", "\u300c": "\u300d", "\u300e": "\u300f", "\u2039": "\u203a", '"': '"'}
_OPENED_BY = {c: [q for q, closing in _CLOSES.items() if c in closing] for closing in _CLOSES.values() for c in closing}
_BRACKETS = frozenset(")]}\uff09\u3011\u3015\uff3d")
_LEADING = ".!?\u2026\u3002\uff01\uff1f\u061f\u0964\u201d\u201c\u00bb\u300d)\uff09]"
_OPENERS = "([{\uff08\u3010\u201c\u201e\u00ab\u300c\u300e\u2039\"\u00bf\u00a1"
_CITATION = re.compile("\\[\\d[\\d,;\u2013\u2014\\- ]*\\]")
_SCRIPTS = re.compile("([\u3040-\u30ff])|([\u4e00-\u9fff])|([\u0e00-\u0e7f])|([\u0900-\u097f])|([\u0600-\u06ff])|([\u0400-\u04ff])")
_OTHER_SCRIPT = re.compile("[\u0400-\u04ff\u0600-\u06ff\u0900-\u097f\u0e00-\u0e7f\u3040-\u30ff\u4e00-\u9fff]")
_NEXT = re.compile("\\s*([\\w.\u2019'-]*)")
_GLUED = re.compile("^.*[^\\W\\d_]{3}[.!?\u2026](?=[^\\W\\d_])")  # the end of a sentence that no space follows
_DIGITS = re.compile("\\d+")
_THAI_SPACE = re.compile("(?<=[^\\s\\d])[^\\S\n\r]+(?=[^\\s\\d])")
_SPACE = re.compile("\\s")
_THAI = re.compile("[\u0e00-\u0e7f]")


def units(text: str) -> Iterator[tuple[int, int]]:
    """Parts between blank lines, without surrounding white space."""
    if ("\r" not in text and "\x0b" not in text and "\x0c" not in text and "\n " not in text and "\n\t" not in text) if text.isascii() else not _ODD_BREAK.search(text):
        at = 0
        for part in text.split("\n\n"):
            end = at + len(part)
            if part:
                if part[0].isspace() or part[-1].isspace():
                    if bare := part.strip():
                        start = at + part.index(bare[0])
                        yield start, start + len(bare)
                else:
                    yield at, end
            at = end + 2
        return
    at = 0
    for m in [*_UNIT_END.finditer(text), None]:
        end = m.start() if m else len(text)
        part = text[at:end]
        bare = part.strip()
        if bare:
            start = at + part.index(bare[0])
            yield start, start + len(bare)
        at = m.end() if m else end


def _script(unit: str) -> str:
    if unit.isascii() or not (m := _OTHER_SCRIPT.search(unit)):
        return "l"
    found = {m.lastindex for m in _SCRIPTS.finditer(unit, m.start())}
    return "khtdac"[min(found) - 1] if found else "l"


def _quotations(unit: str) -> list[tuple[int, int]]:
    """Outermost quotations that are closed within the unit, as positions of both marks."""
    if not _QUOTES.search(unit):
        return []
    stack: list[tuple[str, int]] = []
    places: dict[str, list[int]] = {}  # of each opening mark in the stack
    pairs = []
    for m in _QUOTES.finditer(unit):
        c, i = m[0], m.start()
        opened = [places[q] for q in _OPENED_BY.get(c, ()) if places.get(q)]
        if opened:
            k = max(own[-1] for own in opened)  # the innermost that this mark closes
            pairs.append((stack[k][1], i))
            for q, _ in stack[k:]:
                places[q].pop()
            del stack[k:]
        elif c in _CLOSES:
            places.setdefault(c, []).append(len(stack))
            stack.append((c, i))
    pairs.sort()
    out: list[tuple[int, int]] = []
    for a, b in pairs:
        if not out or a > out[-1][1]:
            out.append((a, b))
    return out


_SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace() and c != 32]
_seen_before: dict[str, str] = {}
_seen_after: dict[tuple[str, bool], str] = {}


def _token_before(raw: str) -> str:
    """The token before a stop: digits alike, without opening marks and without an earlier sentence that no space follows."""
    if (w := _seen_before.get(raw)) is None:
        if len(_seen_before) > 100_000:
            _seen_before.clear()
        w = _seen_before[raw] = _DIGITS.sub("0", _GLUED.sub("", raw.lstrip(_OPENERS)))
    return w


def _token_after(raw: str, short: bool) -> str:
    """The token after a stop: its leading word, a number as 0, two characters in scripts without spaces, or its first mark."""
    key = raw, short
    if (token := _seen_after.get(key)) is None:
        if len(_seen_after) > 100_000:
            _seen_after.clear()
        token = _NEXT.match(raw)[1]
        if not token:
            token = raw[:1]
        elif short and not token[0].isascii():
            token = token[:2]
        else:
            token = token.rstrip(".'\u2019-") or "."
            if token[0].isdigit():
                token = "0"
        _seen_after[key] = token
    return token


def _views(text: str) -> tuple[str, bool, bool]:
    """A text with every white space as a blank, and whether it has any other script than Latin and any quotation mark."""
    flat = text.replace("\n", " ").replace("\r", " ").replace("\t", " ")
    if text.isascii():
        if not text.isprintable():
            for c in "\x0b\x0c\x1c\x1d\x1e\x1f":
                flat = flat.replace(c, " ")
        return flat, False, '"' in text
    for c in _SPACES:
        flat = flat.replace(c, " ")
    return flat, _OTHER_SCRIPT.search(text) is not None, _QUOTES.search(text) is not None


def _candidates(unit: str, flat: str, script: str, quoted: bool) -> list[tuple[int, tuple]]:
    """``(end, next start, kind)`` of each candidate; kind is (token before, token after, mark, closers, opening quote leads, citation, no space, script). At the unit's end the token after is empty.

    The token before a stop reaches to the blank before it, in scripts without spaces it is the last two characters.
    """
    out: list[tuple[int, int, tuple]] = []
    quotes = _quotations(unit) if quoted else ()
    ends = {b: a for a, b in quotes} if quotes else ()
    plain = script in "lc"
    n, q, spaceless = len(unit), 0, script in "hkt"
    blank, known_to = -1, 0  # the last blank before a stop, and how far blanks were looked for
    for m in _STOP.finditer(unit):
        i, j = m.span()
        if j - i == 1 and j < n and unit[j] in _GOES_ON and unit[i] == ".":
            continue
        if quotes:
            while q < len(quotes) and quotes[q][1] < i:
                q += 1
            if q < len(quotes) and quotes[q][0] < i:
                close = quotes[q][1]
                if not (close == j or (close == j + 1 and (flat[j] == " " or flat[j] in _BRACKETS))):
                    continue
        mark = unit[i]
        if mark == "." and j - i > 1:
            mark = "\u2026"
        closers, leads, cited, joined, token = "", False, False, False, ""
        if j < n and (flat[j] != " " or j + 1 in ends):
            while j < n:
                c = flat[j]
                if j in ends or (c == " " and j + 1 in ends and flat[j + 1] == "\u00bb"):
                    j += c == " "
                    closers += "q"
                    at = ends[j] - 1
                    while at >= 0 and flat[at] == " ":
                        at -= 1
                    leads = at < 0 or unit[at] in _LEADING
                    j += 1
                elif c in _BRACKETS:
                    closers += "b"
                    j += 1
                elif c == "[" and (cite := _CITATION.match(unit, j)):
                    cited = True
                    j = cite.end()
                else:
                    break
        at = j
        if j < n:
            c = flat[j]
            if c != " ":
                joined = True
                if c in ",;:\u3001\uff0c\uff1b\uff1a":
                    continue
                if mark not in _FREE and flat[j - 1] not in _FREE and not ((closers or mark == "\u2026") and script in "hk"):
                    if c.isupper() or c in "\u00bf\u00a1\u201c\u201e\u00ab(":
                        if mark == "." and not closers and not cited and not _wordlike(unit, i, j):
                            continue
                    elif c.isascii() or not c.isalpha() or c.islower() or i == 0 or unit[i - 1].isascii():  # letters without case may begin a sentence
                        continue
            else:
                at = j + 1
                while flat[at] == " ":
                    at += 1
            to = flat.find(" ", at)
            raw = flat[at : to if to > 0 else n]
            token = _seen_after.get((raw, spaceless)) or _token_after(raw, spaceless)
            if not joined and plain and i > 40 and token.islower() and "." not in token and flat[i - 60 if i > 60 else 0 : i].islower():
                token = token.capitalize()  # a passage without capitals: what follows its stops says nothing by its case
        if mark == "." and not closers:
            if (found := flat.rfind(" ", known_to, i)) >= 0:
                blank = found
            known_to = i
            raw = flat[max(blank + 1, i - 2) if spaceless and i and not flat[i - 1].isascii() else blank + 1 : i]
            w = _seen_before.get(raw)
            if w is None:
                w = _token_before(raw)
        else:
            w = f"{mark}{closers}{script}{'L' if leads else ''}"
        out.append((j, at, (w, token, mark, closers, leads, cited, joined, script)))
    return out


def _wordlike(unit: str, i: int, j: int) -> bool:
    """Whether a stop without space after it may be an end: a word or number before it and a capitalised word after it."""
    head = unit[max(0, i - 3) : i]
    if len(head) < 2 or "." in head[-2:] or head[-2:].isspace():
        return False
    tail = unit[j : j + 2]
    return len(tail) == 2 and (tail[1].islower() or tail[1].isspace() or not tail[0].isalpha()) and (head[-1].isalnum() or head[-1] in "%)\u00b3\u00b2")


def _shape(token: str) -> str:
    c = token[0]
    if c.isdigit():
        return "d"
    if c.isupper():
        return "U"
    if c.islower():
        return "M" if any(x.isupper() for x in token) else "l"
    if c in _OPENERS:
        return "q" if c in "\u201c\u201e\u00ab\u300c\u300e\u2039\"" else "b"
    return "o" if c.isalpha() else "-"


def _before(w: str) -> str:
    if not w:
        return "none"
    if "." in w:
        return "dotted"
    if len(w) == 1:
        return "U1" if w.isupper() else "l1" if w.islower() else "s1"
    if w[-1].isdigit():
        return "num"
    return ("U" if w[0].isupper() else "x") + ("s" if len(w) <= 3 else "m" if len(w) <= 6 else "l")


class Levels:
    """Levels of tokens by their 64-bit hashes in order: nine bytes a token, so every token with evidence is kept."""

    def __init__(self, hashes: np.ndarray, levels: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.levels = hashes[order], levels[order]

    @staticmethod
    def hash(token: str) -> int:
        return int.from_bytes(hashlib.blake2b(token.encode("utf_8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)

    def get(self, token: str, default: int | None = None) -> int | None:
        h = self.hash(token)
        at = int(np.searchsorted(self.hashes, np.int64(h)))
        return int(self.levels[at]) if at < len(self.hashes) and self.hashes[at] == h else default

    def __contains__(self, token: str) -> bool:
        return self.get(token) is not None

    def __len__(self) -> int:
        return len(self.hashes)


class Model:
    """Counts of tokens and the weights of their features; ``ends(kind)`` decides one kind of candidate."""

    def __init__(self, before: dict[str, int] | Levels, after: dict[str, int] | Levels, inner: dict[str, int] | Levels, weights: dict[str, float]):
        self.before, self.after, self.inner, self.weights = before, after, inner, weights
        self.known: dict[tuple, bool] = {}
        self.texts: dict[str, bool] = {}
        self.lefts: dict[str, tuple] = {}
        self.rights: dict[str, tuple] = {}

    @staticmethod
    def level(yes: int, no: int, base: float) -> int:
        """How often a token is found at a unit's edge, against the average: 0 (never) to 4 (as often as others)."""
        ratio = (yes + 1) / (base * (yes + no) + 1)
        return sum(ratio >= x for x in (0.1, 0.2, 0.35, 0.65))

    @staticmethod
    def share(low: int, others: int) -> int:
        """How often lower case follows a token and its stop: 0 (hardly ever, or not known) to 2."""
        return sum(low / (low + others + 2) >= x for x in (0.12, 0.4))

    def reliable(self, kind: tuple) -> bool:
        """Whether a stop inside a unit is certainly no boundary: what is before it never ends a unit, or what follows never begins one while the token before it is known to go on."""
        return self.before.get(kind[0], 4) == 0 or (self.after.get(kind[1], 4) == 0 and (self.inner.get(kind[0], 0) > 0 or not kind[1].islower()))

    def ordinary(self, kind: tuple) -> bool:
        """Whether a stop inside a unit certainly is a boundary though lower case follows: the token before it ends units as often as others, and hardly ever goes on."""
        return kind[1].islower() and self.before.get(kind[0]) == 4 and self.inner.get(kind[0]) == 0

    def traits(self, kind: tuple) -> tuple:
        """What of a kind its features depend on: few values, however many tokens there are."""
        w, token, mark, closers, leads, cited, joined, script = kind
        left, right = self.lefts.get(w), self.rights.get(token)
        if left is None:
            if len(self.lefts) > 200_000:
                self.lefts.clear()
            left = self.lefts[w] = self.before.get(w, 4), self.inner.get(w, 0), _before(w), min(len(w), 6)
        if right is None:
            if len(self.rights) > 200_000:
                self.rights.clear()
            level = self.after.get(token)
            right = self.rights[token] = (3, "u", _shape(token)) if level is None else (level, "k", _shape(token))
        return left, right, mark, closers, leads, cited, script

    @staticmethod
    def features(traits: tuple) -> list[str]:
        (b, i, p, n), (a, known, s), mark, closers, leads, cited, script = traits
        if mark != "." or closers:
            p = "mark"
        return [
            "bias", f"b{b}", f"a{a}{known}", f"s{s}", f"p{p}", f"m{mark}", f"c{closers}", f"b{b}a{a}", f"b{b}s{s}", f"a{a}s{s}", f"m{mark}s{s}",
            f"c{closers}{leads}s{s}", f"p{p}s{s}", f"p{p}a{a}", f"t{cited}", f"n{n}", f"b{b}p{p}", f"i{i}", f"i{i}s{s}", f"i{i}a{a}", f"i{i}b{b}s{s}", f"i{i}b{b}a{a}s{s}", f"r{script}", f"r{script}m{mark}", f"r{script}s{s}",
        ]

    def ends(self, kind: tuple) -> bool:
        """Whether a kind of candidate is a boundary."""
        traits = self.traits(kind)
        got = self.known.get(traits)
        if got is None:
            if len(self.known) > 200_000:
                self.known.clear()
            z = sum(self.weights.get(f, 0.0) for f in self.features(traits))
            got = self.known[traits] = z >= 0
        return got

    def decide(self, first: int, ends: np.ndarray, starts: np.ndarray, kinds: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of sentences from a document's ``boundaries``."""
        known, yes = self.texts, []
        for k in kinds:
            got = known.get(k)
            if got is None:
                if len(known) > 400_000:
                    known.clear()
                got = known[k] = not k or self.ends(unwritten(k))
            yes.append(got)
        cut = np.array(yes, dtype=bool)
        return np.concatenate(([first], starts[cut][:-1])).astype(np.int32), ends[cut]

    def sentences(self, text: str) -> list[tuple[int, int]]:
        """``(start, end)`` of each sentence, without surrounding white space."""
        first, ends, starts, kinds = boundaries(text)
        if not ends:
            return []
        a, b = self.decide(first, np.array(ends, dtype=np.int32), np.array(starts, dtype=np.int32), kinds)
        return list(zip(a.tolist(), b.tolist()))


def written(kind: tuple) -> str:
    """A kind of candidate as a string; tokens have no white space and so none of its separators."""
    w, token, mark, closers, leads, cited, joined, script = kind
    return f"{w}\x1f{token}\x1f{mark}\x1f{closers}\x1f{leads:d}{cited:d}{joined:d}{script}"


def unwritten(text: str) -> tuple:
    w, token, mark, closers, flags = text.split("\x1f")
    return (w, token, mark, closers, *(f == "1" for f in flags[:3]), flags[3])


def boundaries(text: str, observe: Callable[[list, str, str], None] | None = None) -> tuple[int, list[int], list[int], list[str]]:
    """The first start, and for each boundary or candidate its end, the start of what follows, and its kind; boundaries that are sure have the empty kind.

    A sentence runs from the start after the last boundary to the end of the next. ``observe`` is told the candidates
    of each unit, the unit and its script.
    """
    first, ends, starts, kinds = 0, [], [], []
    flat, mixed, quoted = _views(text)
    for a, b in units(text):
        unit, n = text[a:b], b - a
        script = _script(unit) if mixed else "l"
        found = _candidates(unit, flat[a:b], script, quoted)
        if observe is not None:
            observe(found, unit, script)
        if ends:
            starts.append(a)
        else:
            first = a
        own = [(j, at, written(kind)) for j, at, kind in found if j < n]
        if script == "t":
            spaces = {m.start(): m.end() for m in _THAI_SPACE.finditer(unit) if _THAI.search(unit[m.start() - 1] + unit[m.end()])}
            own = sorted([*((j, at, k) for j, at, k in own if j not in spaces), *((j, at, "") for j, at in spaces.items())])
        at = 0
        for j, after, kind in own:
            if j > at and after < n:
                ends.append(a + j)
                starts.append(a + after)
                kinds.append(kind)
                at = after
        ends.append(b)
        kinds.append("")
    if ends:
        starts.append(len(text))
    return first, ends, starts, kinds


class _Counts:
    """Counts over documents: tokens at the ends and starts of units, kinds of candidates inside, and, of documents for training, kinds of ends with the start that follows."""

    def __init__(self):
        self.edges, self.kinds, self.pairs = Counter(), (Counter(), Counter()), Counter()
        self.before, self.train = None, 0

    def begin(self, train: bool) -> None:
        self.before, self.train = None, int(train)

    def __call__(self, found: list, unit: str, script: str) -> None:
        last, n, kinds = None, len(unit), self.kinds[self.train]
        seen = kinds.get
        for j, _, kind in found:
            if j == n:
                last = kind
            else:
                kinds[kind] = seen(kind, 0) + 1
        if last:
            token = _token_after(unit[: _first_blank(unit)], script in "hkt")
            self.edges["w", last[0]] += 1
            self.edges["n", token] += 1
            if self.before and self.train:
                b = self.before
                self.pairs[b[0], token, b[2], b[3], b[4], b[5], b[6], b[7]] += 1
            self.before = last

    def __len__(self) -> int:
        return len(self.edges) + len(self.kinds[0]) + len(self.kinds[1]) + len(self.pairs)

    def rows(self) -> list[tuple[str, str, bool, int]]:
        """Rows of counts: kind, token, whether at an edge (or in lower case), how many; and empties the counts."""
        inside: Counter = Counter()
        for counted in self.kinds:
            for k, n in counted.items():
                inside["w", k[0], False] += n
                inside["i", k[0], k[1].islower()] += n
                if not k[6]:
                    inside["n", k[1], False] += n
        out = [(*k, n) for k, n in inside.items()] + [(*k, True, n) for k, n in self.edges.items()]
        out += [("t", written(k), False, n) for k, n in self.kinds[1].items()] + [("t", written(k), True, n) for k, n in self.pairs.items()]
        for c in (self.edges, *self.kinds, self.pairs):
            c.clear()
        return out


def _first_blank(unit: str) -> int:
    m = _SPACE.search(unit)
    return m.start() if m else len(unit)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``(id, text, train)``: a row for each document with its boundaries, and rows of counts."""
    counts = _Counts()
    for batch in batches:
        at, firsts, ends, starts, kinds = [], [], [], [], []
        for i, (text, train) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
            counts.begin(train)
            first, e, s, k = boundaries(text, counts)
            if e:
                at.append(i)
                firsts.append(first)
                ends.append(np.array(e, dtype=np.int32).tobytes())
                starts.append(np.array(s, dtype=np.int32).tobytes())
                kinds.append("\x1e".join(k))
        n = len(at)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(firsts, pa.int32()), pa.array(ends, pa.binary()), pa.array(starts, pa.binary()), pa.array(kinds, pa.string()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.int64())], _COLUMNS)
        if len(counts) > 200_000:
            yield _count_rows(counts, batch.column(0).type)
        kind = batch.column(0).type
    if len(counts):
        yield _count_rows(counts, kind)


_COLUMNS = ["id", "first", "ends", "starts", "kinds", "kind", "token", "edge", "n"]


def _count_rows(counts: _Counts, id_type: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*counts.rows()))
    n = len(cols[0])
    return pa.RecordBatch.from_arrays([pa.nulls(n, id_type), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.string()), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.bool_()), pa.array(cols[3], pa.int64())], _COLUMNS)


def _fit(rows: list[tuple[tuple, bool, int]], model: Model, rounds: int = 25, ridge: float = 0.02) -> dict[str, float]:
    """Weights of a maximum-entropy model by Newton's method, over distinct feature lists with their counts."""
    grouped: Counter = Counter()
    for kind, yes, n in rows:
        grouped[tuple(model.features(model.traits(kind))), yes] += n
    names = sorted({f for (fs, _), _ in grouped.items() for f in fs})
    if not names or len({yes for _, yes in grouped}) < 2:
        return {"bias": 1.0}
    at = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(grouped), len(names)))
    y, c = np.zeros(len(grouped)), np.zeros(len(grouped))
    for r, ((fs, yes), n) in enumerate(sorted(grouped.items(), key=repr)):
        x[r, [at[f] for f in fs]] = 1
        y[r], c[r] = yes, n
    for yes in (0.0, 1.0):
        c[y == yes] *= 1000 / c[y == yes].sum()
    w = np.zeros(len(names))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (c * (p - y)) + ridge * w
        h = (x * (c * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(names))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return dict(zip(names, w.tolist()))


def _levels(level: Callable[[int, int], int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        token, yes, no = (b.column(k).to_pylist() for k in range(3))
        yield pa.RecordBatch.from_arrays([pa.array([Levels.hash(t) for t in token], pa.int64()), pa.array([level(y, n) for y, n in zip(yes, no)], pa.int8())], ["hash", "level"])


def _scanned(documents: DataFrame, id_col: str, text_col: str, training_documents: int) -> DataFrame:
    """A written table of the boundaries of all documents and the counts over them, from one pass over the texts."""
    every = max(1, -(-documents.count() // training_documents))  # rows are counted from the footers
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    docs = docs.withColumn("train", F.pmod(F.xxhash64("text"), F.lit(every)) == 0)
    schema = f"id {docs.schema['id'].dataType.simpleString()}, first int, ends binary, starts binary, kinds string, kind string, token string, edge boolean, n long"
    return Scratch(documents.sparkSession, "sentences").put(docs.mapInArrow(_scan, schema))


def _trained(scanned: DataFrame) -> Model:
    counts = scanned.where("kind is not null").groupBy("kind", "token", "edge").agg(F.sum("n").alias("n"))
    scratch = Scratch(scanned.sparkSession, "tokens")
    counts = scratch.put(counts)
    sides = {}
    for side in ("w", "n", "i"):
        t = counts.where(F.col("kind") == side).groupBy("token").agg(F.sum(F.when(F.col("edge"), F.col("n")).otherwise(0)).alias("yes"), F.sum(F.when(F.col("edge"), 0).otherwise(F.col("n"))).alias("no"))
        total = t.agg(F.sum("yes"), F.sum("no")).first()
        base = (total[0] or 0) / max(1, (total[0] or 0) + (total[1] or 0))
        level = Model.share if side == "i" else partial(Model.level, base=base)
        got = t.where("yes + no >= 3").mapInArrow(partial(_levels, level), "hash long, level byte").toArrow()
        sides[side] = Levels(got.column("hash").to_numpy(), got.column("level").to_numpy())
    model = Model(sides["w"], sides["n"], sides["i"], {})
    rows = []
    for token, edge, n in counts.where("kind = 't'").select("token", "edge", "n").collect():
        kind = unwritten(token)
        if edge or model.reliable(kind):
            rows.append((kind, edge, n))
        elif model.ordinary(kind):
            rows.append((kind, True, n))
    scratch.forget(counts)
    model.weights = _fit(rows, model)
    return model


def train(documents: DataFrame, text_col: str = "text", training_documents: int = 8_000) -> Model:
    """A model from the counts over all documents and the reliable boundaries of at most about ``training_documents``.

    Every token that is found three times keeps its level; a rarer one is judged by its form and by the other side. No documents, or none with two kinds of evidence, give a model that
    takes every candidate for a boundary.
    """
    return _trained(_scanned(documents, text_col, text_col, training_documents))


def sentences(documents: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", training_documents: int = 8_000) -> DataFrame:
    """``(id, start_char, end_char)`` for each sentence; offsets count code points, the end is exclusive.

    Null and blank texts give no rows; repeated rows repeat theirs. Only the id and the text are read, once: without a
    model the pass that counts tokens also writes each document's candidates, and these are decided when it is fitted.
    """
    if model is None:
        scanned = _scanned(documents, id_col, text_col, training_documents)
        model = _trained(scanned)
        docs = scanned.where("kind is null").select(F.col("id").alias(id_col), "first", "ends", "starts", "kinds")
    else:
        docs = documents.select(F.col(id_col), F.col(text_col).alias("_text")).where("_text is not null")
    whole = "_text" in docs.columns
    sent = documents.sparkSession.sparkContext.broadcast((model.before, model.after, model.inner, model.weights))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            rows, starts, ends = [], [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int32)]
            columns = [c.to_pylist() for c in batch.columns[1:]]
            for i, row in enumerate(zip(*columns)):
                if whole:
                    first, e, s, kinds = boundaries(row[0])
                    if not e:
                        continue
                    e, s = np.array(e, dtype=np.int32), np.array(s, dtype=np.int32)
                else:
                    first, e, s, kinds = row[0], np.frombuffer(row[1], dtype=np.int32), np.frombuffer(row[2], dtype=np.int32), row[3].split("\x1e")
                a, b = own.decide(first, e, s, kinds)
                rows.append(np.full(len(a), i, dtype=np.int64))
                starts.append(a)
                ends.append(b)
            ids = batch.column(0).take(pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *rows])))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(starts)), pa.array(np.concatenate(ends))], [id_col, "start_char", "end_char"])

    return docs.mapInArrow(emit, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, start_char int, end_char int")

"""Text that was decoded with the wrong character encoding: found and restored by character n-gram models.

Every candidate chain reads the characters back into bytes by one encoding (the wrong one) and decodes these by another
(the right one); UTF-8 read wrongly twice is a chain of its own. A chain is applied word by word, to the parts that it
can decode, so a text may be garbled in part. Smoothed character n-gram models, trained on clean records, score each
word before and after; a chain's score for a text is the sum of its words' gains in log-likelihood. The likeliest
chain is accepted if its gain exceeds a margin, which is validated on all clean records and on the same records garbled
here by known chains: the gains of both are counted in steps in the pass that scores the texts. A replacement character, or a control character of the upper half, says that text was lost in
decoding; such a field is reported with no original unless a chain restores it.

The models are counts of 1- to 3-grams hashed into tables of a fixed size, summed over all clean records; only these
tables go to the driver and to the executors. Every distinct word of a task is scored once, all new words of a batch
in one vectorised pass. Nothing is shuffled but the partial counts.
"""

from __future__ import annotations

import codecs
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.lookalikes import SAME_SHAPE, looks, table_form
from lodestrata.sources.scratch import Scratch

#: Encodings that text is read in by mistake, and encodings that it was written in (fixed values).
WRONG = ("cp1252", "cp1251", "cp437", "cp850", "mac_roman", "cp1250", "koi8_r", "cp866", "cp1253", "gbk", "shift_jis")
RIGHT = ("utf_8", "cp1251", "koi8_r", "cp866", "iso8859_5", "cp1252", "cp437", "cp850", "mac_roman", "cp1250", "gb18030", "big5", "shift_jis", "euc_jp", "euc_kr", "cp1256", "cp1253", "cp874")

_WIDE = ("gbk", "shift_jis", "gb18030", "big5", "euc_jp", "euc_kr")
_UTF8 = re.compile(rb"[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
_DIGITS = re.compile("\\d")
_HIGH = re.compile("[^\x00-\x7f]")
_LOST = "\ufffd"
_CONTROL = re.compile("[\x80-\x84\x86-\x9f]")  # control characters that no text has but one read wrongly


def _bytes_of(encoding: str) -> dict[int, int]:
    """Code point to byte; undefined bytes stand for the control characters of the same number, as decoders commonly have it."""
    out = {b: b for b in range(256)} if encoding == "cp1252" else {b: b for b in range(128)}
    for b in range(128, 256):
        try:
            out[ord(bytes([b]).decode(encoding))] = b
        except UnicodeDecodeError:
            out.setdefault(b, b)
    return out


_TABLES = {w: _bytes_of(w) for w in WRONG if w not in _WIDE} | {"latin_1": {b: b for b in range(256)}}
_RUNS = {w: re.compile("[" + "".join(re.escape(chr(c)) for c, b in t.items() if b >= 128) + "]+") for w, t in _TABLES.items()}


def _utf8(word: str, wrong: str) -> str:
    """A word with those character sequences replaced that are UTF-8 in the wrong encoding's bytes."""
    if wrong in _WIDE:
        try:
            return word.encode(wrong).decode("utf_8")
        except UnicodeError:
            return word
    table = _TABLES[wrong]

    def run(m: re.Match) -> str:
        s = m[0]
        raw = bytes(table[ord(c)] for c in s)
        out, at = [], 0
        for k in _UTF8.finditer(raw):
            try:
                decoded = k[0].decode("utf_8")
            except UnicodeDecodeError:
                continue
            out += [s[at : k.start()], decoded]
            at = k.end()
        if at == 0 and len(raw) < 2:
            return "\u00e0" if raw == b"\xc3" and m.end() == len(word) else s
        rest = s[at:]
        if raw[at:] == b"\xc3" and m.end() == len(word):
            rest = "\u00e0"  # its second byte was a no-break space, and that became the space between the words
        return "".join(out) + rest

    return _RUNS[wrong].sub(run, word)


def _decoded(word: str, wrong: str, right: str) -> str:
    """A word with its parts outside ASCII read again; unchanged where that isn't possible."""
    if wrong in _WIDE:
        try:
            return word.encode(wrong).decode(right)
        except UnicodeError:
            return word
    if right in _WIDE:
        try:
            return codecs.charmap_encode(word, "strict", _TABLES[wrong])[0].decode(right)
        except UnicodeError:
            pass
    return _by_runs(word, wrong, right)


def _by_runs(word: str, wrong: str, right: str) -> str:
    table = _TABLES[wrong]

    def run(m: re.Match) -> str:
        try:
            return bytes(table[ord(c)] for c in m[0]).decode(right)
        except UnicodeError:
            return m[0]

    return _RUNS[wrong].sub(run, word)


CHAINS_OF_TWO = [(w, r) for w in WRONG for r in RIGHT if w != r and not (w in _WIDE and r != "utf_8")]
CHAINS_OF_TWO.append(("latin_1", "cp1252"))
CHAINS = CHAINS_OF_TWO + [(w, "utf_8", w, "utf_8") for w in ("cp1252", "cp1251", "cp437", "cp850", "mac_roman")]


_BACK = {w: {b: chr(c) for c, b in t.items()} for w, t in _TABLES.items()}


def _translation(wrong: str, right: str) -> dict[int, str]:
    """Wrong characters to right ones, for two single-byte encodings; bytes that the right one lacks stay."""
    out = {}
    for c, b in _TABLES[wrong].items():
        if b >= 128:
            try:
                out[c] = bytes([b]).decode(right)
            except UnicodeDecodeError:
                continue
    return out


_SINGLE = {(w, r): _translation(w, r) for w, r in CHAINS_OF_TWO if w not in _WIDE and r not in _WIDE and r != "utf_8"}


def apply_chain(text: str, chain: tuple) -> str:
    """A text read again by one chain."""
    if len(chain) == 4:
        return apply_chain(apply_chain(text, chain[:2]), chain[2:])
    if chain in _SINGLE:
        return text.translate(_SINGLE[chain])
    wrong, right = chain
    read = (lambda w: _utf8(w, wrong)) if right == "utf_8" else (lambda w: _decoded(w, wrong, right))
    return " ".join(read(w) if not w.isascii() else w for w in text.split(" "))


def _disguises(word: str) -> list[str]:
    """A word without what shows nothing and in one width; that with Latin letters for those of the same shape; and its form by the table of looks."""
    plain = unicodedata.normalize("NFC", "".join(c if c.isalpha() and not unicodedata.decomposition(c).startswith(("<wide>", "<narrow>")) else looks(c) for c in word))
    return list(dict.fromkeys([plain, "".join(SAME_SHAPE.get(c, c) for c in word), "".join(SAME_SHAPE.get(c, c) for c in plain), unicodedata.normalize("NFC", table_form(word))]))


def _readings(word: str, single: bool = True) -> Iterator[tuple[int, str]]:
    """Number of each chain and the word as read by it; without ``single`` not those of two single-byte encodings.

    One character of a single-byte encoding is never UTF-8, unless it has lost its second byte; in the wide ones it may be.
    """
    several = len(_HIGH.findall(word)) > 1
    once: dict[str, str] = {}
    raws: dict[str, bytes | None] = {}
    for k, chain in enumerate(CHAINS):
        if chain in _SINGLE:
            if single:
                yield k, word.translate(_SINGLE[chain])
        elif len(chain) == 4:
            if once.get(chain[0], word) != word:
                yield k, _utf8(once[chain[0]], chain[2])
        elif chain[1] != "utf_8":
            wrong, right = chain
            if right in _WIDE and wrong not in _WIDE:
                if wrong not in raws:
                    try:
                        raws[wrong] = codecs.charmap_encode(word, "strict", _TABLES[wrong])[0]
                    except UnicodeError:
                        raws[wrong] = None
                if raws[wrong] is not None:
                    try:
                        yield k, raws[wrong].decode(right)
                        continue
                    except UnicodeError:
                        pass
                yield k, _by_runs(word, wrong, right)
            else:
                yield k, _decoded(word, *chain)
        elif several:
            once[chain[0]] = got = _utf8(word, chain[0])
            yield k, got
        elif chain[0] in _WIDE or word[-1] == "\u00c3":
            yield k, _utf8(word, chain[0])


def garble(text: str, wrong: str, right: str) -> str | None:
    """A text written in ``right`` and read in ``wrong``, or None if it can't be."""
    try:
        raw = text.encode(right)
        return raw.decode("latin_1").translate(_BACK[wrong]) if wrong in _TABLES and wrong != "cp1252" else raw.decode("latin_1" if wrong == "cp1252" else wrong)
    except UnicodeError:
        return None


#: Encodings whose bytes of UTF-8 sequences are not a common run of letters (fixed values); they tell clean records.
_TELLING = ("cp1252", "cp1251", "cp437", "mac_roman")


def suspicious(text: str) -> bool:
    """Whether a text holds a replacement character or anything that is UTF-8 in another encoding's bytes."""
    if text.isascii():
        return False
    return _LOST in text or any(_utf8(text, w) != text for w in _TELLING)


#: Log-likelihood of a character that no clean text has; one of the many from ``_MANY`` on costs twice as much, so that
#: letters of a rare language don't gain by being read as half as many unseen characters of two bytes (fixed values).
_UNSEEN, _MANY = float(np.log(1e-6)), 0x2E80

#: Share of all characters below which a context is rare; the counts of garbled records among the clean ones are.
RARE = 5e-5


#: Characters that are scored in one vectorised pass; it bounds memory and changes no score.
_SPAN = 300_000


def _spans(texts: Iterable[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Numbers of texts and their characters with digits alike, behind two characters of context; a long text is several spans, which change nothing about its n-grams."""
    of, spans, size = [], [], 0
    for i, t in enumerate(texts):
        padded = f"  {_DIGITS.sub('0', t)} "
        for at in range(2, len(padded), _SPAN):
            of.append(i)
            spans.append(padded[at - 2 : at + _SPAN])
            size += len(spans[-1])
            if size > _SPAN:
                yield of, spans
                of, spans, size = [], [], 0
    if of:
        yield of, spans


class Hashed:
    """Character n-gram counts in tables of a fixed size, and log-likelihoods from them."""

    BITS = (16, 20, 22)

    def __init__(self, counts: list[np.ndarray] | None = None):
        self.counts = counts or [np.zeros(1 << b, dtype=np.float32) for b in self.BITS]
        self.total = float(self.counts[0].sum()) or 1.0
        self.few = max(5.0, self.total * RARE)
        self.known = frozenset(map(chr, np.flatnonzero(self.counts[0]))) | frozenset("0123456789")

    @staticmethod
    def keys(spans: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Bucket of each 1-, 2- and 3-gram that ends at a character, over all spans but for their first two characters, which are context; and the number of characters of each."""
        lengths = np.array([len(t) - 2 for t in spans], dtype=np.int64)
        c = np.frombuffer("".join(spans).encode("utf_32_le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        ends = np.cumsum(lengths + 2)
        keep = np.ones(len(c), dtype=bool)
        starts = ends - lengths - 2
        keep[starts] = keep[starts + 1] = False
        at = np.flatnonzero(keep)
        p, q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
        two = c[at - 1] * p + c[at]
        three = (c[at - 2] * p + c[at - 1]) * p + c[at]
        mix = lambda x, b: ((x ^ (x >> np.uint64(29))) * q >> np.uint64(64 - b)).astype(np.int64)
        return [c[at].astype(np.int64) & 0xFFFF, mix(two, 20), mix(three, 22), c[at - 1].astype(np.int64) & 0xFFFF, mix(c[at - 2] * p + c[at - 1], 20), c[at]], lengths

    def likelihood(self, texts: list[str]) -> np.ndarray:
        """Log-likelihood of each text, with digits alike."""
        out = np.zeros(len(texts))
        one, two, three = self.counts
        for of, spans in _spans(texts):
            k, lengths = self.keys(spans)
            p = 0.7 * three[k[2]] / (two[k[4]] + self.few) + 0.25 * two[k[1]] / (one[k[3]] + self.few) + 0.0499 * one[k[0]] / self.total + 1e-6
            p = np.log(p)
            new = (one[k[0]] == 0) | (k[5] > 0xFFFF)
            p[new] = np.where(k[5][new] >= _MANY, 2 * _UNSEEN, _UNSEEN)
            np.add.at(out, of, np.add.reduceat(p, np.concatenate(([0], np.cumsum(lengths)[:-1]))))
        return out

    def most(self, text: str) -> float:
        """What the likelihood of a text cannot exceed, by its unseen characters."""
        return 0.0 if self.known.issuperset(text) else _UNSEEN * sum(1 + (ord(c) >= _MANY) for c in text if c not in self.known)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter = Counter()
    tables = [np.zeros(1 << b, dtype=np.int64) for b in Hashed.BITS]

    def add() -> None:
        n = np.fromiter(words.values(), dtype=np.int64)
        for of, spans in _spans(words):
            k, lengths = Hashed.keys(spans)
            times = np.repeat(n[of], lengths)
            for table, key in zip(tables, k):
                table += np.bincount(key, times, len(table)).astype(np.int64)
        words.clear()

    judged: dict[str, bool] = {}

    def clean(text: str) -> bool:
        for w in text.split(" "):
            if not w.isascii():
                if w not in judged:
                    judged[w] = suspicious(w)
                if judged[w]:
                    return False
        return True

    chars = 0
    for batch in batches:
        for column in batch.columns:
            for text in column.to_pylist():
                if text and (text.isascii() or clean(text)):
                    words.update(_DIGITS.sub("0", text).split(" "))
                    chars += len(text)
                    if chars > 4_000_000:
                        add()
                        judged.clear()
                        chars = 0
    add()
    for order, table in enumerate(tables):
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), order, dtype=np.int32)), pa.array(at.astype(np.int32)), pa.array(table[at])], ["ngram", "bucket", "n"])


def train(texts: DataFrame) -> Hashed:
    """Models from every clean value of the string columns of ``texts``; a value is clean if nothing about it is suspicious."""
    counts = texts.mapInArrow(_count, "ngram int, bucket int, n long").groupBy("ngram", "bucket").agg(F.sum("n").alias("n"))
    model = Hashed()
    table = counts.toArrow()
    order, bucket, n = (table.column(c).to_numpy() for c in ("ngram", "bucket", "n"))
    for k in range(3):
        model.counts[k][bucket[order == k]] = n[order == k]
    return Hashed(model.counts)


_PIECE = re.compile("[^ ]+| +")
#: Words from this length on are scored one reading at a time, and their readings are made again where they are used;
#: it bounds memory and changes no score.
_LONG = 256


def _pieces(text: str) -> list[str]:
    """A text as its words and the blanks between them; a word is never cut, as no place in it is a sequence boundary of every chain."""
    return _PIECE.findall(text)


class Restorer:
    """Scores chains word by word and remembers the words, up to ``most_chars`` characters of words and their readings."""

    def __init__(self, model: Hashed, margin: float, most_chars: int = 20_000_000):
        self.model, self.margin, self.most_chars = model, margin, most_chars
        self.gains: dict[str, list[tuple[int, str | None, float]]] = {}
        self.spoilt: dict[tuple[str, int], float] = {}
        self.chars = 0

    def learn(self, texts: list[str]) -> None:
        """Scores all chains for every new word of the texts, some hundred thousand characters in one pass."""
        if self.chars > self.most_chars:
            self.gains.clear()
            self.spoilt.clear()
            self.chars = 0
        new, size = [], 0
        for w in dict.fromkeys(w for t in texts if not t.isascii() for w in _pieces(t) if not w.isascii()):
            if w in self.gains:
                continue
            if len(w) >= _LONG:
                self._score_long(w)
            else:
                new.append(w)
                size += len(w)
                if size > 100_000:
                    self._score(new)
                    new, size = [], 0
        self._score(new)

    def _score(self, new: list[str]) -> None:
        first = self.model.likelihood(new)
        tried, spelt = [], []
        read: list[dict[str, int]] = [{} for _ in new]
        whole = " ".join(new)  # words have no blanks, and no character becomes one
        for k, chain in enumerate(CHAINS):
            if chain in _SINGLE and (other := whole.translate(_SINGLE[chain])) != whole:
                for w, got, options in zip(new, other.split(" "), read):
                    if got != w:
                        options[got] = options.get(got, 0) | (1 << k)
        for w, as_is, options in zip(new, first, read):
            for k, got in _readings(w, False):
                if got != w:
                    options[got] = options.get(got, 0) | (1 << k)
            options = {o: chains for o, chains in options.items() if self.model.most(o) - as_is > -2}  # others can't be taken
            tried.append(options)
            spelt.append(_disguises(w) if options else [])
        rest = self.model.likelihood([f for forms in spelt for f in forms] + [o for options in tried for o in options])
        scores = np.concatenate([first, rest])
        n = len(new)
        at = n + sum(map(len, spelt))
        for i, (w, options, forms) in enumerate(zip(new, tried, spelt)):
            now = max([scores[i], *(scores[n : n + len(forms)] - 1)])  # as it is, or disguised by look-alikes and what shows nothing
            own = []
            n += len(forms)
            for o, chains in options.items():
                own.append((chains, o, float(scores[at] - now)))
                self.chars += len(o)
                at += 1
            self.gains[w] = own
            self.chars += len(w) + 50

    def _score_long(self, word: str) -> None:
        """As ``_score`` for one word, with one reading held at a time."""
        as_is = float(self.model.likelihood([word])[0])
        now, own = None, {}
        for k, got in _readings(word):
            if got == word or self.model.most(got) - as_is <= -2:
                continue
            same = hash(got), len(got)
            if same in own:
                chains, gain = own[same]
            else:
                if now is None:
                    now = max(as_is, *(self.model.likelihood(_disguises(word)) - 1))
                chains, gain = 0, float(self.model.likelihood([got])[0] - now)
            own[same] = chains | 1 << k, gain
        self.gains[word] = [(chains, None, gain) for chains, gain in own.values()]
        self.chars += len(word) + 50

    def _fixed(self, word: str, k: int) -> str:
        """A learnt word as read by a chain, if that is likely enough; else as it is."""
        for chains, o, gain in self.gains.get(word, ()):
            if chains >> k & 1 and gain > -2:
                return apply_chain(word, CHAINS[k]) if o is None else o
        return word

    def best(self, text: str) -> tuple[int, float]:
        """The likeliest chain of a learnt text and its gain; -1 if none changes it for the better."""
        total: dict[int, float] = {}
        for w in _pieces(text):
            if not w.isascii():
                for chains, _, gain in self.gains[w]:
                    if gain > 0:
                        while chains:
                            low = chains & -chains
                            k = low.bit_length() - 1
                            total[k] = total.get(k, 0.0) + gain
                            chains ^= low
        if not total:
            return -1, 0.0
        k = max(total, key=lambda k: (round(total[k], 6), -k))
        return k, total[k]

    def restore(self, text: str) -> tuple[str | None, str | None] | None:
        """``(chain, original)`` of a garbled text, both null where the original is lost; None for a clean text."""
        hit = self.reading(text)
        return hit and hit[:2]

    def reading(self, text: str) -> tuple[str | None, str | None, float, bool] | None:
        """As ``restore``, with the gain and whether the text says by itself that something was lost."""
        if text.isascii():
            return None
        k, gain = self.best(text)
        lost = bool(_LOST in text or _CONTROL.search(text))
        if k >= 0 and gain >= self.margin:
            fixed = "".join(self._fixed(w, k) for w in _pieces(text))
            return ">".join(CHAINS[k]), None if _LOST in fixed else fixed, gain, lost
        return (None, None, gain, lost) if lost else None

    def clean_gain(self, text: str, common: frozenset[str]) -> float:
        """The gain of a learnt clean text; 0 if its best reading has a common word, as the text then is garbled itself, by a chain that leaves no telling bytes."""
        k, gain = self.best(text)
        return 0.0 if gain <= 0 or any((self._fixed(w, k) if o is None else o) in common for w in _pieces(text) for chains, o, g in self.gains.get(w, ()) if chains >> k & 1 and g > 0) else gain


    def spoilt_gains(self, texts: list[str]) -> list[float]:
        """What clean texts, garbled here, would gain by the chain that garbled them; the text decides which, not its place in a table."""
        pairs = [(k := zlib.crc32(t.encode("utf_8", "replace")) % len(_SPOILING), [(w, k) for w in _pieces(t) if not w.isascii()])[1] for t in texts]
        new, size = [], 0
        for p in dict.fromkeys(p for own in pairs for p in own):
            if p not in self.spoilt:
                new.append(p)
                size += len(p[0])
                if size > 50_000:
                    self._spoil(new)
                    new, size = [], 0
        self._spoil(new)
        return [sum(self.spoilt[p] for p in own) for own in pairs]

    def _spoil(self, new: list[tuple[str, int]]) -> None:
        bad = [garble(w, *_SPOILING[k]) for w, k in new]
        back = [b is not None and b != w and _utf8(b, _SPOILING[k][0]) == w for b, (w, k) in zip(bad, new)]
        forms = [[b, *_disguises(b)] if ok else [] for b, ok in zip(bad, back)]
        scores = self.model.likelihood([w for w, _ in new] + [f for own in forms for f in own])
        at = len(new)
        for i, (pair, own) in enumerate(zip(new, forms)):
            now = max([scores[at], *(scores[at + 1 : at + len(own)] - 1)]) if own else scores[i]
            self.spoilt[pair] = max(0.0, float(scores[i] - now))
            self.chars += len(pair[0]) + 50
            at += len(own)


def _slices(values: list[str | None], chars: int = 500_000) -> Iterator[range]:
    """Ranges of a list whose texts are of bounded size together, one text at least."""
    at = size = 0
    for i, v in enumerate(values):
        size += len(v or "")
        if size > chars:
            yield range(at, i + 1)
            at, size = i + 1, 0
    yield range(at, len(values))


#: Gains are counted in steps up to the largest margin; a margin is at least so much (fixed values).
STEP, LEAST, MOST = 0.05, 3.5, 25.0
#: Share of clean texts from which a word is common, if more than one has it (fixed value).
COMMON = 1 / 4_000
#: Clean texts for each garbled one, by which false hits and misses are weighed (fixed value; sf0.1 has about nine).
CLEAN_TO_GARBLED = 10
_SPOILING = (("cp1252", "utf_8"), ("cp1251", "utf_8"), ("cp437", "utf_8"), ("mac_roman", "utf_8"))


def new_histogram() -> np.ndarray:
    """Numbers of texts by step of the gain; the last place is for gains of ``MOST`` and more."""
    return np.zeros(round(MOST / STEP) + 1, dtype=np.int64)


def count_gains(r: Restorer, clean: list[str], common: frozenset[str], gains: np.ndarray, found: np.ndarray) -> None:
    """Adds the gains of learnt clean texts to ``gains``, and those of the same texts garbled here to ``found``."""
    place = lambda g: min(int(max(g, 0.0) / STEP), len(gains) - 1)
    for t in clean:
        gains[place(r.clean_gain(t, common))] += 1
    for g in r.spoilt_gains(clean):
        found[place(g)] += 1


def chosen_margin(gains: np.ndarray, found: np.ndarray) -> tuple[float, float]:
    """The margin from the gains of clean texts and of garbled ones, and the share of the garbled ones that reach it.

    It is that of the fewest errors, clean texts above it and garbled ones below; of equals the least,
    as texts garbled by other chains may gain less.
    """
    false, recall = (h[::-1].cumsum()[::-1] / max(1, h.sum()) for h in (gains, found))
    errors = CLEAN_TO_GARBLED * false + (1 - recall)
    best = min(range(round(LEAST / STEP), len(gains)), key=lambda m: (round(errors[m], 9), m))
    return float(best * STEP), float(recall[best])


def validated_margin(model: Hashed, clean: list[str]) -> tuple[float, float]:
    """``chosen_margin`` of a list of clean texts."""
    words = Counter(w for t in clean for w in set(_pieces(t)) if not w.isascii())
    r, gains, found = Restorer(model, LEAST), new_histogram(), new_histogram()
    r.learn(clean)
    count_gains(r, clean, frozenset(w for w, n in words.items() if n > max(1, len(clean) * COMMON)), gains, found)
    return chosen_margin(gains, found)


def _clean_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words outside ASCII with the number of clean texts that have them; that of all clean texts outside ASCII has no word."""
    words: Counter = Counter()
    judged: dict[str, bool] = {}

    def out() -> pa.RecordBatch:
        b = pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])
        words.clear()
        judged.clear()
        return b

    for batch in batches:
        for column in batch.columns:
            for text in column.to_pylist():
                if text and not text.isascii():
                    own = {w for w in _pieces(text) if not w.isascii()}
                    for w in own:
                        if w not in judged:
                            judged[w] = suspicious(w)
                    if not any(judged[w] for w in own):
                        words.update(own)
                        words[None] += 1
                    if len(judged) > 300_000:
                        yield out()
    yield out()


def common_words(texts: DataFrame) -> frozenset[str]:
    """Words outside ASCII of more clean texts than one and than the share ``COMMON``: no more than its inverse times the words of a text."""
    counts = Scratch(texts.sparkSession, "words").put(texts.mapInArrow(_clean_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    every = counts.where("word is null").first()
    least = max(1, every["n"] * COMMON) if every else 1
    return frozenset(r["word"] for r in counts.where(F.col("word").isNotNull() & (F.col("n") > F.lit(least))).select("word").toLocalIterator())


def restore(records: DataFrame, columns: list[str], model: Hashed | None = None, margin: float | None = None) -> DataFrame:
    """``records`` with one row per garbled field: all other columns, ``field``, ``text``, ``chain``, ``original``.

    ``columns`` are the string columns to examine. Without a model it is trained on their clean values, and without a
    margin that is validated on all of these: the pass that scores the fields writes those that may be garbled, and the
    gains of clean ones by step. Null, empty and clean fields give no row. Own columns named like the results are left out.
    """
    texts = records.select(*columns)
    model = model or train(texts)
    validate = margin is None
    common = common_words(texts) if validate else frozenset()
    sent = records.sparkSession.sparkContext.broadcast((model.counts, LEAST if validate else margin, common))
    added = ["field", "text", "chain", "original"]
    marks = ["_gain", "_lost", "_step", "_clean", "_garbled"]
    rest = [c for c in records.columns if c not in columns and c not in added]
    docs = records.select(*rest, *columns)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*rest).schema) + "field string, text string, chain string, original string, _gain double, _lost boolean, _step int, _clean long, _garbled long"
    kinds = [pa.string()] * 4 + [pa.float64(), pa.bool_(), pa.int32(), pa.int64(), pa.int64()]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, limit, common = sent.value
        restorer = Restorer(Hashed(counts), limit)
        gains, found, own = new_histogram(), new_histogram(), None
        for batch in batches:
            own = [batch.column(k).type for k in range(len(rest))]
            at, out = [], []
            for column in columns:
                values = batch.column(batch.schema.get_field_index(column)).to_pylist()
                for part in _slices(values):
                    restorer.learn([values[i] for i in part if values[i]])
                    for i in part:
                        v = values[i]
                        if v and not v.isascii() and (hit := restorer.reading(v)):
                            at.append(i)
                            out.append((column, v, *hit, None, None, None))
                    if validate:
                        count_gains(restorer, [v for i in part if (v := values[i]) and not v.isascii() and not suspicious(v)], common, gains, found)
            rows = pa.array(at, type=pa.int64())
            cols = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(k).take(rows) for k in range(len(rest))] + [pa.array(c, t) for c, t in zip(cols, kinds)], [*rest, *added, *marks])
        steps = np.flatnonzero(gains + found)
        if len(steps):
            n = len(steps)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, t) for t in own + kinds[:6]] + [pa.array(x, t) for x, t in zip((steps, gains[steps], found[steps]), kinds[6:])], [*rest, *added, *marks])

    out = docs.mapInArrow(emit, schema)
    if validate:
        out = Scratch(records.sparkSession, "readings").put(out)
        gains, found = new_histogram(), new_histogram()
        for r in out.where("_step is not null").groupBy("_step").agg(F.sum("_clean").alias("c"), F.sum("_garbled").alias("g")).collect():
            gains[r["_step"]], found[r["_step"]] = r["c"], r["g"]
        margin, _ = chosen_margin(gains, found)
    sure = F.col("_gain") >= F.lit(margin)
    out = out.where(F.col("_step").isNull() & (sure | F.col("_lost")))
    return out.select(*[F.col(f"`{c}`") for c in rest], "field", "text", F.when(sure, F.col("chain")).alias("chain"), F.when(sure, F.col("original")).alias("original"))

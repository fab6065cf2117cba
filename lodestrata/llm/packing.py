"""Filling contexts of fixed capacity with whole texts, along a space-filling curve.

Each text is tokenized once by a public tokenizer. Its hashed vector is the sum of one pseudo-random sign vector per
token, which is a random projection of its token counts to a few dimensions; the coordinates are put on a grid by
fixed bounds and give a Hilbert key, so that texts with similar tokens are neighbours along the curve. Items (a text,
or a piece of a text that alone exceeds the capacity) are range-sorted by that key, over ranges that are found by
counting the items of cells of the curve, with a hash of the id to divide equal keys, and each range is packed in order: windows of neighbouring items are placed largest first, each into the
fullest context with room for it among those still open; contexts stay open from window to window until they are
nearly full or too many are open. Only ids, sizes and keys are shuffled, never texts.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from math import erf

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pattern that cuts texts into pretokens for byte-level vocabularies of this kind (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DIMENSIONS, GRID_BITS = 4, 8


@lru_cache(maxsize=4)
def tokenizer(ranks_file: str):
    """A byte-level tokenizer from a file of ranks; its path is a parameter, and the file is read where it is."""
    import tiktoken

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(ranks_file, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _signs(n: int) -> np.ndarray:
    return np.random.default_rng(7).choice(np.array([-1.0, 1.0], dtype=np.float32), size=(n, DIMENSIONS))


def hilbert_key(cells: list[int], bits: int = GRID_BITS) -> int:
    """Position of a grid cell along the Hilbert curve, by the transpose method."""
    x, n = list(cells), len(cells)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    key = 0
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | ((x[i] ^ t) >> b & 1)
    return key


def curve_key(tokens: np.ndarray, vocabulary: int) -> int:
    """The Hilbert key of a text's hashed and projected token counts."""
    if not len(tokens):
        return 0
    v = _signs(vocabulary)[tokens].sum(axis=0) / np.sqrt(len(tokens))
    return hilbert_key([min((1 << GRID_BITS) - 1, int((1 + erf(float(z) / 2)) / 2 * (1 << GRID_BITS))) for z in v])


@lru_cache(maxsize=4)
def _token_bytes(ranks_file: str) -> np.ndarray:
    """Length in bytes of each token."""
    t = tokenizer(ranks_file)
    out = np.ones(t.n_vocab, dtype=np.int64)
    for token, k in t._mergeable_ranks.items():
        out[k] = len(token)
    return out


def pieces(text: str, capacity: int, tokens: np.ndarray, token_bytes: np.ndarray, encode) -> list[tuple[int, int, int]]:
    """``(start, end, tokens)`` of consecutive parts of a text, each within the capacity and about as long as it can be.

    ``tokens`` are those of the whole text. A part ends at white space if there is any among its last tokens, else
    between characters; its size is counted anew, as the tokens beside a cut can change.
    """
    ends = np.cumsum(token_bytes[tokens])
    first = (np.frombuffer(text.encode(), dtype=np.uint8) & 0xC0) != 0x80
    chars = np.concatenate((np.cumsum(first) - first, [len(text)]))  # the character at or across each byte
    whole = np.concatenate((first, [True]))
    starts = np.concatenate(([0], ends))  # first byte of each token, and the end
    out, a = [], 0
    while a < len(tokens):
        room = capacity
        while True:
            b = min(len(tokens), a + max(1, room))
            if b < len(tokens):
                cuts = [k for k in range(b, max(a, b - 24), -1) if whole[starts[k]]]
                spaces = [k for k in cuts if text[chars[starts[k]]].isspace()]
                b = (spaces or cuts or [b])[0]
                while b < len(tokens) and not whole[starts[b]]:
                    b += 1
            at, end = int(chars[starts[a]]), int(chars[starts[b]])
            n = len(encode(text[at:end]))
            if n <= capacity or end - at <= 1 or room <= 1:
                break
            room -= max(1, n - capacity)
        out.append((at, end, n))
        a = b
    return out


def items(documents: DataFrame, budgets: list[tuple[int, int]], ranks_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(budget_id, id, piece, start_char, end_char, tokens, curve)``: each text, or the pieces of one that is too long.

    Null and empty texts are no items. Every text is tokenized once for all budgets.
    """
    docs = documents.select(F.col(id_col), F.col(text_col).alias("text")).where(F.length("text") > 0)
    names = ["budget_id", id_col, "piece", "start_char", "end_char", "tokens", "curve"]
    schema = f"budget_id int, `{id_col}` {docs.schema[id_col].dataType.simpleString()}, piece int, start_char int, end_char int, tokens int, curve long"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, lengths = tokenizer(ranks_file), _token_bytes(ranks_file)
        encode = t.encode_ordinary
        for batch in batches:
            rows, out = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                tokens = np.array(encode(text), dtype=np.int64)
                n, key = len(tokens), curve_key(tokens, t.n_vocab)
                for budget, capacity in budgets:
                    if n <= capacity:
                        rows.append(i)
                        out.append((budget, 0, 0, len(text), n, key))
                    else:
                        for k, (a, b, size) in enumerate(pieces(text, capacity, tokens, lengths, encode)):
                            rows.append(i)
                            out.append((budget, k, a, b, size, key))
            cols = list(zip(*out)) or [()] * 6
            ids = batch.column(0).take(pa.array(rows, type=pa.int64()))
            kinds = [pa.int32()] * 5 + [pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays([arrays[0], ids, *arrays[1:]], names)

    return docs.mapInArrow(emit, schema)


class Packer:
    """Open contexts of one capacity; ``place`` gives each of a window's items its context."""

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.open: list[tuple[int, int]] = []  # room left and number, in order
        self.count = 0

    def place(self, sizes: list[int]) -> list[int]:
        out = [0] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            k = bisect_left(self.open, (sizes[i], -1))
            if k < len(self.open):
                room, number = self.open.pop(k)
            else:
                room, number = self.capacity, self.count
                self.count += 1
            out[i] = number
            if room - sizes[i] > 0:
                insort(self.open, (room - sizes[i], number))
        if len(self.open) > self.most_open:
            del self.open[: len(self.open) - self.most_open]  # the fullest close
        return out


#: Bits of the curve by which items are counted for the ranges: at most 4,096 numbers for each budget (fixed value).
_CELL_BITS = 12


def ranges_of(cells: list[tuple[int, int, int]], items_per_range: int) -> list[tuple[int, int, int, int]]:
    """``(budget_id, cell, range, parts)`` from counts ``(budget_id, cell, items)``.

    Ranges follow the curve and hold about ``items_per_range`` items; a cell of more is divided into ``parts`` ranges
    of its own. They depend on the counts alone, so the same items always give the same ranges.
    """
    out, number, held, last = [], 0, 0, None
    for budget, cell, n in sorted(cells):
        parts = -(-n // items_per_range)
        if budget != last or held + n > items_per_range:
            number += held > 0
            held = 0
        out.append((budget, cell, number, parts))
        held += n
        if parts > 1:
            number += parts
            held = 0
        last = budget
    return out


def pack(sized: DataFrame, budgets: list[tuple[int, int]], id_col: str = "doc_id", items_per_range: int = 100_000, window: int = 2_000, most_open: int = 400) -> DataFrame:
    """``sized`` items with ``context_id``; every context holds at most its budget's capacity.

    Items are counted by cells of the curve, which gives ranges that depend on the items alone; a context is numbered
    within its range, so ids are the same in every run. Items of one cell with more than a range are divided by a hash
    of their id, so a text that fills a large part of the rows is spread over ranges.
    """
    columns = ["budget_id", "context_id", id_col, "piece", "start_char", "end_char", "tokens"]
    kinds = {f.name: f.dataType.simpleString() for f in sized.schema}
    schema = ", ".join(f"`{c}` {kinds[c] if c != 'context_id' else 'string'}" for c in columns)
    capacity = dict(budgets)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows, packer, current = 0, None, None

        def place(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
            nonlocal packer, current
            for at in range(0, len(part), window):
                for (number, budget), own in part.iloc[at : at + window].groupby(["range", "budget_id"], sort=True):
                    if number != current:
                        packer, current = Packer(capacity[budget], most_open), number
                    yield own.assign(context_id=[f"{budget}-{number}-{k}" for k in packer.place(own["tokens"].tolist())])[columns]

        for b in batches:
            held.append(b)
            rows += len(b)
            if rows >= window:
                part = pd.concat(held)
                whole = rows - rows % window
                yield from place(part.iloc[:whole])
                held, rows = [part.iloc[whole:]], rows % window
        if rows:
            yield from place(pd.concat(held))

    spark = sized.sparkSession
    cell = F.shiftright("curve", DIMENSIONS * GRID_BITS - _CELL_BITS).cast("int")
    celled = sized.withColumn("cell", cell).withColumn("salt", F.xxhash64(id_col, "piece"))
    counts = [(r[0], r[1], r[2]) for r in celled.groupBy("budget_id", "cell").count().collect()]
    found = ranges_of(counts, items_per_range)
    first = spark.createDataFrame(found, "budget_id int, cell int, first int, parts int")
    placed = celled.join(F.broadcast(first), ["budget_id", "cell"]).withColumn("range", F.col("first") + F.pmod("salt", "parts").cast("int"))
    tasks = max((f + p for _, _, f, p in found), default=1)
    ordered = placed.repartitionById(tasks, "range").sortWithinPartitions("range", "curve", "salt", id_col, "piece")
    return ordered.drop("salt", "curve", "cell", "first", "parts").mapInPandas(emit, schema)


def fill_contexts(documents: DataFrame, budgets: DataFrame, ranks_file: str, id_col: str = "doc_id", text_col: str = "text", items_per_range: int = 100_000) -> DataFrame:
    """An assignment of all texts to contexts, for each budget of ``budgets(budget_id, capacity_tokens)``.

    ``budgets`` is a table of a few rows, more than 1,000 are an error; null or non-positive capacities are left out.
    Rows: ``budget_id``, ``context_id``, the id, ``piece``, ``start_char``, ``end_char``, ``tokens``.
    """
    from lodestrata.sources.scratch import Scratch

    capacities = [(r[0], r[1]) for r in budgets.where("budget_id is not null and capacity_tokens > 0").groupBy("budget_id").agg(F.max("capacity_tokens")).orderBy("budget_id").take(1001)]
    if len(capacities) > 1000:
        raise ValueError("more than 1,000 budgets")
    sized = Scratch(documents.sparkSession, "packing").put(items(documents, capacities, ranks_file, id_col, text_col))
    return pack(sized, capacities, id_col, items_per_range)

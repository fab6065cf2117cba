"""Name and vector similarity."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.functions.ids import name_tokens, normalized


@F.pandas_udf(T.DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two strings, in that order; null if either is."""
    return pd.Series([SequenceMatcher(None, a, b).ratio() if a is not None and b is not None else None for a, b in zip(left, right)], dtype="float64")


#: From this length of the second string on, ``SequenceMatcher`` leaves out characters that are frequent in it.
POPULAR_LENGTH = 200


def matched_characters(names: list[str], left: np.ndarray, right: np.ndarray, need: np.ndarray, chunk: int = 4096) -> np.ndarray:
    """How many characters ``SequenceMatcher`` matches between ``names[left]`` and ``names[right]``, ASCII strings; -1 where that is less than ``need``.

    The longest common run of each pair, of equals the first in the left name and then in the right one, splits the pair
    into what is before and behind it. All pairs of a chunk are split at once, until none has anything left or what is
    left of it cannot reach ``need``.
    """
    out = np.empty(len(left), dtype=np.int64)
    lengths = np.array([len(n) for n in names])
    long = np.maximum(lengths[left], lengths[right]) >= POPULAR_LENGTH
    for k in np.flatnonzero(long).tolist():
        got = sum(m.size for m in SequenceMatcher(None, names[left[k]], names[right[k]]).get_matching_blocks())
        out[k] = got if got >= need[k] else -1
    starts = np.cumsum(lengths) - lengths
    codes = np.frombuffer("".join(names).encode("ascii"), dtype=np.uint8)
    short = np.flatnonzero(~long)
    short = short[np.argsort(np.maximum(lengths[left[short]], lengths[right[short]]), kind="stable")]
    for c in range(0, len(short), chunk):
        k = short[c : c + chunk]
        out[k] = _matched(codes, starts[left[k]], lengths[left[k]], starts[right[k]], lengths[right[k]], need[k])
    return out


def _matched(codes: np.ndarray, a: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_size: np.ndarray, need: np.ndarray) -> np.ndarray:
    """``matched_characters`` of strings that begin at ``a`` and ``b`` in ``codes``."""
    n = len(a)
    got, pair = np.zeros(n, dtype=np.int64), np.arange(n)
    while len(pair):
        size, i, j = _longest_run(codes, a, a_size, b, b_size)
        got += np.bincount(pair, size, n).astype(np.int64)
        found = size > 0
        # What is before the run and what is behind it, where both have something left.
        a, a_size, b, b_size, pair, size, i, j = (v[found] for v in (a, a_size, b, b_size, pair, size, i, j))
        a, b = np.concatenate([a, a + i + size]), np.concatenate([b, b + j + size])
        a_size, b_size = np.concatenate([i, a_size - i - size]), np.concatenate([j, b_size - j - size])
        pair = np.concatenate([pair, pair])
        rest = np.minimum(a_size, b_size)
        reach = got + np.bincount(pair, rest, n)
        left = (rest > 0) & (reach >= need)[pair]
        got[reach < need] = -1
        order = np.flatnonzero(left)
        a, a_size, b, b_size, pair = (v[order] for v in (a, a_size, b, b_size, pair))
    return got


def _longest_run(codes: np.ndarray, a: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of the longest common run of each pair of strings and where it begins in them, the first of equals."""
    n = len(a)
    size, i, j = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    wide = np.maximum(a_size, b_size)
    edges = [0, 2, 4, 8, 16, 32, POPULAR_LENGTH]
    for low, high in zip(edges, edges[1:]):
        k = np.flatnonzero((wide > low) & (wide <= high))
        if len(k):
            size[k], i[k], j[k] = _longest_of(_table(codes, a[k], a_size[k], 0), _table(codes, b[k], b_size[k], 1))
    return size, i, j


def _table(codes: np.ndarray, at: np.ndarray, size: np.ndarray, fill: int) -> np.ndarray:
    """Strings as columns; no string has the character ``fill``."""
    rows = np.arange(int(size.max()))[:, None]
    return np.where(rows < size, codes[np.minimum(at + rows, len(codes) - 1)], np.uint8(fill))


def _longest_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width, n = b.shape
    best, end_a, end_b = np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    last, now = np.zeros((width + 1, n), dtype=np.uint8), np.zeros((width + 1, n), dtype=np.uint8)
    for i in range(len(a)):
        np.add(last[:-1], 1, out=now[1:])
        np.multiply(now[1:], b == a[i], out=now[1:])
        top = now.max(axis=0)
        more = np.flatnonzero(top > best)
        if len(more):
            best[more], end_a[more], end_b[more] = top[more], i, now[1:, more].argmax(axis=0)
        last, now = now, last
    size = best.astype(np.int64)
    return size, np.where(size > 0, end_a - size + 1, 0), np.where(size > 0, end_b - size + 1, 0)


def ratio_bound(left: Column, right: Column) -> Column:
    """What the ratio cannot exceed: twice the shorter length over both lengths."""
    a, b = F.length(left), F.length(right)
    return 2.0 * F.least(a, b) / F.greatest(a + b, F.lit(1))


def token_jaccard(left: Column, right: Column) -> Column:
    """Jaccard coefficient of two arrays of distinct tokens; 0 if both are empty."""
    return F.size(F.array_intersect(left, right)) / F.greatest(F.size(F.array_union(left, right)), F.lit(1))


def version_of(name: Column) -> Column:
    """The numbers in a name, joined; the empty string if it has none."""
    return F.array_join(F.regexp_extract_all(name, F.lit("\\d+(?:\\.\\d+)*"), F.lit(0)), ",")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, within -1 and 1; 0 if one has no length."""
    n = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(n > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / n))).otherwise(0.0)


__all__ = ["cosine", "dot", "matched_characters", "name_tokens", "normalized", "ratio_bound", "sequence_ratio", "token_jaccard", "version_of"]

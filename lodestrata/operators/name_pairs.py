"""Pairs of names that share words, found where the names meet, so that no pair is ever shuffled."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.similarity import matched_characters

#: Names of one word that meet in one task; a word that more names have is divided over pairs of parts.
PART = 8192
#: Names that are compared at once, rows gathered before pairs are looked for, and pairs gathered before they are scored.
TILE, GATHER, PAIRS = 1024, 50_000, 200_000
#: Words up to which sets are compared as arrays, and counts of one character that are bounded one by one.
WIDE, LEVELS = 8, 8
#: Common words with columns of their own when names are bounded, and columns for all others.
OWN_WORDS, OTHER_WORDS = 64, 64
#: Runs of so many characters are counted, hashed to a table of a fixed size (4 MB).
RUN, BUCKETS = 4, 1 << 20


def word_pairs(names: DataFrame, frequency: DataFrame, least: float, threshold: float, ratio: bool) -> DataFrame:
    """``(x, y, label, j, q, overlap)``: pairs of ``names(label, rep, norm, tokens, versions, stars, shared)`` with one label that can reach the threshold.

    Pairs whose word Jaccard is under ``least``, one inside the other, with versions in conflict or linked as ``stars``
    are left to others. ``j`` is the word Jaccard and ``q`` the character ratio (0 without ``ratio``); what is left out
    cannot reach ``threshold``. With sizes a and b, ``o = ceil(least / (1 + least) * (a + b))`` words in common are
    needed, so one of the first ``a - o + 1`` and ``b - o + 1`` words is common, the rarest first. A name goes to each
    such word that another name of its label has, and a pair counts only at the first word that both have. A word that
    very many names have is divided into parts, and every two parts meet in one task.
    """
    words = names.select("label", "rep", F.size("tokens").alias("a"), F.explode("tokens").alias("t")).join(frequency, ["label", "t"])
    order = F.array_sort(F.collect_list(F.struct("df", "t")))
    ranked = words.groupBy("label", "rep", "a").agg(order.alias("w"))
    fewest = F.greatest(F.ceil(F.col("a") * least - 1e-9), F.lit(1))
    prefix = F.col("a") - F.greatest(F.ceil((F.col("a") + fewest) * (least / (1 + least)) - 1e-9), F.lit(1)) + 1
    kept = ranked.select("label", "rep", F.slice("w", F.lit(1), prefix.cast("int")).alias("w"))
    rows = names.select("label", "rep", "norm", "versions", "stars", "shared").join(kept, ["label", "rep"])
    rows = rows.select("*", F.posexplode("w").alias("at", "_w")).where("_w.df > 1")
    rows = rows.withColumn("before", F.array_join(F.transform(F.slice("w", F.lit(1), F.col("at")), lambda s: s["t"]), " "))
    parts = F.ceil(F.col("_w.df") / PART).cast("int")
    rows = rows.withColumns({"parts": parts, "part": F.pmod(F.xxhash64("rep"), parts.cast("long")).cast("int")})
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.select("label", F.col("_w.t").alias("t"), "rep", "norm", "before", "versions", "stars", "shared", "part", "parts", other.alias("_o"))
    rows = rows.select("label", "t", (F.least("part", "_o") * F.col("parts") + F.greatest("part", "_o")).alias("cell"), F.when(F.col("part") < F.col("_o"), 0).when(F.col("part") > F.col("_o"), 1).otherwise(2).alias("side"), "rep", "norm", "before", "versions", "stars", "shared")
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "label", "t", "cell").sortWithinPartitions("label", "t", "cell")
    kind = names.schema["rep"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            yield from _Met(table, least, threshold, ratio).pairs()

    return rows.mapInArrow(find, f"x {kind}, y {kind}, label string, j double, q double, overlap boolean")


def pairs_inside(names: DataFrame, columns: list[str]) -> DataFrame:
    """``(label, a, b)``: rows of one label as structs of ``columns``, the name ``norm`` of ``a`` inside that of ``b``; each pair once.

    ``a`` goes to its rarest run of four characters, ``b`` to those of its runs that are the rarest of any name. Runs are
    counted in a table of a fixed size; two runs with one place in it only seem less rare than they are.
    """
    kind = names.select("label", *columns).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for b in batches:
            total += np.bincount(_runs(b)[2], minlength=BUCKETS)
        at = np.flatnonzero(total)
        for c in range(0, len(at), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[c : c + 50_000]), pa.array(total[at[c : c + 50_000]])], names=["at", "n"])

    counted = names.select("label", "norm").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(BUCKETS, dtype=np.int64)
    often[counted["at"].to_numpy()] = counted["n"].to_numpy()

    def rarest(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, runs and buckets of the rarest run of each name, without names that have a run of their own, which are inside no other."""
        row, run, at = _runs(b)
        order = np.lexsort((run, often[at], row))
        row, run, at = row[order], run[order], at[order]
        first = np.append(True, row[1:] != row[:-1])[: len(row)] & (often[at] > 1)
        return row[first], run[first], at[first]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = np.zeros(BUCKETS, dtype=bool)
        for b in batches:
            some[rarest(b)[2]] = True
        at = np.flatnonzero(some)
        for c in range(0, len(at), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[c : c + 50_000])], names=["at"])

    chosen = np.zeros(BUCKETS, dtype=bool)
    chosen[names.select("label", "norm").mapInArrow(choose, "at long").distinct().toArrow()["at"].to_numpy()] = True

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, run, _ = rarest(b)
            yield _with_runs(b, row, run)

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, run, at = _runs(b)
            row, run = row[chosen[at]], run[chosen[at]]
            for c in range(0, len(row), 50_000):
                yield _with_runs(b, row[c : c + 50_000], run[c : c + 50_000])

    rows, kind = names.select("label", *columns), kind.add("run", "integer")
    a = rows.mapInArrow(inner, kind).select("label", "run", F.struct(*columns).alias("a"))
    b = rows.mapInArrow(outer, kind).select("label", "run", F.struct(*columns).alias("b"))
    return a.join(b, ["label", "run"]).where((F.length("a.norm") < F.length("b.norm")) & F.contains("b.norm", "a.norm")).select("label", "a", "b")


def _with_runs(b: pa.RecordBatch, row: np.ndarray, run: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*b.take(pa.array(row)).columns, pa.array(run, pa.int32())], names=[*b.schema.names, "run"])


def _runs(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, run as a number, and bucket of each distinct run of four characters of each normalised name."""
    norm = b["norm"].to_pylist()
    codes = _CODES[np.frombuffer("".join(norm).encode("ascii"), dtype=np.uint8)]
    row = np.repeat(np.arange(len(norm)), [len(n) for n in norm])
    n = max(len(codes) - RUN + 1, 0)
    run = np.zeros(n, dtype=np.int64)
    for k in range(RUN):
        run = run * 37 + codes[k : k + n]
    whole = row[:n] == row[RUN - 1 : RUN - 1 + n]
    both = np.unique(row[:n][whole] * 37**RUN + run[whole])
    row, run = both // 37**RUN, both % 37**RUN
    labels = b["label"].to_pylist()
    seed = {v: zlib.crc32(v.encode()) if v is not None else 0 for v in set(labels)}
    seeds = np.array([seed[v] for v in labels], dtype=np.uint64)
    mixed = (run.astype(np.uint64) + seeds[row] * np.uint64(37**RUN)) * np.uint64(0x9E3779B97F4A7C15)
    return row, run, (mixed >> np.uint64(44)).astype(np.int64)


_CODES = np.zeros(128, dtype=np.int64)
_CODES[np.frombuffer(b" 0123456789abcdefghijklmnopqrstuvwxyz", dtype=np.uint8)] = np.arange(37)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about ``GATHER`` rows that end where a group ends."""
    held, n = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n >= GATHER:
            table = pa.Table.from_batches(held).combine_chunks()
            starts = _starts(table)
            if len(starts) > 1:
                yield table.slice(0, starts[-1]).combine_chunks()
                table = table.slice(starts[-1])
            held, n = table.to_batches(), table.num_rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _starts(table: pa.Table) -> np.ndarray:
    """Where groups of label, word and cell begin."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for c in ("label", "t", "cell"):
        v = table[c].combine_chunks()
        new[1:] |= pc.fill_null(pc.not_equal(v.slice(1), v.slice(0, len(v) - 1)), True).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


class _Met:
    """Names that meet at words, and the pairs of them."""

    def __init__(self, table: pa.Table, least: float, threshold: float, ratio: bool):
        self.least, self.threshold, self.ratio = least, threshold, ratio
        self.starts = np.append(_starts(table), table.num_rows)
        self.rep, self.label = table["rep"].combine_chunks(), table["label"].combine_chunks()
        reps = self.rep.to_pylist()
        place = {r: i for i, r in enumerate(sorted(set(reps)))}
        self.reps, self.order = reps, np.array([place[r] for r in reps])
        self.norm = table["norm"].to_pylist()
        self.length = np.array([len(n) for n in self.norm])
        self.side = table["side"].to_numpy()
        ids: dict[str, int] = {}
        self.words = [[ids.setdefault(w, len(ids)) for w in dict.fromkeys(n.split())] for n in self.norm]
        self.before = [[ids.setdefault(w, len(ids)) for w in b.split()] for b in table["before"].to_pylist()]
        self.size = np.array([len(w) for w in self.words])
        self.place = np.array([len(b) + 1 for b in self.before])
        self.wide = self.size > WIDE
        self.word_table, self.before_table = _padded(self.words), _padded(self.before)
        versions: dict[str, int] = {"": 0}
        self.version = np.array([versions.setdefault(v, len(versions)) for v in table["versions"].to_pylist()])
        self.stars, self.shared = ([frozenset(v) if v else None for v in table[c].to_pylist()] for c in ("stars", "shared"))
        self.starred, self.sharing = (np.array([v is not None for v in c]) for c in (self.stars, self.shared))
        self.counts = np.zeros((len(reps), 128), dtype=np.int32)
        np.add.at(self.counts, (np.repeat(np.arange(len(reps)), self.length), np.frombuffer("".join(self.norm).encode("ascii"), dtype=np.uint8)), 1)
        self.counts = self.counts[:, self.counts.any(axis=0)].T.copy()

    def pairs(self) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for i, j in self._candidates():
            held.append((i, j))
            n += len(i)
            if n >= PAIRS:
                yield from self._scored(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                held, n = [], 0
        if n:
            yield from self._scored(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))

    def _candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        corners: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for lo, hi in zip(self.starts[:-1].tolist(), self.starts[1:].tolist()):
            n = hi - lo
            if n <= 64:
                if n > 1:
                    if n not in corners:
                        corners[n] = np.triu_indices(n, 1)
                    yield corners[n][0] + lo, corners[n][1] + lo
            else:
                yield from self._tiles(np.arange(lo, hi))

    def _tiles(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a large group by sizes, those left out that bounds on words and characters rule out."""
        words, counts, beyond = self._features(rows)
        parts: dict[tuple[int, int, int], list[int]] = {}
        for i, k in enumerate(zip(self.side[rows].tolist(), self.size[rows].tolist(), self.place[rows].tolist())):
            parts.setdefault(k, []).append(i)
        keys = sorted(parts)
        for u, (s, a, at) in enumerate(keys):
            for r, b, bt in keys[u:]:
                need = max(int(np.ceil((a + b) * (self.least / (1 + self.least)) - 1e-9)), 1)
                if (s == r != 2) or at > a - need + 1 or bt > b - need + 1 or need > min(a, b):
                    continue
                same, left, right = (s, a, at) == (r, b, bt), np.array(parts[s, a, at]), np.array(parts[r, b, bt])
                common = np.arange(min(a, b) + 1)
                j = common / (a + b - common)
                if self.ratio:  # the share of both lengths that must match for so many words in common
                    share = np.where(common >= need, (self.threshold - 1e-4 - 0.55 * j) / 0.9, 2.0).astype(np.float32)
                else:
                    share = np.where(j >= self.threshold - 1e-6, 0.0, 2.0).astype(np.float32)
                for p in range(0, len(left), TILE):
                    x = left[p : p + TILE]
                    for q in range(p if same else 0, len(right), TILE):
                        y = right[q : q + TILE]
                        o = np.minimum(words[x] @ words[y].T + 0.5, min(a, b) + 0.5).astype(np.int32)
                        wanted = share[o]
                        lengths = (self.length[rows[x]][:, None] + self.length[rows[y]][None, :]).astype(np.float32)
                        if self.ratio:
                            m = counts[x] @ counts[y].T
                            if beyond is not None:
                                m += np.minimum(beyond[x][:, None], beyond[y][None, :])
                            hit = m + 1e-3 >= wanted * lengths
                        else:
                            hit = wanted < 1
                        if same and p == q:
                            hit &= np.tri(len(x), len(y), -1, dtype=bool).T
                        i, k = np.nonzero(hit)
                        for c in range(0, len(i), PAIRS):
                            yield rows[x[i[c : c + PAIRS]]], rows[y[k[c : c + PAIRS]]]

    def _features(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Columns whose products are no less than the words and the characters that two names share."""
        at = np.repeat(np.arange(len(rows)), self.size[rows])
        flat = np.array([w for r in rows.tolist() for w in self.words[r]])
        ids, which, often = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(ids), dtype=np.int64)
        rank[np.argsort(-often, kind="stable")] = np.arange(len(ids))
        column = np.where(rank < OWN_WORDS, rank, OWN_WORDS + rank % OTHER_WORDS)[which]
        keep = often[which] > 1
        words = np.zeros((len(rows), OWN_WORDS + OTHER_WORDS), dtype=np.float32)
        np.add.at(words, (at[keep], column[keep]), 1.0)
        words = np.ascontiguousarray(words[:, words.any(axis=0)])
        counts = self.counts[:, rows]
        levels = [c >= k for c in counts for k in range(1, min(int(c.max()), LEVELS) + 1)]
        over = np.maximum(counts - LEVELS, 0).sum(axis=0).astype(np.float32)
        return words, np.ascontiguousarray(np.stack(levels, axis=1).astype(np.float32)), over if over.any() else None

    def _common(self, i: np.ndarray, j: np.ndarray, table: np.ndarray, lists: list[list[int]]) -> np.ndarray:
        """How many words two rows have in common."""
        out = np.zeros(len(i), dtype=np.int64)
        wide = self.wide[i] | self.wide[j]
        narrow = np.flatnonzero(~wide)
        x, y = table[:, i[narrow]], table[:, j[narrow]]
        n = np.zeros(len(narrow), dtype=np.int64)
        for a in x:
            for b in y:
                n += (a == b) & (a >= 0)
        out[narrow] = n
        for k in np.flatnonzero(wide).tolist():
            out[k] = len(set(lists[i[k]]).intersection(lists[j[k]]))
        return out

    def _scored(self, i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
        swap = self.order[i] > self.order[j]
        x, y = np.where(swap, j, i), np.where(swap, i, j)
        v, w = self.version[x], self.version[y]
        ok = ((v == 0) | (w == 0) | (v == w)) & ((self.side[x] == 2) | (self.side[x] != self.side[y])) & (self.order[x] != self.order[y])
        x, y = x[ok], y[ok]
        both, either = self._common(x, y, self.word_table, self.words), self.size[x] + self.size[y]
        jaccard = both / np.maximum(either - both, 1)
        total = self.length[x] + self.length[y]
        if self.ratio:
            bound = 0.55 * jaccard + 0.45 * (2.0 * np.minimum(self.length[x], self.length[y]) / np.maximum(total, 1))
        else:
            bound = jaccard
        ok = bound >= self.threshold
        x, y, jaccard, total = x[ok], y[ok], jaccard[ok], total[ok]
        ok = self._common(x, y, self.before_table, self.before) == 0
        x, y, jaccard, total = x[ok], y[ok], jaccard[ok], total[ok]
        if self.ratio:
            need = np.ceil((self.threshold - 1e-4 - 0.55 * jaccard) / 0.9 * total - 1e-6)
            bound = np.zeros(len(x), dtype=np.int32)
            for c in self.counts:
                bound += np.minimum(c[x], c[y])
            ok = bound >= need
            x, y, jaccard, total, need = x[ok], y[ok], jaccard[ok], total[ok], need[ok]
            matched = matched_characters(self.norm, x, y, need)
            ok = matched >= need
            x, y, jaccard, total, matched = x[ok], y[ok], jaccard[ok], total[ok], matched[ok]
            q = 2.0 * matched / np.maximum(total, 1)
            whole = matched == np.minimum(self.length[x], self.length[y])
        else:
            q, whole = np.zeros(len(x)), np.ones(len(x), dtype=bool)
        keep = np.ones(len(x), dtype=bool)
        for k in np.flatnonzero(whole).tolist():
            a, b = self.norm[x[k]], self.norm[y[k]]
            keep[k] = min(len(a), len(b)) < 4 or not (a in b or b in a)
        for k in np.flatnonzero(self.starred[x] | self.starred[y]).tolist():
            if self.reps[y[k]] in (self.stars[x[k]] or ()) or self.reps[x[k]] in (self.stars[y[k]] or ()):
                keep[k] = False
        x, y, jaccard, q = x[keep], y[keep], jaccard[keep], q[keep]
        overlap = np.zeros(len(x), dtype=bool)
        for k in np.flatnonzero(self.sharing[x] & self.sharing[y]).tolist():
            overlap[k] = not self.shared[x[k]].isdisjoint(self.shared[y[k]])
        for c in range(0, len(x), 50_000):
            s = slice(c, c + 50_000)
            yield pa.RecordBatch.from_arrays([self.rep.take(pa.array(x[s])), self.rep.take(pa.array(y[s])), self.label.take(pa.array(x[s])), pa.array(jaccard[s]), pa.array(q[s]), pa.array(overlap[s])], names=["x", "y", "label", "j", "q", "overlap"])


def _padded(lists: list[list[int]]) -> np.ndarray:
    """The first ``WIDE`` entries of each list, one row for each place and -1 where there is none."""
    n = min(max(map(len, lists), default=0), WIDE)
    out = np.full((n, len(lists)), -1, dtype=np.int32)
    for i, v in enumerate(lists):
        out[: len(v[:n]), i] = v[:n]
    return out

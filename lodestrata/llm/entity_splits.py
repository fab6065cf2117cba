"""Train, validation and test splits that keep records with a common author together.

Records and persons form a bipartite graph. Its components are found by distributed union-find with local forests
merged hierarchically (``operators.forests``). Groups are then assigned, largest first, to the split that is furthest
below its target. Greedy assignment depends on group sizes alone, so it is solved on the histogram of sizes (at most
about sqrt(2 * records) distinct sizes), and each group takes its split by its rank among groups of its size.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.skew import split_join
from lodestrata.operators.forests import union_find
from lodestrata.sources.scratch import Scratch, rows as row_count

#: Entries of an author list that name nobody (fixed values).
NOBODY = frozenset({"", "et al", "others", "and others", "unknown", "anonymous", "the editors", "editors", "n/a", "na", "none", "anon", "editorial board", "no author", "nn", "n.n", "n. n"})

_MARKS = re.compile(r"[\d*†‡§¶‖#⁰¹²³⁴-⁹₀-₉^]+")
_CUT = re.compile(r"[;|&/\n]|(?<=\s)(?:and|und|et(?!\s+al))(?=\s)")


def persons(authors: str | None) -> list[tuple[str, str]]:
    """``(family, given)`` for each person named in one author string, in lower case and composed accents.

    Items are divided by semicolons, bars, ampersands or "and". A comma divides items too, unless it divides family
    and given name: single words on both sides of a comma are one person, family name first. Without a comma the
    family name is last, unless only an initial follows it. Digits, daggers and asterisks are marks, not names.
    Entries that name nobody give nothing; so does null.
    """
    text = " ".join(_MARKS.sub(" ", unicodedata.normalize("NFC", authors or "").replace("n/a", " ").replace("N/A", " ")).casefold().split())
    out = []
    for item in _CUT.split(text):
        parts = [p.strip() for p in item.split(",")]
        parts = [p for p in parts if p.rstrip(". ") not in NOBODY]
        i = 0
        while i < len(parts):
            words = parts[i].split()
            last = i + 1 < len(parts) and parts[i + 1].split() or []
            if last and _is_given(last) and (len(words) == 1 or all(map(_is_initial, last)) and not any(map(_is_initial, words))):
                out.append((parts[i], " ".join(last)))
                i += 2
                continue
            if len(words) > 1 and all(map(_is_initial, words[1:])) and not _is_initial(words[0]):
                out.append((words[0], " ".join(words[1:])))
            elif len(words) > 1:
                out.append((words[-1], " ".join(words[:-1])))
            elif words:
                out.append((words[0].rstrip("."), ""))
            i += 1
    return [(f, " ".join(w.rstrip(".") for w in g.replace(".", ". ").split())) for f, g in out]


def _is_initial(word: str) -> bool:
    return len(word.rstrip(".")) == 1 or bool(re.fullmatch(r"(\w\.)+", word))


def _is_given(words: list[str]) -> bool:
    return len(words) == 1 or all(map(_is_initial, words))


def _mentions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(n, f, g, all(len(w) == 1 for w in g.split())) for n, a in zip(b["node"], b["authors"]) for f, g in dict.fromkeys(persons(a))]
        yield pd.DataFrame(rows, columns=["node", "family", "given", "short"])


def author_links(rows: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` between the records of ``rows(node, authors)`` and persons.

    Names agree if family and given name do. An initial stands for the one person of the table with that family name
    and initial; if several have it, it stands for nobody and links nothing; if none has it, it is a person itself.
    """
    names = rows.select("node", "authors").where(F.col("authors").isNotNull()).mapInPandas(_mentions, "node string, family string, given string, short boolean")
    names = names.select("node", "given", "short", F.concat_ws("\x1f", "family", F.substring("given", 1, 1)).alias("who"))
    scratch = Scratch(rows.sparkSession, "authors")
    names = scratch.put(names)
    full = names.where("not short").groupBy("who").agg(F.min("given").alias("least"), F.max("given").alias("most"))
    short = split_join(names.where("short"), full, "who", row_count(names), "left")
    one = F.coalesce(F.col("least"), F.col("given"))
    links = names.where("not short").select("node", "who", "given").unionByName(short.where("least is null or least = most").select("node", "who", one.alias("given")))
    return links.select(F.concat(F.lit("r\x1f"), "node").alias("a"), F.concat_ws("\x1f", F.lit("p"), "who", "given").alias("b")).distinct()


def record_groups(manifest: DataFrame, id_col: str = "id", authors_col: str = "authors", split_col: str = "split") -> DataFrame:
    """``(id, group_id, split)`` for every row: rows of one id and rows that name the same person share a group.

    A row with a null id links the rows of its persons like any other. The group is named by its smallest
    member, a person or a record.
    ``split`` comes out without case, spacing and hyphens, null if blank.
    """
    lone = F.concat(F.lit("\x00"), F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys(manifest.columns)])), 256))
    split = F.regexp_replace(F.lower(F.col(split_col)), r"[\s\p{Z}\p{Pd}_]+", "")
    rows = manifest.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col), lone).alias("node"), F.col(authors_col).alias("authors"), F.when(split != "", split).alias("split"))
    rows = Scratch(manifest.sparkSession, "records").put(rows)
    found = union_find(author_links(rows)).where("startswith(node, 'r\x1f')").select(F.substr("node", F.lit(3)).alias("node"), F.col("root").alias("group_id"))
    return split_join(rows, found, "node", row_count(rows), "left").select("id", "node", F.translate(F.coalesce("group_id", F.concat(F.lit("r\x1f"), "node")), "\x1f", "/").alias("group_id"), "split")


def conflicting_records(groups: DataFrame) -> DataFrame:
    """``(id)`` of every record whose group shows two or more different splits; null splits count for nothing."""
    scratch = Scratch(groups.sparkSession, "splits")
    groups = scratch.put(groups)
    torn = groups.where("split is not null").groupBy("group_id").agg(F.min("split").alias("x"), F.max("split").alias("y")).where("x <> y").select("group_id")
    return split_join(groups.where("id is not null"), torn, "group_id", row_count(groups)).select("id").distinct()


def greedy_quotas(sizes: list[tuple[int, int]], shares: list[tuple[str, float]]) -> list[tuple[int, str, int, int]]:
    """``(size, split, from_rank, to_rank)``: largest first, each group to the split furthest below its target.

    ``sizes`` is the histogram ``(size, groups)``. Equal shares fall to the first split by name. A run of equal sizes
    is assigned in closed form as long as one split stays furthest below, so the work follows the distinct sizes.
    """
    total = sum(s * n for s, n in sizes)
    whole = sum(w for _, w in shares) or 1.0
    gap = {k: total * w / whole for k, w in shares}
    out = []
    for size, n in sorted(sizes, reverse=True):
        lowest = min(gap.values())
        top = max(gap.values())
        # Full rounds while every gap stays comparable: level the gaps first, then share the rest evenly.
        take = dict.fromkeys(gap, 0)
        left = n
        if n > 10_000:
            level = np.array([gap[k] for k in sorted(gap)])
            lo, hi = (lowest - size * (n + 1)), top
            for _ in range(200):
                mid = (lo + hi) / 2
                if np.maximum(0, np.floor((level - mid) / size)).sum() > max(0, n - len(gap) - 1):
                    lo = mid
                else:
                    hi = mid
            for k in gap:
                take[k] = int(max(0, np.floor((gap[k] - hi) / size)))
            left = n - sum(take.values())
        heap = [(-(gap[k] - take[k] * size), k) for k in gap]
        heapq.heapify(heap)
        for _ in range(left):
            g, k = heapq.heappop(heap)
            take[k] += 1
            heapq.heappush(heap, (g + size, k))
        at = 0
        for k in sorted(take):
            if take[k]:
                out.append((size, k, at, at + take[k]))
                at += take[k]
            gap[k] -= take[k] * size
    return out


def assign_splits(groups: DataFrame, policy: DataFrame) -> DataFrame:
    """``(id, group_id, assigned)`` for every row of ``record_groups``, by the shares of ``policy(split, share)``.

    The policy is a table of a few rows that names the splits; more than 1,000 are an error. Groups of one size are ranked by a range sort, so no
    task holds a whole size class. An empty policy or no groups give no rows.
    """
    scratch = Scratch(groups.sparkSession, "assign")
    groups = scratch.put(groups)
    sizes = scratch.put(groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("size")))
    shares = [(r[0], float(r[1])) for r in policy.where("split is not null and share > 0").groupBy("split").agg(F.max("share")).take(1001)]
    if len(shares) > 1000:
        raise ValueError("more than 1,000 splits")
    counts = [(r[0], r[1]) for r in sizes.groupBy("size").count().collect()]
    if not shares or not counts:
        return groups.sparkSession.createDataFrame([], "id string, group_id string, assigned string")
    tasks = max(1, -(-row_count(sizes) // 100_000))
    ordered = scratch.put(sizes.repartitionByRange(tasks, "size", "group_id").sortWithinPartitions("size", "group_id").withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()))
    first = {(r[0], r[1]): (r[2], r[3]) for r in ordered.groupBy("size", "part").agg(F.min("row"), F.count(F.lit(1))).collect()}
    start, seen = [], {}
    for (size, part), (row, n) in sorted(first.items()):
        start.append((size, part, row - seen.get(size, 0)))
        seen[size] = seen.get(size, 0) + n
    offsets = groups.sparkSession.createDataFrame(start, "size long, part int, offset long")
    quotas = groups.sparkSession.createDataFrame(greedy_quotas(counts, shares), "size long, assigned string, low long, high long")
    ranked = ordered.join(F.broadcast(offsets), ["size", "part"]).withColumn("rank", F.col("row") - F.col("offset"))
    chosen = ranked.join(F.broadcast(quotas), "size").where("rank >= low and rank < high").select("group_id", "assigned")
    return split_join(groups, chosen, "group_id", row_count(groups)).select("id", "group_id", "assigned")

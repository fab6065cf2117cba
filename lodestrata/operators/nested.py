"""Deeply nested records as related flat tables, by interval labels.

Every node of a record (the record itself, each element of each array at any depth) gets its number in pre-order and
in post-order of a depth-first traversal, children in the order of the schema's fields. Node ``a`` is an ancestor of
node ``d`` exactly if ``a.pre < d.pre and a.post > d.post``, so tables of any two node types can be related without
knowing the levels between them. The numbers follow from subtree sizes, which are prefix sums over Arrow's list
offsets; a batch of records is labelled by a few vectorised passes, in time linear in its nodes, with no shuffle.
All nodes of a record are in one batch, so containment is resolved there by binary search, and a record's copies or
a key that many records share cost nothing extra.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _is_list(t: pa.DataType) -> bool:
    return pa.types.is_list(t) or pa.types.is_large_list(t)


def _fields(values: pa.Array) -> list[tuple[str, pa.Array]]:
    """Fields of a struct array with its nulls pushed down, structs inside it flattened to dotted names."""
    out: list[tuple[str, pa.Array]] = []
    for field, child in zip(values.type, values.flatten()):
        if pa.types.is_struct(field.type):
            out += [(f"{field.name}.{n}", c) for n, c in _fields(child)]
        else:
            out.append((field.name, child))
    return out


class _Node:
    """All nodes of one type in a batch: their labels, the parent's row in the type above, and their values."""

    def __init__(self, path: str, values: pa.Array, parent: np.ndarray, pos: np.ndarray, record: np.ndarray, level: int):
        self.path, self.values, self.parent, self.pos, self.record, self.level = path, values, parent, pos, record, level
        self.children: list[_Node] = []
        self.size = np.ones(len(values), dtype=np.int64)
        if pa.types.is_struct(values.type):
            for name, child in _fields(values):
                if _is_list(child.type):
                    lengths = pc.fill_null(pc.list_value_length(child), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                    up = np.repeat(np.arange(len(child)), lengths)
                    first = np.concatenate(([0], np.cumsum(lengths)))[:-1]
                    node = _Node(f"{path}.{name}" if path else name, pc.list_flatten(child), up, np.arange(len(up)) - first[up], record[up], level + 1)
                    self.children.append(node)
                    self.size += np.bincount(up, node.size, len(values)).astype(np.int64)

    def label(self, pre: np.ndarray) -> None:
        self.pre, self.post = pre, pre + self.size - 1 - self.level
        cursor = pre + 1
        for node in self.children:
            before = np.concatenate(([0], np.cumsum(node.size)))
            start = np.searchsorted(node.parent, np.arange(len(pre)))
            node.label(cursor[node.parent] + before[:-1] - before[start][node.parent])
            cursor = cursor + np.bincount(node.parent, node.size, len(pre)).astype(np.int64)

    def find(self, path: str) -> _Node:
        for node in [self, *self.children]:
            if node.path == path:
                return node
        for node in self.children:
            if path.startswith(f"{node.path}."):
                return node.find(path)
        raise KeyError(path)

    def columns(self) -> list[tuple[str, pa.Array]]:
        if pa.types.is_struct(self.values.type):
            return [(n, v) for n, v in _fields(self.values) if not _is_list(v.type)]
        return [("value", self.values)]


def _labelled(column: pa.Array) -> _Node:
    root = _Node("", column, np.arange(len(column)), np.zeros(len(column), dtype=np.int64), np.arange(len(column)), 0)
    root.label(np.zeros(len(column), dtype=np.int64))
    return root


def _scalars(t: T.DataType, path: str) -> list[T.StructField]:
    """The flat columns of the node type at ``path`` below the type ``t``."""

    def fields(s: T.StructType, prefix: str = "") -> list[T.StructField]:
        out: list[T.StructField] = []
        for f in s:
            out += fields(f.dataType, f"{prefix}{f.name}.") if isinstance(f.dataType, T.StructType) else [T.StructField(prefix + f.name, f.dataType)]
        return out

    names = {"": t}

    def walk(t: T.DataType, at: str) -> None:
        if isinstance(t, T.StructType):
            for f in fields(t):
                if isinstance(f.dataType, T.ArrayType):
                    inner = f"{at}.{f.name}" if at else f.name
                    names[inner] = f.dataType.elementType
                    walk(f.dataType.elementType, inner)

    walk(t, "")
    t = names[path]
    return [f for f in fields(t) if not isinstance(f.dataType, T.ArrayType)] if isinstance(t, T.StructType) else [T.StructField("value", t)]


def node_paths(df: DataFrame, column: str) -> list[str]:
    """The node types of a struct column: the empty path is the record, others are dotted paths of array fields."""
    out = [""]

    def walk(t: T.DataType, at: str) -> None:
        if isinstance(t, T.StructType):
            for f in t:
                path = f"{at}.{f.name}" if at else f.name
                if isinstance(f.dataType, T.ArrayType):
                    out.append(path)
                    walk(f.dataType.elementType, path)
                elif isinstance(f.dataType, T.StructType):
                    walk(f.dataType, path)

    walk(df.schema[column].dataType, "")
    return out


def node_table(df: DataFrame, key: str, column: str, path: str) -> DataFrame:
    """One row per node of the type ``path``: ``record`` (the key), ``pre``, ``post``, ``level``, ``pos`` and its scalars.

    A null or empty array has no nodes; a null element is a node with null scalars that keeps its position; a null
    record is a node with null scalars and no children. Scalars that would clash with a label get a trailing
    underscore. Nothing else of ``df`` is read.
    """
    scalars = _scalars(df.schema[column].dataType, path)
    own = ["record", "pre", "post", "level", "pos"]
    names = [f.name.replace(".", "_") + "_" * (f.name in own) for f in scalars]
    schema = T.StructType([T.StructField("record", df.schema[key].dataType), *(T.StructField(n, T.LongType()) for n in own[1:]), *(T.StructField(n, f.dataType) for n, f in zip(names, scalars))])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = _labelled(batch.column(1)).find(path)
            n = len(node.pre)
            labels = [batch.column(0).take(pa.array(node.record)), pa.array(node.pre), pa.array(node.post), pa.array(np.full(n, node.level, dtype=np.int64)), pa.array(node.pos.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(labels + [v for _, v in node.columns()], [*own, *names])

    return df.select(key, column).mapInArrow(emit, schema)


def contained(df: DataFrame, key: str, column: str, parent: str, child: str) -> DataFrame:
    """Each node of the type ``parent`` with each node of the type ``child`` inside its interval, or with nulls if none.

    Columns: ``record``, ``parent_pos``, the parent's scalars as ``parent_*``, ``child_pos``, the child's scalars as
    ``child_*``; a scalar named ``pos`` gets a trailing underscore. The child may be any number of levels below the parent. The pairs are found from the labels alone:
    by record, children are in pre-order, so those of one interval are adjacent.
    """
    t = df.schema[column].dataType
    above, below = _scalars(t, parent), _scalars(t, child)
    flat = lambda side, f: f"{side}_{f.name.replace('.', '_')}" + "_" * (f.name == "pos")
    schema = T.StructType(
        [T.StructField("record", df.schema[key].dataType), T.StructField("parent_pos", T.LongType())]
        + [T.StructField(flat("parent", f), f.dataType) for f in above]
        + [T.StructField("child_pos", T.LongType())]
        + [T.StructField(flat("child", f), f.dataType) for f in below]
    )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            root = _labelled(batch.column(1))
            a, d = root.find(parent), root.find(child)
            base = np.concatenate(([0], np.cumsum(root.size)))[:-1]
            pres = base[d.record] + d.pre
            low = np.searchsorted(pres, base[a.record] + a.pre, "right")
            high = np.searchsorted(pres, base[a.record] + a.pre + a.size, "left")
            n = np.maximum(high - low, 1)
            up = np.repeat(np.arange(len(a.pre)), n)
            at = np.repeat(low, n) + np.arange(len(up)) - np.repeat(np.cumsum(n) - n, n)
            rows = pa.array(at, mask=np.repeat(high <= low, n))
            ups = pa.array(up)
            arrays = [batch.column(0).take(pa.array(a.record[up])), pa.array(a.pos[up].astype(np.int64))] + [v.take(ups) for _, v in a.columns()]
            arrays += [pa.array(d.pos.astype(np.int64)).take(rows)] + [v.take(rows) for _, v in d.columns()]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return df.select(key, column).mapInArrow(emit, schema)


def within(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Two tables of ``node_table`` joined by record and interval containment; scalars that clash are taken from the child.

    For tables that were written and read again; ``contained`` gives the same pairs in one pass without a shuffle.
    """
    p = parents.select("record", *[parents[c].alias(f"parent_{c}") for c in parents.columns if c != "record"])
    return p.join(children, "record").where("parent_pre < pre and parent_post > post")

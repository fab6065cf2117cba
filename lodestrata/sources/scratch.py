"""Written tables in the shared checkpoint folder, used to cut lineage in iterative operators.

Every iteration of an iterative operator writes its state as Parquet below ``spark.checkpoint.dir`` and reads it
back. All executors share that folder, so a lost executor costs a re-read and never an earlier iteration, and the
footers give Catalyst true sizes, so that a side is broadcast only when the written table is known to be small.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder named by the session; a temporary folder of this machine only where none is named and Spark is local."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _local[app] = tempfile.mkdtemp(prefix="lodestrata-")
        atexit.register(shutil.rmtree, _local[app], True)
    return _local[app]


class Scratch:
    """Tables of one run of an operator. ``forget`` removes a superseded table; the last ones stay with the result."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        _made.setdefault(spark.sparkContext.applicationId, []).append(self.base)

    def put(self, df: DataFrame, **measures: Column) -> DataFrame:
        """Writes a table and reads it again; its row count and the measures asked for are taken while it is written."""
        self._n += 1
        path = f"{self.base}/{self._n:04d}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in measures.items()]).write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._seen = seen.get
        out._scratch_path = path
        return out

    def put_blocks(self, df: DataFrame, block_rows: int) -> list[str]:
        """Writes a table in files of at most ``block_rows`` rows and gives their addresses, for tasks that read it block by block with ``read_block``."""
        self._n += 1
        path = f"{self.base}/{self._n:04d}"
        df.write.option("maxRecordsPerFile", block_rows).parquet(path)
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        found = p.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(p)
        return sorted(str(f.getPath().toUri()) for f in found if str(f.getPath().getName()).endswith(".parquet"))

    def forget(self, *tables: DataFrame | None) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in tables:
            path = getattr(df, "_scratch_path", None)
            if path:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)


def read_block(address: str) -> pa.Table:
    """One file of ``put_blocks``, read in a task from the shared folder."""
    files, path = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", address))
    return pq.read_table(path, filesystem=files)


def grown(start: DataFrame, step: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """The distinct rows of ``start`` and all that ``step`` makes of the newest ones, until it makes no new row.

    Each round is written, so lineage stays short; a cycle ends by itself, as its rows are known. ``step`` keeps the columns.
    """
    scratch = Scratch(start.sparkSession, name)
    new = every = scratch.put(start.distinct())
    while rows(new):
        made = step(new).select(*start.columns).distinct()
        same = [F.col(f"_k.{c}").eqNullSafe(F.col(f"_m.{c}")) for c in start.columns]
        new = scratch.put(made.alias("_m").join(every.alias("_k"), reduce(Column.__and__, same), "left_anti"))
        every = every.unionByName(new)
    return every


def rows(table: DataFrame) -> int:
    """How many rows a scratch table has, as counted when it was written."""
    return table._seen["rows"]


def clear(spark: SparkSession) -> None:
    """Removes all scratch tables of this application; results that still read them are lost, so write these first."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for base in _made.pop(spark.sparkContext.applicationId, []):
        p = jvm.org.apache.hadoop.fs.Path(base)
        p.getFileSystem(conf).delete(p, True)

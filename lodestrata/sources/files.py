"""File scans and sinks: JSON and JSON lines, binary files by content, run folders, audit reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A file with one JSON value over several lines; the schema is given, never inferred."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines; a missing file is an empty table and blank lines are skipped."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines with sorted fields, replacing the table or appended to it."""
    df.select(*sorted(df.columns)).write.mode("append" if append else "overwrite").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A CSV report with a header; arrays are joined by semicolons."""
    cols = [F.array_join(F.col(f.name).cast("array<string>"), ";").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name) for f in df.schema]
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def read_documents(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Binary files below a folder: ``path``, ``sha256``, ``length``, ``is_pdf``, ``content``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = files.select("path", F.sha2("content", 256).alias("sha256"), "length", (F.substring("content", 1, 4) == F.lit(b"%PDF")).alias("is_pdf"), "content")
    return files.orderBy("path").limit(limit) if limit is not None else files


def distinct_contents(files: DataFrame, key: str = "sha256", location: str = "path") -> DataFrame:
    """One row per content: its first location in order, how many locations it has, and how many copies. The locations themselves stay rows of ``files``."""
    return files.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(location).alias("first_location"), F.count_distinct(location).alias("locations"), F.count(F.lit(1)).alias("copies"))


def unparsed(files: DataFrame, parsed: DataFrame, key: str = "sha256") -> DataFrame:
    """Files whose content has no parsed document yet."""
    return files.join(parsed.select(key).distinct(), key, "left_anti")


def latest_per_key(runs: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """The row of each key with the latest time; of equal times the one with the largest ``tie``. Null times are earliest."""
    rest = [c for c in runs.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(F.col(at), F.col(tie)))
    return runs.where(F.col(key).isNotNull()).groupBy(key).agg(best.alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def run_catalog(spark: SparkSession, root: str, artifact: str, preferred: str, schema: T.StructType | str, manifest_schema: T.StructType | str = "run_id string, test_scope string, created_at timestamp", scope: str = "full_paper") -> DataFrame:
    """Rows of an artifact of every run below ``root`` whose manifest has the scope; the preferred artifact replaces the other where a run has it."""
    run = F.regexp_extract("_metadata.file_path", "/([^/]+)/[^/]+$", 1).alias("run_folder")
    if not _exists(spark, f"{root}/*/manifest.json"):
        return spark.createDataFrame([], schema).withColumn("run_folder", F.lit(None).cast("string"))
    runs = spark.read.schema(manifest_schema).option("multiLine", True).json(f"{root}/*/manifest.json").select("*", run).where(F.col("test_scope") == scope).select("run_folder")
    read = lambda name: spark.read.schema(schema).json(f"{root}/*/{name}").select("*", run) if _exists(spark, f"{root}/*/{name}") else None
    best, other = read(preferred), read(artifact)
    if best is None:
        return other.join(runs, "run_folder", "left_semi")
    both = best if other is None else best.unionByName(other.join(best.select("run_folder").distinct(), "run_folder", "left_anti"))
    return both.join(runs, "run_folder", "left_semi")


def job_list(spark: SparkSession, root: str, manifest_schema: T.StructType | str = "run_id string, test_scope string, created_at timestamp") -> DataFrame:
    """The manifests of all runs below a folder, the latest first."""
    if not _exists(spark, f"{root}/*/manifest.json"):
        return spark.createDataFrame([], manifest_schema)
    return spark.read.schema(manifest_schema).option("multiLine", True).json(f"{root}/*/manifest.json").orderBy(F.desc("created_at"), "run_id")


def write_json(df: DataFrame, path: str) -> None:
    """A table of one row, such as a run's manifest, as one JSON file; more rows are an error, none give an empty file."""
    if len(df.take(2)) > 1:
        raise ValueError("more than one row; use write_jsonl()")
    df.coalesce(1).write.mode("overwrite").json(path)


def checksums(files: DataFrame) -> DataFrame:
    """``name``, ``sha256`` of each file, in order of name."""
    return files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "sha256").orderBy("name")


def numbered(df: DataFrame, partition: list[str], order: list, name: str = "ordinal") -> DataFrame:
    """Rows numbered from 0 within each partition."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*partition).orderBy(*order)) - 1).cast("int"))

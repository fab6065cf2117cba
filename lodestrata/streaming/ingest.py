"""Incremental forms: document arrival, replacing a document's rows, folding stage reports, event-time windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def stream_table(spark: SparkSession, folder: str, schema: T.StructType | str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def stream_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of binary documents with their content hash."""
    raw = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    return raw.select("path", F.sha2("content", 256).alias("sha256"), "length", "content")


def replace_by_document(path: str, key: str = "document_id", buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that replaces a document's rows in a table partitioned by ``bucket`` of its id.

    Only the buckets that a batch touches are rewritten, so ``buckets`` should grow with the table; it must stay the same
    for one table, and another number than that of the table's first batch is an error. A repeated batch leaves the same table. The new buckets are written beside the table first,
    so that it is never read and overwritten in one job; a batch that was cut off while they replaced the old ones is
    finished from there when it is repeated, so no row of another document is lost.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        jvm = spark._jvm
        at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
        _same_buckets(spark, f"{path}-buckets", buckets)
        staged = f"{path}-staged-{number}"
        new = batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        if not fs.exists(at(f"{staged}/_SUCCESS")):
            out = new
            if fs.exists(at(path)) and len(fs.listStatus(at(path))):
                old = spark.read.parquet(path)
                touched = new.select("bucket").distinct()
                kept = old.join(touched, "bucket", "left_semi").join(new.select(key).distinct(), key, "left_anti")
                out = kept.select(*new.columns).unionByName(new)
            out.write.mode("overwrite").partitionBy("bucket").parquet(staged)
        spark.read.schema(new.schema).parquet(staged).select(*new.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
        fs.delete(at(staged), True)

    return write


def _same_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    """Keeps a table's number of buckets beside it, and checks it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(path)
    elif (known := spark.read.schema("buckets int").parquet(path).first()) and known[0] != buckets:
        raise ValueError(f"the table has {known[0]} buckets, not {buckets}")


def fold_stages(reports: DataFrame, job: str = "job_id", stage: str = "stage", at: str = "ts", late: str = "1 day") -> DataFrame:
    """The latest stage of each job, as a streaming aggregate: ``(job, stage, ts)``; reports later than the watermark are dropped."""
    return reports.withWatermark(at, late).groupBy(job).agg(F.max_by(stage, at).alias(stage), F.max(at).alias(at))


def event_windows(events: DataFrame, at: str = "ts", by: str = "event_type", size: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums of ``value`` by event-time window and kind."""
    w = F.window(at, size, slide) if slide else F.window(at, size)
    out = events.withWatermark(at, late).groupBy(w.alias("w"), by).agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "events", "value")


def sessions(events: DataFrame, at: str = "ts", by: str = "user_id", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of each user: events with no longer gap than ``gap`` between them."""
    s = events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("events"))
    return s.select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


def drain(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Runs a stream over all that has arrived and stops; the checkpoint makes a second run start where this one ended."""
    q = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q

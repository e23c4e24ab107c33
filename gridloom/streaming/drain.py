"""Incremental draining of new documents and verdicts with Structured Streaming."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.operators.status import backlog, count_pending, latest_verdict, merge_first, merge_verdicts
from gridloom.sources.bucketed import BucketedTable, remove
from gridloom.sources.sinks import _exists, write_batch

Extract = Callable[[DataFrame], tuple[DataFrame, DataFrame]]
KeptExtract = Callable[[DataFrame, str], tuple[DataFrame, DataFrame]]


def drain(stream: DataFrame, extract: Extract | KeptExtract, path: str, verdict_path: str, checkpoint: str, hold: str | None = None) -> StreamingQuery:
    """Extract each micro-batch of a document stream: rows first, verdicts after.

    With ``hold``, a folder that the cluster shares, ``extract`` also gets a new folder below it for what both results
    start from, such as ``jobs.extract``'s ``keep``: the batch's documents are then read once. It is deleted after them.

    Both go to the folder of their batch. A crash between the two repeats the batch, which replaces itself, so nothing
    is ever there twice, and what a batch costs does not grow with those before; ``sinks.read_batches`` reads the rows.
    Runs over what is there and stops.
    """

    def batch(docs: DataFrame, number: int) -> None:
        folder = f"{hold.rstrip('/')}/{number}-{uuid.uuid4().hex}" if hold else None
        rows, verdicts = extract(docs, folder) if folder else extract(docs)
        write_batch(rows, path, number)
        write_batch(verdicts, verdict_path, number)
        if folder:
            remove(docs.sparkSession, folder)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def document_stream(spark: SparkSession, path: str, schema: str, files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def resume_backlog(source: DataFrame, verdicts: DataFrame, statuses: list[str], status: DataFrame | None = None) -> DataFrame:
    """What is still to do. Refuses where documents with a verdict still read as pending in ``status``: those are to be
    flushed first, or they would be done again."""
    if status is not None:
        stale = count_pending(status, verdicts.filter("status <> 'pending'").select("guid").distinct()).first()[0]
        if stale:
            raise RuntimeError(f"{stale} documents with a verdict still read as pending; flush verdicts first")
    return backlog(source, verdicts, statuses)


def flush_verdicts(stream: DataFrame, status_path: str, checkpoint: str) -> StreamingQuery:
    """Add new verdicts to a status table, the last of each guid in a batch.

    The table is a ``base`` and a ``log`` with a folder for each batch, so a batch writes its own verdicts only, and a
    repeated one replaces itself. Only verdicts that a batch has written are marked as read.
    """

    def batch(verdicts: DataFrame, number: int) -> None:
        write_batch(latest_verdict(verdicts), f"{status_path.rstrip('/')}/log", number)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def flush_into(stream: DataFrame, table: BucketedTable, checkpoint: str) -> StreamingQuery:
    """Merge new verdicts into a kept status table: a batch reads and replaces the buckets of its guids only, and no log
    grows. The table keeps the time of each guid's verdict, so one that comes late, or again, changes nothing newer."""

    def batch(verdicts: DataFrame, number: int) -> None:
        last = latest_verdict(verdicts)
        if not last.isEmpty():
            table.refresh().replace(last, newer_verdicts)
            table.vacuum()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newer_verdicts(status: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``merge_verdicts`` of those that are no older than what ``status`` has, whose staged_at they set."""
    if "staged_at" not in status.columns:
        status = status.withColumn("staged_at", F.lit(None).cast(verdicts.schema["staged_at"].dataType))
    known = verdicts.join(status.select("guid", F.col("staged_at").alias("_known")), "guid", "left")
    return merge_verdicts(status, known.filter(F.col("_known").isNull() | (F.col("staged_at") >= F.col("_known"))).drop("_known"))


def read_status(spark: SparkSession, status_path: str) -> DataFrame:
    """The base of a status table with what its log says last of each guid."""
    root = status_path.rstrip("/")
    base = spark.read.parquet(f"{root}/base")
    if not _exists(spark, f"{root}/log"):
        return base
    log = spark.read.parquet(f"{root}/log")
    rest = [c for c in log.columns if c not in ("guid", "batch")]
    last = log.groupBy("guid").agg(F.max(F.struct("batch", *rest)).alias("v")).select("guid", *[F.col("v")[c].alias(c) for c in rest if c != "staged_at"])
    return merge_verdicts(base, last)


def compact_status(spark: SparkSession, status_path: str, to: str) -> None:
    """A new status table at ``to``, whose base is the old one with its log merged in."""
    read_status(spark, status_path).write.parquet(f"{to.rstrip('/')}/base")


def sync_shapes(shared: DataFrame, local: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both shape tables with what the other had first."""
    return merge_first(shared, local), merge_first(local, shared)

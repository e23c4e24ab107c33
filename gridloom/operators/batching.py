"""Size-balanced batches, shape tables, run metrics."""

from __future__ import annotations

import bisect
import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows for each batch, the largest, that go to the lightest batch; the rest follow by rank.
HEAD_PER_BATCH = 20
#: Sizes of one class differ by less than this factor.
CLASS_WIDTH = 1.01
#: Batches that one row of a plan stands for at most.
PLANNED = 10_000


def n_batches(n: int, target: int) -> int:
    return max(1, -(-n // target))


def balanced_batches(df: DataFrame, size: str, target: int, key: str = "guid") -> DataFrame:
    """``df`` (key, size) with ``batch``: about ``target`` rows each and nearly equal sums of ``size``.

    The largest rows, some for each batch, go to the lightest batch, the rest back and forth over the batches by their
    global rank, the lightest first. Which batch is lightest follows from a histogram of size classes: ``head_plan`` deals
    the counts of a class to groups of equally loaded batches, so what the driver holds is bounded by the number of
    classes, whatever the number of rows and batches. Batches differ by about the largest row at most. Ranks come from a
    range partition's own rank plus the rows in earlier partitions. Rows are told apart by rank, so keys may repeat.
    """
    ranked = _written(global_rank(df, [F.desc(size), F.asc(key)]))
    n = ranked.count()
    batches = n_batches(n, target)
    head = min(n, HEAD_PER_BATCH * batches)
    group = F.when(F.col(size) >= 1, F.floor(F.log(F.col(size).cast("double")) / math.log(CLASS_WIDTH))).otherwise(-1)
    classes = ranked.filter(F.col("_rank") < head).groupBy(group.alias("c")).agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col(size).cast("double")), F.lit(0.0))).orderBy(F.desc("c")).collect()
    placed, order = head_plan([(r[1], r[2] / r[1]) for r in classes], batches)
    fixed = _each(df.sparkSession, placed, "_rank")
    turn, at = F.floor((F.col("_rank") - head) / batches), (F.col("_rank") - head) % batches
    place = F.when(turn % 2 == 0, at).otherwise(batches - 1 - at)
    rest = ranked.filter(F.col("_rank") >= head).withColumn("_place", place).join(_each(df.sparkSession, order, "_place"), "_place")
    return ranked.filter(F.col("_rank") < head).join(fixed, "_rank").select(*df.columns, "batch").unionByName(rest.select(*df.columns, "batch"))


def head_plan(classes: list[tuple[int, float]], batches: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Where rows of ``classes`` (count, mean size; largest first) go, and the order of the batches after them, lightest
    first: each as runs (first rank or place, first batch, length).

    Batches of one load are a group, an interval of numbers. A class gives a row to each batch of the lightest group,
    then of the next; only the group that it runs out in is split, so there are as many groups as classes at most.
    """
    groups = [(0.0, 0, batches)]  # load, first batch, how many; lightest first
    placed, rank = [], 0
    for count, mean in classes:
        while count:
            load, first, many = groups.pop(0)
            taken = min(count, many)
            placed.append((rank, first, taken))
            if taken < many:
                groups.insert(0, (load, first + taken, many - taken))
            bisect.insort(groups, (load + mean, first, taken))
            rank, count = rank + taken, count - taken
    order, at = [], 0
    for _, first, many in groups:
        order.append((at, first, many))
        at += many
    return placed, order


def _each(spark: SparkSession, runs: list[tuple[int, int, int]], name: str) -> DataFrame:
    """(``name``, batch) for every place of ``runs``, made by Spark from a row for each piece of a run."""
    cut = [(at + k, first + k, min(PLANNED, many - k)) for at, first, many in runs for k in range(0, many, PLANNED)]
    pieces = spark.createDataFrame(cut, "at long, first long, many long")
    each = pieces.select("at", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("many") - 1)).alias("k"))
    return each.select((F.col("at") + F.col("k")).alias(name), (F.col("first") + F.col("k")).cast("int").alias("batch"))


def global_rank(df: DataFrame, order: list) -> DataFrame:
    """``df`` with ``_rank`` from 0 by range partitions: a rank within each and the number of rows before it.

    The ranges are written once with their numbers, so that rows are counted in the partitions they are ranked in.
    """
    ranged = _written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    inner = ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return inner.join(F.broadcast(before.drop("_size")), "_part").withColumn("_rank", F.col("_before") + F.col("_n") - 1).drop("_part", "_n", "_before")


def global_slice(df: DataFrame, order: list, offset: int, n: int | None) -> DataFrame:
    """``df`` from rank ``offset`` on, ``n`` rows or all, with ``_rank``. Of the range partitions, written to a folder each,
    only those that hold the slice are read again; what the driver sees is a count for each partition."""
    ranged = _written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "_part")
    sizes = sorted(map(tuple, ranged.groupBy("_part").agg(F.count(F.lit(1))).collect()))
    starts, before, end = [], 0, None if n is None else offset + n
    for part, size in sizes:
        if before + size > offset and (end is None or before < end):
            starts.append((part, before))
        before += size
    held = ranged.filter(F.col("_part").isin([p for p, _ in starts]))
    inner = held.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    ranked = inner.join(F.broadcast(df.sparkSession.createDataFrame(starts, "_part int, _before long")), "_part").withColumn("_rank", F.col("_before") + F.col("_n") - 1)
    return ranked.filter((F.col("_rank") >= offset) & (F.lit(True) if end is None else F.col("_rank") < end)).select(*[F.col(f"`{c}`") for c in df.columns], "_rank")


def _written(df: DataFrame, folders: str | None = None) -> DataFrame:
    """``df`` written to the folder that the cluster shares, below a folder for each value of ``folders``, and read back."""
    root = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not df.sparkSession.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the cluster shares")
        root = tempfile.mkdtemp(prefix="gridloom-")
    path = f"{root.rstrip('/')}/gridloom/ranged-{uuid.uuid4().hex}"
    (df.write.partitionBy(folders) if folders else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bin_progress(items: DataFrame) -> DataFrame:
    """(bins, bins_done, guids, guids_done) of rows (batch, guid, done)."""
    bins = items.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.bool_and("done").alias("done"))
    return bins.agg(F.count(F.lit(1)).alias("bins"), F.count_if("done").alias("bins_done"), F.sum("n").alias("guids"), F.sum(F.when(F.col("done"), F.col("n")).otherwise(0)).alias("guids_done"))


def shape_usage(profiles: DataFrame) -> DataFrame:
    """(shape_hash, sheets, hit_count): after its first sheet, each further sheet of a shape is a hit."""
    return profiles.groupBy("shape_hash").agg(F.count(F.lit(1)).alias("sheets"), (F.count(F.lit(1)) - 1).alias("hit_count"))


def shape_stats(shapes: DataFrame) -> DataFrame:
    return shapes.agg(F.count(F.lit(1)).alias("shapes"), F.sum("hit_count").alias("hits"), F.round(F.avg("hit_count"), 3).alias("mean_hits"), F.max("hit_count").alias("most_hits"))


def evict_shapes(shapes: DataFrame, most: int) -> DataFrame:
    """``shapes`` without the least used tenth (by hits, then age) where there are more than ``most``."""
    n = shapes.count()
    if n <= most:
        return shapes
    # Counts of hits are few, however many the shapes: their running total gives the count that the tenth ends in.
    running = Window.orderBy("hit_count").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = shapes.groupBy("hit_count").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(running))
    border = totals.filter(F.col("upto") >= max(1, n // 10)).orderBy("hit_count").select("hit_count", (F.col("upto") - F.col("n")).alias("below")).first()
    oldest = global_rank(shapes.filter(F.col("hit_count") == border["hit_count"]).select("schema_hash", "created_at"), [F.asc("created_at"), F.asc("schema_hash")])
    gone = oldest.filter(F.col("_rank") < max(1, n // 10) - border["below"]).select("schema_hash")
    return shapes.filter(F.col("hit_count") >= border["hit_count"]).join(gone, "schema_hash", "left_anti")


def throughput(batches: DataFrame) -> DataFrame:
    """Per source of rows (ts, source, batch_id, count, duration_sec): totals, the overall rate and the last batch."""
    out = batches.groupBy("source").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("count").alias("documents"),
        F.sum("duration_sec").alias("seconds"),
        F.max(F.struct("ts", "batch_id")).getField("batch_id").alias("last_batch"),
    )
    return out.withColumn("rate_per_sec", F.when(F.col("seconds") > 0, F.round(F.col("documents") / F.col("seconds"), 3)).otherwise(0.0))


def run_metrics(log: DataFrame, stages: list[str]) -> DataFrame:
    """A wide row for each run of a stage log (run_id, guid, source, stage, seconds, rows, ts)."""
    keys = ["run_id", "guid", "source"]
    wide = log.groupBy(*keys).pivot("stage", stages).agg(F.sum("seconds"))
    totals = log.groupBy(*keys).agg(F.sum("seconds").alias("total_seconds"), F.max("rows").alias("rows"), F.max("ts").alias("ts"))
    return wide.join(totals, keys)


def source_metrics(runs: DataFrame) -> DataFrame:
    out = runs.groupBy("source").agg(F.count(F.lit(1)).alias("runs"), F.sum("rows").alias("rows"), F.sum("total_seconds").alias("seconds"), F.max("ts").alias("last_run"))
    return out.withColumn("rows_per_sec", F.when(F.col("seconds") > 0, F.round(F.col("rows") / F.col("seconds"), 3)).otherwise(0.0))


def label_stats(labels: DataFrame, none: str = "NONE") -> DataFrame:
    return labels.agg(F.count(F.lit(1)).alias("labelled"), F.count_if(F.col("label").isNotNull() & (F.col("label") != none)).alias("with_pii"))

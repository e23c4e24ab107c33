"""Helpers that the operators of this subpackage share: the shared scratch folder, staged tables, hot-key joins."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: ASCII white space, as the contracts of exact and near dedup define it (fixed value).
ASCII_SPACE = r"[\x20\x09-\x0D]+"

_fallback: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the cluster shares, ``spark.checkpoint.dir``.

    Only where that setting is absent on a single machine (tests) a temporary folder takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _fallback.get("root")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the cluster shares")
        root = _fallback["root"] = tempfile.mkdtemp(prefix="gridloom-")
    return f"{root.rstrip('/')}/gridloom/{re.sub(r'[^a-z0-9_]', '_', name.lower())}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts lineage so that a lost executor costs a re-read and not a recomputation, and gives the optimizer
    true sizes.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column, ``doc``, beside which further columns may have any names."""
    return docs.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("doc"))


def unpacked(rows: DataFrame) -> DataFrame:
    """The columns that ``packed`` took in, as they were."""
    return rows.select("doc.*")


def numbered(rows: DataFrame, order: list[Column], rows_per_task: int = 500_000) -> DataFrame:
    """``rows`` with ``row``, their number from 0 in the given order, ties in any order that holds from then on.

    Rows are range-partitioned, by a tie-break too, so that equal ones spread over tasks; the number is the place in
    the partition behind the rows of earlier partitions, whose counts, one for each task, are broadcast.
    """
    held = staged(rows.withColumn("_tie", F.monotonically_increasing_id()), "rows_to_number")
    tasks = max(1, -(-held.count() // rows_per_task))
    dealt = held.repartitionByRange(tasks, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    placed = staged(dealt.withColumn("_at", F.monotonically_increasing_id()), "placed_rows")  # partition, then place in it
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = placed.withColumns({"_part": part, "row": place})
    return marked.join(F.broadcast(counts.select("_part", before.alias("_before"))), "_part").withColumn("row", F.col("_before") + F.col("row")).drop("_at", "_part", "_before")


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """``staged``, dealt out by ``key``, a column without hot values: later joins by it take the rows as they lie.

    Where the other side, made of few columns, carries the hint ``shuffle_hash``, the rows are not even sorted.
    """
    spark = df.sparkSession
    n, path, table = int(spark.conf.get("spark.sql.shuffle.partitions")), scratch(spark, name), f"{name}_{uuid.uuid4().hex}"
    df.repartition(n, key).write.format("parquet").option("path", path).bucketBy(n, key).saveAsTable(table)
    return spark.table(table)


def spread(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a staged table of few bytes that much is made of, over tasks of about ``rows`` rows each."""
    return df.repartition(max(1, -(-df.count() // rows)))


@contextmanager
def joins_within_partitions(spark: SparkSession):
    """Joins planned inside need no shuffle where both sides were repartitioned by some of the join's keys alike."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, most_hot: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with one row for each ``key`` in ``groups``; ``size`` counts the key's rows.

    A key with more than 1/``most_hot`` of all rows is hot. Fewer than ``most_hot`` keys can be, which bounds the
    broadcast that joins their rows without a shuffle; the rows of all other keys are joined by a shuffle in which
    no key holds more than that share.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    limit = max(100, total // most_hot)
    hot = groups.filter(F.col(size) > limit)
    marked = rows.join(F.broadcast(hot.select(F.col(key), F.lit(True).alias("_hot"))), key, "left")
    cold = marked.filter("_hot is null").drop("_hot").join(groups.filter(F.col(size) <= limit), key)
    return rows.join(F.broadcast(hot), key).unionByName(cold)

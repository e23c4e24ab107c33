"""Exact dedup on a persistent digest index, with DataFrame operations only.

The index is a table bucketed and sorted by digest. New documents are reduced to one row for each digest, checked
against the index by a sort-merge anti join (the index side needs no shuffle), and the digests that it lacks are
appended. Each append adds a file to every bucket, so the index side is sorted again once it has more than one.

Defined results: a null text counts as empty; texts are equal when identical after each run of ASCII white space
became one space; of equal texts the row with the smallest ``doc_id`` stays (a null id loses to any other); a row
repeated with the same id stays once, as far as ``first_of_group`` tells rows apart; an empty table gives an empty
result; columns other than id and text are not read, and ``first_of_group`` returns them unharmed, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ASCII_SPACE, join_groups, packed, scratch, staged, text_or_empty, unpacked


def digest_of(text: Column) -> Column:
    normal = F.regexp_replace(text_or_empty(text), ASCII_SPACE, " ")
    return F.unhex(F.sha2(normal.cast("binary"), 256))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest): SHA-256 of the normalised text, as 32 bytes."""
    return docs.select(F.col(id_col).alias("doc_id"), digest_of(F.col(text_col)).alias("digest"))


class DigestIndex:
    """A growing set of digests with the document that stands for each: (digest, keep_id)."""

    def __init__(self, spark: SparkSession, path: str | None = None, table: str | None = None, buckets: int = 64):
        """``path`` and ``table`` name an index to go on with, or a new one; give ``buckets`` so that a bucket's file
        fits a task (128 to 256 MB; 40 bytes a distinct text)."""
        self.spark, self.buckets = spark, buckets
        self.path = path or scratch(spark, "digest_index")
        self.table = table or f"digest_index_{uuid.uuid4().hex}"
        if not spark.catalog.tableExists(self.table):
            spark.sql(
                f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
            )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append_new(self, groups: DataFrame) -> DataFrame:
        """Append the digests of ``groups`` (digest, keep_id) that the index lacks and return them.

        The rows are staged between the anti join and the append: a retried append writes the same rows.
        """
        fresh = staged(
            groups.select("digest", "keep_id").repartition(self.buckets, "digest").hint("merge").join(self.read().select("digest").hint("merge"), "digest", "left_anti"),
            "fresh_digests",
        )
        (
            fresh.repartition(self.buckets, "digest")
            .write.mode("append").format("parquet").option("path", self.path)
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table)
        )
        return fresh


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, digest, keep_id, group_size (in ``docs``), known (the index had its text
    before this batch).

    Texts are read once; what is shuffled is 32-byte digests, counted before the shuffle. Rows of texts with very
    many copies are joined by a bounded broadcast (see ``join_groups``).
    """
    rows = staged(digests(docs, id_col, text_col), "digests")
    groups = staged(rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "digest_groups")
    fresh = index.append_new(groups)
    new = fresh.select("digest", F.lit(True).alias("_new"))
    held = groups.drop("keep_id").join(index.read(), "digest").join(new, "digest", "left")
    held = held.select("digest", "keep_id", "group_size", F.col("_new").isNull().alias("known"))
    return join_groups(rows, held, "digest", "group_size").select("doc_id", "digest", "keep_id", "group_size", "known")


def first_of_group(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: new texts only, one row for each.

    Whole rows are shuffled once, by (digest, id), which no group of copies makes uneven. The same partitioning
    serves to keep one of several rows that share both id and text.
    """
    key = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    stay = deduplicate(docs, index, id_col, text_col).filter(~F.col("known") & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    stay = stay.select("digest", key(F.col("doc_id")).alias("id")).distinct()
    marked = packed(docs).withColumns({"digest": digest_of(F.col("doc")[text_col]), "id": key(F.col("doc")[id_col])})
    return unpacked(marked.join(stay, ["digest", "id"], "left_semi").dropDuplicates(["digest", "id"]))

"""A table of rows by guid whose changes cost what they touch: hash buckets, replaced whole and published at once.

Rows lie in one file for each bucket below ``data/gen=<generation>/bucket=<number>``. A manifest names the generation of
every bucket; the newest manifest is the table. A change reads the buckets of its guids, writes their new rows as a new
generation and then the next manifest, one file that appears whole. Until it does, readers see the table as it was, and
what an interrupted change left behind is never read.

Buckets are Spark's own (``hash(guid) mod n``), so a join by guid, or an aggregate, takes the table's side as it lies:
without a shuffle. One writer at a time is assumed; readers may be many.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: (rows of the touched buckets, changes) to the rows that take their place.
Combine = Callable[[DataFrame, DataFrame], DataFrame]
_MANIFEST = "bucket int, gen string, buckets int, columns string"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, on any file system that Spark writes to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [f.getPath().getName() for f in target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)]


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


class BucketedTable:
    """The table at ``path``; ``buckets`` counts for a new one only. Choose it so that a bucket's file has some hundred MB."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.number, self.live, self.schema, self.known = -1, {}, None, -1
        self.refresh()

    def refresh(self) -> BucketedTable:
        """Take the newest manifest."""
        if exists(self.spark, f"{self.path}/manifests"):
            all_ = self.spark.read.schema(f"{_MANIFEST}, number long").parquet(f"{self.path}/manifests")
            newest = all_.agg(F.max("number")).first()[0]
            if newest is not None:
                rows = all_.filter(F.col("number") == newest).collect()  # a row for each bucket
                self.number, self.buckets, self.schema = newest, rows[0]["buckets"], T.StructType.fromJson(json.loads(rows[0]["columns"]))
                self.live = {r["bucket"]: r["gen"] for r in rows if r["gen"] is not None}
        return self

    def bucket(self) -> Column:
        """The number of the bucket that a row's guid falls in; the same that Spark's bucketed writer takes."""
        return F.pmod(F.hash("guid"), F.lit(self.buckets)).cast("int")

    @property
    def name(self) -> str:
        """The catalogue's name for the files; it tells Spark how they are bucketed, and is made where it is needed."""
        seen = f"{self.path} {self.buckets} {self.schema.json()}"
        return f"bucketed_{hashlib.sha256(seen.encode()).hexdigest()[:20]}"

    def _table(self) -> str:
        if not self.spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            self.spark.sql(
                f"CREATE TABLE {self.name} ({columns}, gen STRING, bucket INT) USING parquet PARTITIONED BY (gen, bucket) "
                f"CLUSTERED BY (guid) SORTED BY (guid) INTO {self.buckets} BUCKETS LOCATION '{self.path}/data'"
            )
            self.known = -1
        if self.known != self.number:  # folders that the catalogue has not seen: another session's, or another table's columns
            self.spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")
            self.known = self.number
        return self.name

    def read(self, guid: str | None = None) -> DataFrame:
        """All rows, or those of one guid, whose bucket alone is read."""
        if guid is None:
            return self._scan(self.live)
        wanted = self.spark.range(1).select(F.lit(guid).alias("guid")).select(self.bucket()).first()[0]
        return self._scan({b: g for b, g in self.live.items() if b == wanted}).filter(F.col("guid") == guid)

    def _scan(self, live: dict[int, str]) -> DataFrame:
        """The rows of ``live`` buckets. The condition is on folders' names: nothing else is opened."""
        if self.schema is None:
            raise ValueError(f"{self.path} has no table")
        by_gen: dict[str, list[int]] = {}
        for b, g in live.items():
            by_gen.setdefault(g, []).append(b)
        here = F.lit(False)
        for g, numbers in sorted(by_gen.items()):
            here = here | ((F.col("gen") == g) & F.col("bucket").isin(numbers))
        name = self._table()
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name).filter(here).select(*[F.col(f"`{f.name}`") for f in self.schema.fields])

    def write(self, rows: DataFrame) -> BucketedTable:
        """``rows`` as the whole table, in place of what it held."""
        self._publish(self._write(rows.repartition(self.buckets, "guid")), list(range(self.buckets)))
        return self

    def replace(self, changes: DataFrame, combine: Combine) -> None:
        """Change the buckets that ``changes`` (guid, ...) fall in. ``changes`` is read more than once; write it first
        where it is costly. Columns that ``combine`` adds become the table's; rows before have nulls there."""
        if self.schema is None:
            self.write(changes)
            return
        touched = [r[0] for r in changes.select(self.bucket()).distinct().collect()]  # as many as buckets at most
        old = self._scan({b: self.live[b] for b in touched if b in self.live})
        self._publish(self._write(combine(old, changes)), touched)

    def _write(self, rows: DataFrame) -> str:
        """A new generation, and the table's columns with those that ``rows`` adds."""
        known = self.schema.fieldNames() if self.schema else []
        fields = [*(self.schema.fields if self.schema else []), *[f for f in rows.schema.fields if f.name not in known]]
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
        gen = f"{self.number + 1:09d}-{uuid.uuid4().hex[:8]}"
        have = set(rows.columns)
        out = rows.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        out = out.withColumns({"gen": F.lit(gen), "bucket": self.bucket()})
        out.write.mode("append").format("parquet").partitionBy("gen", "bucket").bucketBy(self.buckets, "guid").sortBy("guid").saveAsTable(self._table())
        return gen

    def _publish(self, gen: str, touched: list[int]) -> None:
        live = {**self.live, **dict.fromkeys(touched, gen)}
        rows = [(b, live.get(b), self.buckets, self.schema.json()) for b in range(self.buckets)]
        # A folder of this number that is already there was never finished: the newest finished one is ours.
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifests/number={self.number + 1}")
        self.number, self.live = self.number + 1, live

    def vacuum(self, keep: int = 2) -> None:
        """Delete manifests but for the newest ``keep``, and the files that none of those names."""
        all_ = self.spark.read.schema(f"{_MANIFEST}, number long").parquet(f"{self.path}/manifests").filter(F.col("number") > self.number - keep)
        kept = {(r["gen"], r["bucket"]) for r in all_.select("gen", "bucket").distinct().collect()}
        data = f"{self.path}/data"
        for gen in [x for x in folders(self.spark, data) if x.startswith("gen=")]:
            there = folders(self.spark, f"{data}/{gen}")
            gone = [x for x in there if x.startswith("bucket=") and (gen[4:], int(x[7:])) not in kept]
            for x in [""] if len(gone) == len(there) else [f"/{x}" for x in gone]:
                remove(self.spark, f"{data}/{gen}{x}")
        for n in [r[0] for r in self.spark.read.schema(f"{_MANIFEST}, number long").parquet(f"{self.path}/manifests").filter(F.col("number") <= self.number - keep).select("number").distinct().collect()]:
            remove(self.spark, f"{self.path}/manifests/number={n}")

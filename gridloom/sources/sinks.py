"""Where results go. Every writer is safe to run again."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridloom.functions.text import sheet_slug
from gridloom.sources.bucketed import BucketedTable, exists, folders, remove
from gridloom.sources.files import ParquetFile

#: What the corpus table keeps of a row's errors.
MOST_ERRORS, ERROR_CHARS = 20, 1024


def write_extractions(rows: DataFrame, path: str, layout: str = "bucket", buckets: int = 64) -> None:
    """Parquet at a fixed place, so a re-run replaces a document's rows.

    ``per_guid`` has a folder for each document and suits small sets. ``bucket`` is a ``BucketedTable``: the buckets that
    ``rows`` touch are rewritten with the rows of their other documents and published together, and what they held before
    is deleted once it is two writes old. For a stream of small batches see ``write_batch``.
    """
    if layout == "per_guid":
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("guid").parquet(path)
        return
    spark, hold = rows.sparkSession, f"{path.rstrip('/')}/hold-{uuid.uuid4().hex}"
    rows.write.parquet(hold)  # the rows are made once
    table = BucketedTable(spark, path, buckets)
    table.replace(spark.read.schema(rows.schema).parquet(hold), lambda old, new: _instead(old, new, table.buckets))
    remove(spark, hold)
    table.vacuum()


def _instead(old: DataFrame, new: DataFrame, buckets: int) -> DataFrame:
    """``old`` with all rows of the guids in ``new`` replaced; only ``new`` is shuffled."""
    new = new.repartition(buckets, "guid")
    return old.join(new.select("guid").distinct(), "guid", "left_anti").unionByName(new, allowMissingColumns=True)


def read_extraction(spark: SparkSession, path: str, guid: str | None = None, sheet: int | None = None) -> DataFrame:
    """What ``write_extractions`` wrote; for one guid only its bucket is read."""
    if exists(spark, f"{path.rstrip('/')}/manifests"):
        rows = BucketedTable(spark, path).read(guid)
    else:
        rows = spark.read.parquet(path)
        rows = rows if guid is None else rows.filter(F.col("guid") == guid)
    return rows if sheet is None else rows.filter(F.col("sheet_index") == sheet)


def write_batch(rows: DataFrame, path: str, number: int) -> None:
    """One batch of a stream in a folder of its own: a repeated batch replaces itself, and no other is touched."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number:09d}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Of each guid the rows of the last batch that had it. The map of guids to batches reads one column."""
    rows = spark.read.parquet(path)
    last = rows.groupBy("guid").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["guid", "batch"], "left_semi").drop("batch")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.parquet(path).columns)
    except Exception as e:  # noqa: BLE001  Spark's error class tells the case apart
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise


def delete_document(spark: SparkSession, path: str, guid: str) -> None:
    """Publish the guid's bucket without it."""
    table = BucketedTable(spark, path)
    gone = spark.range(1).select(F.lit(guid).alias("guid"))
    table.replace(gone, lambda old, gone: old.join(F.broadcast(gone), "guid", "left_anti"))
    table.vacuum()


def ordered_columns(rows: DataFrame) -> DataFrame:
    """(guid, sheet_index, names): column names in order of their first appearance over all rows."""
    seen = rows.select("guid", "sheet_index", "row_number", F.posexplode("columns").alias("pos", "name"))
    first = seen.groupBy("guid", "sheet_index", "name").agg(F.min(F.struct("row_number", "pos")).alias("at"))
    return first.groupBy("guid", "sheet_index").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda x: x["name"]).alias("names"))


def write_wide_by_shape(rows: DataFrame, path: str, most_shapes: int | None = None) -> int:
    """One table for each set of column names, with the names as columns, all by one job; the number of shapes.

    Rows are range-partitioned by shape, and within a shape by document, so that a shape of many rows spreads over tasks
    and a task holds one open file whatever the number of shapes. Files appear under their names only when complete. All
    are below a folder of this run; when every task is done, the folders of earlier runs go. ``wide_shapes`` lists what
    was written. With ``most_shapes``, more of them are refused before anything is written.
    """
    spark, root = rows.sparkSession, path.rstrip("/")
    shaped = rows.join(ordered_columns(rows), ["guid", "sheet_index"]).withColumn("shape", F.substring(F.sha2(F.to_json("names"), 256), 1, 16))
    if most_shapes is not None and len(shaped.select("shape").distinct().limit(most_shapes + 1).collect()) > most_shapes:
        raise ValueError(f"more than {most_shapes} shapes: keep the long form")
    run = f"{root}/run={uuid.uuid4().hex}"
    values = F.transform("names", lambda n: F.try_element_at(F.col("data"), n))
    order = ["shape", "guid", "sheet_index", "row_number"]
    dealt = shaped.select(*order, "sheet_name", "valid", "names", values.alias("values")).repartitionByRange(*order).sortWithinPartitions(*order)
    written = dealt.mapInArrow(partial(_write_shapes, run), "shape string, names array<string>, path string, rows long")
    written.write.parquet(f"{root}/_shapes/{run.rpartition('=')[2]}")
    for name in folders(spark, root):
        if name.startswith("run=") and not run.endswith(name):
            remove(spark, f"{root}/{name}")
            remove(spark, f"{root}/_shapes/{name[4:]}")
    return wide_shapes(spark, path).count()


def _write_shapes(run: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Write runs of rows of one shape, each to a file with the shape's own columns, and list the files."""
    part = TaskContext.get().partitionId()
    kept = ["guid", "sheet_index", "sheet_name", "row_number", "valid"]
    now, out, listed = None, None, []

    def close() -> None:
        if now:
            out.__exit__(None, None, None)
            listed.append(now)

    try:
        for batch in batches:
            shapes = batch.column("shape").to_pylist()
            starts = [i for i, x in enumerate(shapes) if i == 0 or x != shapes[i - 1]]
            for a, b in zip(starts, [*starts[1:], len(shapes)]):
                if now is None or now["shape"] != shapes[a]:
                    close()
                    names = batch.column("names")[a].as_py()
                    now = {"shape": shapes[a], "names": names, "path": f"{run}/shape={shapes[a]}/part-{part:05d}.parquet", "rows": 0}
                    fields = [batch.schema.field(c) for c in kept] + [pa.field(_column_name(n), pa.string()) for n in names]
                    out = ParquetFile(now["path"], pa.schema(fields))
                    out.__enter__()
                cut = batch.slice(a, b - a)
                flat = cut.column("values").flatten()
                width = len(now["names"])
                cells = [flat.take(pa.array(range(i, len(flat), width))) for i in range(width)]
                out.write(pa.RecordBatch.from_arrays([*[cut.column(c) for c in kept], *cells], schema=out.schema))
                now["rows"] += b - a
        close()
    except BaseException as e:
        if out is not None:
            out.__exit__(type(e), e, None)
        raise
    yield pa.RecordBatch.from_pylist(listed, pa.schema([("shape", pa.string()), ("names", pa.list_(pa.string())), ("path", pa.string()), ("rows", pa.int64())]))


def wide_shapes(spark: SparkSession, path: str) -> DataFrame:
    """(shape, names, files, rows) of what ``write_wide_by_shape`` wrote."""
    listed = spark.read.schema("shape string, names array<string>, path string, rows long").option("recursiveFileLookup", True).parquet(f"{path.rstrip('/')}/_shapes")
    return listed.groupBy("shape").agg(F.first("names").alias("names"), F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))


def read_wide(spark: SparkSession, path: str, shape: str) -> DataFrame:
    """The table of one shape."""
    return spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/run=*/shape={shape}").drop("run", "shape")


def _column_name(name: str) -> str:
    return f"{name}_" if name.lower() in ("guid", "sheet_index", "sheet_name", "row_number", "valid") else name


def sheet_runs(rows: DataFrame) -> DataFrame:
    """``rows`` (guid, row_number, sheet_name) of foreign origin with ``run``: consecutive rows of one sheet name."""
    order = Window.partitionBy("guid").orderBy("row_number")
    new = F.when(F.lag("row_number").over(order).isNull() | ~F.col("sheet_name").eqNullSafe(F.lag("sheet_name").over(order)), 1).otherwise(0)
    return rows.withColumn("_new", new).withColumn("run", F.sum("_new").over(order) - 1).drop("_new")


def unique_slugs(sheets: DataFrame) -> DataFrame:
    """``sheets`` (guid, sheet_index, sheet_name) with ``slug``, the n-th of equals in a document as ``slug (n)``."""
    order = Window.partitionBy("guid", "_slug").orderBy("sheet_index")
    named = sheets.withColumn("_slug", sheet_slug(F.col("sheet_name"))).withColumn("_n", F.row_number().over(order))
    return named.withColumn("slug", F.when(F.col("_n") > 1, F.format_string("%s (%d)", "_slug", "_n")).otherwise(F.col("_slug"))).drop("_slug", "_n")


def coerce_output(rows: DataFrame) -> DataFrame:
    """Every cell a string (nested values as JSON), bookkeeping in its own types, unreadable numbers null."""
    out = []
    for f in rows.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in ("row_number", "extra_values"):
            c = c.try_cast("long")
        elif f.name == "valid":
            c = c.try_cast("boolean")
        elif f.name == "errors":
            c = c if isinstance(f.dataType, T.ArrayType) else F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.array(c.cast("string")))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(c)
        else:
            c = c.cast("string")
        out.append(c.alias(f.name))
    return rows.select(*out)


def manifest(rows: DataFrame, version: str, extracted_at: Column) -> DataFrame:
    """Provenance for each sheet: guid, sheet, version, time, rows, columns."""
    names = ordered_columns(rows).select("guid", "sheet_index", F.size("names").alias("column_count"))
    counts = rows.groupBy("guid", "sheet_index").agg(F.max("sheet_name").alias("sheet_name"), F.count(F.lit(1)).alias("row_count"))
    return counts.join(names, ["guid", "sheet_index"], "left").withColumns({"version": F.lit(version), "extracted_at": extracted_at})


def files_written(spark: SparkSession, path: str) -> DataFrame:
    """(files, bytes) of the Parquet files below a folder; their contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return found.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def write_summary(rows: DataFrame, docs: DataFrame, path: str | None = None) -> DataFrame:
    """(documents, empty_documents, sheets, rows), and with the ``path`` that was written to its files and bytes."""
    got = rows.groupBy("guid").agg(F.count_distinct("sheet_index").alias("s"), F.count(F.lit(1)).alias("r"))
    met = docs.select("guid").distinct().join(got, "guid", "left")
    files = [] if path is None else [F.lit(v).alias(k) for k, v in files_written(rows.sparkSession, path).first().asDict().items()]
    return met.agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("r").isNull()).alias("empty_documents"), F.coalesce(F.sum("s"), F.lit(0)).alias("sheets"), F.coalesce(F.sum("r"), F.lit(0)).alias("rows"), *files)


def write_ndjson(rows: DataFrame, path: str, source: str, run_id: str, extracted_at: Column) -> None:
    """One JSON line for each row below source=/dt=/run=, with guid and the time of extraction in UTC."""
    out = rows.withColumns({"EXTRACTED_AT": extracted_at, "source": F.lit(source), "dt": F.date_format(extracted_at, "yyyy-MM-dd"), "run": F.lit(run_id)})
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").partitionBy("source", "dt", "run").json(path)


def write_verdict_log(verdicts: DataFrame, path: str, source: str, run_id: str, at: Column) -> None:
    write_ndjson(verdicts, path, source, run_id, at)


def corpus_rows(rows: DataFrame, extracted_at: Column) -> DataFrame:
    """Rows of the corpus table: errors bounded in number and length, the number of columns, data as a map."""
    errors = F.slice(F.transform("errors", lambda e: F.substring(e, 1, ERROR_CHARS)), 1, MOST_ERRORS)
    return rows.select("guid", "row_number", "valid", errors.alias("errors"), F.size(F.map_keys("data")).alias("column_count"), "data", extracted_at.alias("extracted_at"), F.date_format(extracted_at, "yyyy-MM-dd").alias("dt"))


def append_corpus(rows: DataFrame, path: str, extracted_at: Column) -> None:
    corpus_rows(rows, extracted_at).write.mode("append").partitionBy("dt").parquet(path)


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with every field of ``schema`` (null where it had none), its own further columns after them."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields], *[c for c in df.columns if c not in schema.fieldNames()])


def record_sheets(ledger: DataFrame, sheets: DataFrame) -> DataFrame:
    """The ledger with all rows of the documents in ``sheets`` replaced by theirs."""
    kept = ledger.join(sheets.select("guid").distinct(), "guid", "left_anti")
    return kept.unionByName(sheets, allowMissingColumns=True)


def keep_ledger(table: BucketedTable, sheets: DataFrame) -> None:
    """``record_sheets`` on a table that is kept: only the buckets of the documents in ``sheets`` are read and replaced."""
    table.replace(sheets, lambda ledger, new: _instead(ledger, new, table.buckets))


def audit_export(audited: DataFrame) -> DataFrame:
    """Flat rows for analysts: of each stage's issues the first two."""
    return audited.select("guid", "stage", "passed", F.array_join(F.slice("issues", 1, 2), "; ").alias("issues"))


def export_audit(audited: DataFrame, path: str) -> None:
    audit_export(audited).write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    audited.write.mode("overwrite").json(f"{path}/json")

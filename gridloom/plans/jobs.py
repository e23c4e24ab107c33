"""Whole jobs, composed of the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.pii import pii_flags, pii_score, pii_signals, population_status, refined_flags
from gridloom.functions.text import format_hint
from gridloom.operators.batching import balanced_batches
from gridloom.operators.evaluate import document_outcome, evaluate, sheet_detail
from gridloom.operators.extract import Parsers, data_cells, extract_with, kept_counts, kept_rows, sheet_rows, source_counts
from gridloom.operators.layout import find_header, profile_sheets, with_spec
from gridloom.operators.schema_map import label_columns, map_to_schema
from gridloom.operators.sheets import head_tail, reject_empty, split_sheets
from gridloom.operators.status import backlog, fetch_bodies, gate_document_type, merge_population, status_counts, with_title
from gridloom.sources.bucketed import exists, remove
from gridloom.sources.readers import scan_population, spread


def scored(docs: DataFrame, text: str = "body_text", flags: Callable[[Column], Column] = pii_flags) -> DataFrame:
    """``docs`` with pii_score, pii_signals and status. The nine tests run once, in a projection of their own."""
    flagged = spread(docs).withColumn("_flags", flags(F.coalesce(F.col(text), F.lit(""))))
    return flagged.withColumns({"pii_score": pii_score(F.col("_flags")), "pii_signals": pii_signals(F.col("_flags")), "status": population_status(pii_score(F.col("_flags")))}).drop("_flags")


def select_population(source: DataFrame, status: DataFrame, category: str | None = None, flags: Callable[[Column], Column] = pii_flags) -> tuple[DataFrame, DataFrame]:
    """The status table with newly scored documents merged in, and its counts."""
    found = scored(with_title(scan_population(source, category)), flags=flags)
    merged = merge_population(status, found)
    return merged, status_counts(merged)


def gate_no_pii(docs: DataFrame, text: str = "body_text", keep: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(passed, rejected with NO_PII_SIGNAL) by the precise checks. Each side runs them unless ``keep``, a new folder that
    the cluster shares, may hold the scored documents."""
    flagged = spread(docs).withColumn("_score", pii_score(refined_flags(F.coalesce(F.col(text), F.lit("")))))
    if keep:
        flagged.write.parquet(keep)  # the patterns run once for both sides
        flagged = docs.sparkSession.read.parquet(keep)
    return flagged.filter("_score > 0").drop("_score"), flagged.filter("_score = 0").drop("_score").withColumn("rejection_code", F.lit("NO_PII_SIGNAL"))


def look(docs: DataFrame, specs: DataFrame | None = None) -> DataFrame:
    """Layout reports for every sheet of the documents, detected or as a spec table says."""
    found = profile_sheets(split_sheets(spread(docs)))
    return found if specs is None else with_spec(found, specs)


def inspect(docs: DataFrame) -> DataFrame:
    """(guid, sheet_index, sheet_name, format_hint, header_guess, sampled): what a slice of each sheet shows."""
    sliced = head_tail(reject_empty(split_sheets(spread(docs))).filter("rejection_code is null"))
    lines = F.transform("sample", lambda x: x["record"])
    return sliced.select("guid", "sheet_index", "sheet_name", format_hint(lines).alias("format_hint"), find_header(lines).alias("header_guess"), F.size("sample").alias("sampled"))


@dataclass
class Extraction:
    rows: DataFrame
    profiles: DataFrame
    verdicts: DataFrame
    ledger: DataFrame
    documents: DataFrame


def extract(docs: DataFrame, specs: DataFrame | None = None, parsers: Parsers | None = None, keep: str | None = None) -> Extraction:
    """Documents to rows, a verdict and ledger entry for each sheet, and an outcome for each document.

    Rows and verdicts are lazy, and each of them reads the documents. With ``keep``, a new folder that the cluster
    shares, split and profiled sheets are written there once and all results start from them.
    """
    profiles = look(docs, specs)
    if keep:
        profiles.write.parquet(keep)
        profiles = docs.sparkSession.read.parquet(keep)
    own = F.coalesce(F.col("shape_hash").isin(*parsers.by_shape), F.lit(False)) if parsers and parsers.by_shape else F.lit(False)
    tagged = sheet_rows(profiles.filter(~own))
    rows, counts = kept_rows(tagged), kept_counts(tagged)
    if parsers and parsers.by_shape:
        cells = data_cells(profiles.filter(own))
        rows = extract_with(cells.join(profiles.select("guid", "sheet_index", "shape_hash"), ["guid", "sheet_index"]), parsers).unionByName(rows)
        counts = counts.unionByName(source_counts(cells))
    verdicts = evaluate(rows, counts, profiles.filter("rejection_code is null"))
    ledger = sheet_ledger(profiles, verdicts)
    return Extraction(rows, profiles, verdicts, ledger, document_outcome(ledger))


def sheet_ledger(profiles: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(guid, sheet_index, sheet_name, status, rejection_code, failure_reason, rows_extracted): rejected is not failed."""
    met = profiles.select("guid", "sheet_index", "sheet_name", "rejection_code").join(verdicts.select("guid", "sheet_index", "passed", "failure_reason", "records_returned"), ["guid", "sheet_index"], "left")
    status = F.when(F.col("rejection_code").isNotNull(), "rejected").when(F.col("passed"), "passed").otherwise("failed")
    return met.select("guid", "sheet_index", "sheet_name", status.alias("status"), "rejection_code", "failure_reason", F.coalesce("records_returned", F.lit(0)).alias("rows_extracted"))


def sheet_pii(docs: DataFrame) -> DataFrame:
    """(guid, sheet_index, pii_score, pii_signals) of each sheet's records, whatever became of the sheet."""
    sheets = split_sheets(spread(docs)).withColumn("_flags", refined_flags(F.array_join("records", "\n\n")))
    return sheets.select("guid", "sheet_index", pii_score(F.col("_flags")).alias("pii_score"), pii_signals(F.col("_flags")).alias("pii_signals"))


def corpus_run(source: DataFrame, verdicts: DataFrame, labels: DataFrame, target: int = 500, keep: str | None = None) -> tuple[DataFrame, Extraction, DataFrame]:
    """(batches of the backlog, extraction of what passes both gates, outcomes of rejected documents too)."""
    todo = balanced_batches(backlog(source, verdicts, ["pending"]), "body_length", target)
    bodies = fetch_bodies(source, todo)
    passed, no_pii = gate_no_pii(bodies, keep=f"{keep.rstrip('/')}/scored" if keep else None)
    passed, skipped = gate_document_type(passed, labels)
    done = extract(passed, keep=f"{keep.rstrip('/')}/profiles" if keep else None)
    rejected = no_pii.select("guid", "rejection_code").unionByName(skipped.select("guid", "rejection_code")).select("guid", F.lit("error_rejected").alias("outcome"), F.col("rejection_code").alias("reason"))
    return todo, done, done.documents.select("guid", "outcome", "reason").unionByName(rejected)


def run_in_bins(source: DataFrame, verdicts: DataFrame, labels: DataFrame, root: str, target: int = 1_000_000, at_once: int = 0) -> DataFrame:
    """``corpus_run`` bin by bin below ``root``, a folder that the cluster shares; what ``bins`` says of it in the end.

    The bins of the backlog are written once, so a run that is started again goes on with those of the first. A bin's
    rows and outcomes go to its own folders and its entry in ``progress`` comes last: a bin that was cut off is done again
    from the start and replaces itself, a finished one is never touched. Choose ``target`` documents so that a bin keeps
    the cluster busy for some minutes. Of smaller bins as many run together as hold ``at_once`` documents, one at least:
    a round has its jobs once and reads ``source`` once, whatever the number of its bins.
    """
    spark, root = source.sparkSession, root.rstrip("/")
    if not exists(spark, f"{root}/plan/_SUCCESS"):
        balanced_batches(backlog(source, verdicts, ["pending"]), "body_length", target).write.mode("overwrite").parquet(f"{root}/plan")
    plan = spark.read.parquet(f"{root}/plan")
    done = {r[0] for r in bins(spark, root).select("batch").collect()}
    held, size = [], 0
    for n, documents in sorted(tuple(r) for r in plan.groupBy("batch").count().collect()):  # a row for each bin
        if n in done:
            continue
        if held and size + documents > at_once:
            _run_bins(source, labels, plan, root, held)
            held, size = [], 0
        held, size = [*held, n], size + documents
    if held:
        _run_bins(source, labels, plan, root, held)
    return bins(spark, root)


def _run_bins(source: DataFrame, labels: DataFrame, plan: DataFrame, root: str, numbers: list[int]) -> None:
    spark, work = source.sparkSession, f"{root}/work/{numbers[0]}-{uuid.uuid4().hex}"
    open_bins = F.broadcast(spark.createDataFrame([(n,) for n in numbers], "batch int"))
    guids = plan.join(open_bins, "batch", "left_semi")
    passed, no_pii = gate_no_pii(fetch_bodies(source, guids), keep=f"{work}/scored")
    passed, skipped = gate_document_type(passed, labels)
    done = extract(passed, keep=f"{work}/profiles")
    rejected = no_pii.select("guid", "rejection_code").unionByName(skipped.select("guid", "rejection_code"))
    outcomes = done.documents.select("guid", "outcome", "reason").unionByName(rejected.select("guid", F.lit("error_rejected").alias("outcome"), F.col("rejection_code").alias("reason")))
    _replace(done.rows, guids, f"{root}/rows", numbers)
    _replace(outcomes, guids, f"{root}/outcomes", numbers)
    written = spark.read.parquet(f"{root}/outcomes").join(open_bins, "batch", "left_semi")
    counts = written.groupBy("batch").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("outcome") == "complete").alias("complete"))
    spark.createDataFrame([(n,) for n in numbers], "batch int").join(counts, "batch", "left").fillna(0).coalesce(1).write.mode("append").partitionBy("batch").parquet(f"{root}/progress")
    remove(spark, work)


def _replace(df: DataFrame, guids: DataFrame, path: str, numbers: list[int]) -> None:
    """Write ``df`` to the folders of its guids' bins, in one job, in place of what a run that was cut off left there."""
    spark = df.sparkSession
    if len(numbers) == 1:
        df.write.mode("overwrite").parquet(f"{path}/batch={numbers[0]}")
        return
    for n in numbers:
        remove(spark, f"{path}/batch={n}")
    spark.createDataFrame([], df.schema).write.parquet(f"{path}/batch={numbers[0]}")  # no bin may have rows; this one has columns
    parts = F.pmod(F.xxhash64("guid"), F.lit(max(1, 2 * spark.sparkContext.defaultParallelism // len(numbers))))
    dealt = df.join(guids.select("guid", "batch").distinct(), "guid").select(*df.columns, "batch").repartition("batch", parts)
    dealt.write.mode("append").partitionBy("batch").parquet(path)


def bins(spark: SparkSession, root: str) -> DataFrame:
    """(batch, documents, complete) of the finished bins of ``run_in_bins``."""
    if not exists(spark, f"{root}/progress"):
        return spark.createDataFrame([], "batch int, documents long, complete long")
    return spark.read.schema("documents long, complete long, batch int").parquet(f"{root}/progress").filter("documents is not null").select("batch", "documents", "complete")


def binned(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The ``rows`` or ``outcomes`` of the finished bins."""
    return spark.read.parquet(f"{root}/{name}").join(F.broadcast(bins(spark, root).select("batch")), "batch", "left_semi")


def map_extraction(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """An extraction under canonical field names."""
    columns = rows.select("guid", "sheet_index", F.posexplode("columns").alias("position", "column_name")).groupBy("guid", "sheet_index", "column_name").agg(F.min("position").alias("position"))
    return map_to_schema(rows, label_columns(columns, labels))


def detail(ledger: DataFrame) -> DataFrame:
    return sheet_detail(ledger)


def flatten_table(df: DataFrame, guid: Column, sheet: Column, order: Column, columns: list[str], delimiter: str = ",") -> DataFrame:
    """(guid, title, body_text, body_length): tables as flattened workbooks, a sheet for each value of ``sheet``. The
    inverse of extraction; cells that hold the delimiter or a quote are quoted."""
    from gridloom.functions.text import ROW_SEPARATOR, SHEET_MARKER

    cell = lambda c: F.when(F.contains(c, F.lit(delimiter)) | F.contains(c, F.lit('"')), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    line = F.array_join(F.array(*[cell(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]), delimiter)
    rows = df.select(guid.alias("guid"), sheet.alias("_sheet"), order.alias("_order"), line.alias("_line"))
    sheets = rows.groupBy("guid", "_sheet").agg(F.transform(F.array_sort(F.collect_list(F.struct("_order", "_line"))), lambda x: x["_line"]).alias("_lines"))
    text = F.array_join(F.concat(F.array(F.concat(F.col("_sheet"), F.lit(SHEET_MARKER)), F.lit(delimiter.join(columns))), F.col("_lines")), ROW_SEPARATOR)
    docs = sheets.groupBy("guid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_sheet", text.alias("t")))), lambda x: x["t"]), ROW_SEPARATOR).alias("body_text"))
    return docs.withColumn("title", F.col("guid")).withColumn("body_length", F.octet_length("body_text").cast("long"))

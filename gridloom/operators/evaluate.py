"""Verdicts on extractions: per sheet, per document, per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Shares that a sheet must reach, and how often a sheet may be tried.
MIN_SHARE, MOST_TRIES = 0.9, 2
#: Shares of a table's rows for the older threshold verdict.
SUCCESS, FAILURE = 0.95, 0.70
STEPS = {"fetch_and_sample": "look", "structural_inspector": "look", "generate_parser_script": "think", "sandbox_execute": "test", "evaluate_extraction": "eval"}


def _percent(share: Column) -> Column:
    return F.concat(F.format_string("%.0f", share * 100), F.lit("%"))


def evaluate(rows: DataFrame, counts: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row for each profiled sheet with the evidence, ``passed`` and ``failure_reason``.

    ``rows`` is an extraction, ``counts`` has source_rows and skipped_wrong_shape. In order: rows came back at all,
    enough of them valid, enough columns delivered, enough of the source covered.
    """
    keys = ["guid", "sheet_index"]
    fault = F.when(~F.col("valid") & (F.size("errors") > 0), F.struct("row_number", "errors"))
    got = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("records_returned"), F.count_if("valid").alias("records_valid"), F.min(fault).getField("errors").alias("sample_errors"))
    # The widest of the first twenty rows stands for what was delivered; ranks are pruned before the shuffle.
    order = Window.partitionBy(*keys).orderBy("row_number")
    head = rows.select(*keys, "row_number", F.size("columns").alias("n")).withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= 20)
    widest = head.groupBy(*keys).agg(F.max("n").alias("widest"))
    out = profiles.select(*keys, "modal_field_count", F.size("header_names").alias("header_declares")).join(counts, keys, "left").join(got, keys, "left").join(widest, keys, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    n, source, wanted = zero("records_returned"), zero("source_rows"), zero("modal_field_count")
    present = zero("widest")
    share = F.when(n > 0, zero("records_valid") / n).otherwise(0.0)
    coverage = F.when(source > 0, n / source).otherwise(0.0)
    errors = F.slice(F.coalesce("sample_errors", F.array().cast("array<string>")), 1, 5)
    reason = (
        F.when((source > 0) & (n == 0), F.format_string("Read %d rows from the source and returned none", source))
        .when(n == 0, "The document held no data rows to extract")
        .when(
            share < MIN_SHARE,
            F.concat(
                F.format_string("Only %d/%d returned rows parsed cleanly (", zero("records_valid"), n), _percent(share), F.lit(f", needs {MIN_SHARE:.0%}). Errors: "),
                F.coalesce(F.nullif(F.array_join(F.transform(F.slice(errors, 1, 2), lambda e: F.substring(e, 1, 80)), "; "), F.lit("")), F.lit("none recorded")),
            ),
        )
        .when((wanted > 0) & (present < wanted * MIN_SHARE), F.format_string("Returned %d columns where %d were specified", present, wanted))
        .when((source > 0) & (coverage < MIN_SHARE), F.concat(F.format_string("Returned %d records from %d source rows (", n, source), _percent(coverage), F.lit(f", needs {MIN_SHARE:.0%})")))
    )
    return out.select(
        *keys, source.alias("source_rows_read"), n.alias("records_returned"), zero("records_valid").alias("records_valid"), F.round(share, 3).alias("valid_row_share"), F.round(coverage, 3).alias("source_coverage"),
        wanted.alias("columns_expected"), present.alias("columns_present"), F.when(wanted > 0, F.round(present / wanted, 3)).alias("column_delivery"), "header_declares",
        zero("skipped_wrong_shape").alias("rows_skipped_wrong_shape"), errors.alias("sample_errors"), reason.isNull().alias("passed"), reason.alias("failure_reason"),
    )


def should_retry(passed: Column, attempt: Column, most: int = MOST_TRIES) -> Column:
    return ~passed & (attempt < most)


def quality_metrics(rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """(guid, sheet_index, total, valid, success_rate, completeness, empty_columns (first ten), empty_column_count,
    sample_errors (first ten)): how full the declared columns are."""
    keys = ["guid", "sheet_index"]
    met = rows.join(profiles.select(*keys, "header_names"), keys)
    filled = F.size(F.filter("header_names", lambda c: F.coalesce(F.try_element_at(F.col("data"), c), F.lit("")) != ""))
    per_row = met.withColumn("_full", F.when(F.size("header_names") > 0, filled / F.size("header_names")).otherwise(0.0))
    base = per_row.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.count_if("valid").alias("valid"), F.round(F.avg("_full"), 3).alias("completeness"))
    cells = met.select(*keys, F.posexplode("header_names").alias("at", "name"), "data")
    empty = cells.groupBy(*keys, "at", "name").agg(F.count_if(F.coalesce(F.try_element_at(F.col("data"), F.col("name")), F.lit("")) != "").alias("n")).filter("n = 0")
    empty = empty.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda x: x["name"]).alias("_empty"))
    faults = rows.filter(~F.col("valid")).groupBy(*keys).agg(F.min(F.struct("row_number", "errors")).getField("errors").alias("_errors"))
    out = base.join(empty, keys, "left").join(faults, keys, "left")
    none = F.array().cast("array<string>")
    return out.select(
        *keys, "total", "valid", F.round(F.col("valid") / F.col("total"), 3).alias("success_rate"), "completeness",
        F.slice(F.coalesce("_empty", none), 1, 10).alias("empty_columns"), F.greatest(F.size("_empty"), F.lit(0)).alias("empty_column_count"), F.slice(F.coalesce("_errors", none), 1, 10).alias("sample_errors"),
    )


def judge(metrics: DataFrame, attempt: Column, most: int = 3) -> DataFrame:
    """``metrics`` with verdict (success, partial, failure, no_records) and route (write, reprocess, abandon)."""
    verdict = F.when(F.coalesce("total", F.lit(0)) == 0, "no_records").when(F.col("success_rate") >= SUCCESS, "success").when(F.col("success_rate") <= FAILURE, "failure").otherwise("partial")
    out = metrics.withColumn("verdict", verdict)
    return out.withColumn("route", F.when(F.col("verdict") == "success", "write").when(attempt < most, "reprocess").otherwise("abandon"))


def failure_feedback(metrics: DataFrame) -> DataFrame:
    """``metrics`` with a sentence on what to do better."""
    parts = F.array_compact(
        F.array(
            F.format_string("Success rate was %.0f%%.", F.col("success_rate") * 100),
            F.when(F.size("empty_columns") > 0, F.concat(F.lit("Columns never filled: "), F.array_join(F.slice("empty_columns", 1, 10), ", "), F.lit("."))),
            F.when(F.size("sample_errors") > 0, F.concat(F.lit("Errors: "), F.array_join(F.slice("sample_errors", 1, 3), "; "), F.lit("."))),
        )
    )
    return metrics.withColumn("feedback", F.array_join(parts, " "))


def document_outcome(sheets: DataFrame) -> DataFrame:
    """(guid, outcome, reason, sheets, passed, rejected) from a sheet ledger (guid, sheet_index, sheet_name, status, ...).

    One passing sheet completes a document; all rejected reject it with the first sheet's code; else the first failed
    sheet's reason stands.
    """
    failed = F.col("status") == "failed"
    out = sheets.groupBy("guid").agg(
        F.count(F.lit(1)).alias("sheets"),
        F.count_if(F.col("status") == "passed").alias("passed"),
        F.count_if(F.col("status") == "rejected").alias("rejected"),
        F.min_by("rejection_code", "sheet_index").alias("_code"),
        F.min(F.when(failed, F.struct("sheet_index", "failure_reason"))).getField("failure_reason").alias("_reason"),
    )
    outcome = F.when(F.col("passed") > 0, "complete").when(F.col("rejected") == F.col("sheets"), "error_rejected").otherwise("error_extraction")
    return out.select("guid", outcome.alias("outcome"), F.when(F.col("passed") > 0, None).when(F.col("rejected") == F.col("sheets"), F.col("_code")).otherwise(F.col("_reason")).alias("reason"), "sheets", "passed", "rejected")


def sheet_detail(sheets: DataFrame) -> DataFrame:
    """(guid, detail): ``passed/total sheets`` and the first three that did not pass."""
    bad = F.when(F.col("status") != "passed", F.struct("sheet_index", F.concat(F.coalesce("sheet_name", F.lit("unnamed")), F.lit(": "), F.coalesce("rejection_code", "failure_reason", F.lit("unknown"))).alias("t")))
    out = sheets.groupBy("guid").agg(F.count_if(F.col("status") == "passed").alias("p"), F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(bad)).alias("bad"))
    names = F.array_join(F.transform(F.slice("bad", 1, 3), lambda x: x["t"]), "; ")
    return out.select("guid", F.concat(F.format_string("%d/%d sheets passed", "p", "n"), F.when(F.size("bad") > 0, F.concat(F.lit("; "), names)).otherwise("")).alias("detail"))


def stage_failed(log: DataFrame) -> DataFrame:
    """(guid, sheet_index, stage_failed): the step of the last stage in a log (guid, sheet_index, seq, stage)."""
    names = F.create_map(*[F.lit(x) for pair in STEPS.items() for x in pair])
    last = log.groupBy("guid", "sheet_index").agg(F.max_by("stage", "seq").alias("stage"))
    return last.select("guid", "sheet_index", F.coalesce(F.try_element_at(names, F.col("stage")), F.col("stage")).alias("stage_failed"))


def batch_summary(outcomes: DataFrame) -> DataFrame:
    """(batch_id, passing, empty, failed per kind, alert): an alert holds the distinct reasons where nothing passed."""
    out = outcomes.groupBy("batch_id").agg(
        F.count_if(F.col("outcome") == "complete").alias("passing"),
        F.count_if((F.col("outcome") == "complete") & (F.col("rows") == 0)).alias("empty"),
        F.count_if(F.col("outcome") == "error_rejected").alias("rejected"),
        F.count_if(F.col("outcome") == "error_extraction").alias("extraction_failed"),
        F.count_if(F.col("outcome") == "error_pipeline").alias("pipeline_failed"),
        F.array_sort(F.collect_set("reason")).alias("_reasons"),
    )
    return out.withColumn("alert", F.when(F.col("passing") == 0, F.array_join("_reasons", "; "))).drop("_reasons")


def audit_issues(stages: DataFrame) -> DataFrame:
    """``stages`` (guid, stage, status, format, sample_records, rows, success_rate) with ``issues`` and ``passed``."""
    rate = F.col("success_rate")
    issues = F.array_compact(
        F.array(
            F.when(~F.col("status").eqNullSafe("success"), F.concat(F.lit("status: "), F.coalesce("status", F.lit("missing")))),
            F.when(F.col("format").eqNullSafe("unknown"), "format: unknown"),
            F.when(F.col("sample_records") < 2, F.format_string("sample: only %d records", "sample_records")),
            F.when(F.col("rows") == 0, "rows: none extracted"),
            F.when((rate < 0) | (rate > 1), "success_rate: out of range").when(rate < 0.7, F.format_string("success_rate: %.2f", rate)),
        )
    )
    return stages.withColumn("issues", issues).withColumn("passed", F.size("issues") == 0)


def audit_summary(audited: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pass rate of each stage, and the ten most frequent kinds of issue."""
    rates = audited.groupBy("stage").agg(F.count(F.lit(1)).alias("documents"), F.count_if("passed").alias("passed"), F.round(F.avg(F.col("passed").cast("int")), 3).alias("pass_rate"))
    kinds = audited.select("stage", F.explode("issues").alias("issue")).groupBy(F.get(F.split("issue", ":"), F.lit(0)).alias("kind")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "kind").limit(10)
    return rates, kinds


def conformance(rows: DataFrame, required: list[str]) -> DataFrame:
    """(total, passed, pass_rate, missing): rows with every required field non-null; fields that some row lacks."""
    need = F.array(*[F.lit(r) for r in required])
    lacking = F.filter(need, lambda r: F.coalesce(F.try_element_at(F.col("data"), r), F.lit("")) == "")
    out = rows.select(lacking.alias("_l"))
    return out.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.size("_l") == 0).alias("passed"), F.round(F.avg((F.size("_l") == 0).cast("int")), 3).alias("pass_rate"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("_l")))).alias("missing"))

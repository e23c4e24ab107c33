"""Further registered queries: operators that work on tables written on the way, specs, user parsers, verdict streams."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import pii, text
from gridloom.functions.text import SHEET_MARKER
from gridloom.operators import evaluate, extract, layout, schema_map, sheets, status
from gridloom.plans import jobs
from gridloom.queries import FLAG_SQL, LEDGER, SCORE_SQL, STATUS, _ledger, _shared, long_rows, query, source_docs, status_table, table, verdict_table, workbooks
from gridloom.sources import ranges, readers, sinks
from gridloom.sources.bucketed import BucketedTable
from gridloom.streaming import drain

# ---- sources and sinks -----------------------------------------------------------------------------------------------


@query("SELECT CAST(doc_id AS VARCHAR) AS guid, strlen(text) AS body_length, sha256(text) AS sha FROM documents")
def column_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = readers.documents_from_column(table(spark, sf_dir, "documents"), "doc_id", "text")
    return d.select("guid", "body_length", F.sha2("body_text", 256).alias("sha"))


@query("SELECT p_partkey AS key, strlen(p_name) + 1 AS body_length FROM part")
def file_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files, one for each brand of parts, read back whole and split into their lines again."""
    home = f"{_shared(spark)}/files"
    parts = table(spark, sf_dir, "part").select(F.concat_ws(":", "p_partkey", "p_name").alias("value"), "p_brand")
    parts.repartition("p_brand").write.partitionBy("p_brand").text(home)
    docs = readers.read_text_documents(spark, f"{home}/*/*.txt")
    lines = docs.select(F.explode(F.split("body_text", "\n")).alias("line")).filter("line <> ''")
    key = F.substring_index("line", ":", 1)
    return lines.select(key.cast("int").alias("key"), (F.octet_length("line") - F.octet_length(key)).cast("long").alias("body_length"))


@query("""
    SELECT CAST(c_nationkey AS VARCHAR) AS guid, 'nation ' || CAST(c_nationkey AS VARCHAR) AS sheet_name, CAST(count(*) AS BIGINT) AS records, CAST(sum(c_custkey) AS BIGINT) AS keys, CAST(0 AS BIGINT) AS first_line, CAST(count(*) - 1 AS BIGINT) AS last_line
    FROM customer GROUP BY c_nationkey
""")
def ranged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A workbook file for each nation, growing with the table, read by byte ranges and grouped into its sheet again."""
    home = f"{_shared(spark)}/books"
    c = table(spark, sf_dir, "customer")
    rows = c.select("c_nationkey", F.col("c_custkey").alias("at"), F.concat_ws(",", "c_custkey", "c_name").alias("row"))
    heads = c.select("c_nationkey").distinct().select("c_nationkey", F.lit(-1).cast("long").alias("at"), F.concat(F.lit("nation "), F.col("c_nationkey").cast("string"), F.lit(SHEET_MARKER)).alias("row"))
    lines = rows.withColumn("at", F.col("at").cast("long")).unionByName(heads).repartition("c_nationkey").sortWithinPartitions("c_nationkey", "at")
    lines.select("c_nationkey", F.concat("row", F.lit("\n")).alias("value")).write.partitionBy("c_nationkey").text(home)
    found = ranges.records_of_files(spark, f"{home}/*/*.txt")
    guid = F.regexp_extract("guid", r"c_nationkey=(-?\d+)", 1)
    key = F.substring_index("record", ",", 1).cast("long")
    return found.groupBy(guid.alias("guid"), "sheet_name").agg(F.count(F.lit(1)).alias("records"), F.sum(key).alias("keys"), F.min("line").alias("first_line"), F.max("line").alias("last_line"))


@query(STATUS + "SELECT guid, 'pending' AS status, 'v9' AS extraction_version, 'intake' AS source, body_length FROM status")
def populated_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.populate_status(status_table(spark, sf_dir), "intake", "v9").select("guid", "status", "extraction_version", "source", "body_length")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS guid, o_orderpriority AS source, CAST(o_orderkey AS BIGINT) AS rows, o_orderstatus = 'F' AS success FROM orders WHERE o_orderpriority = '1-URGENT'")
def metrics_of_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run metrics written as CSV and read back for one source."""
    path = f"{_shared(spark)}/metrics"
    o = table(spark, sf_dir, "orders")
    log = o.select(
        F.col("o_orderdate").cast("timestamp").alias("ts"), F.col("o_orderkey").cast("string").alias("guid"), F.col("o_orderpriority").alias("source"), F.lit(1).alias("batch_id"), F.lit("write").alias("stage"),
        F.lit(0.5).alias("seconds"), F.col("o_orderkey").cast("long").alias("rows"), (F.col("o_orderstatus") == "F").alias("success"),
    )
    log.write.option("header", True).csv(path)
    return readers.read_metrics(spark, path, "1-URGENT").select("guid", "source", "rows", "success")


@query("SELECT CAST(c_nationkey AS VARCHAR) AS guid, CAST(c_custkey AS BIGINT) AS row_number, c_name AS name FROM customer WHERE c_nationkey <> 7")
def document_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written in eight buckets, one document deleted, the rest read back; readers find the number of buckets."""
    path = f"{_shared(spark)}/extractions"
    sinks.write_extractions(long_rows(spark, sf_dir), path, buckets=8)
    sinks.delete_document(spark, path, "7")
    return sinks.read_extraction(spark, path).select("guid", "row_number", F.try_element_at("data", F.lit("name")).alias("name"))


@query("SELECT CAST(c_custkey AS BIGINT) AS row_number, c_mktsegment AS sheet_name FROM customer WHERE c_nationkey = 7")
def one_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_shared(spark)}/extractions"
    sinks.write_extractions(long_rows(spark, sf_dir), path, buckets=8)
    return sinks.read_extraction(spark, path, "7").select("row_number", "sheet_name")


@query("SELECT CAST(c_nationkey AS VARCHAR) AS guid, CAST(c_custkey AS BIGINT) AS row_number, c_name AS name, CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR) AS account FROM customer")
def wide_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long rows written as one wide table for each set of columns and read back."""
    path = f"{_shared(spark)}/wide"
    sinks.write_wide_by_shape(long_rows(spark, sf_dir), path)
    return spark.read.parquet(path).select("guid", "row_number", "name", "account")


@query(STATUS + "SELECT guid, status, error_message, '2024-03-04' AS dt, 'labels' AS source FROM verdicts")
def verdict_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts as JSON lines below source, day and run, written twice and read back."""
    path = f"{_shared(spark)}/log"
    for _ in range(2):
        sinks.write_verdict_log(verdict_table(spark, sf_dir), path, "labels", "r1", F.lit("2024-03-04 05:06:07").cast("timestamp"))
    return spark.read.json(path).select("guid", "status", "error_message", F.col("dt").cast("string").alias("dt"), "source")


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(NULL AS DOUBLE) AS missing, c_name FROM customer")
def aligned_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import types as T

    wanted = T.StructType([T.StructField("c_custkey", T.StringType()), T.StructField("missing", T.DoubleType())])
    return sinks.align_to_schema(table(spark, sf_dir, "customer").select("c_name", "c_custkey"), wanted)


@query("SELECT CAST(c_custkey % 50 AS VARCHAR) AS guid, CAST(c_nationkey AS INTEGER) AS sheet_index, CASE WHEN c_custkey % 50 % 3 = 0 THEN 'passed' ELSE 'failed' END AS status, count(*) AS n FROM customer GROUP BY ALL")
def ledger_recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of failed sheets, in which those of every third document are replaced by passed ones."""
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 50).alias("k"), F.col("c_nationkey").cast("int").alias("sheet_index"))
    old = c.select(F.col("k").cast("string").alias("guid"), "sheet_index", F.lit("failed").alias("status"))
    new = c.filter("k % 3 = 0").select(F.col("k").cast("string").alias("guid"), "sheet_index", F.lit("passed").alias("status"))
    return sinks.record_sheets(old, new).groupBy("guid", "sheet_index", "status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(doc_id AS VARCHAR) AS guid, 'extract' AS stage, quality = 1 AS passed, CASE WHEN quality = 1 THEN NULL ELSE 'low; lower' END AS issues FROM labels")
def audit_exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows written as CSV, their first two issues only, and read back."""
    path = f"{_shared(spark)}/audit"
    issues = F.when(F.col("quality") == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("low"), F.lit("lower"), F.lit("lowest")))
    sinks.export_audit(table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("guid"), F.lit("extract").alias("stage"), (F.col("quality") == 1).alias("passed"), issues.alias("issues")), path)
    return spark.read.schema("guid string, stage string, passed boolean, issues string").option("header", True).csv(f"{path}/csv")


# ---- status and streams ----------------------------------------------------------------------------------------------


@query(STATUS + "SELECT count(*) AS n FROM status SEMI JOIN verdicts USING (guid) WHERE status = 'pending' AND source = (SELECT min(source) FROM documents)")
def verdicts_still_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    least = table(spark, sf_dir, "documents").agg(F.min("source")).first()[0]
    return status.count_pending(status_table(spark, sf_dir), verdict_table(spark, sf_dir), least)


@query(STATUS + "SELECT guid, body_length FROM status ANTI JOIN verdicts USING (guid) WHERE status IN ('pending', 'error_extraction') AND body_length >= 1")
def resumed_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left after the verdicts were flushed into the status table."""
    st, v = status_table(spark, sf_dir), verdict_table(spark, sf_dir)
    return drain.resume_backlog(st, v, ["pending", "error_extraction"], status.merge_verdicts(st, v))


@query(STATUS + "SELECT guid, coalesce(v.status, s.status) AS status, CASE WHEN v.status IS NULL THEN s.error_message ELSE v.error_message END AS error_message, body_length FROM status s FULL JOIN verdicts v USING (guid)")
def verdicts_flushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts flushed by a stream in two runs; of each guid's two verdicts the later counts."""
    home = _shared(spark)
    status_table(spark, sf_dir).write.parquet(f"{home}/status/base")
    v = verdict_table(spark, sf_dir)
    early, late = (v.withColumn("staged_at", F.lit(f"2024-01-0{n} 00:00:00").cast("timestamp")) for n in (1, 2))
    for n, part in enumerate([early.withColumn("status", F.lit("error_pipeline")), late]):
        part.write.mode("append").parquet(f"{home}/verdicts")
        flow = spark.readStream.schema(part.schema).parquet(f"{home}/verdicts")
        drain.flush_verdicts(flow, f"{home}/status", f"{home}/progress").awaitTermination()
    return drain.read_status(spark, f"{home}/status").select("guid", "status", "error_message", "body_length")


@query("SELECT CAST(doc_id AS VARCHAR) AS schema_hash, CASE WHEN doc_id % 3 < 2 THEN 'shared' ELSE 'local' END AS maker FROM documents")
def shapes_synced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two shape tables that share a third of their keys; the shared one with what it lacked."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("schema_hash"), (F.col("doc_id") % 3).alias("k"))
    side = lambda keep, maker: d.filter(keep).select("schema_hash", F.lit(1).alias("created_at"), F.lit(maker).alias("maker"))
    both, other = drain.sync_shapes(side("k < 2", "shared"), side("k > 0", "local"))
    return both.join(other.select("schema_hash"), "schema_hash", "left_semi").select("schema_hash", "maker")


@query(STATUS + "SELECT source, status AS outcome, count(*) AS n FROM status GROUP BY 1, 2")
def outcomes_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.verdicts_by_source(status_table(spark, sf_dir).withColumnRenamed("status", "outcome"))


@query("SELECT CAST(doc_id AS VARCHAR) AS guid, CASE WHEN length(text) > 1000 THEN 'published book or manual' ELSE 'other' END AS document_type FROM documents")
def classified_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genres by a user's vectorised classifier."""
    @F.pandas_udf("string")
    def genre(start: pd.Series) -> pd.Series:
        return start.str.len().gt(1000).map({True: "published book or manual", False: "other"})

    return status.classify(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("guid"), F.col("text").alias("body_text")), genre)


# ---- layout, parsers, schema -----------------------------------------------------------------------------------------

_CELLS = "SELECT c_nationkey, c_custkey, c_name || ';' || CASE WHEN c_custkey % 2 = 0 THEN '\"a;b\"' ELSE 'a' END || ';' || CAST(c_custkey AS VARCHAR) AS record FROM customer"


@query("SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '\"' END AS quote_char, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS quoted_field_rows FROM customer")
def quote_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quote of small sheets, of which every other has a cell that holds the delimiter."""
    c = table(spark, sf_dir, "customer")
    quoted = F.when(F.col("c_custkey") % 2 == 0, '"a;b"').otherwise("a")
    s = c.select(F.col("c_custkey").cast("long").alias("c_custkey"), F.array(F.lit("x;y;z"), F.concat_ws(";", "c_name", quoted, F.col("c_custkey").cast("string"))).alias("records"), F.lit(";").alias("delimiter"))
    return layout.detect_quote(s).select("c_custkey", "quote_char", F.col("quoted_field_rows").cast("int").alias("quoted_field_rows"))


@query("SELECT CAST(o_orderkey AS BIGINT) AS key, CAST(o_orderkey AS VARCHAR) AS first, '' AS missing, upper(o_orderstatus) AS status FROM orders")
def user_parsed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by a user's parser, which yields two records for each row, one by position and one by name."""

    def parse(row: list[str], field_count: int, null_tokens: list[str]) -> list[dict]:
        if row[1] == "P":
            raise ValueError("open")
        return [{"values": row}, {"first": f" {row[0]} ", "status": row[1], "_valid": False, "_errors": ["named"]}]

    parsers = extract.Parsers()
    parsers.register("s", parse)
    o = table(spark, sf_dir, "orders")
    rows = o.select(
        F.lit("g").alias("guid"), F.lit(0).alias("sheet_index"), F.lit("s").alias("sheet_name"), F.col("o_orderkey").cast("long").alias("line"), F.array(F.col("o_orderkey").cast("string"), "o_orderstatus").alias("cells"),
        F.array(F.lit("id"), F.lit("status")).alias("header_names"), F.array().cast("array<string>").alias("null_values"), F.lit("s").alias("shape_hash"), F.lit(2).alias("modal_field_count"), F.lit(False).alias("ragged"),
    )
    got = extract.extract_with(rows, parsers)
    value = lambda n: F.try_element_at("data", F.lit(n))
    by_name = got.filter("errors = array('named') and not valid").select(F.col("row_number") - 1, value("first"), F.coalesce(value("id"), F.lit("")), value("status"))
    failed = got.filter("errors = array('open') and not valid").select(F.col("row_number") - 1, (F.col("row_number") - 1).cast("string"), F.lit(""), F.lit("P"))
    return by_name.union(failed).toDF("key", "first", "missing", "status")


@query(
    "SELECT CAST(c_custkey AS BIGINT) AS key, CASE WHEN c_custkey % 3 = 0 THEN 'spec' WHEN c_custkey % 3 = 1 THEN 'row' ELSE 'detected' END AS header_source, CASE WHEN c_custkey % 3 = 0 THEN 'one,two' WHEN c_custkey % 3 = 1 THEN 'x,y' ELSE 'kept' END AS names, "
    "CASE WHEN c_custkey % 3 = 0 THEN ';' WHEN c_custkey % 3 = 1 THEN '|' ELSE ',' END AS delimiter, CASE WHEN c_custkey % 3 = 0 THEN 'NOT_TABULAR' END AS rejection_code FROM customer"
)
def specs_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout specs for two of three sheets: one that names the columns, one whose header is a line of the sheet."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 3
    guid = F.col("c_custkey").cast("string").alias("guid")
    profiles = c.select(
        guid, F.lit(0).alias("sheet_index"), F.col("c_custkey").cast("long").alias("key"), F.array(F.lit("skip"), F.lit("x|y"), F.lit("1|2")).alias("records"), F.lit(",").alias("delimiter"), F.lit(None).cast("string").alias("quote_char"),
        F.lit(0).alias("header_row_index"), F.array(F.lit("kept")).alias("header_names"), F.lit("detected").alias("header_source"), F.lit(0).alias("footer_start_from_bottom"), F.array().cast("array<string>").alias("null_values"), F.lit(None).cast("string").alias("rejection_code"),
    )
    by_line = k == 1
    spec = F.from_json(
        F.when(by_line, '{"layout_type": "table", "head_bounds": {"has_header": true, "header_line_index": 1, "inferred_columns": ["no"]}, "format_spec": {"delimiter_type": "pipe"}}')
        .otherwise('{"layout_type": "prose_or_report", "head_bounds": {"has_header": false, "inferred_columns": ["one", "two"]}, "format_spec": {"delimiter_type": "semicolon"}}'),
        layout.SPEC_SCHEMA.split("spec ", 1)[1],
    )
    specs = c.filter(k < 2).select(guid, F.lit(0).alias("sheet_index"), spec.alias("spec"))
    return layout.with_spec(profiles, specs).select("key", "header_source", F.array_join("header_names", ",").alias("names"), "delimiter", "rejection_code")


@query("SELECT CAST(c_custkey AS BIGINT) AS key, CASE WHEN c_custkey % 4 = 0 THEN '1' ELSE '' END AS leaked FROM customer")
def leaked_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header cells of small sheets with the shape of what is below, a date over dates in every fourth."""
    c = table(spark, sf_dir, "customer")
    header = F.array(F.lit("name"), F.when(F.col("c_custkey") % 4 == 0, "2024-01-01").otherwise("day"))
    data = F.array(*[F.array(F.col("c_name"), F.lit(f"2024-02-0{n}")) for n in range(1, 6)])
    return c.select(F.col("c_custkey").cast("long").alias("key"), F.array_join(layout.leaked_header_cells(header, data), ",").alias("leaked"))


@query("SELECT CAST(c_custkey AS BIGINT) AS key, 'id,name;' || c_name || ',a b;last' AS records, c_custkey % 2 = 0 AS header FROM customer")
def cleaned_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with zero-width characters, blank rows and line feeds in cells, split into clean records."""
    c = table(spark, sf_dir, "customer")
    body = F.concat(F.lit("﻿id,name" + text.ROW_SEPARATOR + " ​ " + text.ROW_SEPARATOR), "c_name", F.lit(",a" + text.CELL_NEWLINE + "b " + text.ROW_SEPARATOR + "last"))
    line = F.when(F.col("c_custkey") % 2 == 0, "id,name").otherwise("id, ")
    return c.select(F.col("c_custkey").cast("long").alias("key"), F.array_join(text.split_records(body), ";").alias("records"), text.has_two_cells(line).alias("header"))


@query("SELECT o_orderpriority AS name, CASE o_orderpriority WHEN '1-URGENT' THEN ',' WHEN '2-HIGH' THEN '|' WHEN '3-MEDIUM' THEN ';' WHEN '5-LOW' THEN ',' ELSE chr(9) END AS delimiter, count(*) AS n FROM orders GROUP BY 1, 2")
def delimiters_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("name"))
    kind = F.when(F.col("name") == "1-URGENT", "comma").when(F.col("name") == "2-HIGH", "pipe").when(F.col("name") == "3-MEDIUM", "semicolon").when(F.col("name") == "5-LOW", "unheard of").otherwise("tab")
    return o.withColumn("delimiter", text.delimiter_char(kind)).groupBy("name", "delimiter").agg(F.count(F.lit(1)).alias("n"))


@query(
    "WITH f AS (SELECT ['FULL_CC_NUM', 'CC_CVV', 'BANK_ACCT_NUM', 'PASSWORD_PIN', 'PERSON_TAX_ID', 'DRIVERS_LICENSE', 'PASSPORT', 'MILITARY_ID', 'PERSON_EMAIL', 'PERSON_ADDRESS_FULL', 'PERSON_PHONE_NUM', 'JURISDICTION', 'RECORD_TYPE', 'BOOL_BIOMETRIC_DATA'] AS names, "
    "['critical', 'critical', 'critical', 'critical', 'sensitive', 'sensitive', 'sensitive', 'sensitive', 'normal', 'normal', 'normal', 'metadata', 'metadata', 'normal'] AS tiers) "
    "SELECT names[c_custkey % 14 + 1] AS field, tiers[c_custkey % 14 + 1] AS tier, c_custkey % 14 < 11 AS labelable, count(*) AS n FROM customer, f GROUP BY 1, 2, 3"
)
def sensitivity_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = "FULL_CC_NUM CC_CVV BANK_ACCT_NUM PASSWORD_PIN PERSON_TAX_ID DRIVERS_LICENSE PASSPORT MILITARY_ID PERSON_EMAIL PERSON_ADDRESS_FULL PERSON_PHONE_NUM JURISDICTION RECORD_TYPE BOOL_BIOMETRIC_DATA".split()
    field = F.element_at(F.array(*map(F.lit, names)), (F.col("c_custkey") % 14 + 1).cast("int"))
    rows = table(spark, sf_dir, "customer").select(field.alias("field"))
    return rows.select("field", schema_map.sensitivity(F.col("field")).alias("tier"), F.col("field").isin(schema_map.labelable_fields()).alias("labelable")).groupBy("field", "tier", "labelable").agg(F.count(F.lit(1)).alias("n"))


# ---- evaluation and samples ------------------------------------------------------------------------------------------


@query("SELECT CAST(doc_id AS VARCHAR) AS guid, quality = 0 AND doc_id % 3 < 2 AS again FROM labels")
def retries_advised(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    return lab.select(F.col("doc_id").cast("string").alias("guid"), evaluate.should_retry(F.col("quality") == 1, (F.col("doc_id") % 3).cast("int")).alias("again"))


@query("SELECT c_nationkey AS nation, 'Success rate was ' || CAST(CAST(round(100 * round(count(*) FILTER (WHERE c_custkey % 10 <> 0) / count(*), 3)) AS INTEGER) AS VARCHAR) || '%.' || CASE WHEN count(*) FILTER (WHERE c_custkey % 10 = 0) > 0 THEN ' Errors: bad width.' ELSE '' END AS feedback FROM customer GROUP BY 1")
def feedback_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = long_rows(spark, sf_dir)
    profiles = rows.select("guid", "sheet_index").distinct().withColumn("header_names", F.array(F.lit("name"), F.lit("account")))
    return evaluate.failure_feedback(evaluate.quality_metrics(rows, profiles)).select(F.col("guid").cast("long").alias("nation"), "feedback")


@query("SELECT CAST(c_nationkey AS VARCHAR) AS guid, CAST(c_custkey AS BIGINT) AS row_number, CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END AS sheet_name FROM customer WHERE c_nationkey % 5 <> 0")
def passing_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of passing sheets; the sheet's name stays where a document has more than one."""
    rows = long_rows(spark, sf_dir)
    first = rows.select("guid", F.lit(0).alias("sheet_index"), (F.col("guid").cast("int") % 5 != 0).alias("passed")).distinct()
    second = rows.filter("int(guid) % 2 = 0").select("guid", F.lit(1).alias("sheet_index"), F.lit(False).alias("passed")).distinct()
    return extract.merge_sheets(rows, first.unionByName(second)).select("guid", "row_number", "sheet_name")


@query("SELECT CAST(c_custkey AS BIGINT) AS key, CASE WHEN c_custkey % 2 = 0 THEN 'ab,cdef,äb' ELSE 'ab,cdefgh,äb' END AS kept FROM customer")
def fair_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three lines in 11 or 13 bytes: the longest is cut to what the others leave."""
    c = table(spark, sf_dir, "customer")
    lines = F.array(F.lit("ab"), F.concat(F.lit("cdefgh"), "c_name"), F.lit("äb"))
    most = F.when(F.col("c_custkey") % 2 == 0, 11).otherwise(13)
    return c.select(F.col("c_custkey").cast("long").alias("key"), F.array_join(sheets.fit_budget(lines, most), ",").alias("kept"))


# ---- tables that are kept, and changed in the buckets that a change touches -----------------------------------------


def _kept(spark: SparkSession, rows: DataFrame, buckets: int = 16) -> BucketedTable:
    return BucketedTable(spark, f"{_shared(spark)}/kept", buckets).write(rows)


@query(STATUS + "SELECT guid, coalesce(v.status, s.status) AS status, CASE WHEN v.status IS NULL THEN s.error_message ELSE v.error_message END AS error_message, CASE WHEN v.status IS NULL THEN s.extraction_version ELSE 'v2' END AS extraction_version, CASE WHEN v.status IS NULL THEN s.extracted_at ELSE 1000 END AS extracted_at, body_length FROM status s FULL JOIN verdicts v USING (guid)")
def verdicts_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts merged into a kept status table; of each guid's two verdicts the later counts, and it clears old messages."""
    kept = _kept(spark, status_table(spark, sf_dir))
    v = verdict_table(spark, sf_dir).withColumn("staged_at", F.lit(2))
    early = v.withColumns({"status": F.lit("error_pipeline"), "error_message": F.lit("early"), "staged_at": F.lit(1)})
    kept.replace(v.unionByName(early), lambda old, new: status.merge_verdicts(old, new, "v2", F.lit(1000).cast("long")))
    return kept.read().select("guid", "status", "error_message", "extraction_version", "extracted_at", "body_length")


@query(STATUS + "SELECT guid, CASE WHEN s.guid IS NULL OR s.status IN ('pending', 'needs_llm_review', 'excluded_no_pii') AND v.guid IS NOT NULL THEN v.status ELSE s.status END AS status, body_length FROM status s FULL JOIN (SELECT guid, status FROM verdicts) v USING (guid)")
def population_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A population pass over a kept status table: open rows are updated, the others stay."""
    kept = _kept(spark, status_table(spark, sf_dir))
    kept.replace(verdict_table(spark, sf_dir).select("guid", "status"), status.merge_population)
    return kept.read().select("guid", "status", "body_length")


@query("SELECT CAST(c_custkey % 50 AS VARCHAR) AS guid, CAST(c_nationkey AS INTEGER) AS sheet_index, CASE WHEN c_custkey % 50 % 3 = 0 THEN 'passed' ELSE 'failed' END AS status, count(*) AS n FROM customer GROUP BY ALL")
def ledger_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``ledger_recorded``, on a kept ledger whose untouched buckets are not read."""
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 50).alias("k"), F.col("c_nationkey").cast("int").alias("sheet_index"))
    row = lambda status: [F.col("k").cast("string").alias("guid"), "sheet_index", F.lit(status).alias("status")]
    kept = _kept(spark, c.select(*row("failed")))
    sinks.keep_ledger(kept, c.filter("k % 3 = 0").select(*row("passed")))
    return kept.read().groupBy("guid", "sheet_index", "status").agg(F.count(F.lit(1)).alias("n"))


@query("""
    WITH rows AS (SELECT '["name","k' || CAST(c_custkey % 997 AS VARCHAR) || '"]' AS names, count(*) AS n FROM customer GROUP BY 1)
    SELECT substr(sha256(names), 1, 16) AS shape, names, n AS rows FROM rows
""")
def many_wide_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly a thousand sets of column names, each a table of its own, written by one job and counted from the files."""
    path = f"{_shared(spark)}/wide"
    c = table(spark, sf_dir, "customer")
    key = F.concat(F.lit("k"), (F.col("c_custkey") % 997).cast("string"))
    rows = c.select(
        key.alias("guid"), F.lit(0).alias("sheet_index"), F.lit("s").alias("sheet_name"), F.col("c_custkey").cast("long").alias("row_number"), F.lit(True).alias("valid"), F.array(F.lit("name"), key).alias("columns"),
        F.create_map(F.lit("name"), F.col("c_name"), key, F.col("c_acctbal").cast("string")).alias("data"),
    )
    sinks.write_wide_by_shape(rows, path)
    found = spark.read.parquet(path).groupBy("shape").agg(F.count("name").alias("rows"))
    return sinks.wide_shapes(spark, path).select("shape", F.to_json("names").alias("names")).join(found, "shape").select("shape", "names", "rows")


@query(STATUS + "SELECT guid, coalesce(v.status, s.status) AS status, CASE WHEN v.status IS NULL THEN s.error_message ELSE v.error_message END AS error_message, v.status IS NOT NULL AS judged FROM status s FULL JOIN verdicts v USING (guid)")
def verdicts_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of the second day streamed into a kept status table, then those of the first day, which come too late."""
    home = _shared(spark)
    kept = BucketedTable(spark, f"{home}/status", 8).write(status_table(spark, sf_dir))
    v = verdict_table(spark, sf_dir)
    early, late = (v.withColumn("staged_at", F.lit(f"2024-01-0{n} 00:00:00").cast("timestamp")) for n in (1, 2))
    for part in (late, early.withColumn("status", F.lit("error_pipeline"))):
        part.write.mode("append").parquet(f"{home}/verdicts")
        drain.flush_into(spark.readStream.schema(part.schema).parquet(f"{home}/verdicts"), kept, f"{home}/progress").awaitTermination()
    return kept.refresh().read().select("guid", "status", "error_message", F.col("staged_at").isNotNull().alias("judged"))


# ---- whole jobs ------------------------------------------------------------------------------------------------------


def _files_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixty documents for each block of 10,000 customers: those of even numbers name a personal number, and of these every
    third is prose without a table."""
    c = table(spark, sf_dir, "customer").withColumn("k", F.col("c_custkey") % 60 + F.floor(F.col("c_custkey") / 10_000) * 60)
    book = lambda rows, name: jobs.flatten_table(rows.select("k", F.col("c_custkey").alias(name), F.col("c_name").alias("name")), F.col("k").cast("string"), F.lit("people"), F.col(name), [name, "name"])
    prose = c.filter("k % 6 = 0").select(F.col("k").cast("string").alias("guid")).distinct().withColumn("body_text", F.lit("the ssn report\n\nnothing here\n\nno table either"))
    prose = prose.withColumns({"title": F.col("guid"), "body_length": F.octet_length("body_text").cast("long")})
    docs = book(c.filter("k % 2 = 0 and k % 6 > 0"), "ssn").unionByName(book(c.filter("k % 2 = 1"), "code")).unionByName(prose)
    return docs.withColumn("status", F.lit("pending"))


OUTCOMES = """
    WITH keys AS (SELECT DISTINCT c_custkey % 60 + c_custkey // 10000 * 60 AS k FROM customer)
    SELECT CAST(k AS VARCHAR) AS guid, CASE WHEN k % 2 = 1 OR k % 5 = 0 OR k % 6 = 0 THEN 'error_rejected' ELSE 'complete' END AS outcome,
        CASE WHEN k % 2 = 1 THEN 'NO_PII_SIGNAL' WHEN k % 5 = 0 THEN 'SKIPPED_DOCUMENT_TYPE' WHEN k % 6 = 0 THEN 'NO_DELIMITER_FOUND' END AS reason
    FROM keys WHERE k % 7 > 0
"""


def _gates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verdicts that every seventh document has, and the genres of all."""
    k = F.col("guid").cast("long")
    return docs.filter(k % 7 == 0).select("guid"), docs.select("guid", F.when(k % 5 == 0, "meeting notes or agenda").otherwise("other").alias("document_type"))


@query(OUTCOMES)
def corpus_in_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corpus run in committed bins: the backlog, both gates, rejected sheets, an outcome for each document."""
    home = _shared(spark)
    _files_of(spark, sf_dir).write.parquet(f"{home}/in")
    docs = spark.read.parquet(f"{home}/in")
    verdicts, labels = _gates(docs)
    jobs.run_in_bins(docs, verdicts, labels, f"{home}/run", target=30, at_once=1_000_000)
    return jobs.binned(spark, f"{home}/run", "outcomes").select("guid", "outcome", "reason")


@query(OUTCOMES)
def corpus_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run as one plan."""
    docs = _files_of(spark, sf_dir)
    verdicts, labels = _gates(docs)
    return jobs.corpus_run(docs, verdicts, labels, target=20, keep=f"{_shared(spark)}/work")[2]


@query(STATUS + f", d AS (SELECT CAST(doc_id AS VARCHAR) AS guid, CASE WHEN doc_id % 2 = 0 THEN 'Document: T' || lang || chr(10) || chr(10) || text ELSE text END AS t FROM documents WHERE n_chars > 0 AND source = 'src1'), f AS (SELECT guid, {FLAG_SQL} FROM d), n AS (SELECT guid, CASE WHEN {SCORE_SQL} > 0 THEN 'pending' ELSE 'excluded_no_pii' END AS status FROM f) SELECT guid, CASE WHEN n.guid IS NOT NULL AND s.status IN ('pending', 'needs_llm_review', 'excluded_no_pii') THEN n.status ELSE s.status END AS status FROM status s LEFT JOIN n USING (guid)")
def population_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one source scanned, scored with ASCII's classes as in its SQL, and merged into the status table."""
    return jobs.select_population(source_docs(spark, sf_dir), status_table(spark, sf_dir), "src1", pii.ascii_flags)[0].select("guid", "status")


@query(LEDGER + "SELECT guid, sheet_index, sheet_name, status FROM ledger WHERE guid = '3'")
def sheets_of_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.sheets_for(_ledger(spark, sf_dir), "3").select("guid", "sheet_index", "sheet_name", "status")


@query("SELECT CAST(c_custkey AS VARCHAR) AS guid, CASE WHEN c_custkey % 3 > 0 THEN CAST(c_custkey AS BIGINT) END AS row_number, c_custkey % 2 = 0 AS valid, '{\"n\":' || CAST(c_nationkey AS VARCHAR) || '}' AS place FROM customer")
def coerced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of whatever types as the writers take them."""
    c = table(spark, sf_dir, "customer")
    number = F.when(F.col("c_custkey") % 3 > 0, F.col("c_custkey").cast("string")).otherwise("none")
    rows = c.select(F.col("c_custkey").alias("guid"), number.alias("row_number"), F.when(F.col("c_custkey") % 2 == 0, "true").otherwise("false").alias("valid"), F.struct(F.col("c_nationkey").alias("n")).alias("place"))
    return sinks.coerce_output(rows)


@query("SELECT 0 AS line, 'o_orderkey,o_orderstatus' AS record UNION ALL SELECT k - 100, record FROM (SELECT row_number() OVER (ORDER BY o_orderkey) AS k, CAST(o_orderkey AS VARCHAR) || ',' || o_orderstatus AS record FROM orders) WHERE k > 100 AND k <= 1100")
def order_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thousand lines from the hundredth on; the slice is the operator."""
    return readers.table_as_records(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], n=1000, offset=100)

"""Where documents come from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.text import ROW_SEPARATOR  # noqa: F401  part of the reader's vocabulary

METRICS_SCHEMA = "ts timestamp, guid string, source string, batch_id int, stage string, seconds double, rows long, success boolean"
# Words whose presence in a first line suggests personal data, in any case; each is one point.
HEADER_FLAGS = [
    "name|nombre",
    "birth|dob",
    "ssn|national.*id|passport|cedula|curp",
    "bank|account.*num|iban|swift",
    "phone|mobile",
    "email",
    "salary|pay|wage|compensation",
    "address|street|city|postal",
    "employee.*id|emp.*id",
]


#: Bytes that a core should have to read before the scan's own tasks, a row group each at most, are taken as they are.
BYTES_PER_CORE = 128 << 20


def spread(docs: DataFrame, key: str = "guid") -> DataFrame:
    """``docs`` for work that costs far more than a shuffle, such as patterns over whole texts.

    A row group is one task however many cores are idle. Where the plan expects fewer bytes than ``BYTES_PER_CORE`` for
    each core, the rows are dealt out by ``key`` over all of them; a larger table is read as it lies, without a shuffle.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    expected = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return docs.repartition(2 * cores, key) if expected < BYTES_PER_CORE * cores else docs


def scan_population(source: DataFrame, category: str | None = None, limit: int | None = None) -> DataFrame:
    """Documents of a triage category that have a body; both tests reach the Parquet scan."""
    rows = source.filter(F.col("body_text").isNotNull() & (F.col("body_length") > 0))
    rows = rows if category is None else rows.filter(F.col("triage_category") == category)
    return rows if limit is None else rows.limit(limit)


def sample_documents(source: DataFrame, n: int, seed: int = 0, min_length: int = 100, key: str = "guid") -> DataFrame:
    """``n`` random documents longer than ``min_length``, the same for the same seed."""
    return source.filter(F.col("body_length") > min_length).orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def table_as_records(df: DataFrame, order: list[str], n: int | None = None, offset: int = 0, delimiter: str = ",") -> DataFrame:
    """(line, record): a table, or ``n`` of its rows from ``offset`` on, as delimited text, its header at line 0; nulls are
    empty. A slice is found by the range partitions' counts and reads no partition but its own."""
    text = F.array_join(F.array(*[F.col(c).cast("string") for c in df.columns]), delimiter, "")
    head = df.sparkSession.createDataFrame([(0, delimiter.join(df.columns))], "line long, record string")
    from gridloom.operators.batching import global_rank, global_slice

    by = [F.asc(c) for c in order]
    numbered = global_rank(df, by) if n is None and not offset else global_slice(df, by, offset, n)
    return head.unionByName(numbered.select((F.col("_rank") + 1 - offset).cast("long").alias("line"), text.alias("record")))


def read_text_documents(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """(guid = file path, body_text, body_length in bytes) of whole files in any encoding the JVM knows."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("guid"), F.decode("content", encoding).alias("body_text"), F.col("length").alias("body_length"))


def documents_from_column(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(guid, body_text, body_length): a text column as documents, measured in bytes, never cut."""
    return df.select(F.col(id_col).cast("string").alias("guid"), F.col(text_col).alias("body_text"), F.octet_length(text_col).cast("long").alias("body_length"))


def rank_by_header(source: DataFrame, min_score: int = 5, n: int = 50) -> DataFrame:
    """The ``n`` documents, known to be no duplicates, whose first line names most kinds of personal data, longest first
    among equals."""
    line = F.coalesce(F.substring_index("body_text", "\n", 1), F.lit(""))
    one, *more = [line.rlike(f"(?i)(?:{p})").cast("int") for p in HEADER_FLAGS]
    score = sum(more, one)
    rows = source.filter(~F.col("is_duplicate")).withColumn("header_score", score).filter(F.col("header_score") >= min_score)
    return rows.orderBy(F.desc("header_score"), F.desc("body_length"), "guid").limit(n)


def populate_status(source: DataFrame, label: str, version: str = "") -> DataFrame:
    """Rows for a new status table, pending, from source documents."""
    return source.select("guid", F.lit("pending").alias("status"), F.lit(version).alias("extraction_version"), F.lit(None).cast("timestamp").alias("extracted_at"), F.lit(None).cast("string").alias("error_message"), "body_length", F.lit(label).alias("source"))


def read_metrics(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    rows = spark.read.schema(METRICS_SCHEMA).csv(path, header=True)
    return rows if source is None else rows.filter(F.col("source") == source)


def sheets_for(ledger: DataFrame, guid: str) -> DataFrame:
    return ledger.filter(F.col("guid") == guid).orderBy("sheet_index")

"""The status of every document: set-based joins, merges and reports on the status and verdict tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Outcomes as another table of the same documents names them.
OUTSIDE_NAMES = {s: f"agentic_{s}" for s in ("complete", "error_rejected", "error_extraction", "error_pipeline")}
#: Statuses that a new population pass may overwrite.
OPEN = ("pending", "needs_llm_review", "excluded_no_pii")
# Genres of documents.
GENRES = [
    "tabular data export or report", "corporate policy document", "published book or manual", "presentation slide deck", "legal or compliance document", "marketing or newsletter content",
    "automated system notification", "meeting notes or agenda", "personal correspondence", "hr or personnel document", "other",
]
KEPT_GENRES = ["other", "tabular data export or report"]


def outside_names(df: DataFrame) -> DataFrame:
    """(ours, theirs): the two vocabularies, as a table of four rows."""
    return df.sparkSession.createDataFrame(list(OUTSIDE_NAMES.items()), "ours string, theirs string")


def skip_types() -> list[str]:
    return [g for g in GENRES if g not in KEPT_GENRES]


def with_title(docs: DataFrame, title: str = "title", body: str = "body_text") -> DataFrame:
    """The body led by ``Document: <title>`` where a title is non-blank; body_length stays the source's."""
    return docs.withColumn(body, F.when(F.trim(F.coalesce(title, F.lit(""))) != "", F.concat(F.lit("Document: "), title, F.lit("\n\n"), body)).otherwise(F.col(body)))


def is_pending(min_length: int = 1, source: str | None = None) -> Column:
    """Pending, long enough (which implies a body), of one source where given. Never reads the body."""
    out = (F.col("status") == "pending") & (F.col("body_length") >= min_length)
    return out if source is None else out & (F.col("source") == source)


def status_counts(status: DataFrame, guids: DataFrame | None = None) -> DataFrame:
    rows = status if guids is None else status.join(guids.select("guid"), "guid", "left_semi")
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "status")


def pending_totals(status: DataFrame, min_length: int = 1, source: str | None = None) -> DataFrame:
    return status.filter(is_pending(min_length, source)).agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("body_length"), F.lit(0)).alias("bytes"))


def pending_metadata(status: DataFrame, min_length: int = 1, source: str | None = None) -> DataFrame:
    """(guid, body_length) of the backlog; the scan reads no body."""
    return status.filter(is_pending(min_length, source)).select("guid", "body_length")


def largest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("body_length"), "guid")


def cap(df: DataFrame, n: int) -> DataFrame:
    return largest_first(df).limit(n)


def fetch_bodies(docs: DataFrame, guids: DataFrame) -> DataFrame:
    return docs.join(guids.select("guid"), "guid", "left_semi").select("guid", "body_text")


def count_pending(status: DataFrame, guids: DataFrame | None = None, source: str | None = None) -> DataFrame:
    rows = status if guids is None else status.join(guids.select("guid"), "guid", "left_semi")
    rows = rows.filter(F.col("status") == "pending")
    return (rows if source is None else rows.filter(F.col("source") == source)).agg(F.count(F.lit(1)).alias("n"))


def backlog(source: DataFrame, verdicts: DataFrame, statuses: list[str], machine: str | None = None, min_length: int = 1) -> DataFrame:
    """(guid, body_length) of source rows with a status to work on and no verdict yet."""
    rows = source.filter(F.col("status").isin(statuses) & (F.col("body_length") >= min_length))
    rows = rows if machine is None else rows.filter(F.col("gpu_machine") == machine)
    return rows.select("guid", "body_length").join(verdicts.select("guid"), "guid", "left_anti")


def latest_verdict(log: DataFrame) -> DataFrame:
    """The last verdict of each guid, by staged_at; of equal times the greatest status."""
    rest = [c for c in log.columns if c not in ("guid", "staged_at", "status")]
    return log.groupBy("guid").agg(F.max(F.struct("staged_at", "status", *rest)).alias("v")).select("guid", "v.*")


def one_each(rows: DataFrame) -> DataFrame:
    """``rows`` with a guid once: of several rows the least. Repeated guids would repeat what they are joined with."""
    rest = [c for c in rows.columns if c != "guid"]
    return rows.groupBy("guid").agg(F.min(F.struct(*rest)).alias("_r")).select("guid", *[F.col("_r")[c].alias(c) for c in rest]) if rest else rows.distinct()


def merge_population(status: DataFrame, scored: DataFrame) -> DataFrame:
    """Status rows updated from ``scored`` where still open, and scored documents that were missing."""
    cols = [c for c in status.columns if c != "guid"]
    marked = status.withColumn("_old", F.lit(True)).alias("s").join(one_each(scored).withColumn("_new", F.lit(True)).alias("n"), "guid", "full")
    replace = F.col("_new") & (F.col("_old").isNull() | F.col("s.status").isin(*OPEN))
    have = set(scored.columns)
    return marked.select("guid", *[(F.when(replace, F.col(f"n.{c}")).otherwise(F.col(f"s.{c}")) if c in have else F.col(f"s.{c}")).alias(c) for c in cols])


def merge_verdicts(status: DataFrame, verdicts: DataFrame, version: str | None = None, at: Column | None = None) -> DataFrame:
    """Every guid of either side. A verdict sets all of its columns, to null too: a complete document loses its old
    message. ``version`` and ``at`` become the extraction_version and extracted_at of its rows.

    Of a guid's verdicts the last by staged_at counts, where there is such a column, else one of them (``one_each``).
    """
    cols = [c for c in status.columns if c != "guid"]
    once = latest_verdict(verdicts) if "staged_at" in verdicts.columns else one_each(verdicts)
    given = {"extraction_version": None if version is None else F.lit(version), "extracted_at": at}
    new = {c: F.col(f"v.{c}") for c in verdicts.columns if c in cols} | {c: v for c, v in given.items() if v is not None and c in cols}
    met = status.alias("s").join(once.withColumn("_new", F.lit(True)).alias("v"), "guid", "full")
    return met.select("guid", *[(F.when(F.col("_new"), new[c]).otherwise(F.col(f"s.{c}")) if c in new else F.col(f"s.{c}")).alias(c) for c in cols])


def merge_first(shared: DataFrame, local: DataFrame, key: str = "schema_hash") -> DataFrame:
    """``shared`` with the rows of ``local`` whose key it lacks; of several, the earliest created."""
    rest = [c for c in local.columns if c not in (key, "created_at")]
    once = local.groupBy(key).agg(F.min(F.struct("created_at", *rest)).alias("r")).select(key, "r.*")
    return shared.unionByName(once.join(shared.select(key), key, "left_anti").select(*shared.columns))


def backfill_null(df: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """``column`` filled from ``pairs`` (guid, column) where it is null; of several pairs the smallest value."""
    found = pairs.groupBy("guid").agg(F.min(column).alias("_found"))
    return df.join(found, "guid", "left").withColumn(column, F.coalesce(F.col(column), F.col("_found"))).select(*df.columns)


def status_drift(ours: DataFrame, theirs: DataFrame, names: DataFrame) -> DataFrame:
    """(should_be, currently, n) for documents whose outside status differs from what ours maps to."""
    met = ours.select("guid", F.col("status").alias("ours")).join(F.broadcast(names), "ours").join(theirs.select("guid", F.col("status").alias("currently")), "guid")
    return met.filter(~F.col("currently").eqNullSafe(F.col("theirs"))).groupBy(F.col("theirs").alias("should_be"), "currently").agg(F.count(F.lit(1)).alias("n"))


def apply_verdicts(ours: DataFrame, theirs: DataFrame, names: DataFrame) -> DataFrame:
    """``theirs`` with the mapped status where ours has an outcome that differs."""
    mapped = ours.select("guid", F.col("status").alias("ours")).join(F.broadcast(names), "ours").select("guid", F.col("theirs").alias("_to")).transform(one_each)
    return theirs.join(mapped, "guid", "left").withColumn("status", F.coalesce("_to", "status")).select(*theirs.columns)


def sync_status(ours: DataFrame, theirs: DataFrame, names: DataFrame) -> DataFrame:
    """``apply_verdicts`` that carries document_type over too, where ours has one."""
    mapped = ours.select("guid", F.col("status").alias("ours"), F.col("document_type").alias("_type")).join(F.broadcast(names), "ours")
    met = theirs.join(one_each(mapped.select("guid", "theirs", "_type")), "guid", "left")
    return met.withColumn("document_type", F.coalesce("_type", "document_type")).withColumn("status", F.coalesce("theirs", "status")).select(*theirs.columns)


def processed_guids(ledger: DataFrame) -> DataFrame:
    return ledger.select("guid").distinct()


def missing_from_status(ledger: DataFrame, status: DataFrame) -> DataFrame:
    return processed_guids(ledger).join(status.select("guid"), "guid", "left_anti")


def _flip(status: DataFrame, guids: DataFrame, when: Column, to: str, message: Column | None = None) -> DataFrame:
    hit = status.join(guids.select("guid", F.lit(True).alias("_hit")).distinct(), "guid", "left")
    change = F.col("_hit").eqNullSafe(True) & when
    out = hit.withColumn("status", F.when(change, to).otherwise(F.col("status"))) if message is None else hit.withColumn("error_message", F.when(change, message).otherwise(F.col("error_message"))).withColumn("status", F.when(change, to).otherwise(F.col("status")))
    return out.select(*status.columns)


def reconcile_processed(status: DataFrame, ledger: DataFrame) -> DataFrame:
    """Pending documents that the ledger has become complete."""
    return _flip(status, ledger, F.col("status") == "pending", "complete")


def park_failed(status: DataFrame, ledger: DataFrame) -> DataFrame:
    """Complete documents with a failed sheet become error_extraction; rejected sheets don't count."""
    return _flip(status, ledger.filter(F.col("status") == "failed"), F.col("status") == "complete", "error_extraction")


def mark_complete(status: DataFrame, guids: DataFrame, version: str) -> DataFrame:
    hit = status.join(guids.select("guid", F.lit(True).alias("_hit")).distinct(), "guid", "left")
    out = hit
    for name, value in (("extraction_version", F.lit(version)), ("error_message", F.lit(None).cast("string")), ("status", F.lit("complete"))):
        out = out.withColumn(name, F.when(F.col("_hit"), value).otherwise(F.col(name)))
    return out.select(*status.columns)


def mark_error(status: DataFrame, guids: DataFrame, kind: str, message: str) -> DataFrame:
    """The guids' status becomes ``error_<kind>`` with a message of at most 8192 characters."""
    return _flip(status, guids, F.lit(True), f"error_{kind}", F.substring(F.lit(message), 1, 8192))


def requeue(status: DataFrame, from_status: str, source: str | None = None, n: int | None = None) -> DataFrame:
    """The oldest ``n`` rows of a status become pending with no message. Rejected is never asked for by name alone."""
    rows = status.filter(F.col("status") == from_status)
    rows = rows if source is None else rows.filter(F.col("source") == source)
    chosen = rows.select("guid") if n is None else rows.orderBy(F.col("extracted_at").asc_nulls_first(), "guid").limit(n).select("guid")
    return _flip(status, chosen, F.col("status") == from_status, "pending", F.lit(None).cast("string"))


def gate_document_type(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passed, rejected with rejection_code SKIPPED_DOCUMENT_TYPE); a missing or unknown label passes."""
    met = docs.join(one_each(labels.select("guid", F.lower(F.trim("document_type")).alias("_label"))), "guid", "left")
    skip = F.coalesce(F.col("_label").isin(skip_types()), F.lit(False))
    return met.filter(~skip).drop("_label"), met.filter(skip).withColumn("rejection_code", F.lit("SKIPPED_DOCUMENT_TYPE")).withColumnRenamed("_label", "document_type_found")


def classify(docs: DataFrame, classifier: Callable[[Column], Column], chars: int = 2000) -> DataFrame:
    """(guid, document_type) by a user's classifier, such as a pandas UDF on strings, of each body's start."""
    return docs.select("guid", classifier(F.substring("body_text", 1, chars)).alias("document_type"))


def verdicts_by_source(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("source", "outcome").agg(F.count(F.lit(1)).alias("n"))


def type_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("document_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "document_type")


def latest_rows(corpus: DataFrame) -> DataFrame:
    """The latest generation of each (guid, row_number)."""
    order = Window.partitionBy("guid", "row_number").orderBy(F.desc("extracted_at"))
    return corpus.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def latest_extraction(rows: DataFrame) -> DataFrame:
    """All rows of each guid's newest extraction."""
    newest = rows.groupBy("guid").agg(F.max("extracted_at").alias("extracted_at"))
    return rows.join(newest, ["guid", "extracted_at"], "left_semi")

"""Kept tables: what a change touches, what it costs and what a crash leaves; tables of many shapes by one job."""

import pytest
from pyspark.sql import functions as F

from gridloom.operators import status
from gridloom.sources import sinks
from gridloom.sources.bucketed import BucketedTable
from gridloom.sources.files import ParquetFile
from gridloom.streaming import drain


@pytest.fixture
def kept(spark, tmp_path):
    rows = spark.range(400).select(F.col("id").cast("string").alias("guid"), F.lit("pending").alias("status"), F.lit("old").alias("error_message"), F.col("id").alias("body_length"))
    return BucketedTable(spark, str(tmp_path / "kept"), 8).write(rows)


def files_of(table):
    return {f.rsplit("/", 1)[1] for f in table.read().inputFiles()}


def verdicts(spark, *rows):
    return spark.createDataFrame(rows, "guid string, status string, error_message string")


def test_a_change_replaces_the_buckets_it_touches_and_no_other(spark, kept):
    before = files_of(kept)
    kept.replace(verdicts(spark, ("7", "complete", None), ("new", "error_pipeline", "x")), status.merge_verdicts)
    after = files_of(kept)
    touched = {r[0] for r in spark.createDataFrame([("7",), ("new",)], "guid string").select(kept.bucket()).collect()}
    assert len(before) == len(after) == 8 and len(before & after) == 8 - len(touched)
    got = {r.guid: (r.status, r.error_message, r.body_length) for r in kept.read().collect()}
    assert len(got) == 401 and got["7"] == ("complete", None, 7) and got["new"] == ("error_pipeline", "x", None) and got["8"] == ("pending", "old", 8)
    again = BucketedTable(spark, kept.path)
    assert again.buckets == 8 and again.read().count() == 401 and [r.status for r in again.read("7").collect()] == ["complete"]
    assert len(again.read("7").inputFiles()) == 1


def test_a_merge_does_not_shuffle_the_kept_side(spark, kept):
    big = verdicts(spark, ("7", "complete", None)).hint("merge")
    plan = status.merge_verdicts(kept.read(), big.repartition(8, "guid"))._jdf.queryExecution().executedPlan().toString()
    side = plan[: plan.index("Exchange")] if plan.index("Exchange") > plan.index("FileScan") else plan[plan.index("FileScan") :]
    assert "Bucketed: true" in plan and "FileScan" in side and plan.count("Exchange") == 1


def test_a_crash_before_the_publication_changes_nothing(spark, kept, monkeypatch):
    before, old = files_of(kept), kept.number
    monkeypatch.setattr(kept, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        kept.replace(verdicts(spark, ("7", "complete", None)), status.merge_verdicts)
    again = BucketedTable(spark, kept.path)
    assert again.number == old and files_of(again) == before and again.read().filter("status = 'complete'").count() == 0
    again.replace(verdicts(spark, ("7", "complete", None)), status.merge_verdicts)
    assert BucketedTable(spark, kept.path).read().filter("status = 'complete'").count() == 1


def test_old_generations_go_and_new_columns_come(spark, kept, tmp_path):
    for n in range(4):
        kept.replace(verdicts(spark, ("7", f"s{n}", None)), status.merge_verdicts)
    kept.vacuum(keep=1)
    assert len(list((tmp_path / "kept/data").rglob("*.parquet"))) == 8 and kept.read("7").first().status == "s3"
    kept.replace(verdicts(spark, ("7", "x", None)), lambda old, new: old.withColumn("run", F.lit(5)))
    assert {r.run for r in kept.read().collect()} == {5, None} and kept.read().count() == 400


def test_verdicts_set_all_their_columns_and_the_last_counts(spark):
    old = spark.createDataFrame([("a", "error_extraction", "old failure", "v1"), ("b", "pending", "kept", "v1")], "guid string, status string, error_message string, extraction_version string")
    log = spark.createDataFrame([("a", "error_pipeline", "x", 1), ("a", "complete", None, 2)], "guid string, status string, error_message string, staged_at int")
    got = {r.guid: tuple(r)[1:] for r in status.merge_verdicts(old, log, "v2").collect()}
    assert got == {"a": ("complete", None, "v2"), "b": ("pending", "kept", "v1")}


def wide_rows(spark, shapes, per_shape):
    key = F.concat(F.lit("k"), (F.col("id") % shapes).cast("string"))
    data = F.create_map(F.lit("name"), F.col("id").cast("string"), key, F.lit(None).cast("string"))
    return spark.range(shapes * per_shape).select(key.alias("guid"), F.lit(0).alias("sheet_index"), F.lit("s").alias("sheet_name"), F.col("id").alias("row_number"), F.lit(True).alias("valid"), F.array(F.lit("name"), key).alias("columns"), data.alias("data"))


def test_five_thousand_shapes_by_one_job(spark, tmp_path):
    path = str(tmp_path / "wide")
    assert sinks.write_wide_by_shape(wide_rows(spark, 5000, 2), path) == 5000
    listed = sinks.wide_shapes(spark, path)
    assert listed.agg(F.sum("rows")).first()[0] == 10_000
    shape = listed.filter(F.col("names")[1] == "k77").first().shape
    one = sinks.read_wide(spark, path, shape)
    assert one.columns == ["guid", "sheet_index", "sheet_name", "row_number", "valid", "name", "k77"] and sorted(r.name for r in one.collect()) == ["5077", "77"]


def test_a_shape_of_most_rows_spreads_and_a_second_run_replaces_the_first(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions are joined otherwise
    sinks.write_wide_by_shape(wide_rows(spark, 3, 10), path)
    hot = wide_rows(spark, 1, 50_000)
    assert sinks.write_wide_by_shape(hot, path) == 1
    listed = sinks.wide_shapes(spark, path).first()
    assert listed.rows == 50_000 and listed.files > 1 and sinks.read_wide(spark, path, listed.shape).select("name").distinct().count() == 50_000
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sinks.write_wide_by_shape(hot.limit(0), path) == 0


def test_a_file_that_fails_does_not_appear(tmp_path):
    import pyarrow as pa

    with pytest.raises(ZeroDivisionError), ParquetFile(f"{tmp_path}/x/part.parquet", pa.schema([("a", pa.int64())])):
        1 / 0  # noqa: B018
    assert not list((tmp_path / "x").iterdir())


def test_a_stream_keeps_the_last_verdict_and_no_log(spark, tmp_path, kept):
    schema = "guid string, status string, error_message string, staged_at int"
    runs = [[("1", "error_pipeline", "x", 5), ("1", "complete", None, 6), ("2", "complete", None, 5)], [("1", "error_pipeline", "late", 3), ("2", "error_extraction", "y", 9)], [("1", "complete", None, 6), ("new", "complete", None, 1)]]
    for rows in runs:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "v"))
        drain.flush_into(spark.readStream.schema(schema).parquet(str(tmp_path / "v")), kept, str(tmp_path / "cp")).awaitTermination()
    kept.refresh()
    got = {r.guid: (r.status, r.error_message, r.staged_at) for r in kept.read().filter("staged_at is not null").collect()}
    assert got == {"1": ("complete", None, 6), "2": ("error_extraction", "y", 9), "new": ("complete", None, 1)} and kept.read().count() == 401
    kept.vacuum(keep=1)
    assert len(list((tmp_path / "kept/data").rglob("*.parquet"))) == 8

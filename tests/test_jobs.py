"""Whole jobs: runs in committed bins, slices, samples and sheet signals against plain Python."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from gridloom import queries
from gridloom.functions import pii
from gridloom.operators import batching
from gridloom.plans import jobs
from gridloom.sources import readers
from tests.test_status_and_sinks import SENTENCES, birth_date, card_number

SF = "/root/testdata/sf0.001"


def test_a_run_that_is_cut_off_goes_on_with_its_first_open_bin(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(str(i), "pending", f"ssn,name\n\n{i},Ann", 10 + i) for i in range(12)], "guid string, status string, body_text string, body_length int")
    none, root, made = docs.select("guid").limit(0), str(tmp_path / "run"), []

    def light(passed, keep):
        made.append(sorted(r.guid for r in passed.collect()))
        if len(made) == 3:
            raise RuntimeError("lost")
        rows = passed.select("guid", F.lit(1).alias("row_number"))
        return jobs.Extraction(rows, None, None, None, passed.select("guid", F.lit("complete").alias("outcome"), F.lit(None).cast("string").alias("reason")))

    monkeypatch.setattr(jobs, "extract", light)
    labels = docs.select("guid", F.when(F.col("guid") == "5", "meeting notes or agenda").alias("document_type"))
    with pytest.raises(RuntimeError):
        jobs.run_in_bins(docs, none, labels, root, target=3)
    assert jobs.bins(spark, root).count() == 2 and jobs.binned(spark, root, "outcomes").count() == 6
    before = {p: p.stat().st_mtime_ns for n in ("plan", "progress", "outcomes", "rows") for p in (tmp_path / "run" / n).rglob("*.parquet")}
    done = jobs.run_in_bins(docs, none, labels, root, target=3).collect()
    assert sorted(r.batch for r in done) == [0, 1, 2, 3] and sum(r.documents for r in done) == 12
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    got = {r.guid: (r.outcome, r.reason) for r in jobs.binned(spark, root, "outcomes").collect()}
    assert len(got) == 12 and got["5"] == ("error_rejected", "SKIPPED_DOCUMENT_TYPE") and sum(x[0] == "complete" for x in got.values()) == 11
    assert made[2] == made[3] and jobs.binned(spark, root, "rows").count() == 11
    jobs.run_in_bins(docs, none, labels, root, target=3)
    assert len(made) == 5  # nothing was left to do


def test_small_bins_run_together_and_each_is_replaced_whole(spark, tmp_path, monkeypatch):
    """A round for many bins, with the result of a round each; a bin without rows, and rows of a run that was cut off, are no trouble."""
    docs = spark.createDataFrame([(str(i), "pending", f"ssn,name\n\n{i},Ann", 10 + i) for i in range(7)], "guid string, status string, body_text string, body_length int")
    none, labels, rounds, shown = docs.select("guid").limit(0), docs.select("guid", F.lit("other").alias("document_type")), [], {}

    def light(passed, keep):
        rounds.append(1)
        rows = passed.filter("guid > '2'").select(F.explode(F.array(F.lit(1), F.lit(2))).alias("row_number"), "guid")
        return jobs.Extraction(rows, None, None, None, passed.select("guid", F.lit("complete").alias("outcome"), F.lit(None).cast("string").alias("reason")))

    monkeypatch.setattr(jobs, "extract", light)
    for at_once, expected in ((0, 7), (3, 3), (1000, 1)):
        root = str(tmp_path / f"run{at_once}")
        rounds.clear()
        if at_once:
            for n in (0, 2):
                spark.createDataFrame([(9, "stale")], "row_number int, guid string").write.parquet(f"{root}/rows/batch={n}")
        done = jobs.run_in_bins(docs, none, labels, root, target=1, at_once=at_once).collect()
        assert len(rounds) == expected
        outcomes, rows = (jobs.binned(spark, root, name) for name in ("outcomes", "rows"))
        shown[at_once] = sorted(map(tuple, done)), sorted(map(str, outcomes.select("batch", "guid", "outcome", "reason").collect())), sorted(map(str, rows.select("batch", "guid", "row_number").collect()))
    assert [len(x) for x in shown[0]] == [7, 7, 8] and shown[0] == shown[3] == shown[1000]


@pytest.mark.parametrize(("offset", "n"), [(0, 5), (95, 20), (990, 50), (1000, 5), (400, None), (0, None)])
def test_a_slice_is_that_of_the_whole_order(spark, offset, n):
    draw = random.Random(2)
    rows = [(draw.randrange(300), i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    want = [f"{a},{b}" for a, b in sorted(rows)][offset : None if n is None else offset + n]
    got = sorted((r.line, r.record) for r in readers.table_as_records(df, ["a", "b"], n=n, offset=offset).collect())
    assert got == [(0, "a,b"), *((i + 1, x) for i, x in enumerate(want))]


def test_a_slice_reads_its_own_partitions_only(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        some = batching.global_slice(spark.range(10_000).repartition(5), [F.asc("id")], 10, 5)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.id for r in some.orderBy("id").collect()] == [10, 11, 12, 13, 14] and "PartitionFilters: [_part" in some._jdf.queryExecution().executedPlan().toString().replace("isnotnull(", "")


def test_the_sample_is_the_one_that_the_hash_orders(spark):
    got = queries.QUERIES["sampled_documents"](spark, SF).collect()

    def order(guid):
        h = xxhash.xxh64_intdigest((7).to_bytes(4, "little"), xxhash.xxh64_intdigest(guid.encode(), 42))
        return h - (1 << 64) if h >= 1 << 63 else h

    docs = [(r.doc_id, r.n_chars) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "n_chars").collect()]
    want = sorted((order(str(i)), str(i)) for i, n in docs if n > 100)[:100]
    assert {r.guid for r in got} == {g for _, g in want}


def test_signals_of_sheets_are_those_of_plain_python(spark, tmp_path):
    draw = random.Random(6)
    said = [t for t, _, _ in SENTENCES] + ["plain words", "", "  ", "DOB", "12.04.1990", "visa", "4485921000111222", "pin: 1234", "x@gmail.com", "Calle 5"]
    docs = [(i, draw.choice(["\n", "\n\n"]).join(draw.choice(said) for _ in range(draw.randint(1, 4)))) for i in range(300)]
    spark.createDataFrame(docs, "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = [(str(i), t) for i, t in docs]
    got = {r.guid: r.pii_signals for r in queries.QUERIES["sheet_signals"](spark, str(tmp_path)).collect()}
    find = lambda p, t: bool(re.search(f"(?i)(?:{p})", t))
    more = {
        "DOB": birth_date, "GOVERNMENT_ID": lambda t: find(f"{pii.ID_NUMBERS}|{pii.ID_PHRASES}", t), "ADDRESS": lambda t: find(pii.CLEAR_ADDRESS, t) or bool(re.search(pii.CAPITAL_STREET, t)),
        "FINANCIAL_ACCOUNT": lambda t: find(pii.CLEAR_ACCOUNT, t) or card_number(t), "CREDENTIAL": lambda t: find(pii.CLEAR_CREDENTIAL, t),
    }
    for guid, text in docs:
        rows = [re.sub("[﻿​‌‍⁠]", "", r.replace("\x04", " ")).strip() for r in text.split("\n\n" if "\n\n" in text else "\n")]
        t = "\n\n".join(r for r in rows if r)
        want = [name for name, p in pii.PATTERNS.items() if find(p, t) and (name not in more or more[name](t))]
        assert got[guid] == ",".join(want), guid
    assert len(got) == len(docs) and len(set(got.values())) > 2

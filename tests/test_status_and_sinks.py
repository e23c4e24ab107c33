"""PII sentences, status joins, batches, sinks and streams."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from gridloom.functions import pii
from gridloom.operators import batching, status
from gridloom.operators.evaluate import document_outcome, evaluate
from gridloom.plans import jobs
from gridloom.queries import table
from gridloom.sources import readers, sinks
from gridloom.streaming import drain

SENTENCES = [
    ("Please update account number 4485921 on file.", "FINANCIAL_ACCOUNT", None),
    ("Full Name: John Smith, Email: john@example.com, Phone: 555-123-4567", "", ""),
    ("Fecha de nacimiento: 12/04/1990", "DOB", "DOB"),
    ("дата на раждане ДАТА НА РАЖДАНЕ 1990", "DOB", "DOB"),
    ("123-45-6789", "GOVERNMENT_ID", "GOVERNMENT_ID"),
    ("Av. Diagonal, 211, 08018 Barcelona", "ADDRESS", None),
    ("Contact: someone@gmail.com", "PERSONAL_EMAIL", "PERSONAL_EMAIL"),
    ('offering a lead","09/30 to next stage', "ADDRESS", ""),
    ("weak for DOB or phone #.///01-18-2021-She needs more", "DOB", ""),
    ("*10/05/2020 shows the willingness", "DOB", ""),
    ("DOB (dd/mm/yyyy): 09/30/1985", "DOB", "DOB"),
    ("Koenigsring 5, 12345 Berlin", "ADDRESS", "ADDRESS"),
    ("Case, 19663844 19663057 19663614, closed", "FINANCIAL_ACCOUNT", ""),
    ("#9156339430850005821,AEROPLAN VISA INFINITE CARD,M2", "FINANCIAL_ACCOUNT", "FINANCIAL_ACCOUNT"),
    ("ref 591055516300 closed without action", "GOVERNMENT_ID", ""),
    ('PASSWORD:,,,,"Is needed to update Location, and more"', "CREDENTIAL", ""),
    ("Video Demo (Password: CU9A0n=z)", "CREDENTIAL", "CREDENTIAL"),
]


def test_pii_sentences(spark):
    df = spark.createDataFrame([(i, s[0]) for i, s in enumerate(SENTENCES)], "i int, t string")
    got = df.select("i", pii.pii_signals(pii.pii_flags(F.col("t"))).alias("b"), pii.pii_signals(pii.refined_flags(F.col("t"))).alias("r")).orderBy("i").collect()
    for row, (text, base, refined) in zip(got, SENTENCES):
        assert base in row.b.split(","), (text, row.b)
        if refined is not None:
            assert (refined in row.r.split(",")) if refined else not set(row.r.split(",")) & set(row.b.split(",")) - {"", "GOVERNMENT_ID", "DEVICE_ID"} or row.r == "", (text, row.r)


def windows(text, pattern):
    """Texts of 40 characters before and after each match."""
    return [(text[max(0, a - 40) : a], text[b : b + 40]) for a, b in (m.span() for m in re.finditer(f"(?i){pattern}", text))]


def birth_date(text):
    """Of every window the first date counts, if no full stop parts it from the word."""
    for before, after in windows(text, pii.BIRTH_WORD):
        a, b = re.split(pii.DATE, after, maxsplit=1), re.split(pii.DATE, before, maxsplit=1)
        if (len(a) == 2 and "." not in a[0]) or (len(b) == 2 and "." not in b[1]):
            return True
    return False


def card_number(text):
    return any(re.search(f"(?i){pii.CARD_WORD}", side) for pair in windows(text, pii.CARD_DIGITS) for side in pair)


def test_flags_agree_with_python(spark):
    random.seed(5)
    words = ["dob", "DOB:", "1990", "12.04.1990", ".", "account", "12345", "4485921000111222", "visa", "iban", "Calle", "5", "pin:", "SSN", "Ringstrasse", "12", "street", "born on", "x@gmail.com", "imei", "date", "of", "birth", ",", "\n", "\u00a0", "ſsn", "né le", "١٢٣٤٥", "passport", "xaccount", "password", "member id", "security code", "Дата на раждане"]
    texts = [" ".join(random.choice(words) for _ in range(random.randint(1, 14))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r for r in df.select("i", pii.pii_flags(F.col("t")).alias("f"), pii.refined_flags(F.col("t")).alias("r")).collect()}
    for i, t in enumerate(texts):
        for name, pattern in pii.PATTERNS.items():
            assert got[i].f[name] == bool(re.search(f"(?i)(?:{pattern})", t)), (name, t)
        assert got[i].r["DOB"] == (got[i].f["DOB"] and birth_date(t))
        assert got[i].r["FINANCIAL_ACCOUNT"] == (got[i].f["FINANCIAL_ACCOUNT"] and (bool(re.search(f"(?i)(?:{pii.CLEAR_ACCOUNT})", t)) or card_number(t)))


def test_ascii_flags_agree_with_sql(spark):
    """Letters beyond ASCII end a word in the SQL's engine, and what follows a street sign may be a line's end."""
    random.seed(6)
    words = ["130 die stöen", "6250 enteßö st.", "208 er stß", "2860 be schß st eine", "via\n12", "rue.7", "Straße 9", "ädob", "dobé", "ſſn", "ssnſ", "sın", "sİn", "Passport", "1990", "account", "\u212aonto", "iban", "ssn\x0bcard", "card\u2028", "expiration date",
             "\r", "\n", "\u00a0", "١٢٣٤٥٦", "pin\x0b:", "pin :", "memberé id", "client id 12345", "mrnü", "xДата на раждане7", "xДата на раж\u1c81ане7", "DE44", "5001051754", ", \u212aA 12345", ", BE 12345", "x@gmail.comé", "x@gmail.com", "ringß 5", "Äring 5", "555-66-7777é", "password", "1", "2 ", "é", "K1A 0B1"]
    texts = words + [" ".join(random.choice(words) for _ in range(random.randint(1, 6))) for _ in range(3000)] + ["".join(random.choice(words) for _ in range(random.randint(1, 4))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.f for r in df.select("i", pii.ascii_flags(F.col("t")).alias("f")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE d (i INTEGER, t VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?)", list(enumerate(texts)))
    for name, pattern in pii.PATTERNS.items():
        for i, found in con.execute("SELECT i, regexp_matches(t, ?) FROM d", [pii.for_re2(pattern)]).fetchall():
            assert got[i][name] == found, (name, texts[i])


def ledger(spark, *rows):
    return spark.createDataFrame(rows, "guid string, sheet_index int, sheet_name string, status string, rejection_code string, failure_reason string")


def test_document_outcome(spark):
    got = {r.guid: (r.outcome, r.reason) for r in document_outcome(ledger(
        spark, ("a", 0, "x", "failed", None, "bad"), ("a", 1, "y", "passed", None, None), ("b", 1, "x", "rejected", "SINGLE_COLUMN", None), ("b", 0, "y", "rejected", "NO_DATA_ROWS", None),
        ("c", 0, "x", "rejected", "NO_DATA_ROWS", None), ("c", 2, "y", "failed", None, "late"), ("c", 1, "z", "failed", None, "early"),
    )).collect()}
    assert got == {"a": ("complete", None), "b": ("error_rejected", "NO_DATA_ROWS"), "c": ("error_extraction", "early")}


@pytest.mark.parametrize(("valid", "invalid", "source", "columns", "width", "passed", "reason"), [
    (48, 2, 50, 3, 3, True, None), (10, 40, 50, 3, 3, False, "parsed cleanly"), (2, 0, 1000, 3, 3, False, "source rows"), (50, 0, 50, 4, 26, False, "columns"), (50, 0, 50, 25, 26, True, None), (0, 0, 10, 3, 3, False, "returned none"), (0, 0, 0, 3, 3, False, "no data rows"),
])
def test_thresholds(spark, valid, invalid, source, columns, width, passed, reason):
    names = [f"c{i}" for i in range(columns)]
    rows = spark.createDataFrame([("g", 0, i, i < valid, [] if i < valid else ["e"], names) for i in range(valid + invalid)], "guid string, sheet_index int, row_number long, valid boolean, errors array<string>, columns array<string>")
    profiles = spark.createDataFrame([("g", 0, width, names)], "guid string, sheet_index int, modal_field_count int, header_names array<string>")
    counts = spark.createDataFrame([("g", 0, source, 0)], "guid string, sheet_index int, source_rows long, skipped_wrong_shape long")
    got = evaluate(rows, counts, profiles).first()
    assert got.passed is passed and (reason is None or reason in got.failure_reason)


def test_batches_are_balanced(spark):
    d = table(spark, "/root/testdata/sf0.1", "documents").select(F.col("doc_id").cast("string").alias("guid"), F.col("n_chars").alias("body_length"))
    got = batching.balanced_batches(d, "body_length", 500).groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.sum("body_length").alias("s")).collect()
    mean = sum(r.s for r in got) / len(got)
    assert sum(r.n for r in got) == d.count() and len(got) == 20
    assert max(r.s for r in got) < 1.02 * mean and max(r.n for r in got) - min(r.n for r in got) <= 20


def test_lines_are_numbered_without_gaps(spark):
    """Columns beyond the sort key make the ranked exchange larger than one of keys only, which must not move its ranges."""
    keys = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("wide")).repartition(7)
        got = sorted((r.line, r.record.split(",")[0]) for r in readers.table_as_records(df, ["id"]).collect())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == [(0, "id"), *((i + 1, str(i)) for i in range(4000))]


def test_rows_of_one_key_are_placed_once(spark):
    d = spark.createDataFrame([("twin", 1000), ("twin", 1000), *((str(i), i) for i in range(300))], "guid string, body_length int")
    got = [tuple(r) for r in batching.balanced_batches(d, "body_length", 100).select("guid", "body_length").collect()]
    assert sorted(got) == sorted(tuple(r) for r in d.collect())


def test_batches_of_even_sizes_have_even_counts(spark):
    d = spark.range(3000).select(F.col("id").cast("string").alias("guid"), (F.col("id") * 7 % 997).alias("body_length"))
    got = batching.balanced_batches(d, "body_length", 100).groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.sum("body_length").alias("s")).collect()
    assert len(got) == 30 and {r.n for r in got} == {100} and max(r.s for r in got) - min(r.s for r in got) <= 997


@pytest.mark.parametrize("batches", [1, 10, 500, 501, 5000])
def test_batches_differ_by_the_largest_row_at_most_whatever_their_number(spark, batches):
    """Heavy-tailed sizes, a null and zeros among them."""
    n = batches * 30
    length = F.floor(F.pow(F.lit(1_000_003) / (1 + F.pmod(F.xxhash64("id"), F.lit(1_000_003))), F.lit(0.7))).cast("long")
    d = spark.range(n).select(F.col("id").cast("string").alias("guid"), F.when(F.col("id") % 50 == 0, 0).when(F.col("id") > 0, length).alias("body_length"))
    got = batching.balanced_batches(d, "body_length", 30).groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.sum("body_length").alias("s")).collect()
    most = d.agg(F.max("body_length")).first()[0]
    assert sorted(r.batch for r in got) == list(range(batches)) and sum(r.n for r in got) == n
    assert max(r.s for r in got) - min(r.s for r in got) <= 1.05 * most


def test_the_plan_of_the_head_is_bounded_by_the_classes():
    classes = [(10**6 + 7 * i, 1.01 ** (500 - i)) for i in range(500)]
    placed, order = batching.head_plan(classes, 10**7 + 3)
    assert sum(m for _, _, m in placed) == sum(c for c, _ in classes) and len(order) <= 501 and len(placed) <= 51 * 501
    assert sorted(f for _, f, _ in order)[0] == 0 and sum(m for _, _, m in order) == 10**7 + 3


def test_rejected_is_not_failed(spark):
    st = spark.createDataFrame([("a", "complete", None), ("b", "complete", None)], "guid string, status string, error_message string")
    led = spark.createDataFrame([("a", "rejected"), ("b", "failed")], "guid string, status string")
    assert {r.guid: r.status for r in status.park_failed(st, led).collect()} == {"a": "complete", "b": "error_extraction"}


def long(spark, *rows):
    return spark.createDataFrame([(g, 0, "s", n, True, [], 0, list(d), d) for g, n, d in rows], "guid string, sheet_index int, sheet_name string, row_number long, valid boolean, errors array<string>, extra_values long, columns array<string>, data map<string,string>")


@pytest.mark.parametrize("kind", ["bucket", "per_guid"])
def test_extractions_replace_themselves(spark, tmp_path, kind):
    path = str(tmp_path / "out")
    sinks.write_extractions(long(spark, ("a", 1, {"x": "1"}), ("b", 1, {"x": "2"}), ("c", 1, {"x": "3"})), path, kind, buckets=2)
    sinks.write_extractions(long(spark, ("a", 1, {"x": "9"}), ("a", 2, {"x": "8"})), path, kind, buckets=2)
    got = sorted((r.guid, r.row_number, r.data["x"]) for r in sinks.read_extraction(spark, path).collect())
    assert got == [("a", 1, "9"), ("a", 2, "8"), ("b", 1, "2"), ("c", 1, "3")]
    assert sinks.read_extraction(spark, path, "a", 0).count() == 2
    if kind == "bucket":
        sinks.delete_document(spark, path, "a")
        assert {r.guid for r in sinks.read_extraction(spark, path).collect()} == {"b", "c"}


def test_wide_tables_and_json(spark, tmp_path):
    rows = long(spark, ("a", 1, {"x": "1", "guid": "z"}), ("b", 1, {"y": None}))
    assert sinks.write_wide_by_shape(rows, str(tmp_path / "wide")) == 2
    with pytest.raises(ValueError):
        sinks.write_wide_by_shape(rows, str(tmp_path / "wide2"), most_shapes=1)
    at = F.lit("2024-03-04 05:06:07").cast("timestamp")
    sinks.write_ndjson(rows, str(tmp_path / "json"), "s", "r1", at)
    got = spark.read.json(str(tmp_path / "json"))
    assert {str(r.dt) for r in got.collect()} == {"2024-03-04"} and {"EXTRACTED_AT", "guid", "source", "run"} <= set(got.columns)
    sinks.append_corpus(rows, str(tmp_path / "corpus"), at)
    assert spark.read.parquet(str(tmp_path / "corpus")).count() == 2
    assert sinks.coerce_output(rows.withColumn("row_number", F.lit("x"))).first().row_number is None


def test_sources(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("é,b\n1,2".encode("latin-1"))
    got = readers.read_text_documents(spark, str(tmp_path / "a.txt"), "ISO-8859-1").first()
    assert got.body_text == "é,b\n1,2" and got.body_length == 7
    docs = spark.createDataFrame([("a", "Name,SSN,DOB,IBAN,Phone,e-mail\n1", 10, False), ("b", "x", 5, False), ("c", None, 0, False), ("d", "name ssn dob iban phone", 30, True)], "guid string, body_text string, body_length int, is_duplicate boolean")
    assert [r.guid for r in readers.rank_by_header(docs).collect()] == ["a"]
    assert {r.guid for r in readers.scan_population(docs).collect()} == {"a", "b", "d"}


def test_streams_drain_and_flush(spark, tmp_path):
    docs = spark.createDataFrame([("a", "id,name\n\n1,Ann\n\n2,Bob"), ("b", "prose only")], "guid string, body_text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "in"))
    schema = "guid string, body_text string"

    def work(batch):
        done = jobs.extract(batch)
        return done.rows, done.documents.select("guid", F.col("outcome").alias("status"), F.col("reason").alias("error_message"), F.current_timestamp().alias("staged_at"))

    for _ in range(2):  # the second run finds nothing new
        drain.drain(drain.document_stream(spark, str(tmp_path / "in"), schema), work, str(tmp_path / "out"), str(tmp_path / "verdicts"), str(tmp_path / "cp")).awaitTermination()
    assert sinks.read_batches(spark, str(tmp_path / "out")).count() == 2
    verdicts = spark.read.parquet(str(tmp_path / "verdicts"))
    assert {r.guid: r.status for r in verdicts.collect()} == {"a": "complete", "b": "error_rejected"}
    spark.createDataFrame([("a", "pending", None), ("c", "pending", None)], "guid string, status string, error_message string").write.parquet(str(tmp_path / "status/base"))
    flow = spark.readStream.schema("guid string, status string, error_message string, staged_at timestamp").parquet(str(tmp_path / "verdicts/*"))
    drain.flush_verdicts(flow, str(tmp_path / "status"), str(tmp_path / "cp2")).awaitTermination()
    assert {r.guid: r.status for r in drain.read_status(spark, str(tmp_path / "status")).collect()} == {"a": "complete", "b": "error_rejected", "c": "pending"}


def test_first_writer_wins(spark):
    shared = spark.createDataFrame([("x", 1, "s")], "schema_hash string, created_at int, code string")
    local = spark.createDataFrame([("x", 0, "l"), ("y", 2, "late"), ("y", 1, "early")], "schema_hash string, created_at int, code string")
    assert {(r.schema_hash, r.code) for r in status.merge_first(shared, local).collect()} == {("x", "s"), ("y", "early")}


def test_a_later_batch_writes_its_own_rows_only(spark, tmp_path):
    out = str(tmp_path / "out")
    sinks.write_batch(long(spark, ("a", 1, {"x": "1"}), ("b", 1, {"x": "2"})), out, 0)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    for _ in range(2):  # a repeated batch replaces itself
        sinks.write_batch(long(spark, ("a", 1, {"x": "9"})), out, 1)
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    assert {(r.guid, r.data["x"]) for r in sinks.read_batches(spark, out).collect()} == {("a", "9"), ("b", "2")}
    assert sinks.files_written(spark, out).first().files == len(list(tmp_path.rglob("*.parquet")))


def test_repeated_guids_on_the_right_repeat_nothing(spark):
    left = spark.createDataFrame([("a", "pending"), ("b", "pending")], "guid string, status string")
    twice = spark.createDataFrame([("a", "complete"), ("a", "error_x"), ("c", "complete"), ("c", "complete")], "guid string, status string")
    for merge in (status.merge_verdicts, status.merge_population):
        assert sorted((r.guid, r.status) for r in merge(left, twice).collect()) == [("a", "complete"), ("b", "pending"), ("c", "complete")]
    passed, rejected = status.gate_document_type(left.select("guid"), twice.select("guid", F.col("status").alias("document_type")))
    assert passed.count() + rejected.count() == 2
    names = status.outside_names(left)
    assert status.apply_verdicts(twice, left, names).count() == 2

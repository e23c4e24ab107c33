"""Further columns of whatever names come back as they were; the whole pipeline on odd and on empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm.exact_dedup import DigestIndex, first_of_group
from gridloom.llm.near_text import first_of_similar
from gridloom.llm.simhash import first_of_component

NAMES = ["_id", "_digest", "_s", "_set", "_size", "_bits", "_fp", "a.b", "a b", "tick`ed", "doc", "id", "digest", "fp", "size", "bits", "component", "first_id", "ids"]
LONG = " ".join(f"word{i}" for i in range(400))
TEXTS = [(1, LONG), (2, LONG), (3, LONG + " more"), (4, "something else entirely, and a bit longer than five words"), (5, None), (6, ""), (None, "no id"), (7, " ".join(f"other{i}" for i in range(20_000)))]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, t, *[f"{n}{k}" for n in range(len(NAMES))]) for k, (i, t) in enumerate(TEXTS)]
    quoted = ", ".join(f"`{n.replace('`', '``')}` string" for n in NAMES)
    return spark.createDataFrame(rows, f"doc_id long, text string, {quoted}").repartition(3)


@pytest.mark.parametrize("keep", [lambda d: first_of_group(d, DigestIndex(d.sparkSession, buckets=4)), first_of_similar, first_of_component], ids=["exact", "similar", "simhash"])
def test_all_columns_come_back_unharmed(clashing, keep):
    kept = keep(clashing)
    assert kept.columns == clashing.columns
    given = {tuple(r) for r in clashing.collect()}
    got = [tuple(r) for r in kept.collect()]
    assert set(got) <= given and len(set(got)) == len(got) and {r[0] for r in got} >= {1, 4, 7} and 2 not in {r[0] for r in got}


@pytest.mark.parametrize("rows", [TEXTS + TEXTS[:3], []], ids=["odd", "empty"])
def test_the_whole_pipeline_on_odd_tables(spark, tmp_path, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _id string, `a.b` int"
    spark.createDataFrame([(i, t, "en", None, 3, "x", 1) for i, t in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "_id", "a.b"]
    assert {r.doc_id for r in docs.collect()} == ({1, 4, 5, None, 7} if rows else set())
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == ({1, 4, 5, None, 7} if rows else set())
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0

"""Every query that has SQL gives what DuckDB gives."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ran = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in ran.description]
    want = ran.fetchall()
    df = entry.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    got = [tuple(plain(r[c]) for c in names) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(repr(tuple(map(plain, r))) for r in want)


@pytest.mark.parametrize("name", ["pii_population", "population_selected"])
def test_populations_same_as_sql_beyond_ascii(spark, tmp_path, name):
    """Large tables hold texts where a letter beyond ASCII follows, or lies in, what looks like a street."""
    texts = ["wer 27.114.252.130 die stöen, der", "ruf +1 (944) 555-6250 ung den enteßö st. ende", "ab 77.250.53.96 das ist die stßä", "via\n12", "plain words", "ssn"]
    rows = [(i, texts[i // 4], "de", "src1", len(texts[i // 4])) for i in range(4 * len(texts))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    ran = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in ran.description]
    assert sorted(map(tuple, entry.queries()[name](spark, str(tmp_path)).select(names).collect())) == sorted(ran.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0

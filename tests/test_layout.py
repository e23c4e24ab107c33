"""Layout detection and extraction on literal sheets."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions.cells import split_cells, unique_names
from gridloom.functions.text import format_hint, header_score, sheet_slug, value_shape
from gridloom.operators.extract import Parsers, data_cells, extract_rows, extract_with, kept_counts, kept_rows, sheet_rows, source_counts
from gridloom.operators.layout import SPEC_SCHEMA, profile_sheets
from gridloom.operators.row_kernel import quoted_split
from gridloom.operators.sheets import split_sheets
from gridloom.plans.jobs import extract


def profile(spark, *sheets):
    df = spark.createDataFrame([("g", i, n, r) for i, (n, r) in enumerate(sheets)], "guid string, sheet_index int, sheet_name string, records array<string>")
    return profile_sheets(df)


def test_quoted_and_json_documents_are_judged(spark, tmp_path):
    """The queries over all documents: quoted cells as Python's csv module splits them, the json hint, no document lost."""
    import csv

    from gridloom import queries

    quoted = ['"a, b, c";x;y', '"d, e";z;w', '"f";"g; h";i']
    texts = ["\n".join(quoted), '"p|q","r|s"\n"t|u","v|w"', 'plain words "said" here', '{"k": 1}\n{"k": 2}', "[1, 2]\n[3, 4]\nx", "a,b\n{c"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    votes = {r.doc_id: (r.delimiter_name, r.confidence) for r in queries.QUERIES["all_delimiter_votes"](spark, str(tmp_path)).collect()}

    def vote(text):
        best = ("unknown", 0.0)
        for d, name in ((",", "comma"), ("|", "pipe"), ("\t", "tab"), (";", "semicolon")):
            all_widths = [len(x) for x in csv.reader(text.split("\n"), delimiter=d)]
            widths = [w for w in all_widths if w > 1]
            if widths:
                w = max(widths, key=widths.count)
                score = widths.count(w) / len(all_widths) * min(1.0, 0.5 + w / 20)
                best = (name, score) if score > best[1] else best
        return best[0], round(best[1], 3)

    assert votes == {i: vote(t) for i, t in enumerate(texts)} and votes[0][0] == "semicolon"
    hints = {r.doc_id: r.hint for r in queries.QUERIES["all_format_hints"](spark, str(tmp_path)).collect()}
    assert len(hints) == len(texts) and hints[3] == hints[4] == "json" and hints[5] == "csv"
    given = "/root/testdata/sf0.001"
    for name in ("delimiter_votes", "format_hints"):
        whole = queries.QUERIES[f"all_{name}"](spark, given)
        assert whole.count() == spark.read.parquet(f"{given}/documents.parquet").count() and queries.QUERIES[name](spark, given).subtract(whole).count() == 0


def test_profiles(spark):
    rows = profile(
        spark,
        (None, ["employee_id,first_name,last_name,email", "1,Ann,Lee,ann@x.com", "2,Bob,Ray,bob@x.com"]),
        (None, ["id|full name|city", "1|Smith, John|Rome", "2|Roe, Jane|Oslo"]),
        (None, ["a,b,c,d", "w,x,y,z", "w,x,y", "w,x,y,z"]),
        (None, ["Monthly Report", "id,name,total", "1,Ann,20", "2,Bob,30"]),
        (None, ["1001,Ann,a@x.com,5", "1002,Bob,b@x.com,6", "1003,Cid,c@x.com,7"]),
        ("Username,WD ID,Asset", ["ann,1234,99", "bob,1235,98", "cid,1236,97"]),
        (None, ["Report of the month", "Address line", "Some text, here", "More", "Even more", "The end"]),
        (None, []),
        (None, ['id,note', '1,"a, b"', '2,"c ""q"""']),
        (None, ["id,when,n@x.com", "1,2024-01-02,a@x.com", "2,2024-01-03,b@x.com"]),
    ).orderBy("sheet_index").collect()
    assert (rows[0].delimiter, rows[0].header_names, rows[0].ragged, rows[0].header_row_index) == (",", ["employee_id", "first_name", "last_name", "email"], False, 0)
    assert (rows[1].delimiter, rows[1].modal_field_count, rows[1].header_names[1]) == ("|", 3, "full name")
    assert (rows[2].ragged, rows[2].min_field_count, rows[2].max_field_count, rows[2].modal_field_count) == (True, 3, 4, 4)
    assert rows[3].header_row_index == 1 and rows[3].header_names == ["id", "name", "total"]
    assert (rows[4].header_source, rows[4].header_row_index, rows[4].header_names) == ("positional", -1, ["column_0", "column_1", "column_2", "column_3"])
    assert (rows[5].header_source, rows[5].header_row_index, rows[5].header_names) == ("sheet_name", -1, ["Username", "WD ID", "Asset"])
    assert rows[6].rejection_code == "SINGLE_COLUMN"
    assert rows[7].rejection_code == "NO_DATA_ROWS"
    assert rows[8].quote_char == '"' and rows[8].quoted_field_rows == 2
    assert rows[9].leaked_header_cells == [2]


def test_unique_names(spark):
    df = spark.createDataFrame([(["agent", "team", "", None, "total"],), (["team", "THU", "FRI", "THU", "FRI"],), (["a", "a", "a_2"],)], "h array<string>")
    got = [r[0] for r in df.select(unique_names(F.col("h"))).collect()]
    assert got == [["agent", "team", "column_2", "column_3", "total"], ["team", "THU", "FRI", "THU_2", "FRI_2"], ["a", "a_2", "a_2__2"]]


def test_quoted_cells(spark):
    df = spark.createDataFrame([(['1,"a, b",c', 'x,y"z,"', 'p,"open, q'],), (["1,2"],)], "r array<string>")
    got = [r[0] for r in df.select(split_cells(F.col("r"), F.lit(","), F.lit('"'))).collect()]
    assert got[0] == [["1", "a, b", "c"], ["x", 'y"z', ""], ["p", "open, q"]] and got[1] == [["1", "2"]]


def rows_of(spark, body, spec=None):
    docs = spark.createDataFrame([("g", body)], "guid string, body_text string")
    specs = None if spec is None else spark.createDataFrame([("g", 0, spec)], SPEC_SCHEMA)
    return extract(docs, specs)


def test_extraction(spark):
    got = rows_of(spark, "id,name,email\n\n1,John,john@x.com\n\n2,Jane,jane@x.com").rows.orderBy("row_number").collect()
    assert [r.data for r in got] == [{"id": "1", "name": "John", "email": "john@x.com"}, {"id": "2", "name": "Jane", "email": "jane@x.com"}]
    assert [r.row_number for r in got] == [2, 3]
    spec = lambda footer, names: ("table", (True, 0, 1, names), (footer > 0, footer, [], None), ("comma", None, None, ["N/A"]), (False, False))
    footed = rows_of(spark, "id,name\n1,John\n2,N/A\nTotal: 2 rows\nConfidential", spec(2, []))
    assert sorted((r.data["id"], r.data["name"]) for r in footed.rows.collect()) == [("1", "John"), ("2", None)]
    wide = rows_of(spark, "a\n\n1,2,3\n\n4,5,6", spec(0, [])).rows.orderBy("row_number").first()
    assert wide.data == {"a": "1", "column_1": "2", "column_2": "3"} and wide.extra_values == 2
    trimmed = rows_of(spark, "id,name,shift\n\n  10259240 ,,Adam\n\n 7 , Bo , 08:00-16:30 ").rows.orderBy("row_number").first()
    assert trimmed.data == {"id": "10259240", "name": None, "shift": "Adam"}
    assert rows_of(spark, "").documents.first().outcome == "error_rejected"


def test_user_parser(spark):
    docs = spark.createDataFrame([("g", "id,name\n\n1,John\n\nx,Jane")], "guid string, body_text string")
    profiles = profile_sheets(split_sheets(docs))
    shape = profiles.first().shape_hash
    cells = data_cells(profiles).withColumn("shape_hash", F.lit(shape))
    parsers = Parsers()
    parsers.register(shape, lambda row, n, nulls: [{"values": [str(int(row[0])), row[1] + " "]}, {"twice": int(row[0]) * 2}])
    got = extract_with(cells, parsers).orderBy("row_number", F.size("columns").desc()).collect()
    assert [r.valid for r in got] == [True, True, False] and got[0].data == {"id": "1", "name": "John"} and got[1].data == {"twice": "2"} and "invalid literal" in got[2].errors[0]
    assert extract_rows(cells).count() == 2


def test_text_functions(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    shapes = {"3f2504e0-4f89-11d3-9a0c-0305e82c3301": "uuid", "a@b.co": "email", "2024-01-02 10:30": "datetime", "1/2/2024": "date", "10:30": "time", "1,234.5": "number", "Smith, John": "comma_name", "0123456789abcdef0": "hex_id", "word": None, "": None}
    assert {k: one(value_shape(F.lit(k))) for k in shapes} == shapes
    assert one(format_hint(F.array(F.lit("title"), F.lit("a|b"), F.lit("c|d")))) == "pipe"
    assert one(format_hint(F.array().cast("array<string>"))) == "unknown"
    assert one(header_score(F.lit("id,name,12"))) == 3.5
    assert one(header_score(F.lit("  "))) == -1.0
    assert one(sheet_slug(F.lit("Q1 / Sales (é)"))) == "Q1_Sales" and one(sheet_slug(F.lit("///"))) == "unnamed"


def test_the_kernel_gives_what_column_functions_give(spark):
    """Over all delimiters, quotes, null tokens, narrow and wide rows, and sheets that end in the middle of a batch."""
    draw = random.Random(4)
    cells = ["a", "  b ", '"q"', '"x, y"', '"un', "12", "", "N/A", 'd"d', '"a""b"', '"c"tail', "é\u2003", "column_3", "'z, z'"]
    docs = []
    for g in range(60):
        d, w = draw.choice(",|;\t"), draw.choice([2, 3, 5])
        body = [d.join(f"h{i}" for i in range(w))] + [d.join(draw.choice(cells) for _ in range(draw.choice([w, w, w, w - 1, w + 2, 1]))) for _ in range(draw.randint(0, 30))]
        docs.append((str(g), "\n\n".join(body)))
    profiles = profile_sheets(split_sheets(spark.createDataFrame(docs, "guid string, body_text string").repartition(3)))
    profiles = profiles.withColumn("null_values", F.when(F.col("guid").cast("int") % 3 == 0, F.array(F.lit("N/A"))).otherwise(F.col("null_values")))
    flat = lambda df: sorted((r.guid, r.sheet_index, r.sheet_name, r.row_number, r.valid, r.errors, r.extra_values, r.columns, sorted(r.data.items(), key=repr)) for r in df.collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        want, got = flat(extract_rows(data_cells(profiles))), flat(kept_rows(sheet_rows(profiles)))
        counts = [sorted(map(tuple, f.collect())) for f in (source_counts(data_cells(profiles)), kept_counts(sheet_rows(profiles)))]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want and len(got) > 300 and counts[0] == counts[1] and any(c[3] for c in counts[0])


@pytest.mark.parametrize("record", ['1,"a, b",c', 'x,y"z,"', 'p,"open, q', "", ",", '"",""', '"a""b",c', '"c"tail,d', '"""x"""', "a,", '"'])
def test_the_kernel_quotes_as_the_pattern_does(spark, record):
    want = spark.createDataFrame([([record],)], "r array<string>").select(split_cells(F.col("r"), F.lit(","), F.lit('"'))).first()[0][0]
    assert quoted_split(record, ",", '"') == want

import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions.text import SHEET_MARKER
from gridloom.operators import sheets
from gridloom.sources import ranges


@pytest.fixture
def small_ranges(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "37b")
    yield
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def made_up(seed):
    random.seed(seed)
    m = SHEET_MARKER
    bodies = []
    for _ in range(60):
        share = random.choice([0, 0.2, 0.5, 0.95])
        line = lambda: random.choice([f"s{random.randint(1, 9)}{m}", f"a,b{m}"]) if random.random() < share else random.choice(["x", "p,q,r", "  ", "long " * 30, "ü​"])  # noqa: B023, E731
        gaps = random.choice([["\n"], ["\n\n"], ["\n", "\n\n", "\n\n\n", "\n\n\n\n", "\n" * 90]])
        bodies.append(random.choice(["", "", "\n", "\n\n"]) + "".join(line() + random.choice(gaps) for _ in range(random.randint(0, 30))) + random.choice(["", "end", f"end{m}"]))
    return [*bodies, "", "\n", "\n\n", "\n\n\n", f"one{m}", f"one{m}\n\na,b{m}\n\nr", "a\nb", "x\r\n\r\ny"]


@pytest.mark.parametrize("seed", [1, 2])
def test_ranges_give_the_records_of_whole_documents(spark, small_ranges, tmp_path, seed):
    bodies = made_up(seed)
    for i, body in enumerate(bodies):
        (tmp_path / f"d{i}.txt").write_bytes(body.encode())
    # A file's last line feed ends its last line.
    docs = spark.createDataFrame([(str(i), b[:-1] if b.endswith("\n") else b) for i, b in enumerate(bodies)], "guid string, body_text string")
    want = {tuple(r) for r in sheets.records(sheets.split_sheets(docs)).select("guid", "sheet_index", "sheet_name", "line", "record").collect()}
    lines = ranges.lines_of_files(spark, str(tmp_path))
    assert lines.select("guid", "range").distinct().count() > 2 * len(bodies)
    got = ranges.records_of_files(spark, str(tmp_path)).withColumn("guid", F.regexp_extract("guid", r"d(\d+)\.txt", 1)).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == want

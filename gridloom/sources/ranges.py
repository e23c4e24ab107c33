"""Documents too large for one cell: files read by byte ranges, their sheets found again from summaries of the ranges.

Spark reads a text file in ranges, each a task, which start and end at line feeds. What a range can't know of those
before it, whether a row goes on, which sheet is open, and how many records it has, follows from one summary row a range
by running totals; only these, a row for each ``spark.sql.files.maxPartitionBytes`` of a file, meet in order. Text is
shuffled by range, never by document, so no task holds more than a range and no cell more than a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.text import MOST_MARKED, clean_row, has_two_cells, is_marker, without_marker
from gridloom.operators.batching import _written

RANGE = ["guid", "range"]


def _before(order: str = "range") -> Window:
    return Window.partitionBy("guid").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _total_before(c: str) -> Column:
    return F.coalesce(F.sum(c).over(_before()), F.lit(0))


def lines_of_files(spark: SparkSession, path: str) -> DataFrame:
    """(guid = file path, range = its first byte, at, line): UTF-8 files' lines, ``at`` ascending within a range."""
    files = spark.read.option("lineSep", "\n").text(path)
    return files.select(F.col("_metadata.file_path").alias("guid"), F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def rows_of_lines(lines: DataFrame) -> DataFrame:
    """(guid, range, row, text, n_rows): the rows of ``functions.text.rows_of`` that have text, numbered from 0 in each
    document, and the number of all of its rows; ``range`` is that in which a row starts.

    Two line feeds end a row, the first two that meet. So a gap of blank lines before a line of text ends (gap + 1) / 2
    rows, and an odd line feed leads the next; at the start of a document it has one line feed less.
    """
    w = Window.partitionBy(*RANGE).orderBy("at")
    seen = lines.withColumn("n", F.row_number().over(w) - 1).withColumn("size", F.count(F.lit(1)).over(Window.partitionBy(*RANGE)))
    text = seen.withColumn("last", F.max(F.when(F.col("line") != "", F.col("n"))).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    text = text.withColumn("gap", F.col("n") - F.coalesce("last", F.lit(-1)) - 1).withColumn("first", F.col("last").isNull() & (F.col("line") != ""))
    ends = F.when((F.col("line") != "") & ~F.col("first"), F.floor((F.col("gap") + 1) / 2)).otherwise(0)
    held = _written(text.withColumn("ends", F.sum(ends).over(w)).select(*RANGE, "n", "size", "gap", "first", "ends", "line"))

    filled = F.col("line") != ""
    ranges = held.groupBy(*RANGE).agg(
        F.max("size").alias("size"), F.count_if(~filled).alias("blanks"), F.max("ends").alias("inner"), F.max(F.when(F.col("first"), F.col("gap"))).alias("lead"), (F.max("size") - F.max(F.when(filled, F.col("n"))) - 1).alias("tail")
    )
    # Blank lines since the last text: those of whole blank ranges, and the end of the last one with text.
    had = F.coalesce(F.max(F.when(F.col("tail").isNotNull(), F.col("range"))).over(_before()), F.lit(-1))
    ranges = ranges.withColumn("lines_before", _total_before("size")).withColumn("had", had)
    open_lines = F.last(F.when(F.col("tail").isNotNull(), F.col("lines_before") + F.col("size") - F.col("tail")), ignorenulls=True).over(_before())
    ranges = ranges.withColumn("blank_before", F.col("lines_before") - F.coalesce(open_lines, F.lit(0)))
    feeds = F.col("blank_before") + F.col("lead") + (F.col("had") >= 0).cast("int")
    ranges = ranges.withColumn("odd", feeds % 2).withColumn("lead_ends", F.coalesce(F.floor(feeds / 2), F.lit(0))).withColumn("ends_here", F.col("lead_ends") + F.col("inner"))
    ranges = ranges.withColumn("rows_before", _total_before("ends_here"))
    whole = Window.partitionBy("guid")
    total, last_text = F.sum("size").over(whole), F.max(F.when(F.col("tail").isNotNull(), F.col("lines_before") + F.col("size") - F.col("tail"))).over(whole)
    end_feeds = total - F.coalesce(last_text, F.lit(1))
    first_blank = F.max(F.when((F.col("lines_before") == 0) & (F.coalesce("lead", F.lit(1)) > 0), 1).otherwise(0)).over(whole)
    last_blank = F.when((total > 1) & (end_feeds > 0), 1).otherwise(0)
    ranges = ranges.withColumn("parted", F.sum("blanks").over(whole) - first_blank - last_blank > 0)
    ranges = ranges.withColumn("n_rows", F.when(F.col("parted"), F.sum("ends_here").over(whole) + F.floor(end_feeds / 2) + 1).otherwise(total))
    ranges = ranges.withColumn("last_line", last_text - 1).withColumn("end_odd", F.col("parted") & (end_feeds == 1))
    ranges = ranges.select(*RANGE, "lines_before", "rows_before", "lead_ends", "odd", "parted", "n_rows", "last_line", "end_odd")

    met = held.filter(filled).join(ranges, RANGE)
    number = F.col("lines_before") + F.col("n")
    feed = F.when(F.col("first"), F.col("odd")).otherwise((F.col("gap") + 1) % 2) == 1  # within a row too
    piece = F.concat(F.when(F.col("parted") & feed, "\n").otherwise(""), F.col("line"), F.when(F.col("end_odd") & (number == F.col("last_line")), "\n").otherwise(""))
    row = F.when(F.col("parted"), F.col("rows_before") + F.col("lead_ends") + F.col("ends")).otherwise(number)
    pieces = met.select(*RANGE, row.cast("long").alias("row"), "n", piece.alias("piece"), F.col("n_rows").cast("long").alias("n_rows"), (F.col("parted") & (F.col("ends") == 0)).alias("head"))
    joined = lambda c, by: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, c))), lambda x: x[c]), "")
    here = pieces.groupBy(*RANGE, "row", "n_rows").agg(joined("piece", "n").alias("piece"), F.bool_or("head").alias("head"))
    # Only the first and last rows of a range may go on in another.
    here = here.withColumn("edge", F.col("head") | (F.col("row") == F.max("row").over(Window.partitionBy(*RANGE))))
    inside = here.filter(~F.col("edge")).select(*RANGE, "row", F.col("piece").alias("text"), "n_rows")
    across = here.filter("edge").groupBy("guid", "row", "n_rows").agg(F.min("range").alias("range"), joined("piece", "range").alias("text"))
    return inside.unionByName(across.select(*RANGE, "row", "text", "n_rows"))


def records_of_files(spark: SparkSession, path: str) -> DataFrame:
    """(guid, sheet_index, sheet_name, line, record): what ``sheets.records(sheets.split_sheets(...))`` gives for the files'
    contents, at any size of a file or sheet. A file's last line feed ends its last line. Empty files have no record."""
    rows = _written(rows_of_lines(lines_of_files(spark, path)))
    marked = rows.groupBy("guid").agg((F.count_if(is_marker(F.col("text"))) / F.max("n_rows") <= MOST_MARKED).alias("workbook"))
    w = Window.partitionBy(*RANGE).orderBy("row")
    sides = rows.groupBy(*RANGE).agg(F.max_by(F.struct("row", is_marker(F.col("text")).alias("marker")), "row").alias("end"))
    sides = sides.withColumn("end", F.lag("end").over(Window.partitionBy("guid").orderBy("range"))).join(marked, "guid")
    this = F.struct("row", is_marker(F.col("text")).alias("marker"))
    seen = rows.join(sides, RANGE).withColumn("prior", F.coalesce(F.lag(this).over(w), F.col("end")))
    marker, follows = is_marker(F.col("text")), F.coalesce(F.col("prior.marker") & (F.col("prior.row") == F.col("row") - 1), F.lit(False))
    seen = seen.withColumn("starts", F.col("workbook") & marker & ~(follows & has_two_cells(without_marker(F.col("text")))))
    record = F.when(~F.col("starts") & (F.col("workbook") | ~marker), clean_row(without_marker(F.col("text"))))
    seen = seen.withColumn("part", F.count_if("starts").over(w)).withColumn("sheet_name", F.last(F.when(F.col("starts"), without_marker(F.col("text"))), ignorenulls=True).over(w))
    cut = _written(seen.select(*RANGE, "row", "part", "sheet_name", record.alias("record")))

    filled = F.coalesce(F.col("record") != "", F.lit(False))
    ranges = cut.groupBy(*RANGE).agg(F.max("part").alias("parts"), F.max_by("sheet_name", "row").alias("name"), F.count_if(filled & (F.col("part") == 0)).alias("open"))
    ranges = ranges.withColumn("parts_before", _total_before("parts")).withColumn("name_before", F.last("name", ignorenulls=True).over(_before()))
    ranges = ranges.withColumn("preamble", F.max(((F.col("parts_before") == 0) & (F.col("open") > 0)).cast("int")).over(Window.partitionBy("guid")))
    # Records of the sheet that is open at a range's start: all since the last range in which a sheet starts.
    tails = cut.filter(filled).groupBy(*RANGE, "part").agg(F.count(F.lit(1)).alias("records"))
    numbered = tails.join(ranges.select(*RANGE, "parts_before"), RANGE).withColumn("sheet", F.col("part") + F.col("parts_before"))
    carried = numbered.withColumn("lines_before", F.coalesce(F.sum("records").over(Window.partitionBy("guid", "sheet").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).filter("part = 0")
    ranges = ranges.join(carried.select(*RANGE, "lines_before"), RANGE, "left")
    many = F.max(F.col("parts") + F.col("parts_before")).over(Window.partitionBy("guid"))
    ranges = ranges.withColumn("shift", F.when((many > 0) & (F.col("preamble") == 0), 1).otherwise(0)).select(*RANGE, "parts_before", "name_before", "lines_before", "shift")
    order = Window.partitionBy(*RANGE, "part").orderBy("row")
    out = cut.filter(filled).withColumn("n", F.row_number().over(order) - 1).join(ranges, RANGE)
    line = F.col("n") + F.when(F.col("part") == 0, F.coalesce("lines_before", F.lit(0))).otherwise(0)
    index = F.col("part") + F.col("parts_before") - F.col("shift")
    return out.select("guid", index.cast("int").alias("sheet_index"), F.coalesce("sheet_name", "name_before").alias("sheet_name"), line.cast("long").alias("line"), "record")

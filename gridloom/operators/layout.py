"""The layout of worksheets: delimiter, quote, header, widths, rejections. One row in, one row out, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.cells import cell_counts, quote_vote, split_cells, unique_names
from gridloom.functions.text import DELIMITERS, REST, delimiter_char, header_score, let, looks_like_header, once, strip, value_shape

from .sheets import head_tail

#: Rows from the top that may hold the header, rows below it that judge it, distinctive columns needed, their share.
SEARCHED, BELOW, DISTINCTIVE, SHARE = 5, 8, 2, 0.7
#: Structure of a user's layout spec, a row for each sheet.
SPEC_SCHEMA = (
    "guid string, sheet_index int, spec struct<layout_type:string,"
    "head_bounds:struct<has_header:boolean,header_line_index:int,data_start_line_index:int,inferred_columns:array<string>>,"
    "tail_bounds:struct<has_footer:boolean,footer_start_from_bottom:int,footer_patterns:array<string>,data_end_strategy:string>,"
    "format_spec:struct<delimiter_type:string,delimiter_regex:string,quote_char:string,null_values:array<string>>,"
    "data_anomalies:struct<contains_inline_summaries:boolean,has_multiline_rows:boolean>>"
)


def votes(values: Column) -> Column:
    """array<struct<n, earliest, value>>: distinct values with their counts; ``earliest`` is greater for one seen first."""
    return let(
        values,
        lambda all_: F.transform(F.array_distinct(all_), lambda v: F.struct(F.size(F.filter(all_, lambda x: x == v)).alias("n"), (-F.array_position(all_, v)).alias("earliest"), v.alias("value"))),
    )


def mode(values: Column) -> Column:
    """struct<n, earliest, value>: the most frequent value, of equals the first seen."""
    return F.array_max(votes(values))


def table_width(widths: Column) -> Column:
    """The width that accounts for most cells among those seen twice or more, else the most frequent; ones below two
    count only where there are no others."""

    def chosen(found: Column) -> Column:
        heavy = F.array_max(F.transform(F.filter(found, lambda v: v["n"] >= 2), lambda v: F.struct((v["n"] * v["value"]).alias("mass"), v["earliest"], v["value"].alias("value"))))
        return F.coalesce(heavy["value"], F.array_max(found)["value"], F.lit(0))

    usable = let(F.filter(widths, lambda w: w >= 2), lambda wide: F.when(F.size(wide) > 0, wide).otherwise(widths))
    return let(votes(usable), chosen)


def width_profile(sheets: DataFrame, cells: str = "cells") -> DataFrame:
    """``sheets`` with modal_, min_ and max_field_count and ragged, of ``cells`` (array<array<string>>)."""
    widths = F.transform(cells, lambda r: F.size(r))
    return sheets.withColumn("_w", once(widths)).select("*", F.coalesce(mode(F.col("_w"))["value"], F.lit(0)).alias("modal_field_count"), F.array_min("_w").alias("min_field_count"), F.array_max("_w").alias("max_field_count"), (F.size(F.array_distinct("_w")) > 1).alias("ragged")).drop("_w")


def detect_delimiter(sheets: DataFrame, records: str = "records") -> DataFrame:
    """``sheets`` with delimiter, delimiter_name and delimiter_confidence (null, unknown, 0 where none splits).

    Each candidate scores the share of the first 50 records that agree on a width above one, weighted by that width;
    ties go to the earlier candidate.
    """
    first = F.slice(records, 1, 50)
    out = sheets
    for k, (d, _, _) in enumerate(DELIMITERS):
        out = out.withColumn(f"_m{k}", once(cell_counts(first, d)))
    modes = {f"_v{k}": once(mode(F.filter(f"_m{k}", lambda w: w > 1))) for k in range(len(DELIMITERS))}
    out = out.withColumns(modes)
    scored = [
        F.struct(
            F.coalesce((F.col(f"_v{k}.n") / F.size(f"_m{k}")) * F.least(F.lit(1.0), 0.5 + F.col(f"_v{k}.value") / 20), F.lit(0.0)).alias("confidence"),
            F.lit(-k).alias("order"),
            F.lit(d).alias("delimiter"),
            F.lit(name).alias("name"),
        )
        for k, (d, name, _) in enumerate(DELIMITERS)
    ]
    best = F.array_max(F.array(*scored))
    out = out.withColumn("_best", once(best)).drop(*[f"_{x}{k}" for x in "mv" for k in range(len(DELIMITERS))])
    found = F.col("_best.confidence") > 0
    return out.select(
        "*",
        F.when(found, F.col("_best.delimiter")).alias("delimiter"),
        F.when(found, F.col("_best.name")).otherwise("unknown").alias("delimiter_name"),
        F.col("_best.confidence").alias("delimiter_confidence"),
    ).drop("_best")


def detect_quote(sheets: DataFrame, records: str = "records") -> DataFrame:
    """``sheets`` (with delimiter) with quote_char and quoted_field_rows, judged on the first 20 records."""
    first = F.slice(records, 1, 20)
    vote = F.when(F.col("delimiter").isNotNull(), quote_vote(first, F.coalesce("delimiter", F.lit(","))))
    return sheets.withColumn("_q", once(vote)).select("*", F.col("_q.quote").alias("quote_char"), F.coalesce("_q.rows", F.lit(0)).alias("quoted_field_rows")).drop("_q")


def _matching_columns(shapes: Column, i: Column) -> Column:
    """array<boolean>: for row i's columns that have a distinctive shape below, whether the row's own cell shares it."""

    def column(below: Column, own: Column, c: Column) -> Column:
        seen = F.filter(F.transform(below, lambda r: F.get(r, c)), lambda x: x.isNotNull() & (x != "blank"))
        return let(seen, lambda x: F.struct(own.alias("own"), mode(x).alias("most"), F.size(x).alias("n")))

    columns = lambda below: F.transform(F.get(shapes, i), lambda own, c: column(below, own, c))
    distinctive = lambda x: (x["most"]["value"] != "text") & (x["most"]["n"] >= F.greatest(F.lit(1.0), x["n"] * 0.6))
    return F.transform(F.filter(let(F.slice(shapes, i + 2, BELOW), columns), distinctive), lambda x: x["own"] == x["most"]["value"])


def row_is_data(shapes: Column, i: Column) -> Column:
    """Whether row i resembles the columns beneath it; ``shapes`` has each cell's shape, text or blank."""
    return let(_matching_columns(shapes, i), lambda match: (F.size(match) >= DISTINCTIVE) & (F.size(F.filter(match, lambda m: m)) >= F.size(match) * SHARE))


def cell_shapes(cells: Column) -> Column:
    return F.transform(cells, lambda r: F.transform(r, lambda c: F.when(strip(c) == "", "blank").otherwise(F.coalesce(value_shape(c), F.lit("text")))))


def locate_header(sheets: DataFrame) -> DataFrame:
    """``sheets`` (with cells, sheet_name, delimiter, quote_char) with header_source (row, sheet_name, positional),
    header_row_index and header (cells).

    The first of the opening rows that reads like labels and comes before any that is data; else a sheet name of the
    table's width; else columns are numbered.
    """
    rows = F.col("cells")
    seen = sheets.withColumn("_shapes", once(cell_shapes(F.slice(rows, 1, SEARCHED + BELOW)))).withColumn("_widths", once(F.transform(rows, lambda r: F.size(r))))
    judged = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(SEARCHED - 1)), lambda i: (i < F.size(rows) - 1) & (F.size(F.get(rows, i)) >= 2)),
        lambda i: F.struct(i.alias("i"), row_is_data(F.col("_shapes"), i).alias("data"), looks_like_header(F.get(rows, i)).alias("labels")),
    )
    seen = seen.withColumn("_judged", once(judged))
    stop = F.coalesce(F.array_min(F.transform(F.filter("_judged", lambda j: j["data"]), lambda j: j["i"])), F.lit(SEARCHED))
    seen = seen.withColumn("_stop", once(stop))
    row = F.array_min(F.transform(F.filter("_judged", lambda j: j["labels"] & (j["i"] < F.col("_stop"))), lambda j: j["i"]))
    named = F.get(split_cells(F.array(F.coalesce("sheet_name", F.lit(""))), F.coalesce("delimiter", F.lit(",")), F.lit('"')), F.lit(0))
    seen = seen.withColumn("_row", once(row)).withColumn("_named", once(F.transform(named, lambda c: strip(c))))
    from_name = F.exists("_widths", lambda w: w >= 2) & (F.size("_named") == table_width(F.col("_widths"))) & looks_like_header(F.col("_named"))
    source = F.when(F.col("_row").isNotNull(), "row").when(from_name, "sheet_name").otherwise("positional")
    numbered = F.transform(F.sequence(F.lit(0), F.greatest(F.coalesce(mode(F.col("_widths"))["value"], F.lit(1)) - 1, F.lit(0))), lambda i: F.concat(F.lit("column_"), i.cast("string")))
    seen = seen.withColumn("header_source", once(source)).withColumn("header_row_index", once(F.coalesce("_row", F.lit(-1))))
    header = F.when(F.col("header_source") == "row", F.get(rows, F.col("_row"))).when(F.col("header_source") == "sheet_name", F.col("_named")).otherwise(numbered)
    return seen.withColumn("header", once(header)).drop("_shapes", "_widths", "_judged", "_stop", "_row", "_named")


def leaked_header_cells(header: Column, data: Column) -> Column:
    """array<int>: positions whose header has the shape of most of its column's first values."""

    def leaked(shape: Column, c: Column, shapes: Column) -> Column:
        seen = F.filter(F.transform(shapes, lambda r: F.get(r, c)), lambda s: s.isNotNull() & (s != "blank"))
        return let(seen, lambda x: F.when((F.size(x) > 0) & (F.size(F.filter(x, lambda s: s == shape)) >= F.greatest(F.lit(1.0), F.size(x) * 0.6)), c))

    found = let(cell_shapes(F.slice(data, 1, BELOW)), lambda shapes: F.transform(F.transform(header, value_shape), lambda s, c: F.when(s.isNotNull(), leaked(s, c, shapes))))
    return F.array_compact(found)


def reject_shape(profile: DataFrame) -> DataFrame:
    """``profile`` with rejection_code: NO_DATA_ROWS, NO_DELIMITER_FOUND or SINGLE_COLUMN (over half the rows hold one
    field), else null."""
    single = F.size(F.filter("data_widths", lambda w: w < 2)) > F.size("data_widths") * 0.5
    code = F.when(F.size("records") == 0, "NO_DATA_ROWS").when(F.col("delimiter").isNull(), "NO_DELIMITER_FOUND").when(F.size("data_widths") == 0, "NO_DATA_ROWS").when(single, "SINGLE_COLUMN")
    return profile.withColumn("rejection_code", code)


def reject_layout(spec: Column) -> Column:
    """The rejection code that a spec's layout type means, else null."""
    return F.when(spec["layout_type"] == "no_data", "NO_DATA_ROWS").when(spec["layout_type"] == "prose_or_report", "NOT_TABULAR")


def shape_hash(delimiter: Column, has_header: Column, ragged: Column) -> Column:
    """Sixteen hex digits that sheets of one shape share."""
    text = F.concat(F.lit('{"delimiter": "'), F.replace(delimiter, F.lit("\t"), F.lit("\\t")), F.lit('", "has_header": '), has_header.cast("string"), F.lit(', "ragged": '), ragged.cast("string"), F.lit("}"))
    return F.substring(F.sha2(text, 256), 1, 16)


def profile_sheets(sheets: DataFrame, head: int = 40, tail: int = 20) -> DataFrame:
    """``sheets`` (guid, sheet_index, sheet_name, records) with their layout report, from a slice of each sheet's
    first and last records."""
    sliced = head_tail(sheets, head, tail).withColumn("_all", F.col("records")).withColumn("records", once(F.transform("sample", lambda x: x["record"])))
    found = detect_quote(detect_delimiter(sliced))
    delimiter = F.coalesce("delimiter", F.lit(","))
    cells = F.transform(split_cells(F.col("records"), delimiter, F.col("quote_char")), lambda r: F.transform(r, lambda c: strip(c)))
    found = locate_header(found.withColumn("cells", once(cells)))
    found = found.withColumn("data", once(F.slice("cells", F.col("header_row_index") + 2, REST))).withColumn("data_widths", once(F.transform("data", lambda r: F.size(r))))
    found = reject_shape(found).withColumn("header_names", once(unique_names(F.col("header"))))
    return found.select(
        "guid", "sheet_index", "sheet_name", F.col("_all").alias("records"), "delimiter", "delimiter_name", F.round("delimiter_confidence", 3).alias("delimiter_confidence"), "quote_char", "quoted_field_rows",
        "header_source", "header_row_index", "header_names", leaked_header_cells(F.col("header_names"), F.col("data")).alias("leaked_header_cells"),
        table_width(F.col("data_widths")).alias("modal_field_count"), F.array_min("data_widths").alias("min_field_count"), F.array_max("data_widths").alias("max_field_count"),
        (F.size(F.array_distinct("data_widths")) > 1).alias("ragged"), F.lit(0).alias("footer_start_from_bottom"), F.array().cast("array<string>").alias("null_values"), "rejection_code",
        shape_hash(delimiter, F.col("header_source") == "row", F.size(F.array_distinct("data_widths")) > 1).alias("shape_hash"),
    )


def with_spec(profiles: DataFrame, specs: DataFrame) -> DataFrame:
    """``profiles`` where a spec table (``SPEC_SCHEMA``) overrides what was detected.

    Header names come from the header's own line where the spec names one, never from the spec's list; that list is
    used where there is no header line.
    """
    met = profiles.join(specs, ["guid", "sheet_index"], "left")
    spec, given = F.col("spec"), F.col("spec").isNotNull()
    delimiter = F.when(given, delimiter_char(spec["format_spec"]["delimiter_type"])).otherwise(F.col("delimiter"))
    quote = F.when(given, spec["format_spec"]["quote_char"]).otherwise(F.col("quote_char"))
    met = met.withColumn("delimiter", once(delimiter)).withColumn("quote_char", once(quote))
    index = F.when(given, F.when(spec["head_bounds"]["has_header"], spec["head_bounds"]["header_line_index"]).otherwise(-1)).otherwise(F.col("header_row_index"))
    met = met.withColumn("header_row_index", once(index))
    line = F.get(split_cells(F.slice("records", F.greatest(F.col("header_row_index"), F.lit(0)) + 1, 1), F.coalesce("delimiter", F.lit(",")), F.col("quote_char")), F.lit(0))
    names = F.when(given & (F.col("header_row_index") >= 0), unique_names(line)).when(given, unique_names(spec["head_bounds"]["inferred_columns"])).otherwise(F.col("header_names"))
    return (
        met.withColumn("header_names", once(names))
        .withColumn("header_source", F.when(given, F.when(F.col("header_row_index") >= 0, "row").otherwise("spec")).otherwise(F.col("header_source")))
        .withColumn("footer_start_from_bottom", F.coalesce(F.when(spec["tail_bounds"]["has_footer"], spec["tail_bounds"]["footer_start_from_bottom"]), F.col("footer_start_from_bottom")))
        .withColumn("null_values", F.coalesce(spec["format_spec"]["null_values"], F.col("null_values")))
        .withColumn("rejection_code", F.when(given, reject_layout(spec)).otherwise(F.col("rejection_code")))
        .drop("spec")
    )


def find_header(lines: Column) -> Column:
    """Index of the line, of the first ten, that scores best as a header; the first of equals."""
    scored = F.transform(F.slice(lines, 1, 10), lambda x, i: F.struct(header_score(x).alias("score"), (-i).alias("order")))
    return F.coalesce(-F.array_max(scored)["order"], F.lit(0))

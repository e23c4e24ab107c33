"""Rows out of worksheets, by their layout."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.cells import name_cells, parse_cells, record_cells
from gridloom.functions.text import once
from gridloom.operators.row_kernel import name_records

ROW_SCHEMA = "guid string, sheet_index int, sheet_name string, row_number long, valid boolean, errors array<string>, extra_values long, columns array<string>, data map<string,string>"


def data_cells(profiles: DataFrame) -> DataFrame:
    """One row for each data record: guid, sheet_index, sheet_name, line, cells and the layout's columns.

    Records down to the header and the footer's are left out; all are where the footer is as long as the data.    """
    header, footer, n = F.col("header_row_index"), F.col("footer_start_from_bottom"), F.size("records")
    data = F.slice("records", header + 2, F.greatest(n - header - 1 - footer, F.lit(0)))
    rows = profiles.filter(F.col("rejection_code").isNull()).select(
        "guid", "sheet_index", "sheet_name", "delimiter", F.coalesce("quote_char", F.lit('"')).alias("quote"), "header_names", "modal_field_count", "null_values", header.alias("_h"), F.posexplode(data).alias("_at", "record")
    )
    cells = record_cells(F.col("record"), F.col("delimiter"), F.col("quote"))
    return rows.withColumn("line", F.col("_at") + F.col("_h") + 1).withColumn("cells", once(cells)).drop("_h", "_at", "record")


def wide_enough(modal: str = "modal_field_count") -> F.Column:
    """Rows narrower than half the table's width belong to something else on the sheet."""
    return F.size("cells") >= F.greatest(F.lit(1), F.floor(F.col(modal) * 0.5))


def drop_wrong_shape(rows: DataFrame) -> DataFrame:
    return rows.filter(wide_enough())


def source_counts(rows: DataFrame) -> DataFrame:
    """(guid, sheet_index, source_rows, skipped_wrong_shape) of ``data_cells``."""
    return rows.groupBy("guid", "sheet_index").agg(F.count_if(wide_enough()).alias("source_rows"), F.count_if(~wide_enough()).alias("skipped_wrong_shape"))


def extract_rows(rows: DataFrame) -> DataFrame:
    """The default parser on ``data_cells``: ``ROW_SCHEMA``. Width is never an error; surplus values are counted."""
    kept = drop_wrong_shape(rows).withColumn("_v", once(parse_cells(F.col("cells"), F.size("header_names"), F.col("null_values"))))
    surplus = F.greatest(F.size("_v") - F.size("header_names"), F.lit(0)).cast("long")
    named = kept.withColumn("data", name_cells(F.col("_v"), F.col("header_names")))
    return named.select("guid", "sheet_index", "sheet_name", (F.col("line") + 1).cast("long").alias("row_number"), F.lit(True).alias("valid"), F.array().cast("array<string>").alias("errors"), surplus.alias("extra_values"), F.map_keys("data").alias("columns"), "data")


def sheet_rows(profiles: DataFrame) -> DataFrame:
    """``ROW_SCHEMA`` and ``kept`` for every data record of ``profiles``: what ``extract_rows`` gives for ``data_cells``, by
    Arrow's kernels on batches of records; records that are too narrow are there too, without data and not kept.

    Every record is a row of its own before it reaches a kernel, so a batch does not grow with a sheet.
    """
    header, footer, n = F.col("header_row_index"), F.col("footer_start_from_bottom"), F.size("records")
    data = F.slice("records", header + 2, F.greatest(n - header - 1 - footer, F.lit(0)))
    least = F.greatest(F.lit(1), F.floor(F.col("modal_field_count") * 0.5)).cast("int")
    sheet = F.struct("delimiter", F.coalesce("quote_char", F.lit('"')).alias("quote"), F.col("header_names").alias("names"), F.col("null_values").alias("nulls"), least.alias("least"))
    rows = profiles.filter(F.col("rejection_code").isNull()).select("guid", "sheet_index", "sheet_name", (header + 2).alias("_from"), sheet.alias("_sheet"), F.posexplode(data).alias("_at", "record"))
    rows = rows.select("guid", "sheet_index", "sheet_name", (F.col("_from") + F.col("_at")).cast("long").alias("row_number"), "record", F.when(F.col("_at") == 0, F.col("_sheet")).alias("sheet"))
    return rows.mapInArrow(name_records, f"{ROW_SCHEMA}, kept boolean")


def kept_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter("kept").drop("kept")


def kept_counts(tagged: DataFrame) -> DataFrame:
    """(guid, sheet_index, source_rows, skipped_wrong_shape) of ``sheet_rows``."""
    return tagged.groupBy("guid", "sheet_index").agg(F.count_if("kept").alias("source_rows"), F.count_if(~F.col("kept")).alias("skipped_wrong_shape"))


RowParser = Callable[[list[str], int, list[str]], dict | list[dict]]


class Parsers:
    """User row parsers by shape. A parser gets (cells, field count, null tokens) and returns ``{"values": [...]}``,
    named fields, or a list of either, with optional ``_valid`` and ``_errors``."""

    def __init__(self) -> None:
        self.by_shape: dict[str, RowParser] = {}

    def register(self, shape: str, parser: RowParser) -> None:
        self.by_shape[shape] = parser


def _normal(value: object) -> object:
    return value.strip() or None if isinstance(value, str) else value


def _as_rows(result: dict | list[dict], names: list[str]) -> Iterator[tuple[dict, bool, list[str], int]]:
    for one in result if isinstance(result, list) else [result]:
        if not isinstance(one, dict):
            continue
        errors = [str(e) for e in one.get("_errors") or []]
        valid = bool(one.get("_valid", True))
        if (values := one.get("values")) is None:
            data, surplus = {k: v for k, v in one.items() if not k.startswith("_")}, 0
        else:
            data, surplus = {names[i] if i < len(names) else f"column_{i}": v for i, v in enumerate(values)}, max(0, len(values) - len(names)) if names else 0
        yield {k: None if (x := _normal(v)) is None else str(x) for k, v in data.items()}, valid, errors, surplus


def extract_with(rows: DataFrame, parsers: Parsers) -> DataFrame:
    """``ROW_SCHEMA`` by users' parsers: ``rows`` is ``data_cells`` with ``shape_hash``; shapes without a parser are left
    out, so that they can take ``extract_rows``. An exception makes an invalid row. Code runs where the rows are."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                names = list(r.header_names)
                try:
                    found = list(_as_rows(parsers.by_shape[r.shape_hash](list(r.cells), len(names), list(r.null_values)), names))
                except Exception as e:  # noqa: BLE001  a user's parser may raise anything
                    found = [({}, False, [str(e)], 0)]
                out += [(r.guid, r.sheet_index, r.sheet_name, r.line + 1, valid, errors, surplus, list(data), data) for data, valid, errors, surplus in found]
            yield pd.DataFrame(out, columns=["guid", "sheet_index", "sheet_name", "row_number", "valid", "errors", "extra_values", "columns", "data"])

    return drop_wrong_shape(rows).filter(F.col("shape_hash").isin(*parsers.by_shape)).mapInPandas(parse, ROW_SCHEMA)


def merge_sheets(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of passing sheets; the sheet's name stays where a document has more than one sheet."""
    many = verdicts.groupBy("guid").agg((F.count(F.lit(1)) > 1).alias("_many"))
    kept = rows.join(verdicts.filter("passed").select("guid", "sheet_index"), ["guid", "sheet_index"], "left_semi")
    return kept.join(many, "guid").withColumn("sheet_name", F.when(F.col("_many"), F.col("sheet_name"))).drop("_many")


"""Column functions on documents, records and cells. All run in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marks of a flattened workbook.
SHEET_MARKER = " \u0001\u0000"
CELL_NEWLINE = "\u0004"
ROW_SEPARATOR = "\n\n"
#: Unicode white space and the four separators of ASCII.
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
ZERO_WIDTH = "﻿​‌‍⁠"
DELIMITERS = [(",", "comma", "csv"), ("|", "pipe", "pipe"), ("\t", "tab", "tab"), (";", "semicolon", "semicolon")]
#: A workbook whose rows are marked beyond this share isn't one.
MOST_MARKED = 0.9
#: A slice's length that means all the rest; the largest integer would overflow when the start is added.
REST = 1_000_000_000


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def once(value: Column) -> Column:
    """``value`` for a column of its own that later columns use many times.

    The optimizer copies a deterministic column into each of its uses, lambdas included, and so computes it many times
    over; it leaves alone one that depends on the partition. For ``withColumn`` and ``select`` only.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def strip_zero_width(c: Column) -> Column:
    """Without the invisible characters that white-space trimming leaves."""
    return F.when(c.rlike(f"[{ZERO_WIDTH}]"), F.translate(c, ZERO_WIDTH, "")).otherwise(c)  # translate goes by the character


def strip(c: Column) -> Column:
    """Without leading and trailing Unicode white space; ``trim`` by itself would take blanks only."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def rows_of(body: Column) -> Column:
    """The rows of a flattened document: between blank lines, or lines where it has none."""
    return F.when(F.contains(body, F.lit(ROW_SEPARATOR)), F.split(body, ROW_SEPARATOR)).otherwise(F.split(body, "\n"))


def is_marker(row: Column) -> Column:
    return F.endswith(row, F.lit(SHEET_MARKER))


def without_marker(row: Column) -> Column:
    return F.when(is_marker(row), F.substring(row, F.lit(1), F.length(row) - len(SHEET_MARKER))).otherwise(row)


def clean_row(row: Column) -> Column:
    return strip(strip_zero_width(F.replace(row, F.lit(CELL_NEWLINE), F.lit(" "))))


def clean_rows(rows: Column) -> Column:
    return F.filter(F.transform(rows, clean_row), lambda r: r != "")


def split_records(body: Column) -> Column:
    """array<string>: a document's records, marker rows and blank rows left out."""
    return F.coalesce(clean_rows(F.filter(rows_of(body), lambda r: ~is_marker(r))), F.array().cast("array<string>"))


def marker_names(body: Column) -> Column:
    """array<string>: the texts of a document's marker rows."""
    return F.transform(F.filter(rows_of(body), is_marker), without_marker)


def has_two_cells(c: Column) -> Column:
    """Two or more non-blank comma cells: the row reads like a header."""
    return F.size(F.filter(F.split(c, ","), lambda x: strip(x) != "")) >= 2


def is_workbook(rows: Column) -> Column:
    """Whether marker rows are few enough for a workbook."""
    return F.size(F.filter(rows, is_marker)) / F.greatest(F.size(rows), F.lit(1)) <= MOST_MARKED


# Shapes distinctive enough to tell a value from a label, in order of precedence.
SHAPES = {
    "uuid": r"(?i)^[0-9a-f]{8}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{12}$",
    "email": r"(?i)^[^@\s]+@[^@\s]+\.[a-z]{2,}$",
    "datetime": r"^\d{1,4}[/-]\d{1,2}[/-]\d{1,4}[ T]\d{1,2}:\d{2}",
    "date": r"^\d{1,4}[/-]\d{1,2}[/-]\d{1,4}$",
    "time": r"^\d{1,2}:\d{2}(:\d{2})?$",
    "number": r"^[-+]?[\d,]+(\.\d+)?$",
    "comma_name": r"^[A-Z][\w'-]+,\s+[A-Z][\w'-]+$",
    "hex_id": r"(?i)^[0-9a-f]{16,}$",
}


def value_shape(c: Column) -> Column:
    """The distinctive shape of a cell, or null for plain text."""
    names = list(SHAPES)
    first = lambda text: F.when(text.rlike(SHAPES[names[0]]), names[0])
    return let(strip(F.coalesce(c, F.lit(""))), lambda text: reduce(lambda acc, n: acc.when(text.rlike(SHAPES[n]), n), names[1:], first(text)))


def looks_like_header(cells: Column) -> Column:
    """Labels, not values: half the cells filled (two at least), few numbers, addresses and long texts."""

    def judged(filled: Column) -> Column:
        n = F.size(filled)
        numbers = F.size(F.filter(filled, lambda x: x.rlike(r"^[-+]?[\d.,/%:]+$")))
        addresses = F.size(F.filter(filled, lambda x: F.contains(x, F.lit("@"))))
        prose = F.size(F.filter(filled, lambda x: F.length(x) > 128))
        return (numbers <= n * 0.3) & (addresses <= F.greatest(F.lit(1.0), n * 0.3)) & (prose <= F.greatest(F.lit(1.0), n * 0.5))

    enough = lambda filled: F.size(filled) >= F.greatest(F.lit(2.0), F.size(cells) * 0.5)
    return let(F.filter(F.transform(cells, strip), lambda x: x != ""), lambda filled: enough(filled) & judged(filled))


# Words that column names are made of.
HEADER_WORDS = "id name title date time email phone value count amount price description comment address city state zip country status".split()
FIRST_WORDS = "id name title date time email phone value count".split()


def _any_word(c: Column, words: list[str]) -> Column:
    return c.rlike("|".join(words))


def _is_number(c: Column) -> Column:
    return c.try_cast("double").isNotNull() & ~c.rlike(r"(?i)[df]$")


def header_score(line: Column) -> Column:
    """How much a line reads like a header: words of names count for it, numbers against it."""
    tokens = F.coalesce(
        *[F.when(F.size(F.split(line, p)) >= 2, F.split(line, p)) for p in (",", "\t", r"\|")],
        F.filter(F.split(strip(line), r"(?U)\s+"), lambda t: t != ""),
    )

    def share(t: Column) -> Column:
        kind = F.when(_is_number(t), F.lit(-0.5)).when(_any_word(t, HEADER_WORDS), F.lit(2.0)).when(t.rlike(r"(?U)^[\p{L}_-]+$"), F.lit(0.5)).otherwise(F.lit(-0.2))
        return kind

    def total(tokens: Column) -> Column:
        shares = F.transform(F.filter(F.transform(tokens, lambda t: strip(F.lower(t))), lambda t: t != ""), share)
        bonus = lambda x: F.when(F.size(F.filter(x, lambda s: s > 0)) >= F.size(tokens) * 0.7, 1.0).otherwise(0.0)
        return let(shares, lambda x: F.aggregate(x, F.lit(0.0), lambda a, s: a + s) + bonus(x))

    return F.when(strip(F.coalesce(line, F.lit(""))) == "", F.lit(-1.0)).otherwise(F.round(let(tokens, total), 6))


def first_is_header(line: Column) -> Column:
    """Whether a first line's first word names a column or at least is no number."""
    word = F.lower(F.try_element_at(F.filter(F.split(F.try_element_at(F.split(line, ","), F.lit(1)), r"(?U)\s+"), lambda t: t != ""), F.lit(1)))
    return let(word, lambda w: F.when(w.isNull(), False).otherwise(_any_word(w, FIRST_WORDS) | ~_is_number(w)))


def format_hint(lines: Column) -> Column:
    """json, csv, pipe, tab, space_delimited or unknown, from how many of the lines each would split."""

    def judged(kept: Column) -> Column:
        n = F.size(kept)
        holding = lambda text: F.size(F.filter(kept, lambda x: F.contains(x, F.lit(text))))
        best = F.greatest(holding(","), holding("|"), holding("\t"))
        return (
            F.when(F.coalesce(n, F.lit(0)) <= 0, "unknown")
            .when(F.size(F.filter(kept, lambda x: x.rlike(r"^[{\[]"))) > n / 2, "json")
            .when((best > 0) & (holding(",") == best), "csv")
            .when((best > 0) & (holding("|") == best), "pipe")
            .when(best > 0, "tab")
            .when(holding(" ") > n / 2, "space_delimited")
            .otherwise("unknown")
        )

    return let(F.filter(F.transform(F.coalesce(lines, F.array().cast("array<string>")), strip), lambda x: x != ""), judged)


def line_format(line: Column) -> Column:
    """The format hint of one line."""
    return (
        F.when(F.coalesce(line, F.lit("")) == "", "unknown")
        .when(strip(line).rlike(r"^[{\[]"), "json")
        .when(F.contains(line, F.lit("|")), "pipe")
        .when(F.contains(line, F.lit("\t")), "tab")
        .when(F.contains(line, F.lit(",")), "csv")
        .when(F.contains(line, F.lit(" ")), "space_delimited")
        .otherwise("unknown")
    )


def delimiter_char(name: Column) -> Column:
    """The delimiter that a type name stands for; a comma for unknown names."""
    return reduce(lambda acc, d: acc.when(name.isin(d[1], d[2]), d[0]), DELIMITERS[1:], F.when(name.isin("comma", "csv"), ",")).otherwise(",")


def sheet_slug(name: Column) -> Column:
    """A file-safe name of at most 80 characters."""
    slug = F.substring(F.btrim(F.regexp_replace(F.coalesce(name, F.lit("")), r"[^A-Za-z0-9._-]+", "_"), F.lit("_")), 1, 80)
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("unnamed"))


def column_key(name: Column, version: str = "v3") -> Column:
    """A key that spellings of a column name share: its letters and digits in lower case, with the label set's version."""
    words = F.array_join(F.regexp_extract_all(F.lower(F.coalesce(name, F.lit(""))), F.lit(r"[a-z0-9]+"), F.lit(0)), " ")
    return F.substring(F.sha2(F.concat(F.lit(f"{version}|"), words), 256), 1, 16)


def type_from_reason(reason: Column) -> Column:
    """The document type in brackets at the end of a rejection's text; null if none."""
    found = F.regexp_extract(reason, r"non-tabular document type \((.+)\)$", 1)
    return F.when(found != "", found)

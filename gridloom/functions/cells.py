"""Cells of records: quote-aware splitting, the row contract, column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import REST, let, strip


def plain_cells(record: Column, delimiter: Column) -> Column:
    """Cells between delimiters, none of which quotes. A delimiter of one character behind a backslash is a pattern that
    Java splits at without compiling it; a letter, a digit or a longer text is quoted as a whole."""
    short = delimiter.rlike(r"^[^\p{Alnum}]$")
    return F.split(record, F.when(short, F.concat(F.lit("\\"), delimiter)).otherwise(F.concat(F.lit("\\Q"), delimiter, F.lit("\\E"))), -1)


def quoted_cells(record: Column, delimiter: Column, quote: Column) -> Column:
    """array<string>: cells of a record that may quote. A quote counts at a cell's start; doubled inside it is one; what
    follows the closing quote is taken as it is; an open quote takes the rest of the record."""
    d, q = F.concat(F.lit("\\Q"), delimiter, F.lit("\\E")), quote
    inner = F.concat(F.lit("[^"), q, F.lit("]*+(?:"), q, q, F.lit("[^"), q, F.lit("]*+)*+"))
    cell = F.concat(d, F.lit("("), q, inner, F.lit("(?:"), q, F.lit("[^"), d, F.lit("]*|\\z)|[^"), d, F.lit("]*)"))
    parts = F.concat(F.lit("(?s)^"), q, F.lit("("), inner, F.lit(")"), q, F.lit("?(.*)$"))
    plain = lambda c: F.concat(F.replace(F.regexp_replace(c, parts, F.lit("$1")), F.concat(q, q), q), F.regexp_replace(c, parts, F.lit("$2")))
    return F.transform(F.regexp_extract_all(F.concat(delimiter, record), cell, F.lit(1)), lambda c: F.when(F.startswith(c, q), plain(c)).otherwise(c))


def record_cells(record: Column, delimiter: Column, quote: Column) -> Column:
    return F.when(F.contains(record, quote), quoted_cells(record, delimiter, quote)).otherwise(plain_cells(record, delimiter))


def split_cells(records: Column, delimiter: Column, quote: Column) -> Column:
    """array<array<string>>: cells of each record, quotes honoured."""
    return let(F.coalesce(quote, F.lit('"')), lambda q: F.transform(records, lambda r: record_cells(r, delimiter, q)))


def cell_counts(records: Column, delimiter: str) -> Column:
    """array<int>: how many cells each record has, double quotes honoured; a record without any is not split for it."""
    d, q = F.lit(delimiter), F.lit('"')
    plain = lambda r: F.octet_length(r) - F.octet_length(F.replace(r, d, F.lit(""))) + 1
    return F.transform(records, lambda r: F.when(F.contains(r, q), F.size(quoted_cells(r, d, q))).otherwise(plain(r)))


def quote_vote(records: Column, delimiter: Column) -> Column:
    """struct<quote, rows>: the quote that changes most of the records' cells, and of how many; null where none does."""

    def changed(quote: str) -> Column:
        differs = lambda r: F.transform(quoted_cells(r, delimiter, F.lit(quote)), strip) != F.transform(plain_cells(r, delimiter), strip)
        return F.size(F.filter(records, lambda r: F.contains(r, F.lit(quote)) & differs(r)))

    one = lambda rows, quote: F.struct(rows.alias("rows"), F.lit(quote).alias("quote"))
    return let(changed('"'), lambda a: let(changed("'"), lambda b: F.when(b > a, one(b, "'")).when(a > 0, one(a, '"')).otherwise(one(F.lit(0), None))))


def parse_cells(cells: Column, width: Column, null_tokens: Column) -> Column:
    """The default row contract: trimmed, blank and null tokens null, padded to the width, surplus cells kept."""
    absent = lambda c: (c == "") | F.coalesce(F.array_contains(null_tokens, c), F.lit(False))
    valued = F.transform(F.transform(cells, strip), lambda c: F.when(~absent(c), c))
    return F.concat(valued, F.array_repeat(F.lit(None).cast("string"), F.greatest(width - F.size(cells), F.lit(0))))


def name_cells(values: Column, names: Column) -> Column:
    """map<string,string>: position i takes name i; positions beyond the names are ``column_<i>``."""
    surplus = F.transform(F.slice(values, F.size(names) + 1, REST), lambda _, i: F.concat(F.lit("column_"), (i + F.size(names)).cast("string")))
    surplus = F.transform(surplus, lambda n: F.when(F.array_contains(names, n), F.concat(n, F.lit("_x"))).otherwise(n))
    return F.map_from_arrays(F.concat(F.slice(names, 1, F.size(values)), surplus), values)


def unique_names(header: Column) -> Column:
    """array<string>: blank cells become ``column_<i>``, the n-th repeat of a name ``<name>_<n>``; a clash with a
    literal name gains its position."""
    earlier = lambda names, i, name: F.size(F.filter(F.slice(names, 1, i), lambda x: x == name))
    filled = F.transform(header, lambda h, i: F.coalesce(F.nullif(strip(h), F.lit("")), F.concat(F.lit("column_"), i.cast("string"))))
    counted = lambda base: F.transform(
        base, lambda b, i: let(earlier(base, i, b), lambda n: F.when(n > 0, F.concat(b, F.lit("_"), (n + 1).cast("string"))).otherwise(b))
    )
    apart = lambda named: F.transform(named, lambda n, i: F.when(earlier(named, i, n) > 0, F.concat(n, F.lit("__"), i.cast("string"))).otherwise(n))
    return let(let(filled, counted), apart)

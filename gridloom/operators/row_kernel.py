"""Records to named cells, a batch of records at a time, with Arrow's own kernels.

Records arrive one a row in the order of their sheets; what holds for a whole sheet (delimiter, quote, names) comes with
its first record only and is kept for those that follow, also in later batches. Records are split at their delimiter and
trimmed by Arrow; those that hold a quote are few and split by ``quoted_split``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gridloom.functions.text import WHITE_SPACE

FIELDS = [
    ("guid", pa.string()), ("sheet_index", pa.int32()), ("sheet_name", pa.string()), ("row_number", pa.int64()), ("valid", pa.bool_()), ("errors", pa.list_(pa.string())), ("extra_values", pa.int64()),
    ("columns", pa.list_(pa.string())), ("data", pa.map_(pa.string(), pa.string())), ("kept", pa.bool_()),
]


def quoted_split(record: str, delimiter: str, quote: str) -> list[str]:
    """Cells of a record that may quote: a quote counts at a cell's start; doubled inside it is one; what follows the
    closing quote is taken as it is; an open quote takes the rest of the record."""
    cells, at, end = [], 0, len(record)
    while True:
        inner, rest = [], at
        if record.startswith(quote, at):
            rest = at + 1
            while True:
                close = record.find(quote, rest)
                if close < 0:
                    inner.append(record[rest:])
                    rest = end
                    break
                inner.append(record[rest:close])
                rest = close + 1
                if not record.startswith(quote, rest):
                    break
                inner.append(quote)
                rest += 1
        stop = record.find(delimiter, rest)
        stop = end if stop < 0 else stop
        cells.append("".join(inner) + record[rest:stop])
        if stop >= end:
            return cells
        at = stop + len(delimiter)


@dataclass
class Sheet:
    delimiter: str
    quote: str
    names: list[str]
    nulls: list[str]
    least: int
    keys: list[str] = field(default_factory=list)

    def keys_to(self, n: int) -> list[str]:
        """The names of ``n`` cells; beyond the header's they are numbered, and told apart from the header's."""
        if not self.keys:
            self.keys = list(self.names)
        for i in range(len(self.keys), n):
            name = f"column_{i}"
            self.keys.append(f"{name}_x" if name in self.names else name)
        return self.keys


def _split(records: pa.Array, sheet_of: np.ndarray, sheets: list[Sheet]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """For each record the place of its first cell in an array of all cells, that array, and the number of cells."""
    starts, counts, parts, before = np.zeros(len(records), np.int64), np.zeros(len(records), np.int64), [], 0
    by_mark: dict[tuple[str, str], list[int]] = {}
    for i, s in enumerate(sheets):
        by_mark.setdefault((s.delimiter, s.quote), []).append(i)
    for (delimiter, quote), mine in by_mark.items():
        rows = np.flatnonzero(np.isin(sheet_of, mine))
        some = records.take(pa.array(rows))
        quoted = pc.match_substring(some, quote).to_numpy(zero_copy_only=False)
        for kind, chosen in ((False, rows[~quoted]), (True, rows[quoted])):
            if not len(chosen):
                continue
            texts = records.take(pa.array(chosen))
            cells = pa.array([quoted_split(t, delimiter, quote) for t in texts.to_pylist()], pa.list_(pa.string())) if kind else pc.split_pattern(texts, delimiter)
            counts[chosen] = n = pc.list_value_length(cells).to_numpy(zero_copy_only=False)
            starts[chosen] = before + np.cumsum(n) - n
            parts.append(cells.flatten())
            before += len(parts[-1])
    return starts, pa.concat_arrays(parts) if parts else pa.array([], pa.string()), counts


def name_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``FIELDS``, of batches (guid, sheet_index, sheet_name, row_number, record, and for a sheet's first record
    sheet: delimiter, quote, names, nulls, least). ``kept`` tells whether a record has the ``least`` number of cells;
    one that has not has no data."""
    last: list[Sheet] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        heads = batch.column("sheet")
        first = pc.is_valid(heads).to_numpy(zero_copy_only=False)
        parts = [heads.field(i).filter(pa.array(first)).to_pylist() for i in range(5)]  # by place: names don't all come through
        sheets = last + [Sheet(delimiter, quote, names, nulls or [], least) for delimiter, quote, names, nulls, least in zip(*parts)]
        sheet_of = np.cumsum(first) - (0 if last else 1)
        starts, cells, counts = _split(batch.column("record"), sheet_of, sheets)
        width = np.array([len(s.names) for s in sheets], np.int64)[sheet_of]
        kept = counts >= np.array([s.least for s in sheets], np.int64)[sheet_of]
        total = np.where(kept, np.maximum(counts, width), 0)
        ends = np.cumsum(total)
        row = np.repeat(np.arange(batch.num_rows), total)
        place = np.arange(len(row)) - (ends - total)[row]
        there = place < counts[row]
        values = pc.utf8_trim(cells.take(pa.array(starts[row] + place, mask=~there)), characters=WHITE_SPACE)
        absent = pc.equal(values, "")
        for i in [i for i, s in enumerate(sheets) if s.nulls]:
            absent = pc.or_(absent, pc.and_(pc.is_in(values, value_set=pa.array(sheets[i].nulls, pa.string())), pa.array(sheet_of[row] == i)))
        values = pc.if_else(absent, pa.scalar(None, pa.string()), values)
        most = np.zeros(len(sheets), np.int64)
        np.maximum.at(most, sheet_of, total)
        pools = [s.keys_to(int(n)) for s, n in zip(sheets, most)]
        pool_at = np.cumsum([0, *map(len, pools[:-1])])
        names = pa.array([k for p in pools for k in p], pa.string()).take(pa.array(pool_at[sheet_of][row] + place))
        offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("guid"), batch.column("sheet_index"), batch.column("sheet_name"), batch.column("row_number"), pa.array(np.ones(n, bool)), pa.ListArray.from_arrays(pa.array(np.zeros(n + 1), pa.int32()), pa.array([], pa.string())),
                pa.array(np.maximum(counts - width, 0) * kept), pa.ListArray.from_arrays(offsets, names), pa.MapArray.from_arrays(offsets, names, values), pa.array(kept),
            ],
            names=[f for f, _ in FIELDS],
        )
        last = sheets[-1:]

"""Reproducible shuffling into shards by a Feistel permutation of row numbers, with DataFrame operations only.

Row numbers 0 to n - 1 are permuted within the next power of two by an alternating Feistel network; a value that falls
at n or beyond is permuted again until it falls below (cycle walking). Of the permuted number p, the shard is p modulo
the number of shards and the slot is the quotient: shards differ by at most one row and slots have no gaps. Both follow
from the row number alone, and the inverse permutation gives the row number of any shard and slot.

Defined results: rows are numbered by id (null first), then by size and checksum of the text; rows equal in all of
these are interchangeable. A null text has no bytes. An empty table gives an empty result. All columns of the input
travel in one struct column, so their names may be any.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import numbered

ROUNDS = 6
#: A walk leaves the rows in more than half of the domain: each step ends it with a chance of a half or more.
MOST_STEPS = 200


@dataclass(frozen=True)
class Permutation:
    """A permutation of 0 to ``n`` - 1 that ``seed`` chooses; n is at most 2 to the 48th."""

    n: int
    seed: int = 42

    def __post_init__(self) -> None:
        if not 0 <= self.n <= 1 << 48:
            raise ValueError("n must be from 0 to 2 to the 48th")

    @property
    def widths(self) -> tuple[int, int]:
        """Bits of the upper and of the lower half."""
        bits = max(2, (self.n - 1).bit_length())
        return bits // 2, bits - bits // 2

    def keys(self) -> list[tuple[int, int]]:
        """An offset and an odd factor for each round; a product stays below 2 to the 56th."""
        draw = random.Random(self.seed)
        return [(draw.randrange(1 << 24), draw.randrange(1 << 29, 1 << 30) * 2 + 1) for _ in range(ROUNDS)]

    def _step(self, x: Column, inverse: bool) -> Column:
        up, low = self.widths
        halves = [F.shiftright(x, low), x.bitwiseAND(F.lit((1 << low) - 1))]
        rounds = list(enumerate(self.keys()))
        for r, (offset, factor) in reversed(rounds) if inverse else rounds:
            to, by = r % 2, 1 - r % 2
            mixed = F.shiftright((halves[by] + F.lit(offset)) * F.lit(factor), 24)
            halves[to] = halves[to].bitwiseXOR(mixed.bitwiseAND(F.lit((1 << (up, low)[to]) - 1)))
        return F.shiftleft(halves[0], low).bitwiseOR(halves[1])

    def _walk(self, x: Column, inverse: bool) -> Column:
        inside = lambda v: v < F.lit(self.n)
        once = self._step(x.cast("long"), inverse)
        more = F.aggregate(F.sequence(F.lit(1), F.lit(MOST_STEPS)), once, lambda v, _: F.when(inside(v), v).otherwise(self._step(v, inverse)))
        return F.when(inside(once), once).otherwise(more)

    def of(self, x: Column) -> Column:
        """Where the row of number ``x`` goes."""
        return self._walk(x, False)

    def back(self, p: Column) -> Column:
        """The number of the row that went to ``p``."""
        return self._walk(p, True)

    def shard_and_slot(self, x: Column, shards: int) -> tuple[Column, Column]:
        p = self.of(x)
        return (p % F.lit(shards)).cast("int"), F.floor(p / F.lit(shards)).cast("long")

    def row_at(self, shard: Column, slot: Column, shards: int) -> Column:
        """The number of the row in a slot of a shard."""
        return self.back(slot.cast("long") * F.lit(shards) + shard.cast("long"))


def shard_documents(docs: DataFrame, shards: int, seed: int = 42, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc: struct of all columns or those to ``keep``, the id among them, size: bytes of the text and 8 more, text_crc32, row, shard, slot).

    What is kept is sorted by id once; a plan of the shards alone keeps the id and moves no text.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("doc"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = numbered(rows, [F.col("doc")[id_col].asc_nulls_first(), F.col("size"), F.col("text_crc32")])
    shard, slot = Permutation(placed.count(), seed).shard_and_slot(F.col("row"), shards)
    return placed.withColumns({"shard": shard, "slot": slot})


def write_shards(placed: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """The documents of ``shard_documents`` below a folder for each shard, in the order of their slots.

    A shard's slots are cut into ranges, each written by a task of its own.
    """
    tasks = max(1, -(-placed.count() // rows_per_file))
    dealt = placed.repartitionByRange(tasks, "shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.select("doc", "slot", "shard").write.mode("overwrite").partitionBy("shard").parquet(path)

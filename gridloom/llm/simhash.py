"""SimHash near-dedup with deletion-variant signatures.

A 64-bit fingerprint is cut into three segments (21, 21 and 22 bits). Two fingerprints that differ in at most four
bits have a segment that differs in at most one, so they share at least one of the 64 signatures made by putting a
wildcard on one bit of one segment. An equality join on the signature finds every such pair; the join's condition
verifies the distance.

Defined results: a null text counts as empty and has fingerprint zero, as has a text without words; such rows are
linked like any others. Ties and repeated rows fall into one component. An empty table gives an empty result. Only id
and text columns are read, so other columns may have any names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .components import connected_components
from .shared import join_groups, joins_within_partitions, packed, spread, staged, unpacked

BITS = 64
BLOCK = 8
#: What two fingerprints of one signature have in common: the first two name it, the others follow from them.
SIGNATURE = ("part", "wild", "rest", "block")


def shingle_hashes(text: str | None, words: int, seed: int) -> np.ndarray:
    """64-bit hashes of the word shingles of a text; a text of fewer words is one shingle, one without words has none."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(joined, seed)] if parts else [], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[words - 1 :].tolist())), np.uint64, len(parts) - words + 1)


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """SimHash of the word shingles of a text as a signed 64-bit integer."""
    hashes = shingle_hashes(text, words, seed)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        ones += np.unpackbits(hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp long)."""

    @F.pandas_udf(T.LongType())
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words, seed) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).alias("doc_id"), hashed(F.col(text_col)).alias("fp"))


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the fewest segments of which one differs by at most one bit."""
    n = distance // 2 + 1
    width = BITS // n
    return [(i * width, width if i < n - 1 else BITS - i * width) for i in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _mask(segment: tuple[int, int]) -> int:
    return ((1 << segment[1]) - 1) << segment[0]


def blocks(distance: int) -> list[list[tuple[int, int, int]]]:
    """Each segment cut into blocks of at most ``BLOCK`` bits: (bit, the segment's other bits, its bits outside the block) for each bit of a block."""
    cut = [((first, bits), range(at, min(at + BLOCK, first + bits))) for first, bits in segments(distance) for at in range(first, first + bits, BLOCK)]
    return [[(1 << b, _mask(s) & ~(1 << b), _mask(s) & ~_mask((block[0], len(block)))) for b in block] for s, block in cut]


def signatures(fps: DataFrame, distance: int, rows: int) -> DataFrame:
    """``fps`` with one row for each signature: ``wild`` (the bit put out) and ``part`` (what is left of its segment).

    The ``rows`` are shuffled once for each block of bits, by its number ``block`` and ``rest``, the segment's bits
    outside the block; the signatures with a wildcard in the block are made after the shuffle. Groups by ``SIGNATURE``
    then need no shuffle of their own. No column that is added is null.
    """
    table = blocks(distance)
    cut = F.array(*[F.struct(F.lit(n).alias("block"), F.lit(_signed(bits[0][2])).alias("_outside")) for n, bits in enumerate(table)])
    keyed = fps.select("*", F.inline(cut)).withColumn("rest", F.col("fp").bitwiseAND(F.col("_outside"))).drop("_outside")
    dealt = keyed.repartition(max(1, -(-rows // 16384)), "block", "rest")
    wilds = F.array(*[F.array(*[F.struct(F.lit(_signed(bit)).alias("wild"), F.lit(_signed(keep)).alias("_keep")) for bit, keep, _ in bits]) for bits in table])
    made = dealt.select("*", F.inline(F.get(wilds, F.col("block"))))
    return made.withColumn("part", F.coalesce(F.col("fp").bitwiseAND(F.col("_keep")), F.lit(0))).withColumn("wild", F.coalesce("wild", F.lit(0))).drop("_keep")


def first_wild(diff: Column, distance: int) -> Column:
    """Of the signatures that two fingerprints share, the wildcard of the first; ``diff`` is their exclusive or."""
    out = F.lit(None).cast("long")
    for s in reversed(segments(distance)):
        part = diff.bitwiseAND(F.lit(_signed(_mask(s))))
        out = F.when(F.bit_count(part) == 0, F.lit(_signed(1 << s[0]))).when(F.bit_count(part) == 1, part).otherwise(out)
    return out


def linked_components(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, component): components of the graph that links fingerprints differing in at most ``distance`` bits.

    ``distinct`` holds each fingerprint once. Two rounds keep the number of links linear where a bucket is large.
    The first links neighbours in each bucket's order, which joins most of a dense group. The second needs only
    pairs from different components so far; of these one side lies outside the bucket's largest component, so only
    such rows probe the bucket, and the join emits a pair once, from the first signature that it shares.
    """
    order = Window.partitionBy(*SIGNATURE).orderBy("fp")
    fps = spread(distinct.select(F.coalesce("fp", F.lit(0)).alias("fp")), 16384)
    near = signatures(fps, distance, distinct.count()).withColumn("other", F.lag("fp").over(order)).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance)
    first = connected_components(staged(near.select(F.col("other").alias("a"), F.col("fp").alias("b")).distinct(), "near_links"))
    sizes = first.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    known = staged(
        distinct.select("fp").join(first.withColumnRenamed("node", "fp").join(sizes, "component"), "fp", "left")
        .select("fp", F.coalesce("component", "fp").alias("c"), F.coalesce("members", F.lit(1)).alias("members")),
        "first_components",
    )
    # No column is null, so neither side of the join gets a filter that the other lacks.
    fps = spread(known.select(F.coalesce("fp", F.lit(0)).alias("fp"), F.struct("members", "c").alias("in")), 16384)
    keyed = signatures(fps, distance, known.count())
    # A pair is met from the side of the smaller component. Both sides have the same columns, so one shuffle serves both.
    probes = keyed.withColumn("largest", F.max("in").over(Window.partitionBy(*SIGNATURE))).filter(F.col("in") < F.col("largest")).select([F.col(c).alias(f"{c}_a") for c in keyed.columns])
    diff = F.col("fp_a").bitwiseXOR(F.col("fp"))
    same = F.col("in_a") < F.col("in")
    for c in reversed(SIGNATURE):
        same = (F.col(f"{c}_a") == F.col(c)) & same
    # Merge hints: the optimizer takes exploded signatures for as small as their source and would broadcast them.
    pairs = probes.hint("merge").join(keyed.hint("merge"), same & (F.bit_count(diff) <= distance) & (first_wild(diff, distance) == F.col("wild_a")))
    with joins_within_partitions(distinct.sparkSession):
        between = staged(pairs.select(F.least("in_a.c", "in.c").alias("a"), F.greatest("in_a.c", "in.c").alias("b")).distinct(), "further_links")
    second = connected_components(between).select(F.col("node").alias("c"), F.col("component").alias("final"))
    return known.join(second, "c", "left").select("fp", F.coalesce("final", "c").alias("component"))


def near_duplicates(docs: DataFrame, distance: int = 4, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, fp, component_id (the smallest id that links reach, its own included).

    Copies meet in one row for each fingerprint before anything is paired.
    """
    rows = staged(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "distinct_fingerprints")
    parts = linked_components(distinct, distance)
    held = staged(distinct.join(parts, "fp"), "fingerprint_components")
    ids = held.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("members"))
    named = join_groups(held, ids, "component", "members").select("fp", "component_id", "copies")
    return join_groups(rows, named, "fp", "copies").select("doc_id", "fp", "component_id")


def first_of_component(docs: DataFrame, distance: int = 4, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one for each component, with all their columns.

    The row with the component's smallest id stays (a null id loses to any other); of several rows with that id and
    fingerprint, one of them. Rows are told apart by fingerprint and id, so different texts that share an id, or have
    none, stay as long as nothing links them.
    """

    @F.pandas_udf(T.LongType())
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    marked = staged(packed(docs).select("doc", hashed(F.col("doc")[text_col]).alias("fp"), F.col("doc")[id_col].alias("id")), "fingerprinted")
    distinct = staged(marked.groupBy("fp").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "distinct_fingerprints")
    return unpacked(first_rows(marked, distinct.join(linked_components(distinct, distance), "fp")))


def first_rows(marked: DataFrame, held: DataFrame) -> DataFrame:
    """The rows of ``marked`` (fp, id, ...) that stay, one for each component of ``held`` (fp, first_id, component).

    A component's row is that with the smallest ``first_id``, nulls last, then with the smallest fp.
    """
    first = held.groupBy("component").agg(F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "fp")).alias("first"))
    stay = first.select("first.fp", F.col("first.first_id").alias("first_id"))
    here = (marked["fp"] == stay["fp"]) & marked["id"].eqNullSafe(stay["first_id"])
    return marked.join(stay, here, "left_semi").dropDuplicates(["fp"])

"""SimHash near-dedup at a stated similarity: deletion-variant signatures find pairs, exact Jaccard verifies them.

Four of 64 bits is a similarity of about 0.96. For 0.8 a set of word shingles gets a wider SimHash of 16 segments of 16
bits. Two sets of similarity s differ in a bit with probability arccos(2s / (1 + s)) / pi if they are of one size, which
is 0.15 at 0.8, so a segment differs in at most one bit in 28 of 100 cases, and of 16 segments at least one does for all
but one pair in 190 at 0.8, one in 1700 at 0.85 and one in 70,000 at 0.9. Each segment is indexed by its 16 one-wildcard
variants; an equality join on them finds the pairs, whose bits and then whole texts are verified. The join's condition
also bounds a pair's similarity by the parities of both sets, an odd sketch: of 256 classes of shingles, those of which a
set has an odd number. Each shingle that only one set has changes one parity, so two sets differ in at least as many
shingles as parities. No pair of the wanted similarity fails that bound; edits of one text, similar but not similar
enough, do, unless they have many hundred shingles.

Candidates by chance grow with the square of the number of different sets, by 256 / 2^15 of all pairs; beyond some
hundred million sets wider segments, and more of them, are needed.

Defined results: a null text counts as empty; texts without words are copies of each other and of nothing else; a text
shorter than a shingle is one shingle; letters differ by case beyond ASCII only. Texts of one set meet in one row
before anything is paired, by a 64-bit hash of the set. An empty table gives an empty result.
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
from .shared import bucketed, joins_within_partitions, packed, spread, staged, unpacked
from .simhash import shingle_hashes

SEGMENTS, WIDTH, QUARTER = 16, 16, 4
WORDS = SEGMENTS * WIDTH // 64
#: Bits of the first 64, and of all 256, in which a pair of similarity 0.8 differs at most: four standard deviations.
MOST_FIRST, MOST_ALL = 21, 64
_MIX = np.random.default_rng(42).integers(0, 1 << 63, (2, WORDS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, words: int = 5, seed: int = 42) -> np.ndarray:
    """The sorted 64-bit hashes of a text's different word shingles."""
    return np.unique(shingle_hashes(text, words, seed))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """256 bits, as four signed 64-bit integers: each is set where more than half of the set's hashes have it."""
    ones = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(hashes), 1 << 13):  # blocks that stay in the processor's cache
        x = (hashes[at : at + (1 << 13), None] ^ _MIX[0]) * _MIX[1]
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        bits = np.unpackbits(x.view(np.uint8), axis=1, bitorder="little")
        full = len(bits) // 255 * 255  # so many sum up in a byte
        ones += bits[:full].reshape(-1, 255, 64 * WORDS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[full:].sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")


def parities(hashes: np.ndarray) -> np.ndarray:
    """256 bits, as four signed 64-bit integers: each is set where an odd number of the set's hashes fall into its class."""
    counts = np.bincount((hashes % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<i8")


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both)


def sketched(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row: a number, doc: struct of all columns, id, fp: hash of the shingle set, size: shingles in it, bits: none for an empty set, odd: its parities)."""

    @F.pandas_udf(T.StructType([T.StructField("set", T.LongType()), T.StructField("size", T.LongType()), T.StructField("bits", T.ArrayType(T.LongType())), T.StructField("odd", T.ArrayType(T.LongType()))]))
    def sketch(texts: pd.Series) -> pd.DataFrame:
        out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for text in texts:
            s = shingle_set(text, words)
            out.append((np.uint64(xxhash.xxh64_intdigest(s.tobytes())).astype(np.int64), len(s), wide_fingerprint(s) if len(s) else np.zeros(0, np.int64), parities(s)))
        sets, sizes, bits, odd = zip(*out) if out else ((), (), (), ())
        return pd.DataFrame({"set": pd.Series(sets, dtype="int64"), "size": pd.Series(sizes, dtype="int64"), "bits": pd.Series(bits, dtype=object), "odd": pd.Series(odd, dtype=object)})

    made = packed(docs).withColumn("s", sketch(F.col("doc")[text_col]))
    return made.select(F.monotonically_increasing_id().alias("row"), "doc", F.col("doc")[id_col].alias("id"), F.col("s.set").alias("fp"), "s.size", "s.bits", "s.odd")


def segments(sets: DataFrame) -> DataFrame:
    """``sets`` with a row for each segment: ``part``, its bits below its number."""
    of = lambda n: F.shiftrightunsigned(F.col("bits")[n * WIDTH // 64], n * WIDTH % 64).bitwiseAND(F.lit((1 << WIDTH) - 1)).cast("int").bitwiseOR(F.lit(n << WIDTH))
    return sets.filter(F.size("bits") > 0).select("*", F.explode(F.array(*map(of, range(SEGMENTS)))).alias("part"))


def variants(parts: DataFrame, sets: int) -> DataFrame:
    """``segments`` of so many ``sets``, none of its columns null, with a row for each wildcard.

    ``part`` is the segment without one bit, below that bit's number. Rows are shuffled once for each quarter of a
    segment, by ``key``, the bits outside the quarter; the quarter's wildcards are made after the shuffle. Groups by
    (key, part) then need no shuffle of their own.
    """
    quarters = F.inline(F.array(*[F.struct(F.lit(~((1 << QUARTER) - 1 << at)).alias("_keep"), F.lit(at << 24).alias("_at")) for at in range(0, WIDTH, QUARTER)]))
    keyed = parts.withColumnRenamed("part", "whole").select("*", quarters).withColumn("key", F.col("whole").bitwiseAND(F.col("_keep")).bitwiseOR(F.col("_at"))).drop("_keep", "_at")
    dealt = keyed.repartition(min(SEGMENTS * (WIDTH // QUARTER) << (WIDTH - QUARTER), max(1, -(-sets // 4096))), "key")
    wild = F.explode(F.array(*[F.shiftright("key", 24) + F.lit(b) for b in range(QUARTER)]))
    part = F.col("whole").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1), F.col("_wild")))).bitwiseOR(F.shiftleft("_wild", 24))
    return dealt.select("*", wild.alias("_wild")).withColumn("part", part)


def first_met(a: str, b: str, wild: str, bit_a: str, bit_b: str) -> Column:
    """Of the variants that two sets share, at most one in each segment, and none if an earlier one of the first 64 bits has one.

    ``a`` and ``b`` are the whole segments of a shared variant, ``wild`` is the number of its wildcard.
    """
    apart = F.col(a).bitwiseXOR(F.col(b))
    once = (apart != 0) | (F.col(wild) == 0)
    diff = F.col(bit_a).bitwiseXOR(F.col(bit_b))
    for n in range(64 // WIDTH):
        met = F.bit_count(diff.bitwiseAND(F.lit(((1 << WIDTH) - 1 << n * WIDTH) - (1 << 64 if n == 64 // WIDTH - 1 else 0)))) <= 1
        once = once & ~(met & (F.shiftright(a, WIDTH) > n))
    return once


def close_pairs(pairs: DataFrame, distinct: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b: sets) those that differ in few enough of all bits."""
    bits = lambda c: distinct.select(F.col("fp").alias(c), F.col("bits").alias(f"_{c}"))
    apart = F.aggregate(F.zip_with("_a", "_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    return staged(pairs.join(bits("a"), "a").join(bits("b"), "b").filter(apart <= MOST_ALL).select("a", "b"), "close_pairs")


def texts_of(pairs: DataFrame, distinct: DataFrame, marked: DataFrame, text_col: str) -> DataFrame:
    """(fp, text) for the sets of ``pairs``. Only the numbers of their rows are shuffled."""
    wanted = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).distinct()
    rows = distinct.select("fp", "row").join(wanted, "fp")
    return staged(marked.select("row", F.col("doc")[text_col].alias("text")).join(rows.hint("shuffle_hash"), "row").select("fp", "text"), "candidate_texts")


def similar_pairs(pairs: DataFrame, texts: DataFrame, similarity: float, words: int) -> DataFrame:
    """Of ``pairs`` those whose texts are similar enough."""

    @F.pandas_udf(T.BooleanType())
    def near(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similar(shingle_set(x, words), shingle_set(y, words), similarity) for x, y in zip(a, b)], dtype=bool)

    side = lambda c: texts.select(F.col("fp").alias(c), F.col("text").alias(f"_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(near("_a", "_b")).select("a", "b")


def lone_shingles(texts: DataFrame, words: int) -> DataFrame:
    """(fp, lone) for every set of ``texts``: how many of its shingles none of the other sets has."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, words).view("<i8") for t in texts], dtype=object)

    owners = texts.select("fp", F.explode(hashed("text")).alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("sets"), F.min("fp").alias("fp"))
    lone = owners.filter("sets = 1").groupBy("fp").agg(F.count(F.lit(1)).cast("int").alias("lone"))
    return staged(texts.select("fp").join(lone, "fp", "left").select("fp", F.coalesce("lone", F.lit(0)).alias("lone")), "lone_shingles")


def linked_components(distinct: DataFrame, marked: DataFrame, similarity: float, words: int, text_col: str = "text") -> DataFrame:
    """(fp, component): components of the graph that links sets of ``similarity`` or more.

    ``distinct`` (fp, row, size, bits, odd) holds each set once, with one of its rows in ``marked``. Three rounds keep the number of texts that are compared linear
    where many texts are edits of one. In the first, each set is compared with one other: of its predecessors, in bit
    order, among sets with a whole segment in common, that which it meets most often. The sets that are close to
    theirs are candidates for large groups; their shingles are counted. In the second, each of them is compared with
    the set of its buckets that has the smallest share of shingles of its own, which is the text that the others edit.
    The third joins all variants, but only pairs from different components so far; of these one side lies outside the
    bucket's largest component. Of two counted sets neither can share a shingle of its own, which bounds what they have
    in common: a pair whose bound is below ``similarity`` has no link and is no candidate. The parities of any two sets
    bound it too.
    """
    near = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= MOST_FIRST
    of_size = lambda x, y: F.least(x, y) >= similarity * F.greatest(x, y)

    def met_most(met: DataFrame) -> DataFrame:
        """Of the sets that one meets (fp, o: size, bit, fp) the close one that it meets most often, as a pair."""
        met = met.filter(near(F.col("bit"), F.col("o.bit")) & of_size(F.col("size"), F.col("o.size")) & (F.col("fp") != F.col("o.fp"))).select("fp", F.col("o.fp").alias("other"))
        best = met.groupBy("fp", "other").count().groupBy("fp").agg(F.max(F.struct("count", "other"))["other"].alias("a"))
        return close_pairs(best.select("a", F.col("fp").alias("b")), distinct)

    keyed = segments(spread(distinct.select("fp", "size", "bits"), 8192)).select("fp", "size", F.col("bits")[0].alias("bit"), "part")
    before = met_most(keyed.withColumn("o", F.lag(F.struct("fp", "size", "bit")).over(Window.partitionBy("part").orderBy("bit", "fp"))))
    texts = texts_of(before, distinct, marked, text_col)
    lone = lone_shingles(texts, words)
    counted = segments(spread(distinct.select("fp", "size", "bits").join(lone, "fp"), 8192)).select("part", "fp", "size", F.col("bits")[0].alias("bit"), (-F.col("lone") / F.col("size")).alias("shared"))
    hubs = met_most(variants(counted, lone.count()).withColumn("o", F.max(F.struct("shared", "size", "fp", "bit")).over(Window.partitionBy("key", "part"))))
    first = connected_components(staged(similar_pairs(before.union(hubs).distinct(), texts, similarity, words), "near_links"))
    sizes = first.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    known = staged(
        distinct.join(first.withColumnRenamed("node", "fp").join(sizes, "component"), "fp", "left").join(lone, "fp", "left")
        .select("fp", "size", "bits", "odd", F.coalesce("component", "fp").alias("c"), F.coalesce("members", F.lit(1)).cast("int").alias("members"), F.coalesce("lone", F.lit(-1)).alias("lone")),
        "first_components",
    )
    component = F.struct("members", "c").alias("in")
    whole = lambda c: F.coalesce(c, F.lit(0))  # noqa: E731  no column is null, so neither side gets a filter that the other lacks
    keyed = segments(spread(known, 8192)).select("part", "fp", component, F.col("size").cast("int").alias("size"), "lone", F.col("bits")[0].alias("bit"), *[F.col("odd")[n].alias(f"odd{n}") for n in range(WORDS)])
    keyed = variants(keyed.select("in", *[whole(F.col(c)).alias(c) for c in keyed.columns if c != "in"]), known.count())
    # A pair is met from the side of the smaller component. Both sides have the same columns, so one shuffle serves both.
    probes = keyed.withColumn("largest", F.max("in").over(Window.partitionBy("key", "part"))).filter(F.col("in") < F.col("largest")).select([F.col(c).alias(f"{c}_a") for c in keyed.columns])
    same = (F.col("key_a") == F.col("key")) & (F.col("part_a") == F.col("part")) & first_met("whole_a", "whole", "_wild", "bit_a", "bit")
    wanted = same & (F.col("in_a") < F.col("in")) & near(F.col("bit_a"), F.col("bit")) & of_size(F.col("size_a"), F.col("size"))
    common = F.least(F.col("size_a") - F.col("lone_a"), F.col("size") - F.col("lone"))
    possible = (F.least("lone_a", "lone") < 0) | (common >= similarity * (F.col("size_a") + F.col("size") - common))
    differ = sum((F.bit_count(F.col(f"odd{n}_a").bitwiseXOR(F.col(f"odd{n}"))) for n in range(WORDS)), F.lit(0))
    both = F.col("size_a") + F.col("size")  # twice what they have in common at most, over twice their union, in the numbers of ``similar``
    possible = possible & (both - differ >= similarity * (both + differ))
    # Merge hints: the optimizer takes exploded variants for as small as their source and would broadcast them.
    pairs = probes.hint("merge").join(keyed.hint("merge"), wanted & possible).select(F.least("fp_a", "fp").alias("a"), F.greatest("fp_a", "fp").alias("b")).distinct()
    with joins_within_partitions(distinct.sparkSession):
        further = staged(pairs, "further_pairs")
    close = close_pairs(further, distinct)
    links = staged(similar_pairs(close, texts_of(close, distinct, marked, text_col), similarity, words), "further_links")
    of = lambda c: known.select(F.col("fp").alias(c), F.col("c").alias(f"c_{c}"))
    between = links.join(of("a"), "a").join(of("b"), "b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b")).distinct()
    second = connected_components(between).select(F.col("node").alias("c"), F.col("component").alias("final"))
    return known.join(second, "c", "left").select("fp", F.coalesce("final", "c").alias("component"))


def first_of_similar(docs: DataFrame, similarity: float = 0.8, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one for each component of near copies, with all their columns.

    The row with the component's smallest id stays (a null id loses to any other); of several such rows, one. Whole rows
    are shuffled once, by their number, when they are sketched; what is looked up later are numbers.
    """
    if similarity < 0.8:
        raise ValueError("the segments and bit limits are chosen for similarities of 0.8 or more")
    marked = bucketed(sketched(docs, words, id_col, text_col), "row", "sketched")
    groups = marked.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("first_id"), "row")).alias("first"), F.max("size").alias("size"), F.max("bits").alias("bits"), F.max("odd").alias("odd"))
    distinct = staged(groups.select("fp", "first", "first.row", "size", "bits", "odd"), "distinct_sets")
    held = distinct.select("fp", "first").join(linked_components(distinct, marked, similarity, words, text_col), "fp")
    stay = held.groupBy("component").agg(F.min(F.struct("first.none", "first.first_id", "fp", "first.row")).alias("stays")).select("stays.row")
    return unpacked(marked.join(stay.hint("shuffle_hash"), "row", "left_semi"))

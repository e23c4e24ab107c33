"""Exact nearest binary codes by incremental multi-index hashing.

Codes are cut into segments, each with its own index. Round s looks up every segment value at s bits from the
query's; after it, all codes within ``segments * (s + 1) - 1`` bits have been met. A query leaves the search when its
k-th verified distance lies within that radius, so results are exact. Rounds are Spark joins on (segment, value).

Defined results: a null or empty embedding has no code, is in no result and as a query gives no rows; a null element
counts as not positive; a query is never its own neighbour, but rows with other ids and the same code are; ties go to
the smaller id; of rows that repeat an id and code one counts; with fewer than k others all are returned; codes have as many
words of 64 bits as the longest vector needs, and shorter vectors count as not positive beyond their end. Other columns
are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .shared import join_groups, staged

BITS = 64
#: Bits of the widest segment; a wider one would have more values than an index has codes to tell apart.
MOST_WIDE = 22


def sign_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, code): bit i is set where element i is positive. A code is a long where no vector has more than 64 elements,
    else a struct of longs, w0 for the first 64 elements and so on."""
    rows = vectors.filter(F.size(vector_col) > 0)
    words = -(-(rows.agg(F.max(F.size(vector_col))).first()[0] or 1) // BITS)

    def word(at: int) -> Column:
        part = F.slice(vector_col, at * BITS + 1, BITS)
        set_bits = F.transform(part, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
        return F.aggregate(set_bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))

    code = word(0) if words == 1 else F.struct(*[word(i).alias(f"w{i}") for i in range(words)])
    return rows.select(F.col(id_col).alias("id"), code.alias("code")).distinct()


def _words(df: DataFrame, code: str) -> list[str]:
    """Names of the longs of a code."""
    held = df.schema[code].dataType
    return [f"{code}.{f.name}" for f in held.fields] if isinstance(held, T.StructType) else [code]


def cut(codes: int, words: int = 1) -> list[tuple[int, int, int]]:
    """(word, first bit, bits) of the fewest segments of a word that are no wider than the binary logarithm of the number
    of codes, nor than ``MOST_WIDE`` bits. Wider ones would be probed mostly at values that no code has."""
    n = max(-(-BITS // MOST_WIDE), math.ceil(BITS / max(3.0, math.log2(max(2, codes)))))
    edges = [round(i * BITS / n) for i in range(n + 1)]
    return [(word, a, b - a) for word in range(words) for a, b in zip(edges, edges[1:])]


def _part(word: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(word, first).bitwiseAND(F.lit((1 << bits) - 1))


def nearest_codes(queries: DataFrame, codes: DataFrame, k: int) -> DataFrame:
    """(query, code, distance): for each distinct query code the k nearest of the distinct ``codes`` (code, first_id),
    ties by ``first_id``."""
    total = codes.count()
    names = _words(codes, "code")
    mine = [n.replace("code", "query", 1) for n in names]
    segments = cut(total, len(names))
    widths = sorted({w for *_, w in segments})
    # A key is a segment's number above the bits that a segment can have.
    key = lambda j, part: F.lit(j << MOST_WIDE).cast("long").bitwiseOR(part)
    index = staged(codes.select(F.explode(F.array(*[key(j, _part(F.col(names[i]), a, w)) for j, (i, a, w) in enumerate(segments)])).alias("key"), "code", "first_id"), "segment_index")
    best = Window.partitionBy("query").orderBy("distance", "first_id")
    active = staged(queries.select(F.col("code").alias("query"), F.lit(BITS * len(names)).alias("bound")), "queries")
    state, done = None, []
    for radius in range(max(widths) + 1):
        if active.isEmpty():
            break
        parts = F.array(*[F.struct(key(j, _part(F.col(mine[i]), a, w)).alias("own"), F.lit(w).alias("bits")) for j, (i, a, w) in enumerate(segments)])
        asked = active.select("query", "bound", F.inline(parts))
        # At most 2 to the MOST_WIDE values in all rounds together, of each width: small enough to broadcast.
        flips = _flips(codes, widths, radius)
        probe = asked.join(F.broadcast(flips), "bits").select("query", "bound", F.col("own").bitwiseXOR(F.col("flip")).alias("probe"))
        differ = [F.col(q).bitwiseXOR(F.col(c)) for q, c in zip(mine, names)]
        far, *more = [F.bit_count(x) for x in differ]
        distance = sum(more, far)
        apart = [F.bit_count(_part(differ[i], a, w)) for i, a, w in segments]
        met_now = (F.least(*apart) if len(apart) > 1 else apart[0]) == radius  # not in an earlier round
        first = F.coalesce(*[F.when(x == radius, F.lit(j)) for j, x in enumerate(apart)])  # nor by an earlier segment
        # Merge hints: the optimizer takes exploded probes for as small as their source and would broadcast them.
        segment = F.shiftright("key", MOST_WIDE)
        wanted = met_now & (first == segment) & (distance <= F.col("bound"))
        found = probe.hint("merge").join(index.hint("merge"), (F.col("probe") == F.col("key")) & wanted)
        found = found.select("query", "code", "first_id", distance.cast("int").alias("distance"))
        if state is not None:
            found = found.unionByName(state.join(active.select("query"), "query", "left_semi"))
        state = staged(found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank"), "nearest")
        covered = len(segments) * (radius + 1) - 1
        kth = state.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"))
        closed = kth.filter((F.col("n") >= min(k, total)) & (F.col("far") <= covered)).select("query")
        done.append(state.join(closed, "query", "left_semi"))
        left = active.select("query").join(closed, "query", "left_anti").join(kth, "query", "left")
        active = staged(left.select("query", F.when(F.col("n") >= k, F.col("far")).otherwise(BITS * len(names)).alias("bound")), "queries")
    kind, first_id = codes.schema["code"].dataType, codes.schema["first_id"].dataType
    empty = T.StructType([T.StructField("query", kind), T.StructField("code", kind), T.StructField("first_id", first_id), T.StructField("distance", T.IntegerType())])
    out = codes.sparkSession.createDataFrame([], empty)
    for found in done:
        out = out.unionByName(found)
    return out


def _flips(df: DataFrame, widths: list[int], radius: int) -> DataFrame:
    """(bits, flip): the values of each width that have ``radius`` bits."""
    values = df.sparkSession.range(1 << max(widths)).filter(F.bit_count("id") == radius)
    return values.select(F.explode(F.array(*[F.lit(w) for w in widths])).alias("bits"), F.col("id").alias("flip")).filter(F.col("flip") < F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, distance) from ``vectors`` (id, code) for ``queries`` (id, code).

    Equal codes meet before the search: each distinct code keeps its k + 1 smallest ids, which suffice for any
    query's k nearest without itself, and each distinct query code is searched once.
    """
    numbered = vectors.withColumn("n", F.row_number().over(Window.partitionBy("code").orderBy("id"))).filter(F.col("n") <= k + 1)
    ids = staged(numbered, "code_ids")
    codes = staged(ids.filter("n = 1").select("code", F.col("id").alias("first_id")), "distinct_codes")
    asked = staged(queries.groupBy("code").agg(F.count(F.lit(1)).alias("askers")), "query_codes")
    near = staged(nearest_codes(asked, codes, k + 1), "nearest_codes")
    order = Window.partitionBy("query").orderBy("distance", "id")
    spread = near.join(ids, "code").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k + 1)
    lists = spread.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("distance", "id"))).alias("near")).withColumnRenamed("query", "code").join(asked, "code")
    mine = join_groups(queries.select(F.col("id").alias("query_id"), "code"), lists, "code", "askers")
    others = F.slice(F.filter("near", lambda x: ~x["id"].eqNullSafe(F.col("query_id"))), 1, k)
    return mine.select("query_id", F.posexplode(others).alias("at", "hit")).select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("id"), F.col("hit.distance").alias("distance"))

"""The trie of all conversation prefixes, with a count-min screen that keeps unshared tails out of the shuffle.

Each turn has a digest, and each prefix of a conversation two 64-bit ones: the exclusive or of the hashes of its turns,
each hashed with its depth, so it is a running aggregate. A count-min sketch of all prefixes, a counter for each digest
and cell that only tells one from more, becomes a bitmap that is broadcast. An estimate of one proves that a single
conversation has the prefix: that node, with its parent where the same holds for it, is written where it is found.
Only prefixes that may be shared are shuffled and grouped exactly.

Figures of subtrees need no walk up the tree. A node is named after its smallest member c. On c's path the nodes named
after c are those from some depth on, so a node's subtree has as many leaves as members that name a leaf, and its
nodes' words sum up to those of each member from the depth of its first own node on.

The bitmap has two cells a row, up to ``most_bits``; beyond that fewer tails are proven single and more are shuffled,
with the same result.

Defined results: turns are ordered by turn (null first), those of one number by digest; a null role or text is empty;
rows without conv_id belong to no conversation and are left out; repeated rows are turns of their own; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import join_groups, numbered, staged

#: Turns of a conversation that one task reads together.
BLOCK = 1024
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, at: 1 for the first turn, turn_hash, words) and, for each conversation, ``n`` turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.char_length(role), F.lit(":"), role, text).cast("binary")))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    rows = numbered(rows, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")])
    convs = staged(rows.groupBy("conv_id").agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("n")), "conversations")
    return join_groups(rows, convs, "conv_id", "n").select("conv_id", (F.col("row") - F.col("first_row") + 1).alias("at"), "digest", "words", "n")


def rebuilt(turns: DataFrame, group: int = 20, most_head: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, digest, words, n) of the rebuilt conversations, and (conv_id, n: their turns).

    A conversation's first h turns are replaced by those of its group's first conversation; h is the checksum of its
    decimal id modulo ``most_head``.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % F.lit(most_head)
    convs = turns.filter("at = 1").select("conv_id", F.col("n").alias("had"), h.alias("h"), (F.col("conv_id") - F.col("conv_id") % F.lit(group)).alias("base"))
    there = convs.select(F.col("conv_id").alias("base"), F.least("had", F.lit(most_head - 1)).alias("base_n"))
    convs = convs.join(there, "base", "left").withColumn("b", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = staged(convs.withColumn("n", F.col("b") + F.greatest(F.col("had") - F.col("h"), F.lit(0))), "rebuilt_conversations")
    # Depths stay where the head is as long as it was, which is nearly everywhere; other conversations are joined.
    shorter = convs.filter("b < h").select("conv_id", (F.col("h") - F.col("b")).alias("less"), "had")
    own = turns.filter(F.col("at") > h)
    own = join_groups(own, shorter, "conv_id", "had").unionByName(own.join(shorter, "conv_id", "left_anti"), allowMissingColumns=True)
    less = F.coalesce("less", F.lit(0))
    own = own.select("conv_id", (F.col("at") - less).alias("depth"), "digest", "words", (F.col("n") - less).alias("n"))
    heads = turns.filter(F.col("at") < most_head).select(F.col("conv_id").alias("base"), F.col("at").alias("depth"), "digest", "words")
    taken = heads.join(convs.filter("b > 0").select("base", "conv_id", "b", "n"), "base").filter("depth <= b").select("conv_id", "depth", "digest", "words", "n")
    return own.unionByName(taken), convs.select("conv_id", "n")


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, depth, digest, words, n) with the digests of their prefixes, ``p`` and, of the parent, ``up``,
    and the words ``before`` them. Long conversations are read in blocks, whose sums are summed up first."""
    rows = turns.withColumns({"a": F.xxhash64("depth", "digest"), "b": F.xxhash64("digest", F.lit(1), "depth"), "block": F.floor((F.col("depth") - 1) / BLOCK)})
    sums = lambda w: {"ra": F.bit_xor("a").over(w), "rb": F.bit_xor("b").over(w), "rw": F.sum("words").over(w)}
    inner = rows.withColumns(sums(Window.partitionBy("conv_id", "block").orderBy("depth")))
    blocks = rows.filter(F.col("n") > BLOCK).groupBy("conv_id", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("words").alias("words"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumns(sums(earlier)).filter("block > 0").select("conv_id", "block", F.col("ra").alias("oa"), F.col("rb").alias("ob"), F.col("rw").alias("ow"))
    met = inner.join(offsets, ["conv_id", "block"], "left")
    whole = lambda r, o: F.col(r).bitwiseXOR(F.coalesce(o, F.lit(0)))
    a, b = whole("ra", "oa"), whole("rb", "ob")
    return met.select(
        "conv_id", "depth", "words", "n", F.struct(a.alias("a"), b.alias("b")).alias("p"), F.struct(a.bitwiseXOR(F.col("a")).alias("a"), b.bitwiseXOR(F.col("b")).alias("b")).alias("up"),
        (F.col("rw") + F.coalesce("ow", F.lit(0)) - F.col("words")).alias("before"),
    )


def _cell(digest: Column, width: int) -> Column:
    return digest.bitwiseAND(F.lit(width - 1))


def screened(rows: DataFrame, most_bits: int = 1 << 28) -> DataFrame:
    """``rows`` of ``prefixes`` with ``single`` and ``up_single``: the sketch proves that one conversation has ``p``, or
    ``up``. The root is never proven single.

    The sketch has a row of cells for each of the two digests. What is shuffled are cells, counted before that; the
    bitmaps of cells with more than one are broadcast, at most ``most_bits`` each.
    """
    width = 1 << max(6, min(most_bits, 2 * rows.count()).bit_length() - 1)
    cells = rows.select(F.inline(F.array(*[F.struct(F.lit(x).alias("lane"), _cell(F.col("p")[x], width).alias("cell")) for x in "ab"])))
    full = cells.groupBy("lane", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    at = lambda cell: F.shiftright(cell, 6).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("cell").bitwiseAND(F.lit(63)).cast("int"))
    zeros = rows.sparkSession.range(width // 64).select(F.col("id").cast("int").alias("at"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("lane"), F.lit(0).cast("long").alias("word"))
    words = full.select(at(F.col("cell")).alias("at"), "lane", bit.alias("word")).unionByName(zeros).groupBy("lane", "at").agg(F.bit_or("word").alias("word"))
    lane = lambda x: F.transform(F.array_sort(F.collect_list(F.when(F.col("lane") == x, F.struct("at", "word")))), lambda y: y["word"])
    bitmaps = staged(words.agg(lane("a").alias("_a"), lane("b").alias("_b")).withColumn("_all", F.lit(0)), "screen")

    def many(digest: str) -> Column:
        held = [F.call_function("shiftright", F.get(f"_{x}", at(c)), c.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) for x in "ab" for c in [_cell(F.col(digest)[x], width)]]
        return (held[0] == 1) & (held[1] == 1)

    met = rows.withColumn("_all", F.lit(0)).join(F.broadcast(bitmaps), "_all")
    return met.select(*rows.columns, (~many("p")).alias("single"), ((F.col("depth") > 1) & ~many("up")).alias("up_single"))


def end_hashes(ends: DataFrame) -> DataFrame:
    """(p, ends_sha256) of ``ends`` (p, conv_id): ids in numeric order, joined by commas. A task streams its nodes' sorted
    ids through the hash, so memory does not grow with a node."""
    rows = ends.select("p.a", "p.b", "conv_id").repartition("a", "b").sortWithinPartitions("a", "b", "conv_id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []
        for batch in batches:
            for a, b, conv in zip(*(batch[c].to_pylist() for c in ("a", "b", "conv_id"))):
                if (a, b) == now:
                    state.update(b",%d" % conv)
                    continue
                if now:
                    out.append((*now, state.hexdigest()))
                now, state = (a, b), hashlib.sha256(b"%d" % conv)
            if len(out) > 10_000:
                yield _hash_rows(out)
                out = []
        if now:
            out.append((*now, state.hexdigest()))
        yield _hash_rows(out)

    found = rows.mapInArrow(hashed, "a long, b long, ends_sha256 string")
    return found.select(F.struct("a", "b").alias("p"), "ends_sha256")


def _hash_rows(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    a, b, h = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(h, pa.string())], names=["a", "b", "ends_sha256"])


def prefix_trie(turns: DataFrame, convs: DataFrame, most_bits: int = 1 << 28) -> DataFrame:
    """A row for each distinct prefix of the conversations ``turns`` (conv_id, depth, digest, words, n) and ``convs``
    (conv_id, n): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = staged(screened(staged(prefixes(turns), "prefixes"), most_bits), "screened_prefixes")
    zero = F.lit(0).cast("long")
    tail = {"n_convs": zero + 1, "n_children": (F.col("depth") < F.col("n")).cast("long"), "n_leaves": zero + 1, "saved_tokens": zero, "ends_sha256": F.when(F.col("depth") == F.col("n"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(EMPTY_SHA256)}
    local = rows.filter("single and up_single").withColumn("parent_conv_id", F.col("conv_id")).withColumns(tail)
    edge = rows.filter("single and not up_single")
    digest = F.struct(zero.alias("a"), zero.alias("b"))
    roots = convs.select("conv_id", zero.alias("depth"), zero.alias("words"), "n", digest.alias("p"), digest.alias("up"), zero.alias("before"), F.lit(False).alias("single"), F.lit(False).alias("up_single"))
    exact = rows.filter("not single").unionByName(roots)
    of_node = [F.max(c).alias(c) for c in ("depth", "words", "before", "up", "up_single")]
    nodes = staged(exact.groupBy("p").agg(F.min("conv_id").alias("conv_id"), *of_node, F.count(F.lit(1)).alias("n_convs"), F.count_if(F.col("n") == F.col("depth")).alias("n_ends")), "prefix_nodes")

    kids = nodes.filter("depth > 0 and not up_single").select("conv_id", "depth", "up").unionByName(edge.select("conv_id", "depth", "up"))
    counted = nodes.select("p", "conv_id").join(kids.groupBy(F.col("up").alias("p")).agg(F.count(F.lit(1)).alias("n_children")), "p")
    parents = staged(counted.select(F.col("p").alias("up"), F.col("conv_id").alias("parent_conv_id"), "n_children"), "prefix_parents")
    named = join_groups(kids, parents, "up", "n_children").select("conv_id", "depth", "parent_conv_id")

    # From which depth on a conversation names its nodes, the words before that, and whether it names a leaf.
    first = F.struct("depth", "before").alias("first")
    owned = nodes.select("conv_id", first, (F.col("n_convs") == F.col("n_ends")).alias("leaf"), F.lit(None).cast("long").alias("total"))
    owned = owned.unionByName(edge.select("conv_id", first, F.lit(True).alias("leaf"), F.lit(None).cast("long").alias("total")))
    whole = exact.filter("n = depth").select("conv_id", F.lit(None).cast("struct<depth:bigint,before:bigint>").alias("first"), F.lit(False).alias("leaf"), (F.col("before") + F.col("words")).alias("total"))
    figures = owned.unionByName(whole).groupBy("conv_id").agg(F.min("first").alias("first"), F.max("leaf").alias("leaf"), F.max("total").alias("total"))
    figures = figures.select("conv_id", F.col("leaf").cast("long").alias("leaf"), F.coalesce("first.before", "total").alias("shared"))
    below = exact.select("conv_id", "p", "before").join(figures, "conv_id").groupBy("p").agg(F.sum("leaf").alias("n_leaves"), F.sum(F.greatest(F.col("shared") - F.col("before"), zero)).alias("saved_tokens"))

    ends = end_hashes(exact.filter("n = depth").select("p", "conv_id"))
    met = nodes.join(below, "p").join(parents.select(F.col("up").alias("p"), "n_children"), "p", "left").join(ends, "p", "left")
    met = met.join(named, ["conv_id", "depth"], "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = met.withColumns({"parent_conv_id": parent, "n_children": F.coalesce("n_children", zero), "ends_sha256": F.coalesce("ends_sha256", F.lit(EMPTY_SHA256))})
    edges = edge.withColumns(tail).join(named, ["conv_id", "depth"])
    return inner.select(*columns).unionByName(edges.select(*columns)).unionByName(local.select(*columns))


def conversation_trie(conversations: DataFrame, most_bits: int = 1 << 28) -> DataFrame:
    """The trie of the rebuilt conversations of a table (conv_id, turn, role, text)."""
    turns, convs = rebuilt(staged(turn_rows(conversations), "turns"))
    return prefix_trie(turns, convs, most_bits)

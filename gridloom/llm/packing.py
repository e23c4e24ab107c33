"""Best-fit-decreasing packing of token sequences.

Documents longer than a sequence are cut; full pieces are sequences of their own. The rest is dealt at random into
shards of many sequences each, and every shard is packed by best-fit decreasing: a segment tree over remaining
capacities finds the tightest open sequence in logarithmic time. A shard loses at most its last open sequence, so
with shards of ``shard_tokens`` the loss is a fraction of ``seq_len / shard_tokens``.

Defined results: a null text counts as empty and packs its end id; repeated rows pack once each; an empty table gives
an empty result; only id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import staged
from .tokens import encoder


class TightestFit:
    """Open bins by remaining capacity, 0 to ``capacity``.

    A segment tree over the capacities holds in each node whether a bin with such room is open.
    """

    def __init__(self, capacity: int):
        self.half = 1 << capacity.bit_length()
        self.open = bytearray(2 * self.half)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, name: int) -> None:
        self.bins[room].append(name)
        node, tree = room + self.half, self.open
        while node and not tree[node]:
            tree[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, bin) of the bin with the least room of ``need`` or more."""
        node, tree = need + self.half, self.open
        while not tree[node]:
            while node & 1:  # a right child: what is larger lies beyond its ancestor
                node >>= 1
            if not node:
                return None
            node += 1
            if node & (node - 1) == 0:  # wrapped round to the next level's first node
                return None
        while node < self.half:
            node *= 2
            if not tree[node]:
                node += 1
        room = node - self.half
        name = self.bins[room].pop()
        if not self.bins[room]:
            tree[node] = 0
            while node > 1:
                node >>= 1
                if tree[2 * node] or tree[2 * node + 1]:
                    break
                tree[node] = 0
        return room, name


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each item, and the number of bins. Items of equal length keep their order."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fit, n = TightestFit(capacity), 0
    order = np.argsort(-lengths, kind="stable")
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        room, name = fit.take(length) or (capacity, n)
        n += name == n
        bins[i], offsets[i] = name, capacity - room
        if room > length:
            fit.put(room - length, name)
    return bins, offsets, n


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, seq_len: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's tokens with the end id, cut where they exceed ``seq_len``.

    All pieces but a cut document's first have ``seq_len`` tokens.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc, found in zip(batch["doc_id"].to_pylist(), encode.encode_all(x.as_py() for x in batch["text"])):
                ids = memoryview(found + end)
                n, at = len(ids) // 4, 0
                for piece in range(-(-n // seq_len)):
                    size = (n % seq_len or seq_len) if piece == 0 else seq_len
                    out.append((doc, piece, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])))
                    at += size
            cols = zip(*out) if out else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(parts: DataFrame, seq_len: int, shard_tokens: int = 8_000_000) -> DataFrame:
    """``parts`` (with a column length of 1 to ``seq_len``) with sequence_id and offset.

    The parts are staged: only their lengths and ids move, never tokens. Shards are dealt by a hash of the row's
    place in the staged table, so no document id is a hot key and a shard's size follows ``shard_tokens``.
    """
    rows = staged(parts, "pieces").withColumn("_row", F.monotonically_increasing_id())
    loose = rows.filter(F.col("length") < seq_len)
    total = loose.agg(F.sum("length")).first()[0] or 0
    shards = max(1, round(total / shard_tokens))
    schema = parts.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    names = [f.name for f in schema.fields]

    def packed(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("_row", ignore_index=True)
        bins, offsets, _ = best_fit_decreasing(shard["length"].to_numpy(), seq_len)
        return shard.assign(sequence_id=(shard["_shard"].to_numpy() << 32) + bins, offset=offsets)[names]

    dealt = loose.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))
    full = rows.filter(F.col("length") >= seq_len).select("*", (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return dealt.groupBy("_shard").applyInPandas(packed, schema).select(*names).unionByName(full.select(*names))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, seq_len: int = 2048, shard_tokens: int = 8_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, tokenizer_path, end_id, seq_len, id_col, text_col), seq_len, shard_tokens)


def sequences(docs: DataFrame, placed: DataFrame, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, ids array<int>): the packed sequences themselves, for unique document ids.

    Tokens are made again where they are needed, one document at a time, and gathered by sequence, whose size
    ``pack`` bounds.
    """
    slots = placed.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("slots"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(slots, "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out = []
            for found, slots in zip(encode.encode_all(x.as_py() for x in batch["text"]), batch["slots"].to_pylist()):
                ids = np.frombuffer(found + end, "<u4")
                out += [{"sequence_id": s["sequence_id"], "offset": s["offset"], "ids": ids[s["start"] : s["start"] + s["length"]].astype("<i4")} for s in slots]
            yield pa.RecordBatch.from_pylist(out, pa.schema([("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32()))]))

    cuts = rows.mapInArrow(cut, "sequence_id long, offset long, ids array<int>")
    return cuts.groupBy("sequence_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda s: s["ids"])).alias("ids"))

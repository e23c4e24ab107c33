"""Byte-pair encoding by a walk over a trie of the distinct words, and decoding.

In byte-pair encoding the encoding of a word is fixed by the last token of each of its prefixes: that token is the
one vocabulary entry that ends the prefix and that the merges leave apart from the last token of what stands before
it. So the distinct words of a block of texts go into a byte trie; a depth-first walk gives every node its last
token from the states of its ancestors, once for all words that share the prefix; a word's tokens are then read off
backwards from its end node.

Defined results: a null text counts as empty (no ids, empty decoded text); an added token in a text is one id, as
the library gives; null ids decode to empty text; other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .tokens import PieceEncoder, byte_letters

#: How byte-level tokenizers split text before their merges (fixed value).
SPLITS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Below it all Unicode versions agree on what a letter or a number is.
SETTLED = "\u0530"
#: Known pairs of tokens that a worker keeps.
MOST_PAIRS = 500_000

_loaded: dict[str, Vocabulary] = {}


class Vocabulary(PieceEncoder):
    """A byte-level vocabulary whose merged tokens are numbered in merge order."""

    def __init__(self, path: str, most_bytes: int = 96 << 20):
        super().__init__(path, most_bytes)
        model = self.spec["model"]
        if model.get("type") != "BPE" or not self.cuts or model.get("ignore_merges"):
            raise ValueError("a plain byte-level BPE vocabulary is needed")
        byte_of = {c: b for b, c in byte_letters().items()}
        raw = lambda word: bytes(map(byte_of.__getitem__, word))
        self.token_bytes: dict[int, bytes] = {i: raw(w) for w, i in model["vocab"].items()}
        self.id_of = {b: i for i, b in self.token_bytes.items()}
        self.prefixes = {b[:n] for b in self.id_of for n in range(len(b) + 1)}
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.made_at: dict[int, int] = {}
        for n, merge in enumerate(model["merges"]):
            a, b = (self.id_of[raw(x)] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            made = self.id_of[self.token_bytes[a] + self.token_bytes[b]]
            self.rank.setdefault((a, b), n)
            if made not in self.halves:
                self.halves[made], self.made_at[made] = (a, b), n
        self.token_bytes |= {i: s.encode() for s, i in self.added.items()}
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.library = Tokenizer.from_file(path).pre_tokenizer  # splits text with letters on which Unicode versions differ
        self.apart: dict[int, bool] = {}
        self.sound: dict[int, bool] = {}
        # States of the automaton that reads words: the longest ending so far that begins a token. Made as they are met.
        self.names, self.state_of = [b""], {b"": 0}
        self.moves: dict[int, int] = {}
        self.endings: list[list[tuple[int, int]]] = [[]]
        self.line_feed = self.whole("\n")
        del self.spec

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the merges, run over both tokens' bytes, end in exactly these two tokens."""
        key = left << 32 | right
        known = self.apart.get(key)
        if known is None:
            known = self._nothing_across(left, right, 1 << 60)
            if len(self.apart) < MOST_PAIRS:
                self.apart[key] = known
        return known

    def _nothing_across(self, a: int, b: int, until: int) -> bool:
        """Whether no merge crosses the border of two tokens before the merge of rank ``until``.

        Undoes the merges inside both tokens, latest first. A merge across the border that comes earlier than the
        merge just undone would have been taken in its place; of equal merges the one further left is taken first.
        """
        before = until
        while True:
            across = self.rank.get((a, b))
            if across is not None and across < before:
                return False
            at_a, at_b = self.made_at.get(a, -1), self.made_at.get(b, -1)
            if at_a > at_b:
                a, before = self.halves[a][1], min(until, at_a)
            elif at_b >= 0:
                b, before = self.halves[b][0], min(until, at_b + 1)
            else:
                return True

    def is_sound(self, token: int) -> bool:
        """Whether the merges make this token out of its own bytes."""
        if token not in self.halves:
            return True
        if token not in self.sound:
            a, b = self.halves[token]
            self.sound[token] = self.is_sound(a) and self.is_sound(b) and self._nothing_across(a, b, self.made_at[token])
        return self.sound[token]

    def move(self, state: int, byte: int) -> int:
        """The state after a further byte."""
        ending = self.names[state] + bytes((byte,))
        while ending not in self.prefixes:
            ending = ending[1:]
        to = self.state_of.get(ending)
        if to is None:
            to = self.state_of[ending] = len(self.names)
            self.names.append(ending)
            tokens = ((len(ending) - n, self.id_of.get(ending[n:])) for n in range(len(ending)))
            self.endings.append([(size, token) for size, token in tokens if token is not None and self.is_sound(token)])
        self.moves[state << 8 | byte] = to
        return to

    def encode_words(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Ids of distinct words. Words in sorted order are their trie in depth-first order, so what is held is the
        path to the current node: each node's automaton state, last token, and the depth at which that token starts."""
        longest = max(map(len, words), default=0)
        state, last, starts = [0] * (longest + 1), [0] * (longest + 1), [0] * (longest + 1)
        moves, endings, apart, move, stay_apart = self.moves, self.endings, self.apart, self.move, self.stay_apart
        packers = [struct.Struct(f"<{n}I").pack for n in range(64)]
        previous = b""
        for word in sorted(words):
            shared = 0
            for x, y in zip(previous, word):
                if x != y:
                    break
                shared += 1
            at = state[shared]
            for depth in range(shared, len(word)):
                byte = word[depth]
                to = moves.get(at << 8 | byte)
                at = move(at, byte) if to is None else to
                depth += 1
                state[depth] = at
                for size, token in endings[at]:
                    start = depth - size
                    if start:
                        left = last[start]
                        fits = apart.get(left << 32 | token)
                        if not (stay_apart(left, token) if fits is None else fits):
                            continue
                    last[depth], starts[depth] = token, start
                    break
            ids, depth = [], len(word)
            while depth:
                ids.append(last[depth])
                depth = starts[depth]
            ids.reverse()
            yield word, packers[len(ids)](*ids) if len(ids) < 64 else np.array(ids, "<u4").tobytes()
            previous = word

    def split(self, text: str) -> list[str]:
        if not text or max(text) < SETTLED:
            return SPLITS.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def encode_pieces(self, pieces: list[str], lead: str) -> Iterator[bytes]:
        whole: dict[bytes, bytes] = {}
        parts: dict[str, list[bytes]] = {}
        for piece in pieces:
            text = lead + piece
            if piece.isalpha() and max(piece) < SETTLED:
                whole[text.encode()] = b""
            else:
                parts[piece] = [x.encode() for x in self.split(text)]
        words = set(whole)
        for x in parts.values():
            words.update(x)
        known = dict(self.encode_words(words))
        for piece in pieces:
            yield known[(lead + piece).encode()] if piece not in parts else b"".join([known[w] for w in parts[piece]])

    def whole(self, text: str) -> bytes:
        plan: list[bytes | int] = []
        for chunk in self.added_pattern.split(text) if self.added_pattern else [text]:
            plan += [self.added[chunk]] if chunk in self.added else [x.encode() for x in self.split(chunk)]
        known = dict(self.encode_words({x for x in plan if x.__class__ is bytes}))
        return b"".join([known[x] if x.__class__ is bytes else struct.pack("<I", x) for x in plan])

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _ids_array(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype("<i4")
    return pa.ListArray.from_arrays(pa.array(ends), pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))]))


def _portions(batch: pa.RecordBatch, words: Vocabulary, most: int = 1_000_000) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Ids of documents and of their texts, some million at a time."""
    at, size, held = 0, 0, []
    for ids in words.encode_all(x.as_py() for x in batch["text"]):
        held.append(ids)
        size += len(ids)
        if size >= most:
            yield batch["doc_id"].slice(at, len(held)), held
            at, size, held = at + len(held), 0, []
    if held:
        yield batch["doc_id"].slice(at), held


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>). Texts are worked in blocks of some million characters, so a trie stays small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(tokenizer_path)
        for batch in batches:
            for doc_ids, ids in _portions(batch, words):
                yield pa.RecordBatch.from_arrays([doc_ids, _ids_array(ids)], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``; broken UTF-8 becomes U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(tokenizer_path)
        for batch in batches:
            step = 200
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                texts = [words.decode(x or ()) for x in part["ids"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["ids"], pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def encode_and_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded): both directions in one pass, so a task needs one worker and one vocabulary.

    ``decoded`` is made from the ids alone, as ``decode`` makes it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(tokenizer_path)
        for batch in batches:
            for doc_ids, ids in _portions(batch, words):
                texts = [words.decode(memoryview(x).cast("I")) for x in ids]
                yield pa.RecordBatch.from_arrays([doc_ids, _ids_array(ids), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")

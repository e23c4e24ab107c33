"""Tokenising of whole texts inside tasks: cutting at blanks, and the tokenizers library behind it."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator

import numpy as np
from tokenizers import Tokenizer

os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task is one thread; the library's own would only wait


def byte_letters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


def blocks(texts: Iterable[str | None], most: int = 1_000_000) -> Iterator[list[str | None]]:
    """``texts`` in lists of about ``most`` characters; a longer text ends a list."""
    block: list[str | None] = []
    size = 0
    for text in texts:
        block.append(text)
        size += len(text or "")
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


class PieceEncoder:
    """Ids of whole texts, from the ids of their pieces; a subclass encodes pieces and texts that can't be cut.

    Byte-level tokenizers split a text before their merges. A single blank between two characters that are not white
    space starts a split, and so does a line feed; one or two line feeds together are a split each. So texts are cut
    there, and every distinct piece of a block is encoded once. A text goes through ``whole`` where it has other white
    space, a blank beside white space or at an end, more line feeds together, two at its end, or an added token. Ids
    of pieces are kept for later blocks, ``most_bytes`` of them in each worker; those beyond are encoded anew.
    """

    def __init__(self, path: str, most_bytes: int = 128 << 20):
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        before, added = self.spec.get("pre_tokenizer") or {}, self.spec.get("added_tokens", [])
        self.added = {x["content"]: x["id"] for x in added}
        self.cuts = (
            self.spec.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
            and not any(x.get("lstrip") or x.get("rstrip") or x["content"].split() != [x["content"]] for x in added)
        )
        self.inner, self.first = _Kept(""), _Kept("\n")
        self.room = most_bytes

    def whole(self, text: str) -> bytes:
        """Ids of a text."""
        raise NotImplementedError

    def encode_pieces(self, pieces: list[str], lead: str) -> Iterable[bytes]:
        """Ids of pieces without white space, each behind ``lead``, a blank or nothing."""
        raise NotImplementedError

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers, a block of texts at a time."""
        for block in blocks(texts):
            yield from self._block(block) if self.cuts else [self.whole(x) if x else b"" for x in block]

    def _settle(self, missed: set[str]) -> tuple[dict[str, bytes], set[str]]:
        """Ids of new pieces, and those of them that show that a text can't be cut. A line feed marks pieces that start
        a line."""
        marked = {p for p in missed if p[:1] == "\n"}
        unfit = {p for p in missed - marked if p.split() != [p]} | {p for p in marked if p[1:].split() != [p[1:]]}
        if any(x in everything for everything in [" ".join(missed)] for x in self.added):
            unfit |= {p for p in missed if any(x in p for x in self.added)}
        heads, rests = [p[1:] for p in marked - unfit], list(missed - marked - unfit)
        new: dict[str, bytes] = {}
        for pieces, lead, mark, kept in ((heads, "", "\n", self.first), (rests, " ", "", self.inner)):
            if not pieces:
                continue
            for piece, ids in zip(pieces, self.encode_pieces(pieces, lead)):
                new[mark + piece] = ids
                if self.room > 0 and len(piece) <= 32:
                    kept[piece] = ids
                    self.room -= len(piece) + len(ids) + 200  # with what the objects and their places take
        return new, unfit

    def _block(self, texts: list[str | None]) -> list[bytes]:
        missed: list[str] = []  # in the order of the gaps that they leave
        self.first.missed = self.inner.missed = missed
        first, inner, line_feed = self.first, self.inner.__getitem__, self.line_feed
        out: list[bytes | None] = []
        gaps: list[tuple[int, list[bytes | None], int, int]] = []
        for n, text in enumerate(texts):
            if not text:
                out.append(b"")
            elif "\n\n\n" in text or text.endswith("\n\n"):
                out.append(self.whole(text))
            else:
                ids: list[bytes | None] = []
                before = len(missed)
                for line in text.split("\n"):
                    ids.append(line_feed)
                    if line:
                        head, *rest = line.split(" ")
                        ids.append(first[head])
                        ids += map(inner, rest)
                ids[0] = b""
                if len(missed) == before:
                    out.append(b"".join(ids))
                else:
                    out.append(None)
                    gaps.append((n, ids, before, len(missed)))
        new, unfit = self._settle(set(missed))
        for n, ids, a, b in gaps:
            if unfit and not unfit.isdisjoint(missed[a:b]):
                out[n] = self.whole(texts[n])
                continue
            at = -1
            for piece in missed[a:b]:
                at = ids.index(None, at + 1)
                ids[at] = new[piece]
            out[n] = b"".join(ids)
        return out


class _Kept(dict):
    """Ids by piece. A piece that is missing is noted in ``missed``, behind ``mark``, and gives None."""

    def __init__(self, mark: str):
        self.mark, self.missed = mark, []

    def __missing__(self, piece: str) -> None:
        self.missed.append(self.mark + piece)


class TextEncoder(PieceEncoder):
    """Ids as the library gives them; one call encodes all new pieces of a block."""

    def __init__(self, path: str, most_bytes: int = 128 << 20):
        super().__init__(path, most_bytes)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        if self.cuts:
            blank, self.line_feed = byte_letters()[32], self.whole("\n")
            self.opens = np.zeros(self.size, bool)
            self.opens[[i for word, i in self.spec["model"]["vocab"].items() if word[0] == blank]] = True
            self.breaks = np.zeros(self.size, bool)
            self.breaks[np.frombuffer(self.line_feed, "<u4")] = True
        del self.spec

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def whole(self, text: str) -> bytes:
        return self.ids(text).tobytes()

    def encode_pieces(self, pieces: list[str], lead: str) -> list[bytes]:
        """The library gets the pieces as one text; a piece's ids start at a token that starts with a blank, or end
        before a line feed."""
        if lead:
            ids = self.ids(lead + lead.join(pieces))
            starts = np.flatnonzero(self.opens[ids])
            ends = np.append(starts[1:], len(ids))
        else:
            ids = self.ids("\n".join(pieces))
            ends = np.append(np.flatnonzero(self.breaks[ids]), len(ids))
            starts = np.append(0, ends[:-1] + 1)
        if len(starts) != len(pieces):  # a vocabulary without such tokens
            return [self.whole(lead + p) for p in pieces]
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip((4 * starts).tolist(), (4 * ends).tolist())]

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_all([text]))


_loaded: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The encoder for a vocabulary file, loaded once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = TextEncoder(path)
    return _loaded[path]

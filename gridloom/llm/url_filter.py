"""URL filtering by a bit-parallel wildcard automaton.

All glob rules are packed into one row of 64-bit words. A URL's characters drive every rule at once (Shift-And with
self-loops for runs), and numpy steps a whole Arrow batch of URLs together.

A glob is a string of bytes with ``*`` for any run, ``?`` for any byte and ``~`` for any run without a slash.

Defined results: a null url, or one without ``://``, has empty host and path and gets the default verdict; of rules
that fit, the longest wins, then the first in sorted order; ``page_id`` may be null or repeated; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class GlobAutomaton:
    """Simulates all globs over byte strings; each takes a start bit and a bit for each byte of its pattern."""

    def __init__(self, globs: list[str]):
        steps: list[int | None] = []  # for each bit: None for a start, a byte, or -1 for any byte
        loops: list[str] = []  # for each bit: the run that may stand after it
        ends = []
        for glob in globs:
            steps.append(None)
            loops.append("")
            for c in glob.encode():
                if chr(c) in "*~":
                    loops[-1] = "*" if "*" in (chr(c), loops[-1]) else "~"
                else:
                    steps.append(-1 if chr(c) == "?" else c)
                    loops.append("")
            ends.append(len(steps) - 1)
        self.words = max(1, -(-len(steps) // 64))
        self.take = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for bit, (step, loop) in enumerate(zip(steps, loops)):
            word, mask = bit // 64, np.uint64(1 << bit % 64)
            if step is None:
                self.start[word] |= mask
            elif step < 0:
                self.take[:, word] |= mask
            else:
                self.take[step, word] |= mask
            if loop:
                self.stay[:, word] |= mask
                if loop == "~":
                    self.stay[ord("/"), word] &= ~mask
        self.end_word = np.array([e // 64 for e in ends], np.int64)
        self.end_bit = np.array([e % 64 for e in ends], np.uint64)

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """(texts, globs) booleans."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")
        flat = np.frombuffer(b"".join(texts), np.uint8)
        starts = (np.cumsum(lengths) - lengths)[order]
        running = lengths[order]
        state = np.tile(self.start, (len(texts), 1))
        one, top = np.uint64(1), np.uint64(63)
        for at in range(int(running[0]) if len(running) else 0):
            live = int(np.searchsorted(-running, -at))  # those longer than ``at`` come first
            chars, now = flat[starts[:live] + at], state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:live] = moved & self.take[chars] | now & self.stay[chars]
        out = np.empty((len(texts), len(self.end_word)), bool)
        out[order] = (state[:, self.end_word] >> self.end_bit) & one
        return out


def host_of(url: str | Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case."""
    c = F.col(url) if isinstance(url, str) else url
    host = F.regexp_extract(c, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    c = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(c, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row; ``rules`` are (verdict, host, path).

    A rule fits its host and all subdomains where the path starts with the rule's. The canonical URL is a dot, the
    host and the path, so ``~.host/path*`` is the rule's glob. The rules travel with the task.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    names = [h + p for _, h, p in ranked]
    verdicts = [v for v, _, _ in ranked]
    automaton = GlobAutomaton([f"~.{h}{p}*" for _, h, p in ranked])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = automaton.matches([f".{h}{p}".encode() for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist())])
            best = np.where(fits.any(axis=1), fits.argmax(axis=1), -1).tolist() if names else [-1] * batch.num_rows
            rule = pa.array([names[k] if k >= 0 else None for k in best], pa.string())
            verdict = pa.array([verdicts[k] if k >= 0 else default for k in best], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rule, verdict], names=["page_id", "host", "path", "rule", "verdict"])

    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    return rows.mapInArrow(judge, f"page_id {pages.schema[id_col].dataType.simpleString()}, host string, path string, rule string, verdict string")

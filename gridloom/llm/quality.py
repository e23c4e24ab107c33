"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad; the field sees numbers that describe the line and its two neighbours, and has a weight for
each pair of labels that follow one another. A document's score is the mean of its lines' forward-backward marginals
of "good", weighted by line length.

Defined results: a null text counts as empty; an empty text is one empty line and gets a score; without labelled rows
every score is 0.5; repeated rows are scored alike; only the text is an input of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .shared import staged

#: Kinds of bytes: other, letter (all bytes beyond ASCII too), capital, digit, blank, sentence mark, exclamation, symbol, bar.
KINDS = np.zeros(256, np.uint8)
KINDS[[*range(97, 123), *range(128, 256)]] = 1
KINDS[65:91] = 2
KINDS[48:58] = 3
KINDS[[9, 11, 12, 13, 32]] = 4
KINDS[list(b".,;:'\"-()")] = 5
KINDS[list(b"!?")] = 6
KINDS[list(b"#$%&*+<=>@\\^_`{}~/[]")] = 7
KINDS[list(b"|")] = 8
N_KINDS = 9
N_LINE = N_KINDS + 8


#: Lines that a recursion over a text takes one by one; longer texts are taken in parts side by side.
STEPS = 512


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of all texts, each line's weight, and lines in each text."""
    lines_of = [(t or "").split("\n") for t in texts]
    counts = np.fromiter(map(len, lines_of), np.int64, len(texts))
    flat = "\n".join([t or "" for t in texts]).encode("utf-8", "replace")
    kinds = KINDS[np.frombuffer(flat + b"\n", np.uint8)]
    ends = np.flatnonzero(np.frombuffer(flat + b"\n", np.uint8) == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = ends - starts
    own = np.zeros((len(ends), N_LINE), np.float32)
    for kind in range(N_KINDS):
        total = np.concatenate(([0], np.cumsum(kinds == kind, dtype=np.int64)))
        own[:, kind] = (total[ends] - total[starts]) / np.maximum(size, 1)
    words = np.zeros((len(ends), 5), np.float32)
    at = 0
    for lines in lines_of:
        seen: set[str] = set()
        for line in lines:
            w = line.split()
            n = len(w) or 1
            words[at] = (len(w), len(set(w)) / n, sum(map(eq, w, w[1:])) / n, line in seen, len(lines))
            seen.add(line)
            at += 1
    own[:, N_KINDS] = np.log1p(size)
    own[:, N_KINDS + 1] = np.log1p(words[:, 0])
    own[:, N_KINDS + 2] = size / np.maximum(words[:, 0], 1)
    own[:, N_KINDS + 3 : N_KINDS + 6] = words[:, 1:4]
    own[:, N_KINDS + 6] = np.log1p(words[:, 4])
    own[:, N_KINDS + 7] = size == 0
    own[:, N_KINDS + 2] = np.minimum(own[:, N_KINDS + 2], 40)
    return own, size + 1.0, counts


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before it and of the line after it; zeros at a text's ends."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    first = np.cumsum(counts) - counts
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first] = 0
    after[first + counts - 1] = 0
    return np.concatenate([own, before, after], axis=1)


class LineField:
    """The trained field: standardisation, weights of the features for "good", and transition scores."""

    def __init__(self, features: int):
        self.mean, self.scale = np.zeros(features), np.ones(features)
        self.weights, self.bias, self.moves = np.zeros(features), 0.0, np.zeros((2, 2))

    def emissions(self, own: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The score of "good" for each line. Only one number a line is held beside its own features."""
        out = np.full(len(own), self.bias)
        first = np.cumsum(counts) - counts
        n = own.shape[1]
        for k, ends in enumerate((None, first, first + counts - 1)):  # the line's own features, and its neighbours'
            mean, scale, weights = self.mean[k * n : (k + 1) * n], self.scale[k * n : (k + 1) * n], self.weights[k * n : (k + 1) * n]
            part = np.empty(len(own))
            for at in range(0, len(own), 1 << 15):
                part[at : at + (1 << 15)] = np.clip((own[at : at + (1 << 15)] - mean) / scale, -8, 8) @ weights
            if ends is not None:
                part = np.roll(part, 1 if k == 1 else -1)
                part[ends] = np.clip(-mean / scale, -8, 8) @ weights
            out += part
        return np.clip(out, -25, 25)

    def forward_backward(self, score: np.ndarray, counts: np.ndarray, left: np.ndarray | None = None, right: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
        """P(good) of each line, expected label pairs summed over the texts, and the log of the normalisers' product.

        All texts take a step together, the longest first in order, so a step is one numpy operation. Parts of texts
        take what the lines before them say of their first line's label, ``left``, and those after of their last's,
        ``right``.
        """
        order = np.argsort(-counts, kind="stable")
        first, long = (np.cumsum(counts) - counts)[order], counts[order]
        emit = np.stack([np.ones_like(score), np.exp(score)], axis=1)
        move = np.exp(self.moves)
        alpha, beta, norm = np.empty((len(score), 2)), np.ones((len(score), 2)), np.empty(len(score))
        if right is not None:
            beta[first + long - 1] = right[order]
        live = [int(np.searchsorted(-long, -t)) for t in range(int(long[0]))]
        for t, n in enumerate(live):
            at = first[:n] + t
            a = (emit[at] if left is None else emit[at] * left[order][:n]) if t == 0 else (alpha[at - 1] @ move) * emit[at]
            norm[at] = a.sum(axis=1)
            alpha[at] = a / norm[at][:, None]
        pairs = np.zeros((2, 2))
        for t in range(len(live) - 2, -1, -1):
            at = first[: live[t + 1]] + t
            ahead = emit[at + 1] * beta[at + 1] / norm[at + 1][:, None]
            beta[at] = ahead @ move.T
            pairs += alpha[at].T @ ahead * move
        both = alpha * beta
        return both[:, 1] / both.sum(axis=1), pairs, float(np.log(norm).sum())

    def marginals(self, score: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """P(good) of each line. Texts of more than ``STEPS`` lines are cut in parts: products of the parts' matrices
        carry two numbers over each border, in either direction, and then all parts are taken side by side."""
        if counts.max(initial=0) <= STEPS:
            return self.forward_backward(score, counts)[0]
        parts = [[STEPS] * ((n - 1) // STEPS) + [(n - 1) % STEPS + 1] for n in counts.tolist()]
        sizes = np.array([x for p in parts for x in p])
        starts = np.cumsum(sizes) - sizes
        emit, move = np.stack([np.ones_like(score), np.exp(score)], axis=1), np.exp(self.moves)
        through = np.tile(np.eye(2), (len(sizes), 1, 1))  # from the label before a part to that of its last line
        for t in range(STEPS):
            on = np.flatnonzero(sizes > t)
            step = through[on] @ move * emit[starts[on] + t][:, None, :]
            through[on] = step / step.sum(axis=(1, 2))[:, None, None]
        left, right = np.ones((len(sizes), 2)), np.ones((len(sizes), 2))
        at = 0
        for p in parts:
            a = emit[starts[at]]  # of a text's first part, whose matrix has a move too many, the messages are made anew
            for t in range(1, p[0]):
                a = (a @ move) * emit[starts[at] + t]
                a = a / a.sum()
            for n in range(at + 1, at + len(p)):
                left[n] = a @ move
                left[n] /= left[n].sum()
                a = a @ through[n]
                a = a / a.sum()
            for n in range(at + len(p) - 1, at, -1):
                right[n - 1] = through[n] @ right[n]
                right[n - 1] /= right[n - 1].sum()
            at += len(p)
        return self.forward_backward(score, sizes, left, right)[0]

    def fit(self, x: np.ndarray, counts: np.ndarray, good: np.ndarray, rounds: int = 200, rate: float = 0.05, penalty: float = 0.05) -> LineField:
        """Maximise the likelihood of the line labels (each text's own label on all its lines) by Adam.

        A text counts once, however many lines it has: its lines' terms are divided by their number.
        """
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        label = np.repeat(good, counts).astype(float)
        share = np.repeat(1.0 / counts, counts)
        truth = np.zeros((2, 2))
        for g in (0, 1):
            truth[g, g] = (counts[good == g] - 1).sum()
        theta = np.zeros(len(self.weights) + 5)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, rounds + 1):
            self.weights, self.bias, self.moves = theta[:-5], theta[-5], theta[-4:].reshape(2, 2)
            p, pairs, _ = self.forward_backward(np.clip(z @ self.weights + self.bias, -25, 25), counts)
            gap = (label - p) * share
            grad = np.concatenate([z.T @ gap, [gap.sum()], ((truth - pairs) / max(1.0, counts.mean())).ravel()]) / len(counts)
            grad[:-5] -= penalty * theta[:-5] / len(counts)
            grad[-4:] -= 0.05 * theta[-4:]
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.weights, self.bias, self.moves = theta[:-5], theta[-5], theta[-4:].reshape(2, 2)
        return self

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        own, weight, counts = line_features(texts)
        p = self.marginals(self.emissions(own, counts), counts)
        first = np.cumsum(counts) - counts
        return np.clip(np.add.reduceat(p * weight, first) / np.add.reduceat(weight, first), 0, 1)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether crc32 of the id as text is divisible by five; a null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most_docs: int = 4000, most_lines: int = 200_000, id_col: str = "doc_id", text_col: str = "text") -> LineField:
    """Fit on at most ``most_docs`` labelled documents that are not held out, picked by a hash of their ids.

    The bounds are on the sample, never on what is scored. Documents are taken in the hash's order as long as all of
    them together have no more than ``most_lines`` lines; features are computed on the executors, from whole texts, and
    the driver gets a few numbers for each line of the sample. A document with labels that contradict each other
    is left out.
    """
    known = labels.select(F.col("doc_id").alias("_label_id"), F.col("quality").cast("int").alias("quality")).filter(F.col("quality").isin(0, 1) & ~held_out("_label_id"))
    known = known.groupBy("_label_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_most")).filter("quality = _most").drop("_most")
    picked = known.orderBy(F.xxhash64("_label_id"), "_label_id").limit(most_docs)
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(picked), F.col("_id") == F.col("_label_id"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                part = part.filter(pa.array([(t or "").count("\n") < most_lines for t in part["text"].to_pylist()], pa.bool_()))
                if not part.num_rows:
                    continue
                own, _, counts = line_features(part["text"].to_pylist())
                cuts = np.split(with_neighbours(own, counts), np.cumsum(counts)[:-1])
                yield pa.RecordBatch.from_arrays([part["_id"], part["quality"], pa.array([c.astype("<f4").tobytes() for c in cuts], pa.binary()), pa.array(counts, pa.int64())], names=["_id", "quality", "lines", "n"])

    found = staged(sample.select(F.col("_id").cast("long").alias("_id"), "quality", "text").mapInArrow(features, "_id long, quality int, lines binary, n long"), "line_sample")
    so_far = F.sum("n").over(Window.orderBy(F.xxhash64("_id"), "_id"))
    taken = found.groupBy("_id").agg(F.sum("n").alias("n")).withColumn("_lines", so_far).filter(F.col("_lines") <= most_lines)
    rows = found.join(F.broadcast(taken.select("_id")), "_id", "left_semi").drop("n").toPandas()
    field = LineField(3 * N_LINE)
    if rows.empty or rows["quality"].nunique() < 2:
        return field
    rows = rows.sort_values(["_id", "lines"], ignore_index=True)
    lines = [np.frombuffer(b, "<f4").reshape(-1, 3 * N_LINE) for b in rows["lines"]]
    return field.fit(np.concatenate(lines).astype(float), np.array([len(x) for x in lines]), rows["quality"].to_numpy())


def score_column(field: LineField, text_col: str = "text") -> F.Column:
    """The score as a column, from whole texts in blocks of some million characters."""

    @F.pandas_udf(T.DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        out: list[np.ndarray] = []
        block: list[str | None] = []
        size = 0
        for t in texts:
            block.append(t)
            size += len(t or "")
            if size > 2_000_000:
                out.append(field.scores(block))
                block, size = [], 0
        out.append(field.scores(block))
        return pd.Series(np.concatenate(out))

    return scored(F.col(text_col))

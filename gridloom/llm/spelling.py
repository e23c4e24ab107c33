"""Spelling variants of a corpus' words: asymmetric q-chunks find the pairs that one edit separates.

Of two words that one inserted, deleted or replaced code point separates, the shorter (of equal lengths the first)
contributes two disjoint chunks of half its length, at its start and at its end; the other contributes its positional
grams of that length. The edit leaves one chunk whole, and it moves by at most one place, so an equality join on the
gram, with the places at most one apart, meets every such pair; the edit distance is verified.

A bucket that many words share is split: a shared chunk leaves a rest in which the edit is, and the rest's own two
chunks, one of which is whole too, are added to the bucket's key. So the pairs of a bucket stay in proportion to its
words, until the rest is a letter.

Defined results: a null text has no words and a null id reads as an empty string in the checksum; empty tables and texts
without words give an empty result; repeated rows count again. Other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import staged

LETTERS = "A-Za-zÀ-ÿ"
_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
#: Characters of a text that are searched at once, and different words that a task counts before it passes them on.
SLICE, HELD = 1_000_000, 400_000


def _runs(text: str, least: int) -> Iterator[list[str]]:
    """Lower-cased maximal runs of letters of ``least`` code points or more, a slice of the text at a time."""
    run, other = re.compile(f"[{LETTERS}]{{{least},}}"), re.compile(f"[^{LETTERS}]")
    at = 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            gap = other.search(text, end)
            end = gap.start() if gap else len(text)
        yield run.findall(text[at:end].translate(_LOWER))
        at = end


def word_counts(docs: DataFrame, least_length: int = 6, noise: int = 199, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n). Where ``noise`` divides the checksum of a document's id and a run, the run loses a code point.

    Words are counted within tasks, in bounded memory, before they are shuffled.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["id"].to_pylist(), batch["text"]):
                text = text.as_py()
                if not text:
                    continue
                own: Counter[str] = Counter()
                for found in _runs(text, least_length):
                    own.update(found)
                start = zlib.crc32(f"{doc_id}:".encode())
                for run in [w for w in own if zlib.crc32(w.encode(), start) % noise == 0]:
                    k = zlib.crc32(run.encode(), start) % len(run)
                    n, word = own.pop(run), run[:k] + run[k + 1 :]
                    if len(word) >= least_length:
                        total[word] += n
                for run, n in own.items():
                    total[run] += n
                if len(total) > HELD:
                    yield _count_rows(total)
                    total.clear()
        yield _count_rows(total)

    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _count_rows(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])


def _parts(rows: DataFrame) -> DataFrame:
    """The two rows that each of ``rows`` (side, d, word, n, lo, hi, key) becomes when its rest, from ``lo`` to ``hi``, is
    halved: one half joins the key, the other is the new rest. ``d`` is by how much the rest is longer than the other
    word's; places count from 0."""
    q = F.floor((F.col("hi") - F.col("lo") - F.col("d")) / 2).cast("int")
    gram = lambda at: F.substring(F.col("word"), at + 1, q)
    part = lambda k, at, lo, hi: F.struct(F.xxhash64("key", F.lit(k), gram(at)).alias("key"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    return rows.select("side", "d", "word", "n", F.inline(F.array(part(0, lo, lo + q, hi), part(1, hi - q, lo, hi - q))))


def chunks_and_grams(words: DataFrame, least_length: int) -> DataFrame:
    """(side, d, word, n, key, lo, hi): the chunks of every word, ``c``, and its grams, ``g``, that can meet a chunk of a
    word as long (d = 0) or shorter by one (d = 1), with the rest that a meeting leaves.

    A chunk moves by nothing where the edit is behind it and by ``d`` where it is before it. Grams at the other place
    within a shift of one leave no rest (lo is null): what they meet is near only if the other chunk meets too.
    """
    sides = F.inline(F.array(*[F.struct(F.lit(side).alias("side"), F.lit(d).alias("d")) for side, d in (("c", 0), ("g", 0), ("g", 1))]))
    whole = words.select("word", "n", F.char_length("word").alias("hi"), sides).filter(F.col("hi") - F.col("d") >= least_length)
    whole = whole.withColumns({"lo": F.lit(0), "key": (F.col("hi") - F.col("d")).cast("long")})
    q = F.floor(F.col("key") / 2).cast("int")
    none = F.lit(None).cast("int")
    shifted = F.array(*[F.struct(F.xxhash64("key", F.lit(k), F.substring(F.col("word"), at + 1, q)).alias("key"), none.alias("lo"), none.alias("hi")) for k, at in ((0, F.lit(1)), (1, F.col("hi") - 1 - q))])
    return _parts(whole).unionByName(whole.filter("d = 1").select("side", "d", "word", "n", F.inline(shifted)))


def near_words(words: DataFrame, least_length: int = 6, most_shared: int = 64) -> DataFrame:
    """(word, n, other, other_n) for every two of ``words`` (word, n; each once) that one edit separates, both ways round.

    A bucket in which more than ``most_shared`` chunks meet more than so many grams is split.
    """
    rows, found = staged(chunks_and_grams(words, least_length), "chunks_and_grams"), None
    while True:
        sizes = rows.groupBy("key").agg(F.count_if(F.col("side") == "c").alias("c"), F.count_if(F.col("side") == "g").alias("g"), F.max(F.col("hi") - F.col("lo") - F.col("d")).alias("rest"))
        large = staged(sizes.filter(F.least("c", "g") > most_shared).filter("rest >= 2").select("key"), "large_buckets")
        small = rows.join(large, "key", "left_anti")
        a = small.filter("side = 'c'").select("key", F.col("word").alias("word_a"), F.col("n").alias("n_a"))
        b = small.filter("side = 'g'").select("key", "d", F.col("word").alias("word_b"), F.col("n").alias("n_b"))
        once = (F.col("d") == 1) | (F.col("word_a") < F.col("word_b"))
        # Merge hint: the optimizer takes exploded rows to be as small as their source.
        met = a.hint("merge").join(b, (a["key"] == b["key"]) & once & (F.levenshtein("word_a", "word_b", 1) == 1)).select("word_a", "n_a", "word_b", "n_b")
        found = met if found is None else found.unionByName(met)
        if large.isEmpty():
            break
        rows = staged(_parts(rows.filter("lo is not null").join(large, "key", "left_semi")), "split_buckets")
    pairs = staged(found.distinct(), "near_words")
    one = lambda a, b: pairs.select(F.col(f"word_{a}").alias("word"), F.col(f"n_{a}").alias("n"), F.col(f"word_{b}").alias("other"), F.col(f"n_{b}").alias("other_n"))
    return one("a", "b").unionByName(one("b", "a"))


def roots(forms: DataFrame, most_n: int, ratio: int) -> DataFrame:
    """(word, root) of ``forms`` (word, form), each followed to the end. A form is ``ratio`` times as frequent as its
    word, which bounds the steps by the logarithm of ``most_n``; each round doubles them."""
    now = forms.select("word", F.col("form").alias("root"))
    steps = max(1, math.ceil(math.log(max(most_n, 2), ratio)))
    for _ in range(math.ceil(math.log2(steps))):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = staged(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling_roots")
    return now


def spelling_variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, ratio: int = 5, noise: int = 199, most_shared: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of a corpus.

    A word's form is its most frequent near word (of equally frequent ones the first in code-point order), if that is
    ``ratio`` times as frequent; its root is the last in its chain of forms.
    """
    counts = word_counts(docs, least_length, noise, id_col, text_col)
    words = staged(counts.filter(F.col("n") >= least_count), "words")
    near = near_words(words, least_length, most_shared).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.max("n").alias("n"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    near = staged(near.select("word", "n_near", F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best")), "nearest_words")
    most = words.agg(F.max("n")).first()[0] or 0
    last = roots(near.filter("best is not null").select("word", F.col("best.form").alias("form")), most, ratio)
    met = words.join(near, "word", "left").join(last, "word", "left")
    return met.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"), F.coalesce("root", "word").alias("root"))

"""Spelling variants, the conversation trie and sharding against brute force, and on odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridloom.llm import conversations
from gridloom.llm.conversations import conversation_trie
from gridloom.llm.sharding import Permutation, shard_documents, write_shards
from gridloom.llm.shared import scratch
from gridloom.llm.spelling import _runs, spelling_variants

SF = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}


def words_of(rows):
    c = Counter()
    for i, t in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = r.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            if h % 199 == 0:
                k = h % len(r)
                r = r[:k] + r[k + 1 :]
            c[r] += 1
    return {w: n for w, n in c.items() if len(w) >= 6 and n >= 5}


def variants(rows):
    c = words_of(rows)
    near, same = defaultdict(set), defaultdict(set)
    for w in c:
        for k in range(len(w)):
            less = w[:k] + w[k + 1 :]
            same[k, less].add(w)
            if less in c:
                near[w].add(less)
                near[less].add(w)
    for ws in same.values():
        for a in ws:
            near[a] |= ws - {a}
    form = {}
    for w, n in c.items():
        best = min(near[w], key=lambda x: (-c[x], x), default=None)
        if best and c[best] >= 5 * n:
            form[w] = best
    out = []
    for w, n in c.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, n, len(near[w]), f, c[f] if f else None, root))
    return sorted(out)


@pytest.fixture(scope="module")
def misspelt():
    draw = random.Random(3)
    words = ["".join(draw.choice("abÀ÷") for _ in range(draw.choice([6, 6, 7, 7, 8, 11, 12]))) for _ in range(600)]
    pick = lambda: draw.choice(words).upper() if draw.random() < 0.1 else draw.choice(words[: 60 if draw.random() < 0.6 else 600])
    rows = [(draw.choice([None, *range(50)]), " ".join(pick() for _ in range(60))) for _ in range(250)]
    return [*rows, rows[0], (1, None), (2, ""), (3, " ".join(words[:10]) * 3), (4, "12 .. ab"), (5, "verylong " * 50_000)]


@pytest.mark.parametrize("most_shared", [64, 1])
def test_spelling_equals_brute_force_with_and_without_split_buckets(spark, misspelt, most_shared):
    rows = [(*r, 7, "x") for r in misspelt]
    got = spelling_variants(spark.createDataFrame(rows, "doc_id long, text string, n int, word string").repartition(3), most_shared=most_shared)
    want = variants(misspelt)
    assert sorted(map(tuple, got.collect())) == want
    assert sum(r[2] for r in want) > 100 and any(r[3] for r in want)


def test_spelling_words_of_one_long_prefix(spark):
    draw = random.Random(5)
    words = ["internationali" + "".join(draw.choice("abcd") for _ in range(6)) for _ in range(400)]
    rows = [(i, " ".join(words)) for i in range(6)]
    assert sorted(map(tuple, spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"), most_shared=8).collect())) == variants(rows)


def test_spelling_of_nothing(spark):
    assert spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_do_not_depend_on_slices(monkeypatch):
    text = "Abcdefg hij ÀÖöabcdef;" * 30
    whole = [w for part in _runs(text, 6) for w in part]
    monkeypatch.setattr("gridloom.llm.spelling.SLICE", 7)
    assert [w for part in _runs(text, 6) for w in part] == whole == ["abcdefg", "ÀÖöabcdef"] * 30


def trie(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            convs[c].append(((t is not None, t or 0), hashlib.md5(f"{len(r)}:{r}{x}".encode()).digest(), r, x))
    convs = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = convs.get(int(c / 20) * 20, [])[:h] + own[h:]
    members, kids = defaultdict(list), defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    out, leaves, saved = [], {}, {}
    for k in sorted(members, key=len, reverse=True):
        m = members[k]
        leaves[k] = sum(leaves[x] for x in kids[k]) if kids[k] else 1
        saved[k] = sum(saved[x] for x in kids[k]) + ((len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0)
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


@pytest.fixture(scope="module")
def talks():
    """Missing bases, short heads, nulls in any column, repeated turn numbers and rows."""
    draw = random.Random(1)
    rows = [
        (c, draw.choice([None, 0, 1, 2, 3]), draw.choice(["u", None, ""]), draw.choice(["a b", "a", None, "c  d e"]))
        for c in [0, 1, 2, 3, 20, 21, 22, 41, 42, 45, 46, 47, 48, 49, -3, None] for _ in range(draw.randint(1, 6))
    ]
    return rows + rows[:10]


@pytest.mark.parametrize(("bits", "block"), [(1 << 28, 1024), (64, 1024), (1 << 28, 3)])
def test_trie_equals_brute_force_whatever_the_screen_proves(spark, talks, monkeypatch, bits, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    df = spark.createDataFrame([(*r, 1) for r in talks], "conv_id long, turn long, role string, text string, depth int")
    assert sorted(map(tuple, conversation_trie(df, bits).collect())) == trie(talks)


def test_trie_of_given_conversations_of_copies_and_of_nothing(spark):
    given = spark.read.parquet(f"{SF}/conversations.parquet")
    assert sorted(map(tuple, conversation_trie(given).collect())) == trie([tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()])
    copies = [(c, t, "u", f"turn {t}") for c in range(0, 4000, 20) for t in range(3)]
    df = spark.createDataFrame(copies, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, conversation_trie(df).collect())) == trie(copies)
    assert conversation_trie(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 24, 1000, 4097])
def test_permutation_is_one_and_goes_back(spark, n):
    p = Permutation(n)
    rows = spark.range(n).select("id", p.of(F.col("id")).alias("p")).withColumn("back", p.back(F.col("p"))).collect()
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)


def test_shards_are_even_gapless_reproducible_and_computable(spark):
    rows = [(i, f"text {i % 50}", i, "s") for i in range(500)] + [(None, None, 0, "a")] * 40 + [(7, "text 7", 1, "b")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, shard string")
    placed = shard_documents(docs.repartition(5), 7)
    got = placed.collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.size == len((r.doc.text or "").encode()) + 8 and r.text_crc32 == zlib.crc32((r.doc.text or "").encode())
    assert sorted(map(tuple, (r.doc for r in got)), key=repr) == sorted(rows, key=repr)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = shard_documents(docs.repartition(3), 7).collect()
    key = lambda r: (r.doc.doc_id is not None, r.doc.doc_id or 0, r.size, r.shard, r.slot)
    assert sorted(map(key, got)) == sorted(map(key, again))
    back = placed.filter(F.col("row") != Permutation(len(rows)).row_at(F.col("shard"), F.col("slot"), 7))
    assert back.count() == 0
    write_shards(placed, path := scratch(spark, "shards"), rows_per_file=100)
    read = spark.read.parquet(path)
    assert read.count() == len(rows) and sorted(r.slot for r in read.filter("shard = 3").collect()) == sorted(slots[3])
    assert shard_documents(docs.limit(0), 7).count() == 0

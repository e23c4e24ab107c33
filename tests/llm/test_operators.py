"""Each operator against a brute-force version, a round trip or held-out accuracy, and on odd tables."""

import base64
import hashlib
import json
import random
import re
import zlib
from collections import defaultdict
from html import unescape

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridloom.llm import html_text, queries, quality
from gridloom.llm.bpe import Vocabulary, decode, encode, encode_and_decode
from gridloom.llm.components import connected_components
from gridloom.llm.exact_dedup import DigestIndex, deduplicate, first_of_group
from gridloom.llm.packing import best_fit_decreasing, pack_documents, sequences
from gridloom.llm.simhash import fingerprint, first_of_component, near_duplicates
from gridloom.llm.token_files import FrameReader, read_token_files, write_token_files
from gridloom.llm.tokens import TextEncoder, byte_letters
from gridloom.llm.topk import sign_codes, top_k
from gridloom.llm.url_filter import GlobAutomaton, filter_urls
from gridloom.llm.warc import read_archives, write_archives

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LONG = "lorem ipsum dolor " * 60_000
#: Nulls in any column, empty and very long texts, ties, repeated rows, a row without id, columns with clashing names.
ODD = [
    (1, "a b c", 0), (2, "a  b\tc", 0), (2, "a  b\tc", 0), (3, None, 1), (4, "", 1), (5, " \n", None), (6, LONG, 2), (7, LONG, 2), (None, "no id here at all", 3), (8, "x <|endoftext|> y", 3), (9, "a b c", 3), (10, "ünï cödé 🙂 Ж՘", 3),
]
SCHEMA = "doc_id long, text string, ids int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCABULARY)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words32(ids):
    return np.array(ids, "<u4").tobytes()


# ---- exact dedup


def test_exact_dedup(spark, odd, none):
    got = sorted(((r.doc_id, r.keep_id, r.group_size) for r in deduplicate(odd, DigestIndex(spark, buckets=4)).collect()), key=str)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t, _ in ODD:
        groups[norm(t)].append(i)
    want = sorted(((i, min((x for x in groups[norm(t)] if x is not None), default=None), len(groups[norm(t)])) for i, t, _ in ODD), key=str)
    assert got == want
    assert deduplicate(none, DigestIndex(spark, buckets=4)).count() == 0
    kept = first_of_group(odd, DigestIndex(spark, buckets=4))
    assert kept.columns == odd.columns and sorted(((r.doc_id for r in kept.collect())), key=str) == sorted([1, 3, 5, 6, 8, 10, None], key=str)


def test_index_goes_on(spark):
    index = DigestIndex(spark, buckets=4)
    frame = lambda *rows: spark.createDataFrame(rows, "doc_id long, text string")
    deduplicate(frame((5, "one"), (6, "two")), index).collect()
    got = {r.doc_id: (r.keep_id, r.known) for r in deduplicate(frame((1, "one "), (2, "one"), (3, "three")), index).collect()}
    assert got[2] == (5, True) and got[3] == (3, False)
    assert index.read().count() == 4
    assert [r.doc_id for r in first_of_group(frame((9, "nine"), (2, "one")), index).collect()] == [9]


def test_one_text_for_a_third_of_rows(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    got = deduplicate(rows, DigestIndex(spark, buckets=4))
    assert got.count() == 3000 and got.filter("keep_id = 0 and group_size = 1000").count() == 1000


# ---- SimHash


def brute_fingerprint(text, n):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    ones = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(fps, distance):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_near_duplicates(spark, documents, odd, none):
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(1000 + i, t) for i, t, _ in ODD if i is not None]
    fps = [brute_fingerprint(t, 4) for _, t in rows]
    part = brute_components(fps, 4)
    least = defaultdict(lambda: 1 << 62)
    for (i, _), p in zip(rows, part):
        least[p] = min(least[p], i)
    got = sorted((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted((i, f, least[p]) for (i, _), f, p in zip(rows, fps, part))
    assert near_duplicates(odd).count() == len(ODD) and near_duplicates(none).count() == 0
    kept = first_of_component(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id = 2").count() == 0
    assert fingerprint(None) == fingerprint(" \n") == 0


def test_texts_without_or_with_one_id_stay_apart(spark):
    """Unlinked texts all stay, whether they have no id, repeat one or have their own; of linked ones, one row."""
    random.seed(5)
    text = lambda: " ".join(str(random.random()) for _ in range(40))
    near = text()
    rows = [*[(None, text()) for _ in range(6)], *[(7, text()) for _ in range(5)], (8, text()), (None, near), (None, near.upper()), (9, ""), (None, None), (None, " ")]
    kept = first_of_component(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id for r in kept), key=str) == [7] * 5 + [8, 9] + [None] * 7
    assert {(r.doc_id, r.text) for r in kept} - {(None, near), (None, near.upper())} == {*rows[:12], (9, "")}


def test_no_link_is_lost(spark):
    """Random fingerprints in dense balls, at every distance."""
    from gridloom.llm import simhash
    from gridloom.llm.shared import staged

    random.seed(4)
    fps = set()
    for _ in range(12):
        centre = random.getrandbits(64)
        for _ in range(40):
            x = centre
            for b in random.sample(range(64), random.randint(0, 9)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    frame = staged(spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in fps], "fp long"), "test_fps")
    got = {r.fp & (2**64 - 1): r.component for r in simhash.linked_components(frame, 4).collect()}
    part = dict(zip(fps, brute_components(fps, 4)))
    assert len(got) == len(fps)
    for a in random.sample(fps, 60):
        for b in fps:
            assert (got[a] == got[b]) == (part[a] == part[b])


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (200, 200), (7, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


# ---- near copies by similarity


def brute_shingles(text, n=5):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_near_copies_at_every_similarity(spark, odd, none):
    """The survivors are those of brute force over exact five-word shingle similarity, with pairs around 0.8."""
    import corpus_pipeline as pipe

    random.seed(9)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    for g in range(60):
        words = [f"w{random.randrange(10**6)}" for _ in range(random.randint(60, 300))]
        for k in range(4):
            new = list(words)
            for at in random.sample(range(len(words)), random.randint(0, len(words) // 30)):
                new[at] = f"v{random.randrange(10**6)}"
            rows.append((10**6 + 10 * g + k if g % 3 else None, " ".join(new)))
    rows += [(i, t) for i, t, _ in ODD] + [(None, None), (None, "only this here")]
    sets = [brute_shingles(t) for _, t in rows]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s or {None}:
            where[x].append(i)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    at_least, below = 0, 0
    for b, s in enumerate(sets):
        for a in {a for x in s or {None} for a in where[x] if a < b}:
            both = len(s & sets[a])
            if s == sets[a] or 5 * both >= 4 * len(s | sets[a]):
                root[find(b)] = find(a)
                at_least += both < 0.9 * len(s | sets[a])
            else:
                below += both >= 0.7 * len(s | sets[a])
    assert at_least > 20 and below > 20
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[find(i)].append(d)
    want = [min((d for d in g if d is not None), default=None) for g in groups.values()]
    kept = pipe.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5), "")
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)
    assert pipe.near_dedup(spark, none, "").count() == 0 and pipe.near_dedup(spark, odd, "").columns == odd.columns


def test_edits_of_one_text_are_few_candidates(spark, monkeypatch):
    """Edits that are less than 0.8 similar to each other are no candidates, and no link is lost: components are brute force's."""
    from gridloom.llm import near_text

    random.seed(11)
    first = [f"w{random.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(400):
        new = list(first)
        for at in random.sample(range(5, 145, 5), 5 if i % 10 else 1):  # each changes five shingles, so no pair is close to 0.8
            new[at] = f"v{random.randrange(10**6)}"
        rows.append((i, " ".join(new)))
    sets = [near_text.shingle_set(t) for _, t in rows]
    odd = [near_text.parities(s) for s in sets]
    root = list(range(len(rows)))
    for b in range(len(rows)):
        for a in range(b):
            differ = len(np.setxor1d(sets[a], sets[b]))
            assert sum(int(x).bit_count() for x in (odd[a] ^ odd[b]).view(np.uint64)) <= differ
            if near_text.similar(sets[a], sets[b], 0.8):
                old, new = root[b], root[a]
                root = [new if x == old else x for x in root]
    candidates = []

    def staged(df, name, write=near_text.staged):
        out = write(df, name)
        candidates.extend([out.count()] if name == "further_pairs" else [])
        return out

    monkeypatch.setattr(near_text, "staged", staged)
    kept = near_text.first_of_similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r.doc_id for r in kept.collect()} == {root.index(x) for x in set(root)}
    assert len(candidates) == 1 and candidates[0] < 2000  # of 79,800 pairs


# ---- tokens


def test_encoder_is_the_library(library):
    encoder, words = TextEncoder(VOCABULARY, most_bytes=10_000), Vocabulary(VOCABULARY, most_bytes=10_000)
    random.seed(0)
    texts = ["".join(random.choice("ab ,.'sé1\n!Üñ ’Жa\teth e") for _ in range(random.randint(0, 40))) for _ in range(3000)]
    texts += ["", " ", "x<|endoftext|>", "a" * 300, "  \n\n ", "it's he'll", "\u3000x\u00a0y", "՘ 🙂‍", *[t for _, t, _ in ODD if t and t != LONG]]
    assert [encoder.encode(t) for t in texts] == [words32(library(t)) for t in texts]
    assert list(encoder.encode_all(texts)) == list(words.encode_all(texts)) == [words32(library(t)) for t in texts]


def test_trie_on_random_bytes():
    words, letters = Vocabulary(VOCABULARY), byte_letters()
    random.seed(1)
    t = Tokenizer.from_file(VOCABULARY)
    for _ in range(400):
        w = "".join(chr(random.choice([97, 98, 101, 46, 0x416, 0x1F642])) for _ in range(random.randint(1, 30)))
        assert dict(words.encode_words({w.encode()}))[w.encode()] == words32([x.id for x in t.model.tokenize("".join(letters[b] for b in w.encode()))])


def test_bpe_round_trip(odd, none, library):
    got = sorted(((r.doc_id, list(r.ids), r.decoded) for r in decode(encode(odd, VOCABULARY), VOCABULARY).collect()), key=str)
    both = sorted(((r.doc_id, list(r.ids), r.decoded) for r in encode_and_decode(odd, VOCABULARY).collect()), key=str)
    assert both == got and encode_and_decode(none, VOCABULARY).count() == 0
    assert got == sorted(((i, library(t), t or "") for i, t, _ in ODD), key=str)
    assert decode(encode(none, VOCABULARY), VOCABULARY).count() == 0
    assert Vocabulary(VOCABULARY).decode([127, 250, 447]) == Tokenizer.from_file(VOCABULARY).decode([127, 250, 447], skip_special_tokens=False)


def test_token_files(spark, odd, none, library, tmp_path):
    manifest = write_token_files(odd, VOCABULARY, 2, path=str(tmp_path), files=3)
    got = sorted(((r.doc_id, r.start, bytes(r.ids)) for r in read_token_files(manifest).collect()), key=lambda x: x[1])
    at, want = 0, []
    for i, t, _ in sorted(ODD, key=lambda x: -1 if x[0] is None else x[0]):
        ids = library(t) + [2]
        want.append((i, at, words32(ids)))
        at += len(ids)
    assert [g[1:] for g in got] == [w[1:] for w in want] and [g[0] for g in got] == [w[0] for w in want]
    some = read_token_files(manifest, spark.createDataFrame([(2,), (8,), (99,)], "doc_id long"))
    assert sorted(r.doc_id for r in some.collect()) == [2, 2, 8]
    assert write_token_files(none, VOCABULARY, 2).count() == 0
    path = manifest.first().path
    raw = bytearray(open(path, "rb").read())
    raw[12] ^= 255
    open(path, "wb").write(raw)
    with pytest.raises(Exception):
        FrameReader(path).ids(0)


# ---- packing


def test_packing(odd, none, library):
    rows = pack_documents(odd, VOCABULARY, 0, 2048, shard_tokens=20_000).collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(len(library(t)) + 1 for _, t, _ in ODD)
    assert sum(r.length for r in rows) == total
    long = sorted((r.piece, r.start, r.length) for r in rows if r.doc_id == 6)
    n = len(library(LONG)) + 1
    assert long[0][2] == (n % 2048 or 2048) and all(x[2] == 2048 for x in long[1:]) and [x[0] for x in long] == list(range(len(long)))
    assert pack_documents(none, VOCABULARY).count() == 0


def test_best_fit_decreasing():
    random.seed(2)
    for capacity in (1, 7, 64, 2048):
        lengths = np.array([random.randint(1, capacity) for _ in range(400)], np.int64)
        rooms = []
        for n in sorted(lengths.tolist(), reverse=True):
            fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
            if fits:
                rooms[min(fits)[1]] -= n
            else:
                rooms.append(capacity - n)
        bins, offsets, count = best_fit_decreasing(lengths, capacity)
        assert count == len(rooms) and np.bincount(bins, lengths).max() <= capacity


def test_sequences_hold_the_tokens(spark, library):
    docs = spark.createDataFrame([(i, "word " * (i * 37)) for i in range(60)], "doc_id long, text string")
    placed = pack_documents(docs, VOCABULARY, 0, 256)
    got = {r.sequence_id: list(r.ids) for r in sequences(docs, placed, VOCABULARY, 0).collect()}
    tokens = {i: library("word " * (i * 37)) + [0] for i in range(60)}
    for r in placed.collect():
        assert got[r.sequence_id][r.offset : r.offset + r.length] == tokens[r.doc_id][r.start : r.start + r.length]


# ---- WARC


def test_archives(spark, tmp_path):
    pages = [(1, "http://a/ü\r\n", "same " * 50, "x"), (2, None, "same " * 50, "x"), (2, None, "same " * 50, "x"), (3, "u", None, None), (4, "u", "", "x"), (None, "u", "lone", "x"), *[(10 + i, "u", f"<p>page {i}</p>" * 30, "x") for i in range(40)]]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, digest string").repartition(3)
    index = write_archives(frame, path=str(tmp_path), sample_bytes=3000)
    got = read_archives(index).collect()
    assert len(got) == len(pages)
    for r in got:
        payload = {p[0]: (p[2] or "").encode() for p in pages}[r.page_id]
        assert r.payload_bytes == len(payload) and r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == payload
    kinds = sorted((r.page_id, r.record_type, r.refers_to) for r in got if r.page_id in (1, 2, 3, 4))
    assert kinds == [(1, "revisit", 2), (2, "response", None), (2, "revisit", 2), (3, "revisit", 4), (4, "response", None)]
    big = read_archives(write_archives(frame, min_bytes=1000))
    assert big.filter("record_type = 'revisit'").count() == 0
    assert write_archives(frame.limit(0)).count() == 0


# ---- top-k


@pytest.mark.parametrize("n", [3, 300])
def test_top_k(spark, n):
    random.seed(6)
    base = [random.getrandbits(64) for _ in range(max(2, n // 10))]
    rows = [(i, x - 2**64 if (x := random.choice(base) ^ sum(1 << b for b in random.sample(range(64), random.choice([0, 0, 3, 20])))) >> 63 else x) for i in range(n)]
    frame = spark.createDataFrame(rows, "id long, code long")
    got = defaultdict(list)
    for r in top_k(frame, frame.filter("id % 20 = 0"), 10).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.distance, r.id))
    for q, code in rows:
        if q % 20 == 0:
            assert got[q] == sorted((bin((c ^ code) & (2**64 - 1)).count("1"), i) for i, c in rows if i != q)[:10]


def test_codes_of_any_width(spark):
    frame = lambda *sizes: spark.createDataFrame([(n, [-1.0] * (n - 1) + [1.0]) for n in sizes], "vec_id int, embedding array<double>")
    assert {r.id: r.code & (2**64 - 1) for r in sign_codes(frame(3, 64)).collect()} == {3: 4, 64: 1 << 63}
    assert {r.id: [w & (2**64 - 1) for w in r.code] for r in sign_codes(frame(3, 65, 130)).collect()} == {3: [4, 0, 0], 65: [0, 1, 0], 130: [0, 0, 2]}
    random.seed(9)
    base = [[random.choice([-1.0, 1.0]) for _ in range(150)] for _ in range(12)]
    vectors = [(i, [-x if random.random() < 0.02 else x for x in random.choice(base)][: random.choice([150, 150, 100])]) for i in range(120)]
    vectors += [(500, []), (501, None), (520, [None] * 70), (540, vectors[0][1])]
    codes = sign_codes(spark.createDataFrame(vectors, "vec_id int, embedding array<double>").repartition(3))
    got = defaultdict(list)
    for r in top_k(codes, codes.filter("id % 20 = 0"), 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.distance, r.id))
    ones = {i: {k for k, x in enumerate(v) if x and x > 0} for i, v in vectors if v}
    assert got == {q: sorted((len(ones[q] ^ ones[i]), i) for i in ones if i != q)[:5] for q in ones if q % 20 == 0}
    assert top_k(codes.limit(0), codes.limit(0), 5).count() == 0


# ---- URL filter


def test_automaton():
    import fnmatch

    random.seed(8)
    globs = ["a*b", "*", "?b*", "ab", "*ba*ab*", "b?*a", *["".join(random.choice("ab*?") for _ in range(12)) for _ in range(30)]]
    texts = ["".join(random.choice("ab") for _ in range(random.randint(0, 20))) for _ in range(300)]
    got = GlobAutomaton(globs).matches([t.encode() for t in texts])
    assert (got == np.array([[fnmatch.fnmatchcase(t, g) for g in globs] for t in texts])).all()
    assert GlobAutomaton(["~.net/*"]).matches([b".net/", b".a.net/x", b".a/b.net/", b".anet/"]).ravel().tolist() == [True, True, False, False]


def test_url_rules(spark):
    urls = ["https://A.Example.NET/en/x?y#z", "http://example.net/de", "http://net", "http://net/", "http://xnet/", None, "no scheme", "http://", "ftp://u.org/fr/", "http://example.com/de/1", "http://a.com/b.net/", "x://y://net/", "http://net?/en/", "http://" + "n" * 5000 + ".net/"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = [(r.host, r.path, r.rule, r.verdict) for r in filter_urls(frame, queries.URL_RULES).orderBy("page_id").collect()]
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[1] == ("example.net", "/de", "net/", "block") and got[2] == ("net", "", None, "allow") and got[3][2] == "net/"
    assert [g[2] for g in got[4:]] == [None, None, None, None, "org/fr/", "example.com/de/", None, None, None, "net/"]
    assert got[5][:2] == got[6][:2] == ("", "") and got[11][:2] == ("y:", "//net/")
    assert filter_urls(frame.limit(0), queries.URL_RULES).count() == 0 and filter_urls(frame, []).filter("verdict = 'allow'").count() == len(urls)


# ---- main text


def page(body, title="t"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var a='<p>no</p>';</script></head><body>{body}</body></html>"


def test_main_text(spark):
    pages = []
    for i in range(12):
        text = "".join(f"<p>para {i} {j} &amp; <b>bold</b><br>line" for j in range(i % 4 + 1))
        side = '<aside class="sidebar">side</aside>' if i % 2 else ""
        pages.append((i, "http://one.example/a", page(f"<nav><ul><li><a href=x>menu</a></li></ul></nav><div class='ad'>buy</div><article><h1>Head {i}</h1>{text}<div class=comments><p>reader {i}</p></div></article>{side}<footer>&copy; foot</footer>")))
        paras = "".join(f"<p>{' '.join(f'w{i}x{j}y{k}' for k in range(30))}</p>" for j in range(3))
        pages.append((100 + i, "http://two.example/b", page(f"<div class=top>Site name</div><div class=wrap><div class=inner><div class=tagline>Always the same line here</div>{paras}</div><div class=menu>x y z</div></div>")))
    pages += [(200, None, None), (201, "u", ""), (202, "http://one.example/z", "<p>odd <i>page</i>"), (203, "http://deep", "<div>" * 3000 + "deep" + "</div>" * 3000), (203, "http://deep", "<div>" * 3000 + "deep" + "</div>" * 3000)]
    frame = spark.createDataFrame(pages, "page_id int, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in html_text.main_texts(frame).collect()}
    assert len(got) == len({p[0] for p in pages})
    for i in range(12):
        assert got[i] == f"Head {i} " + " ".join(f"para {i} {j} & bold line" for j in range(i % 4 + 1))
        assert got[100 + i] == " ".join(f"w{i}x{j}y{k}" for j in range(3) for k in range(30))
    assert got[200] == got[201] == "" and got[202] == "odd page" and got[203] == "deep"
    assert html_text.main_texts(frame.limit(0)).count() == 0
    salted = {r.page_id: r.text for r in html_text.main_texts(frame, broadcast_bytes=0).collect()}
    assert salted == got


def test_copies_of_a_page_keep_their_text(spark):
    """Where no tag marks the article, a text is the template's only if all pages have it and three of them differ."""
    copies = [(i, "http://copies.example/a", page("<div><h2>Only head</h2><p>only paragraph here</p></div>")) for i in range(5)]
    body = lambda i: f"<div><b>Template line</b><p>{' '.join(f'w{i}y{k}' for k in range(30))}</p>"
    more = [(100 + i, "http://more.example/a", page(body(i) + "</div>")) for i in range(20)]
    more += [(200 + i, "http://more.example/b", page(body(99) + "<blockquote>quoted by copies</blockquote></div>")) for i in range(4)]
    frame = spark.createDataFrame(copies + more, "page_id int, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_text.main_texts(frame).collect()}
    assert {got[i] for i in range(5)} == {"Only head only paragraph here"}
    for i in range(20):
        assert got[100 + i] == " ".join(f"w{i}y{k}" for k in range(30))
    assert {got[200 + i] for i in range(4)} == {" ".join(f"w99y{k}" for k in range(30)) + " quoted by copies"}


def test_slots_decide_without_names(spark):
    """With the sections' tags and names replaced by ones that say nothing, and in any partitioning, the texts are the same."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")

    def plain(html):
        for tag, name in (("nav", "qa"), ("article", "qc"), ("footer", "qd")):
            html = html.replace(f"<{tag}>", f'<div class="{name}">').replace(f"</{tag}>", "</div>")
        return html.replace('class="ad"', 'class="qb"')

    many = pages.withColumn("host", html_text.host_of("url"))
    many = many.join(many.groupBy("host").count().filter("count >= 8"), "host", "left_semi").select("page_id", "url", "html")
    neutral = spark.createDataFrame([(r.page_id, r.url, plain(r.html)) for r in many.collect()], "page_id long, url string, html string")
    want = {r.page_id: r.text for r in html_text.main_texts(pages.repartition(7)).collect()}
    got = {r.page_id: r.text for r in html_text.main_texts(neutral.repartition(3)).collect()}
    assert len(got) >= 40 and got == {k: want[k] for k in got}

    def brute(html):  # the article's own text, by what these pages are known to look like
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>)", html, re.S)[1]
        return " ".join(unescape(re.sub(r"<(?:p|/p|h1|/h1|br)>", " ", inner).replace("<b>", "").replace("</b>", "")).split())

    assert want == {r.page_id: brute(r.html) for r in pages.collect()}


def test_alignment_is_longest(monkeypatch):
    random.seed(6)
    for bound in (html_text.TABLE_BYTES, 4):  # whole, and cut in halves again and again
        monkeypatch.setattr(html_text, "TABLE_BYTES", bound)
        for _ in range(200):
            a, b = ([random.choice("abcd") for _ in range(random.randint(0, 25))] for _ in range(2))
            best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
            pairs = html_text.common(a, b)
            assert len(pairs) == best[-1][-1] and all(a[i] == b[j] for i, j in pairs)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    monkeypatch.undo()
    assert len(html_text.common(["x", "y"] * 10_000, ["y", "z", "x"] * 7_000)) >= 7_000


def test_menus_and_shared_lines_of_the_main_part(spark):
    body = lambda i: f"<div class=aa><p>{' '.join(f'w{i}y{k}' for k in range(40))}</p><ul><li><a href=x>go {i}</a></li><li><a href=y>on {i}</a></li></ul><b>Same line</b></div>"
    rows = [(i, "http://h.example/a", page(f"<div class=bb>short {i}</div>{body(i)}")) for i in range(10)]
    got = {r.page_id: r.text for r in html_text.main_texts(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert got == {i: " ".join(f"w{i}y{k}" for k in range(40)) for i in range(10)}


@pytest.mark.parametrize("n", [2, 4, 7, 8, 12])
def test_an_articles_own_parts_stay_at_any_number_of_pages(spark, n):
    words = lambda i, tag: " ".join(f"{tag}{i}w{k}" for k in range(9))
    parts = lambda i: f"<h1>Head {i}</h1><p class='related-work'>{words(i, 'r')}</p><div class='side-effects'><p>{words(i, 's')}</p></div><blockquote>shared by all pages</blockquote><p>{words(i, 'p')}</p>"
    menu = lambda i: f"<div id='menu'><p>{words(i, 'm')}</p></div>" if n > 2 else ""
    out = "<div class='related'><ul><li><a href=x>other page</a></li></ul></div><div class='social share'>Share 12</div><div class='comment-list'><p>a reader wrote quite a long comment here</p></div>"
    rows = [(i, "http://h.example/a", page(f"<nav><a href=x>go</a></nav><article>{parts(i)}{menu(i)}{out}</article>")) for i in range(n)]
    got = {r.page_id: r.text for r in html_text.main_texts(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert got == {i: " ".join([f"Head {i}", words(i, "r"), words(i, "s"), "shared by all pages", words(i, "p"), *([words(i, "m")] if n > 2 else [])]) for i in range(n)}


def test_nameless_pages(spark):
    """With all sections' tags and names taken away, texts are the same; where a notice is longer than the article, a page alone
    can't tell, but aligned with others it can."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    bare = lambda html: re.sub(r"<(/?)(?:nav|article|footer|aside|header)>", r"<\1div>", html.replace(' class="ad"', ""))
    want = {r.page_id: r.text for r in html_text.main_texts(pages).collect()}
    rows = spark.createDataFrame([(r.page_id, r.url, bare(r.html)) for r in pages.collect()], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_texts(rows).collect()}
    assert got == want

    notice = " ".join(f"terms{k}" for k in range(60))
    article = lambda i: " ".join(f"a{i}w{k}" for k in range(20))
    html = lambda i: page(f"<div><p>{notice}</p></div><div><a href=x>go</a></div><div><p>{article(i)}</p></div>")
    rows = spark.createDataFrame([(i, "http://h.example/a", html(i)) for i in range(6)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.main_texts(rows).collect()} == {i: article(i) for i in range(6)}
    assert html_text.page_text(html(0), None) != article(0)


def test_wrappers_stay_small(monkeypatch):
    monkeypatch.setattr(html_text, "MOST_ITEMS", 300)
    whole = None
    for i in range(2000):
        one = html_text.item_of(html_text.parse(f"<main><h1>t {i}</h1><p>text {i}</p>{'<ul><li>x</ul>' if i % 3 == 0 else ''}<div class='odd{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i // 100 % 10]}'>o</div></main>"))
        whole = one if whole is None else html_text.merge(whole, one)
        if whole.pages % 64 == 0:
            whole.prune()
            assert whole.size() <= 300
    main = next(k for k in whole.kids if k.key == "main")
    assert main.pages == 2000 and {"h1", "p", "ul"} <= {k.key for k in main.kids}


def test_rare_parts_keep_their_roles_in_large_wrappers(spark):
    """A host's wrapper of over 20,000 items: what two of 200 pages have is judged as on a small host."""
    words = lambda i, tag: " ".join(f"{tag}{i}w{k}" for k in range(20))
    letters = "abcdefghijklmnopqrstuvwxyz"
    name = lambda n: "".join(letters[n // 26**k % 26] for k in range(4))
    odd = lambda i: "".join(f"<div class='odd{name(60 * i + j)}'>o{j}</div>" for j in range(60))
    rare = lambda i: f"<div class='related'><p>{words(i, 'r')}</p></div><ul class=zz><li><a href=x>go {i}</a><li><a href=x>on {i}</a></ul>" if i % 100 == 7 else ""
    rows = [(i, "http://h.example/a", page(f"<article><h1>Head {i}</h1>{rare(i)}<p>{words(i, 'p')}</p>{odd(i)}</article>")) for i in range(200)]
    frame = spark.createDataFrame(rows, "page_id int, url string, html string").repartition(4)
    held = html_text.wrappers(frame)
    assert html_text.Item.unpacked(json.loads(held.first()["wrapper"])).size() > html_text.MOST_ITEMS
    got = {r.page_id: r.text for r in html_text.main_texts(frame, held).collect()}
    assert got == {i: " ".join([f"Head {i}", *([words(i, "r")] if i % 100 == 7 else []), words(i, "p"), *(f"o{j}" for j in range(60))]) for i in range(200)}


def test_wrapper_rules():
    item = lambda h: html_text.item_of(html_text.parse(h))
    w = html_text.merge(item("<ul><li>a<li>b</ul><p>x"), item("<ul><li>a</ul><h2>t</h2><p>y<p>z"))
    keys = [(k.key, k.optional, k.repeated) for k in w.kids]
    assert keys == [("ul", False, False), ("h2", True, False), ("p", False, True)] and w.kids[0].kids[0].repeated
    pairs = item("<h2>a</h2><p>b</p><h2>c</h2><p>d</p><h2>e</h2><p>f</p>")
    assert [k.key for k in pairs.kids] == ["()"] and [k.key for k in pairs.kids[0].kids] == ["h2", "p"]
    assert html_text.Item.unpacked(w.packed()).packed() == w.packed()


# ---- quality


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    field = quality.train(docs, labels, most_docs=1500)
    met = docs.join(labels, "doc_id").select("quality", quality.held_out().alias("h"), quality.score_column(field).alias("s")).filter("h").collect()
    good, bad = [r.s for r in met if r.quality == 1], [r.s for r in met if r.quality == 0]
    assert len(met) > 500 and np.mean(np.array(good) >= 0.3) > 0.98 and np.mean(np.array(bad) < 0.3) > 0.9


def test_quality_of_odd_texts(spark, odd, none):
    flat = quality.LineField(3 * quality.N_LINE)
    assert [r[0] for r in odd.select(quality.score_column(flat)).collect()] == [0.5] * len(ODD)
    assert none.select(quality.score_column(flat)).count() == 0
    blank = quality.train(none, spark.createDataFrame([], "doc_id long, quality int"))
    assert blank.scores(["x", None]).tolist() == [0.5, 0.5]
    assert {r.doc_id: r.h for r in odd.select("doc_id", quality.held_out().alias("h")).collect()}[7] == (zlib.crc32(b"7") % 5 == 0)


def test_forward_backward_is_exact():
    import itertools

    rng = np.random.default_rng(0)
    field = quality.LineField(1)
    field.moves = rng.normal(size=(2, 2))
    counts, score = np.array([3, 1, 4]), rng.normal(size=8)
    p, _, _ = field.forward_backward(score, counts)
    at = 0
    for n in counts:
        weight = {y: np.exp(sum(score[at + i] * y[i] for i in range(n)) + sum(field.moves[y[i], y[i + 1]] for i in range(n - 1))) for y in itertools.product((0, 1), repeat=int(n))}
        for i in range(n):
            assert np.isclose(p[at + i], sum(w for y, w in weight.items() if y[i]) / sum(weight.values()))
        at += n


def test_long_texts_in_parts(monkeypatch):
    """Texts cut in parts get the marginals that they get whole, and a million lines take bounded memory and time."""
    import time
    import tracemalloc

    rng = np.random.default_rng(2)
    field = quality.LineField(3 * quality.N_LINE)
    field.moves, field.weights, field.bias = rng.normal(size=(2, 2)), rng.normal(size=3 * quality.N_LINE) * 0.3, 0.1
    texts = ["\n".join("x" * int(n) for n in rng.integers(0, 9, k)) for k in (1, 5, 700, 33, 64, 65, 129)]
    own, _, counts = quality.line_features(texts)
    z = np.clip((quality.with_neighbours(own, counts) - field.mean) / field.scale, -8, 8)
    score = np.clip(z @ field.weights + field.bias, -25, 25)
    assert np.allclose(field.emissions(own, counts), score)
    whole = field.forward_backward(score, counts)[0]
    for steps in (7, 64):
        monkeypatch.setattr(quality, "STEPS", steps)
        assert np.allclose(field.marginals(score, counts), whole)
    monkeypatch.undo()
    began = time.process_time()
    tracemalloc.start()
    assert 0 <= field.scores(["a\n" * 1_000_000])[0] <= 1
    assert tracemalloc.get_traced_memory()[1] < 400 << 20 and time.process_time() - began < 60
    tracemalloc.stop()


# ---- pipeline


def test_pipeline(spark):
    import corpus_pipeline as pipe

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    field = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    rows = [r for r, s in zip(rows, field.scores([t for _, t in rows])) if s >= 0.3]
    seen, unique = set(), []
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        if key not in seen:
            seen.add(key)
            unique.append((i, t))
    sets = [brute_shingles(t) for _, t in unique]
    root = list(range(len(unique)))
    for b in range(len(unique)):
        for a in range(b):
            if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                old, new = root[b], root[a]
                root = [new if x == old else x for x in root]
    first = {}
    for (i, _), p in zip(unique, root):
        first.setdefault(p, i)
    assert len(first) < len(unique)
    got = pipe.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(first.values())
    library = Tokenizer.from_file(VOCABULARY)
    want = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in unique if i in set(first.values()))
    assert sum(r.length for r in got) == want and max(r.offset + r.length for r in got) <= 2048

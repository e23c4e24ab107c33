"""The registered queries of this subpackage: each applies its operator to a whole table and derives digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import DigestIndex, deduplicate

    found = deduplicate(_table(spark, sf_dir, "documents"), DigestIndex(spark))
    return found.select("doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import main_texts

    return main_texts(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    found = near_duplicates(_table(spark, sf_dir, "documents"), distance=4, words=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import held_out, score_column, train

    docs = _table(spark, sf_dir, "documents")
    field = train(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"), score_column(field).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import read_token_files, write_token_files

    manifest = write_token_files(_table(spark, sf_dir, "documents"), vocabulary_path(), end_id=2)
    return read_token_files(manifest).select("doc_id", "start", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_and_decode

    both = encode_and_decode(_table(spark, sf_dir, "documents"), vocabulary_path())
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), vocabulary_path(), end_id=0, seq_len=2048)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import read_archives, write_archives

    return read_archives(write_archives(_table(spark, sf_dir, "pages"))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of every vector whose id is divisible by 20, against all vectors."""
    from .shared import staged
    from .topk import sign_codes, top_k

    codes = staged(sign_codes(_table(spark, sf_dir, "embeddings")), "codes")
    return top_k(codes, codes.filter("id % 20 = 0"), k=10).select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


#: verdict, host, path
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls

    return filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import spelling_variants

    found = spelling_variants(_table(spark, sf_dir, "documents"), least_length=6, least_count=5, ratio=5, noise=199)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversations import conversation_trie

    return conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_documents

    placed = shard_documents(_table(spark, sf_dir, "documents"), shards=24, seed=42, keep=["doc_id"])
    return placed.select("doc.doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_html_text": op2_html_text,
    "op3_simhash": op3_simhash,
    "op4_quality": op4_quality,
    "op5_token_files": op5_token_files,
    "op6_bpe": op6_bpe,
    "op7_packing": op7_packing,
    "op8_warc": op8_warc,
    "op9_topk": op9_topk,
    "op10_url_filter": op10_url_filter,
    "op11_spelling": op11_spelling,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_sharding": op13_sharding,
}

#: DuckDB has no CRC-32: a table of its 256 steps, as a list, and the reduction of a value's bytes by it.
_CRC_TABLE = "crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps FROM range(256) t(i))"


def _crc(text: str) -> str:
    """SQL for the CRC-32 of a text, beside a row of ``_CRC_TABLE``."""
    values = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda b: CAST('0x' || b AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {values}), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"


def _shards_sql(shards: int, seed: int) -> str:
    """The sharding of ``documents``, with the permutation's constants put in; rounds and walk are recursive."""
    from .sharding import ROUNDS, Permutation

    keys = Permutation(1, seed).keys()
    pick = lambda n: "CASE r " + " ".join(f"WHEN {r} THEN {k[n]}" for r, k in enumerate(keys)) + " END"
    return f"""
        WITH RECURSIVE {_CRC_TABLE}, docs AS (
            SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, {_crc("coalesce(text, '')")} AS text_crc32 FROM documents, crc
        ), total AS (
            SELECT count(*) AS n, CAST(greatest(2, ceil(log2(greatest(count(*), 2)))) AS BIGINT) AS bits FROM docs
        ), sizes AS (
            SELECT n, bits // 2 AS up, bits - bits // 2 AS low FROM total
        ), numbers AS (
            SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS x FROM docs
        ), walk AS (
            SELECT x, x >> low AS hi, x & ((1 << low) - 1) AS lo, 0 AS r FROM numbers, sizes
            UNION ALL
            SELECT x,
                CASE WHEN r % 2 = 0 THEN xor(hi, (((lo + ({pick(0)})) * ({pick(1)})) >> 24) & ((1 << up) - 1)) ELSE hi END,
                CASE WHEN r % 2 = 1 THEN xor(lo, (((hi + ({pick(0)})) * ({pick(1)})) >> 24) & ((1 << low) - 1)) ELSE lo END,
                r + 1
            FROM (SELECT x, hi, lo, CASE WHEN r = {ROUNDS} THEN 0 ELSE r END AS r FROM walk, sizes WHERE NOT (r = {ROUNDS} AND (hi << low) + lo < n)), sizes
        ), placed AS (
            SELECT x, (hi << low) + lo AS p FROM walk, sizes WHERE r = {ROUNDS} AND (hi << low) + lo < n
        )
        SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p % {shards} AS INTEGER) AS shard, p // {shards} AS slot, CAST(NULL AS INTEGER) AS grown_shard
        FROM numbers JOIN placed USING (x)
    """


ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op9_topk": """
        WITH codes AS (
            SELECT vec_id, list_transform(embedding[1:64], lambda x: x > 0) AS bits FROM embeddings WHERE len(embedding) > 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(len(list_filter(list_zip(q.bits, c.bits), lambda z: z[1] <> z[2])) AS INTEGER) AS distance
            FROM codes q JOIN codes c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, distance FROM ranked WHERE rank <= 10
    """,
    "op10_url_filter": r"""
        WITH parts AS (
            SELECT page_id,
                translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        ), judged AS (
            SELECT *, CASE
                WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/'
            END AS rule FROM parts
        )
        SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM judged
    """,
    "op11_spelling": f"""
        WITH RECURSIVE {_CRC_TABLE}, runs AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
        ), own AS (
            SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
        ), hashed AS (
            SELECT run, n, {_crc("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM own, crc
        ), words AS (
            SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n FROM hashed GROUP BY 1
            HAVING length(word) >= 6 AND sum(n) >= 5
        ), less AS (
            SELECT word, k, word[:k - 1] || word[k + 1:] AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS k FROM words)
        ), near AS (
            SELECT a.word, b.word AS other FROM less a JOIN less b USING (k, rest) WHERE a.word <> b.word
            UNION SELECT word, rest FROM less WHERE rest IN (SELECT word FROM words)
            UNION SELECT rest, word FROM less WHERE rest IN (SELECT word FROM words)
        ), best AS (
            SELECT a.word, count(*) AS n_near, min_by({{'f': b.word, 'n': b.n}}, {{'less': -b.n, 'w': encode(b.word)}}) AS b FROM near JOIN words a USING (word) JOIN words b ON b.word = other GROUP BY 1
        ), forms AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 5 * n THEN b.f END AS form, CASE WHEN b.n >= 5 * n THEN b.n END AS form_n FROM words LEFT JOIN best USING (word)
        ), chain AS (
            SELECT word, word AS root FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
        ), last AS (
            SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL
        )
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN last USING (word)
    """,
    "op12_conversation_trie": rf"""
        WITH {_CRC_TABLE}, turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT conv_id, conv_id - conv_id % 20 AS base, {_crc("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc
        ), mixed AS (
            SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
            UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
        ), steps AS (
            SELECT conv_id, row_number() OVER w AS depth, list({{'r': role, 't': text}}) OVER w AS path, len(regexp_extract_all(text, '[^ 	-
]+')) AS words
            FROM mixed WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)
        ), members AS (
            SELECT conv_id, depth, sha256(CAST(path AS VARCHAR)) || md5(CAST(to_json(path) AS VARCHAR)) AS node, words FROM steps
            UNION ALL SELECT conv_id, 0, '', 0 FROM convs
        ), long AS (
            SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS up FROM members
        ), nodes AS (
            SELECT node, min(up) AS up, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
            FROM long GROUP BY node
        ), kids AS (
            SELECT up AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
        ), above AS (
            SELECT u.node AS top, v.node AS below FROM nodes v JOIN members m ON m.conv_id = v.conv_id AND m.depth <= v.depth JOIN nodes u ON u.node = m.node
        ), sums AS (
            SELECT a.top AS node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves, CAST(sum(v.saved) AS BIGINT) AS saved_tokens
            FROM above a JOIN nodes v ON v.node = a.below LEFT JOIN kids k ON k.node = a.below GROUP BY 1
        )
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
        FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN nodes p ON p.node = n.up AND n.depth > 0
    """,
    "op13_sharding": _shards_sql(shards=24, seed=42),
}

"""Contract columns of the registered queries on the smallest tables."""

import pytest

from gridloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_exact_dedup": "doc_id keep_id group_size kept text_sha256", "op2_html_text": "page_id url text n_chars", "op3_simhash": "doc_id fingerprint component_id", "op4_quality": "doc_id held_out score predicted",
    "op5_token_files": "doc_id start n_tokens ids_crc32", "op6_bpe": "doc_id n_tokens ids_sha256 decoded_sha256", "op7_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op8_warc": "page_id payload_bytes payload_digest record_type refers_to", "op9_topk": "query_id rank vec_id distance", "op10_url_filter": "page_id host path rule verdict",
    "op11_spelling": "word form root n n_near form_n", "op12_conversation_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256", "op13_sharding": "doc_id size text_crc32 law shard slot grown_shard",
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns == COLUMNS[name].split()
    source = {"op2": "pages", "op8": "pages", "op10": "pages", "op9": "embeddings"}.get(name.split("_")[0], "documents")
    n, got = spark.read.parquet(f"{SF}/{source}.parquet").count(), df.count()
    assert got == n if name not in ("op7_packing", "op9_topk", "op11_spelling", "op12_conversation_trie") else got > 0

"""Queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from tapeloom.llm import (
    q_bpe, q_chat, q_html, q_jaccard, q_neardup_vectors, q_packing, q_quality, q_sharding, q_subvector_clusters, q_target_sampling,
    q_token_planes, q_toxicity, q_warc,
)


def queries() -> dict:
    return {
        "op1_html_extraction": q_html.op1_html_extraction,
        "op2_embedding_neardup": q_neardup_vectors.op2_embedding_neardup,
        "op3_ngram_jaccard": q_jaccard.op3_ngram_jaccard,
        "op4_bpe": q_bpe.op4_bpe,
        "op5_toxicity": q_toxicity.op5_toxicity,
        "op6_quality": q_quality.op6_quality,
        "op7_sharding": q_sharding.op7_sharding,
        "op8_packing": q_packing.op8_packing,
        "op9_warc": q_warc.op9_warc,
        "op10_chat_formatting": q_chat.op10_chat_formatting,
        "op11_token_planes": q_token_planes.op11_token_planes,
        "op12_target_sampling": q_target_sampling.op12_target_sampling,
        "op13_subvector_clusters": q_subvector_clusters.op13_subvector_clusters,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_embedding_neardup": q_neardup_vectors.OP2_SQL,
        "op3_ngram_jaccard": q_jaccard.OP3_SQL,
        "op7_sharding": q_sharding.OP7_SQL,
        "op9_warc": q_warc.OP9_SQL,
        "op10_chat_formatting": q_chat.OP10_SQL,
        "op12_target_sampling": q_target_sampling.OP12_SQL,
        "op13_subvector_clusters": q_subvector_clusters.OP13_SQL,
    }

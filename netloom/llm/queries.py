"""The opN_ queries of this package and their SQL."""

from __future__ import annotations

from netloom.llm import byte_bpe, centroids, chat_format, decontamination, exact_dedup, importance, lexical_search, ngram_join, resharding, sentencepiece_codec, token_store, toxicity, url_filter

QUERIES = {
    "op1_reshard": resharding.op1_reshard,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op3_importance": importance.op3_importance,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_token_store": token_store.op5_token_store,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_chat_format": chat_format.op9_chat_format,
    "op10_sentencepiece": sentencepiece_codec.op10_sentencepiece,
    "op11_byte_bpe": byte_bpe.op11_byte_bpe,
    "op12_centroids": centroids.op12_centroids,
    "op13_lexical_search": lexical_search.op13_lexical_search,
}

ORACLE_SQL = {
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op8_url_filter": url_filter.OP8_SQL,
    "op9_chat_format": chat_format.OP9_SQL,
    "op12_centroids": centroids.OP12_SQL,
    "op13_lexical_search": lexical_search.OP13_SQL,
}

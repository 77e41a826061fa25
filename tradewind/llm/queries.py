"""The registered queries of this folder, and the SQL of those that SQL can express."""

from tradewind.llm import (
    byte_bpe,
    centroid_clustering,
    chat_format,
    embedding_dups,
    language_id,
    merkle_manifest,
    mixing,
    ngram_join,
    phrase_automata,
    quality_rules,
    suffix_dedup,
    url_filter,
    word_bpe,
)

QUERIES = {
    "op1_embedding_dups": embedding_dups.op1_embedding_dups,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_phrase_automata": phrase_automata.op3_phrase_automata,
    "op4_language_id": language_id.op4_language_id,
    "op5_chat_format": chat_format.op5_chat_format,
    "op6_byte_bpe": byte_bpe.op6_byte_bpe,
    "op7_mixing": mixing.op7_mixing,
    "op8_ngram_join": ngram_join.op8_ngram_join,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_word_bpe": word_bpe.op11_word_bpe,
    "op12_merkle_manifest": merkle_manifest.op12_merkle_manifest,
    "op13_centroid_clustering": centroid_clustering.op13_centroid_clustering,
}

ORACLES = {
    "op2_url_filter": url_filter.ORACLE,
    "op5_chat_format": chat_format.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op12_merkle_manifest": merkle_manifest.ORACLE,
    "op13_centroid_clustering": centroid_clustering.ORACLE,
}

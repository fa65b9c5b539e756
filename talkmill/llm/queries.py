"""The registered queries of the llm operators and the SQL that DuckDB can run for them."""

from __future__ import annotations

from . import katz, language_id, line_dedup, mixing, ngram_join, order_minhash, quality_rules, sentencepiece_codec, token_counts, url_filter

QUERIES = {
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_katz_scoring": katz.op9_katz_scoring,
    "op1_sentencepiece": sentencepiece_codec.op1_sentencepiece,
    "op3_language_id": language_id.op3_language_id,
    "op4_order_minhash": order_minhash.op4_order_minhash,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_url_filter": url_filter.op6_url_filter,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op10_ngram_join": ngram_join.op10_ngram_join,
}
ORACLES = {"op6_url_filter": url_filter.OP6_SQL, "op10_ngram_join": ngram_join.OP10_SQL}

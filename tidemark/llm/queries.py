"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bit_packing, byte_bpe, exact_dedup, filter_audit, hnsw, html_text, language_id, lm_score, multi_index, packing, passages, ranked_search, simhash_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": html_text.op1,
    "op2_byte_bpe": byte_bpe.op2,
    "op3_hnsw": hnsw.op3,
    "op4_passages": passages.op4,
    "op5_packing": packing.op5,
    "op6_exact_dedup": exact_dedup.op6,
    "op7_simhash_dedup": simhash_dedup.op7,
    "op8_language_id": language_id.op8,
    "op9_lm_score": lm_score.op9,
    "op10_bit_packing": bit_packing.op10,
    "op11_filter_audit": filter_audit.op11,
    "op12_ranked_search": ranked_search.op12,
    "op13_multi_index": multi_index.op13,
}

ORACLE: dict[str, str] = {
    "op6_exact_dedup": exact_dedup.OP6_SQL,
    "op11_filter_audit": filter_audit.OP11_SQL,
    "op12_ranked_search": ranked_search.OP12_SQL,
    "op13_multi_index": multi_index.OP13_SQL,
}

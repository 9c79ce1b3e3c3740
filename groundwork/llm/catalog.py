"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from groundwork.llm.decontaminate import op9_benchmark_decontamination
from groundwork.llm.embedding_dedup import op10_embedding_dedup
from groundwork.llm.html_extract import op5_html_extraction
from groundwork.llm.language_id import op6_language_id
from groundwork.llm.line_dedup import op3_line_dedup
from groundwork.llm.minhash_dedup import op8_minhash_dedup
from groundwork.llm.packing import op1_best_fit_packing
from groundwork.llm.secret_scan import op11_secret_scan
from groundwork.llm.spelling_variants import op13_spelling_variants
from groundwork.llm.substring_dedup import op4_substring_dedup
from groundwork.llm.token_alignment import op12_cross_tokenizer_alignment
from groundwork.llm.token_counts import op7_token_counts
from groundwork.llm.url_filter import OP2_SQL, op2_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_url_filter,
        op3_line_dedup,
        op4_substring_dedup,
        op5_html_extraction,
        op6_language_id,
        op7_token_counts,
        op8_minhash_dedup,
        op9_benchmark_decontamination,
        op10_embedding_dedup,
        op11_secret_scan,
        op12_cross_tokenizer_alignment,
        op13_spelling_variants,
    )
}
SQL = {"op2_url_filter": OP2_SQL}

"""Queries of this subpackage and the SQL twins of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm import collocations, hard_negatives, minhash_dedup
from tidemark.llm.byte_bpe import op5_byte_bpe
from tidemark.llm.fingerprints import op3_spotsigs
from tidemark.llm.html_extraction import op2_html_extraction
from tidemark.llm.language_id import op1_language_id
from tidemark.llm.license_scan import op9_license_scan
from tidemark.llm.neighbours import op6_learned_partitions
from tidemark.llm.ngram_join import op7_ngram_join
from tidemark.llm.packing import op4_best_fit_packing
from tidemark.llm.pitman_yor import op8_pitman_yor
from tidemark.llm.substring_dedup import op10_substring_dedup

LLM_QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_html_extraction": op2_html_extraction,
    "op3_spotsigs": op3_spotsigs,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_learned_partitions": op6_learned_partitions,
    "op7_ngram_join": op7_ngram_join,
    "op8_pitman_yor": op8_pitman_yor,
    "op9_license_scan": op9_license_scan,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_minhash_tensor": minhash_dedup.op11_minhash_tensor,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_debruijn_phrases": collocations.op13_debruijn_phrases,
    "pipeline": corpus_pipeline.run,
}
LLM_ORACLES: dict[str, str] = {
    "op11_minhash_tensor": minhash_dedup.ORACLE_SQL,
    "op12_hard_negatives": hard_negatives.ORACLE_SQL,
    "op13_debruijn_phrases": collocations.ORACLE_SQL,
}

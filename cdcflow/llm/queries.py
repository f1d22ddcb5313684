"""The registered queries of this subpackage and their expected answers."""

from __future__ import annotations

from . import oracles
from .alignment import op12_cross_tokenizer_alignment
from .byte_dedup import op2_suffix_array_dedup
from .decontamination import op5_benchmark_decontamination
from .jaccard import op4_ngram_jaccard_join
from .language import op3_language_id
from .licenses import op9_license_scan
from .lm import op13_pitman_yor_scores
from .packing import op10_best_fit_packing
from .pii import op6_pii_surrogates
from .quality import op7_quality_rules
from .token_file import op1_token_file
from .whitening import op11_embedding_whitening
from .word_dedup import op8_substring_dedup


def queries():
    return {
        "op1_token_file": op1_token_file,
        "op2_suffix_array_dedup": op2_suffix_array_dedup,
        "op3_language_id": op3_language_id,
        "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
        "op5_benchmark_decontamination": op5_benchmark_decontamination,
        "op6_pii_surrogates": op6_pii_surrogates,
        "op7_quality_rules": op7_quality_rules,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_license_scan": op9_license_scan,
        "op10_best_fit_packing": op10_best_fit_packing,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
        "op13_pitman_yor_scores": op13_pitman_yor_scores,
    }


def oracle_sql():
    return {
        "op2_suffix_array_dedup": oracles.SUBSTRINGS_OF_BYTES,
        "op4_ngram_jaccard_join": oracles.COMPONENTS,
        "op8_substring_dedup": oracles.SUBSTRINGS_OF_WORDS,
    }

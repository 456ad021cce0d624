"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from marketloom.llm import (
    exact_dedup, hard_negatives, jpeg, language_id, line_dedup, near_dedup, packing, phrase_dedup, piece_sampling, quality, spelling, suffix_dedup,
    token_files,
)


def queries() -> dict:
    return {
        "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
        "op2_token_files": token_files.op2_token_files,
        "op3_exact_dedup": exact_dedup.op3_exact_dedup,
        "op4_near_dedup": near_dedup.op4_near_dedup,
        "op5_line_dedup": line_dedup.op5_line_dedup,
        "op6_quality": quality.op6_quality,
        "op7_media_jpeg": jpeg.op7_media_jpeg,
        "op8_piece_sampling": piece_sampling.op8_piece_sampling,
        "op9_language_id": language_id.op9_language_id,
        "op10_packing": packing.op10_packing,
        "op11_spelling_variants": spelling.op11_spelling_variants,
        "op12_phrase_dedup": phrase_dedup.op12_phrase_dedup,
        "op13_hard_negatives": hard_negatives.op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": exact_dedup.OP3_SQL,
        "op5_line_dedup": line_dedup.OP5_SQL,
        "op11_spelling_variants": spelling.OP11_SQL,
        "op12_phrase_dedup": phrase_dedup.OP12_SQL,
        "op13_hard_negatives": hard_negatives.OP13_SQL,
    }

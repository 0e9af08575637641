"""Training-data operators. Nothing else in the package imports this subpackage."""

from __future__ import annotations

from folioforge.llm import ann, bpe_fst, decontaminate, language_id, line_dedup, quality, simhash, substring_dedup, token_pack, toxicity


def queries() -> dict:
    return {
        "op1_ann_rotated_codes": ann.op1_ann_rotated_codes,
        "op2_decontaminate": decontaminate.op2_decontaminate,
        "op3_token_pack": token_pack.op3_token_pack,
        "op4_simhash": simhash.op4_simhash,
        "op5_quality": quality.op5_quality,
        "op6_bpe_fst": bpe_fst.op6_bpe_fst,
        "op7_language_id": language_id.op7_language_id,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_line_dedup": line_dedup.op9_line_dedup,
        "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op9_line_dedup": line_dedup.ORACLE}

"""The registered queries of the training-data operators and their oracle SQL."""

from . import (
    align,
    decontaminate,
    exact_dedup,
    language,
    lm_score,
    merkle,
    mixing,
    packing,
    pii,
    simhash,
    substring_dedup,
    token_codes,
    toxicity,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_lm_score": lm_score.op3_lm_score,
    "op4_mix": mixing.op4_mix,
    "op5_simhash": simhash.op5_simhash,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_suffix_dedup": substring_dedup.op7_suffix_dedup,
    "op8_token_codes": token_codes.op8_token_codes,
    "op9_pii": pii.op9_pii,
    "op10_language": language.op10_language,
    "op11_merkle": merkle.op11_merkle,
    "op12_align": align.op12_align,
    "op13_pack": packing.op13_pack,
}
ORACLES = {
    "op4_mix": mixing.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op11_merkle": merkle.ORACLE,
}

"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from ledgerline.llm import (
    decontaminate,
    mixing,
    periodic_runs,
    piece_codec,
    quality_model,
    quality_rules,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    suffix_dedup,
    token_counts,
    url_filter,
)

QUERIES = {
    f.__name__: f
    for f in (
        mixing.op1_mixing,
        token_counts.op2_token_counts,
        suffix_dedup.op3_suffix_dedup,
        sharding.op4_sharding,
        simhash.op5_simhash,
        quality_model.op6_quality_model,
        substring_dedup.op7_substring_dedup,
        decontaminate.op8_decontamination,
        quality_rules.op9_quality_rules,
        url_filter.op10_url_filter,
        spelling.op11_spelling,
        piece_codec.op12_sentencepiece,
        periodic_runs.op13_periodic_runs,
    )
}

ORACLE = {**mixing.ORACLE, **suffix_dedup.ORACLE, **substring_dedup.ORACLE, **quality_rules.ORACLE}

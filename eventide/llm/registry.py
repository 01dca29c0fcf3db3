"""Queries of this package and, where SQL can express them, their DuckDB forms."""

from __future__ import annotations

from eventide.llm import (
    bpe,
    decontamination,
    line_dedup,
    maxent_lm,
    merkle,
    periodic_runs,
    pieces,
    pii,
    quality,
    sharding,
    simhash,
    token_counts,
    warc,
)

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_maxent_lm": maxent_lm.op2_maxent_lm,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_simhash": simhash.op4_simhash,
    "op5_pii": pii.op5_pii,
    "op6_warc": warc.op6_warc,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_byte_bpe": bpe.op9_byte_bpe,
    "op10_sharding": sharding.op10_sharding,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_merkle": merkle.op12_merkle,
    "op13_sentencepiece": pieces.op13_sentencepiece,
}

SQL: dict[str, str] = {
    "op6_warc": warc.OP6_SQL,
    "op3_line_dedup": line_dedup.OP3_SQL,
    "op12_merkle": merkle.OP12_SQL,
}

"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from closebook.llm import (
    byte_bpe,
    collocations,
    decontamination,
    jaccard_join,
    language_id,
    license_scan,
    line_dedup,
    merkle,
    mixing,
    quality_classifier,
    quality_rules,
    sanitisation,
    sql,
    toxicity,
)

QUERIES = {
    "op1_decontamination": decontamination.op1,
    "op2_sanitisation": sanitisation.op2,
    "op3_quality_classifier": quality_classifier.op3,
    "op4_license_scan": license_scan.op4,
    "op5_language_id": language_id.op5,
    "op6_toxicity": toxicity.op6,
    "op7_quality_rules": quality_rules.op7,
    "rule_ablations": quality_rules.rule_ablations,
    "op8_jaccard_join": jaccard_join.op8,
    "op9_line_dedup": line_dedup.op9,
    "op10_mixing": mixing.op10,
    "op11_merkle_manifest": merkle.op11,
    "op12_byte_bpe": byte_bpe.op12,
    "op13_collocations": collocations.op13,
}

#: the others train, sample, compress or count what their own method finds
ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": sql.DECONTAMINATION,
    "op7_quality_rules": sql.QUALITY_RULES,
    "rule_ablations": sql.RULE_ABLATIONS,
    "op8_jaccard_join": sql.JACCARD_JOIN,
    "op9_line_dedup": sql.LINE_DEDUP,
    "op11_merkle_manifest": sql.MERKLE_MANIFEST,
    "op13_collocations": sql.COLLOCATIONS,
}

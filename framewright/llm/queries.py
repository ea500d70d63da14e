"""The queries of this subpackage, and the SQL that must give the same rows."""

from __future__ import annotations

from framewright.llm import chat_format, decontaminate, fill_in_middle, packing, quality_classifier, quality_rules, secret_scan, sentencepiece_codec, simhash_dedup, spelling_variants, substring_dedup, token_binary, warc_archive

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_sentencepiece": sentencepiece_codec.op3_sentencepiece,
    "op4_warc": warc_archive.op4_warc,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_simhash_dedup": simhash_dedup.op6_simhash_dedup,
    "op7_quality_classifier": quality_classifier.op7_quality_classifier,
    "op8_chat_format": chat_format.op8_chat_format,
    "op9_token_binary": token_binary.op9_token_binary,
    "op10_secret_scan": secret_scan.op10_secret_scan,
    "op11_fill_in_middle": fill_in_middle.op11_fill_in_middle,
    "op12_packing": packing.op12_packing,
    "op13_spelling_variants": spelling_variants.op13_spelling_variants,
}
ORACLES = {"op1_quality_rules": quality_rules.ORACLE, "op2_substring_dedup": substring_dedup.ORACLE, "op4_warc": warc_archive.ORACLE, "op8_chat_format": chat_format.ORACLE, "op11_fill_in_middle": fill_in_middle.ORACLE, "op13_spelling_variants": spelling_variants.ORACLE}

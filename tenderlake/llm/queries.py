"""Registered queries of the corpus operators and the SQL that some of them must match."""

from __future__ import annotations

from tenderlake.llm import decontamination, filter_audit, licenses, line_dedup, minhash, packing, quality_model, quality_rules, sentencepiece_codec, sharding, simhash, spelling, warc

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_best_fit": packing.op2_best_fit,
    "op3_minhash": minhash.op3_minhash,
    "op4_sampled_splitters": sharding.op4_sampled_splitters,
    "op5_segment_reassembly": warc.op5_segment_reassembly,
    "op6_simhash": simhash.op6_simhash,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_quality_classifier": quality_model.op8_quality_classifier,
    "op9_prefix_table": sentencepiece_codec.op9_prefix_table,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_filter_interaction_audit": filter_audit.op12_filter_interaction_audit,
    "op13_benchmark_decontamination": decontamination.op13_benchmark_decontamination,
}
ORACLE = {
    "op7_quality_rules": quality_rules.ORACLE_SQL,
    "op11_spelling_variants": spelling.ORACLE_SQL,
    "op12_filter_interaction_audit": filter_audit.ORACLE_SQL,
    "op13_benchmark_decontamination": decontamination.ORACLE_SQL,
}

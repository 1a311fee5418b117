"""The corpus operators' queries and their SQL."""

from __future__ import annotations

from . import archives, chat, decontamination, filter_audit, fingerprints, language, licenses, near_dup, packing, token_counts, toxicity, vector_codes, vector_search

QUERIES = {
    "op1_pack_power_of_two": packing.op1_pack_power_of_two,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_minhash_forest": near_dup.op3_minhash_forest,
    "op4_pivot_top_k": vector_search.op4_pivot_top_k,
    "op5_chat_snapshots": chat.op5_chat_snapshots,
    "op6_spaced_seeds": decontamination.op6_spaced_seeds,
    "op7_language_mixture": language.op7_language_mixture,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_zip_warc": archives.op9_zip_warc,
    "op10_license_join": licenses.op10_license_join,
    "op11_fingerprints": fingerprints.op11_fingerprints,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

#: For the others SQL has no form; tests hold them against brute force, the tokenizer library or held-out labels.
ORACLE_SQL = {
    "op3_minhash_forest": near_dup.OP3_SQL,
    "op4_pivot_top_k": vector_search.OP4_SQL,
    "op5_chat_snapshots": chat.OP5_SQL,
    "op9_zip_warc": archives.OP9_SQL,
    "op10_license_join": licenses.oracle_sql(),
    "op12_vector_codes": vector_codes.oracle_sql(),
    "op13_filter_audit": filter_audit.OP13_SQL,
}

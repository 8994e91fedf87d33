"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from screenweave.llm import byte_bpe, context_tree, language_id, license_scan, ngram_join, periodic_runs, phrases, source_mixing, string_tiling, token_attribution, toxicity, transport_stream, warc

QUERIES = {
    "op1_language_id": language_id.query,
    "op2_source_mixing": source_mixing.query,
    "op3_license_scan": license_scan.query,
    "op4_transport_stream": transport_stream.query,
    "op5_context_tree": context_tree.query,
    "op6_string_tiling": string_tiling.query,
    "op7_warc_transactions": warc.query,
    "op8_ngram_jaccard": ngram_join.query,
    "op9_token_attribution": token_attribution.query,
    "op10_toxicity": toxicity.query,
    "op11_periodic_runs": periodic_runs.query,
    "op12_phrase_mining": phrases.query,
    "op13_byte_bpe": byte_bpe.query,
}

ORACLES = {
    "op3_license_scan": license_scan.oracle(),
    "op7_warc_transactions": warc.ORACLE,
    "op8_ngram_jaccard": ngram_join.ORACLE,
    "op12_phrase_mining": phrases.ORACLE,
}

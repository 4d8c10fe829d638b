"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from catalog_lineage.llm import chat, decontamination, mixing, neardup, neighbours, passages, periods, phrases, secrets, sharding, spelling, toxicity, urls

QUERIES = {q.__name__: q for q in (
    secrets.op1_secret_scan, mixing.op2_mix_sources, urls.op3_url_filter, chat.op4_chat_format, sharding.op5_sharding,
    neardup.op6_minhash_near_duplicates, toxicity.op7_toxicity, neighbours.op8_nearest_neighbours, passages.op9_substring_dedup,
    decontamination.op10_benchmark_decontamination, spelling.op11_spelling_variants, periods.op12_periodic_runs,
    phrases.op13_document_fingerprints,
)}
ORACLES = {
    **secrets.ORACLES, **mixing.ORACLES, **chat.ORACLES, **sharding.ORACLES, **passages.ORACLES, **urls.ORACLES,
    **spelling.ORACLES, **periods.ORACLES,
}

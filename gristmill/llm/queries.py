"""The registered queries of the training-data operators."""

from __future__ import annotations

from gristmill.llm import decontaminate, lang_id, mih_search, ngram_automaton, packing, pii_skipchain, quality_cnn, secret_scan, simhash_dedup, toxicity_crf
from gristmill.llm.common import read

QUERIES = {
    "op1_secret_scan": lambda s, d: secret_scan.digest(read(s, d, "documents")),
    "op2_quality_classifier": lambda s, d: quality_cnn.score(read(s, d, "documents"), read(s, d, "labels")),
    "op3_language_id": lambda s, d: lang_id.identify(read(s, d, "documents")),
    "op4_best_fit_packing": lambda s, d: packing.pack(read(s, d, "documents")),
    "op5_toxicity": lambda s, d: toxicity_crf.score(read(s, d, "documents"), read(s, d, "labels")),
    "op6_nearest_neighbours": lambda s, d: mih_search.nearest(read(s, d, "embeddings")),
    "op7_lm_scoring": lambda s, d: ngram_automaton.score(read(s, d, "documents")),
    "op8_pii": lambda s, d: pii_skipchain.digest(read(s, d, "documents")),
    "op9_simhash_dedup": lambda s, d: simhash_dedup.digest(read(s, d, "documents")),
    "op10_decontamination": lambda s, d: decontaminate.leaks(read(s, d, "documents"), read(s, d, "benchmark")),
}

#: DuckDB has no such operators (learned models, positions of matches, XXH64); tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {}

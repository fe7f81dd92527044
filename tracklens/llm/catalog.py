"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from tracklens.llm import (
    cutting_stock,
    debruijn_dedup,
    hypergeometric_shards,
    kneser_ney_toxicity,
    merkle_manifest,
    multi_index_hashing,
    ngram_join,
    periodic_runs,
    quote_threads,
    subword_quality,
    suffix_automaton,
    suffix_groups,
    url_reputation,
)

QUERIES = {
    "op1_ngram_join": ngram_join.query,
    "op2_suffix_automaton": suffix_automaton.query,
    "op3_hypergeometric_shards": hypergeometric_shards.query,
    "op4_cutting_stock": cutting_stock.query,
    "op5_multi_index_hashing": multi_index_hashing.query,
    "op6_subword_quality": subword_quality.query,
    "op7_debruijn_dedup": debruijn_dedup.query,
    "op8_kneser_ney_toxicity": kneser_ney_toxicity.query,
    "op9_quote_threads": quote_threads.query,
    "op10_url_reputation": url_reputation.query,
    "op11_periodic_runs": periodic_runs.query,
    "op12_merkle_manifest": merkle_manifest.query,
    "op13_suffix_groups": suffix_groups.query,
}
ORACLES = {
    "op1_ngram_join": ngram_join.ORACLE,
    "op2_suffix_automaton": suffix_automaton.ORACLE,
    "op7_debruijn_dedup": debruijn_dedup.ORACLE,
    "op9_quote_threads": quote_threads.ORACLE,
    "op10_url_reputation": url_reputation.ORACLE,
    "op12_merkle_manifest": merkle_manifest.ORACLE,
}

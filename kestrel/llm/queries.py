"""The operators' registered queries and, where SQL can express one, its DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import collocations, conversation_trie, decontam, licenses, lines, minhash, mixing, ngram_join, pii, quality, secrets, sharding, wavelet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_wavelet_shards": wavelet.op1_wavelet_shards,
    "op2_contextual_pii": pii.op2_contextual_pii,
    "op3_block_max_wand": decontam.op3_block_max_wand,
    "op4_entropy_mix": mixing.op4_entropy_mix,
    "op5_fuzzy_lines": lines.op5_fuzzy_lines,
    "op6_window_entropy": secrets.op6_window_entropy,
    "op7_robust_outliers": quality.op7_robust_outliers,
    "op8_dice_licenses": licenses.op8_dice_licenses,
    "op9_minimax_shards": sharding.op9_minimax_shards,
    "op10_icws_near_duplicates": minhash.op10_icws_near_duplicates,
    "op11_euler_prefix_trie": conversation_trie.op11_euler_prefix_trie,
    "op12_phrase_automata": collocations.op12_phrase_automata,
    "op13_ngram_jaccard_join": ngram_join.op13_ngram_jaccard_join,
}

ORACLES: dict[str, str] = {
    "op11_euler_prefix_trie": conversation_trie.OP11_SQL,
    "op12_phrase_automata": collocations.OP12_SQL,
    "op13_ngram_jaccard_join": ngram_join.OP13_SQL,
}

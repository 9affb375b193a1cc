"""Queries and DuckDB SQL of the training-data operators."""

from __future__ import annotations

from lakeward.llm.bpe import op9_bpe_roundtrip
from lakeward.llm import (chat, collocations, decontam, line_dedup, metric_tree, ngram_join, phrases, pii, runs,
                          warc)
from lakeward.llm.quality import op2_quality_rules
from lakeward.llm.quality_sql import SQL as QUALITY_SQL
from lakeward.llm.sharding import op6_hash_ring

QUERIES = {
    "op1_jaccard_join": ngram_join.op1_jaccard_join,
    "op2_quality_rules": op2_quality_rules,
    "op3_chat_format": chat.op3_chat_format,
    "op4_warc_chunks": warc.op4_warc_chunks,
    "op5_line_similarity": line_dedup.op5_line_similarity,
    "op6_hash_ring": op6_hash_ring,
    "op7_pii_disclosure": pii.op7_pii_disclosure,
    "op8_phrase_automata": phrases.op8_phrase_automata,
    "op9_bpe_roundtrip": op9_bpe_roundtrip,
    "op10_spaced_seeds": decontam.op10_spaced_seeds,
    "op11_collocations": collocations.op11_collocations,
    "op12_periodic_runs": runs.op12_periodic_runs,
    "op13_metric_tree": metric_tree.op13_metric_tree,
}

SQL: dict[str, str] = {
    "op1_jaccard_join": ngram_join.SQL,
    "op2_quality_rules": QUALITY_SQL,
    "op3_chat_format": chat.SQL,
    "op4_warc_chunks": warc.SQL,
    "op5_line_similarity": line_dedup.SQL,
    "op8_phrase_automata": phrases.SQL,
    "op10_spaced_seeds": decontam.SQL,
    "op11_collocations": collocations.SQL,
    "op13_metric_tree": metric_tree.SQL,
}

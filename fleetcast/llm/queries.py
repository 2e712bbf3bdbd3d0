"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from . import (byte_bpe, chat_perspectives, cotraining, count_rtree, fuzzy_lines, ga_packing, mixing, nce_lm, nra_topk, prefix_forest,
               repair, sentence_spans, wht_clusters)

MODULES = [chat_perspectives, cotraining, prefix_forest, sentence_spans, nce_lm, nra_topk, ga_packing, byte_bpe, count_rtree, fuzzy_lines,
           mixing, repair, wht_clusters]
QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}

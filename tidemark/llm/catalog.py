"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.llm import (
    decontaminate,
    exact_sort,
    importance,
    lz_spans,
    pii_spans,
    prefix_tree,
    simhash,
    source_mix,
    spelling,
    suffix_columns,
    tag_paths,
    token_planes,
    whitening,
)

QUERIES = {
    "op1_importance": importance.op1_importance,
    "op2_source_mix": source_mix.op2_source_mix,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_simhash": simhash.op4_simhash,
    "op5_pii_spans": pii_spans.op5_pii_spans,
    "op6_tag_paths": tag_paths.op6_tag_paths,
    "op7_lz_spans": lz_spans.op7_lz_spans,
    "op8_prefix_tree": prefix_tree.op8_prefix_tree,
    "op9_token_planes": token_planes.op9_token_planes,
    "op10_exact_sort": exact_sort.op10_exact_sort,
    "op11_spelling": spelling.op11_spelling,
    "op12_suffix_columns": suffix_columns.op12_suffix_columns,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE = {
    "op3_decontaminate": decontaminate.OP3_SQL,
    "op7_lz_spans": lz_spans.OP7_SQL,
    "op8_prefix_tree": prefix_tree.OP8_SQL,
    "op10_exact_sort": exact_sort.OP10_SQL,
}

"""Registered queries of this subpackage, and the SQL each must agree with where SQL can express it."""

from __future__ import annotations

from tripmill.llm import ctw, forest, hnsw, html_text, jaccard, lines, mixing, packing, quality, resampling, spelling, toxicity, urls

QUERIES = {
    "op1_hnsw_dedup": hnsw.op1_hnsw_dedup,
    "op2_ctw_score": ctw.op2_ctw_score,
    "op3_tag_paths": html_text.op3_tag_paths,
    "op4_weak_quality": quality.op4_weak_quality,
    "op5_line_dedup": lines.op5_line_dedup,
    "op6_pack": packing.op6_pack,
    "op7_jaccard_join": jaccard.op7_jaccard_join,
    "op8_pareto_mix": mixing.op8_pareto_mix,
    "op9_url_filter": urls.op9_url_filter,
    "op10_forest_search": forest.op10_forest_search,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_bitslice_resample": resampling.op12_bitslice_resample,
    "op13_toxicity_neighbours": toxicity.op13_toxicity_neighbours,
}

ORACLES = {
    "op5_line_dedup": lines.OP5_SQL,
    "op9_url_filter": urls.OP9_SQL,
    "op11_spelling_variants": spelling.OP11_SQL,
    "op12_bitslice_resample": resampling.OP12_SQL,
}

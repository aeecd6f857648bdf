"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from timeloom.llm import (
    op1_licenses,
    op2_fingerprints,
    op3_mixing,
    op4_packing,
    op5_topk,
    op6_language,
    op7_token_counts,
    op8_toxicity,
    op9_jaccard_join,
    op10_quality,
    op11_collocations,
    op12_token_records,
    op13_fill_in_middle,
    pipeline,
)

QUERIES = {
    "op1_licenses": op1_licenses.query,
    "op2_fingerprints": op2_fingerprints.query,
    "op3_mixing": op3_mixing.query,
    "op4_packing": op4_packing.query,
    "op5_topk": op5_topk.query,
    "op6_language": op6_language.query,
    "op7_token_counts": op7_token_counts.query,
    "op8_toxicity": op8_toxicity.query,
    "op9_jaccard_join": op9_jaccard_join.query,
    "op10_quality": op10_quality.query,
    "op11_collocations": op11_collocations.query,
    "op12_token_records": op12_token_records.query,
    "op13_fill_in_middle": op13_fill_in_middle.query,
    "pipeline": pipeline.run,
}

ORACLE_SQL = {"op5_topk": op5_topk.SQL, "op11_collocations": op11_collocations.SQL, "op13_fill_in_middle": op13_fill_in_middle.SQL}
if pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = pipeline.ORACLE_SQL

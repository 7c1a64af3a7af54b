"""The registered queries of this subpackage and the SQL that they are held against."""

from __future__ import annotations

from genescreen.llm import alignment as _op11
from genescreen.llm import decontaminate as _op5
from genescreen.llm import language as _op3
from genescreen.llm import licenses as _op9
from genescreen.llm import line_dedup as _op4
from genescreen.llm import lm_score as _op1
from genescreen.llm import merkle as _op12
from genescreen.llm import packing as _op10
from genescreen.llm import sentencepieces as _op13
from genescreen.llm import simhash as _op2
from genescreen.llm import substrings as _op6
from genescreen.llm import toxicity as _op7
from genescreen.llm import vectors as _op8

QUERIES = {
    "op1_lm_scoring": _op1.op1_lm_scoring,
    "op2_simhash_near_dedup": _op2.op2_simhash_near_dedup,
    "op3_language_id": _op3.op3_language_id,
    "op4_line_dedup": _op4.op4_line_dedup,
    "op5_benchmark_decontamination": _op5.op5_benchmark_decontamination,
    "op6_substring_dedup": _op6.op6_substring_dedup,
    "op7_toxicity": _op7.op7_toxicity,
    "op8_embedding_near_dedup": _op8.op8_embedding_near_dedup,
    "op9_license_scan": _op9.op9_license_scan,
    "op10_packing": _op10.op10_packing,
    "op11_token_alignment": _op11.op11_token_alignment,
    "op12_merkle_manifest": _op12.op12_merkle_manifest,
    "op13_sentencepiece": _op13.op13_sentencepiece,
}

ORACLES = {
    "op4_line_dedup": _op4.OP4_SQL,
    "op5_benchmark_decontamination": _op5.OP5_SQL,
    "op6_substring_dedup": _op6.OP6_SQL,
    "op8_embedding_near_dedup": _op8.OP8_SQL,
    "op9_license_scan": _op9.OP9_SQL,
    "op12_merkle_manifest": _op12.OP12_SQL,
}

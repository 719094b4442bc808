"""The queries of this subpackage by name, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from clickstats.llm.q_html import op4_html_text
from clickstats.llm.q_mixing import op8_mix_sources
from clickstats.llm.q_ngram import OP1_SQL, op1_ngram_jaccard
import corpus_pipeline
from clickstats.llm.q_audit import OP12_SQL, op12_filter_audit
from clickstats.llm.q_decontaminate import OP5_SQL, op5_decontaminate
from clickstats.llm.q_dedup import OP2_SQL, OP10_SQL, op2_phrase_dedup, op10_suffix_dedup
from clickstats.llm.q_pii import op6_personal_data
from clickstats.llm.q_quality import op11_quality
from clickstats.llm.q_runs import op13_periodic_runs
from clickstats.llm.q_secret import OP7_SQL, op7_secret_scan
from clickstats.llm.q_topk import OP9_SQL, op9_exact_topk
from clickstats.llm.q_toxicity import op3_toxicity

LLM_QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_phrase_dedup": op2_phrase_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_html_text": op4_html_text,
    "op5_decontaminate": op5_decontaminate,
    "op6_personal_data": op6_personal_data,
    "op7_secret_scan": op7_secret_scan,
    "op8_mix_sources": op8_mix_sources,
    "op9_exact_topk": op9_exact_topk,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_quality": op11_quality,
    "op12_filter_audit": op12_filter_audit,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}
LLM_ORACLE = {
    "op1_ngram_jaccard": OP1_SQL,
    "op2_phrase_dedup": OP2_SQL,
    "op5_decontaminate": OP5_SQL,
    "op7_secret_scan": OP7_SQL,
    "op9_exact_topk": OP9_SQL,
    "op10_suffix_dedup": OP10_SQL,
    "op12_filter_audit": OP12_SQL,
}
if corpus_pipeline.ORACLE_SQL is not None:
    LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

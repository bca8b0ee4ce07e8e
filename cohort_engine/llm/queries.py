"""The queries of this subpackage and their DuckDB twins, as ``__spark_entry__`` registers them."""

from __future__ import annotations

from cohort_engine.llm import decontaminate, merkle, near_duplicates, phrases, warc
from cohort_engine.llm.decontaminate import op5_decontamination
from cohort_engine.llm.html_text import op1_html_text
from cohort_engine.llm.merkle import op12_merkle_manifest
from cohort_engine.llm.near_duplicates import op7_near_duplicates
from cohort_engine.llm.packing import op4_linear_grouping
from cohort_engine.llm.personal_data import op11_personal_data
from cohort_engine.llm.phrases import op13_phrases
from cohort_engine.llm.quality import op10_quality
from cohort_engine.llm.sharding import op8_ring_sharding
from cohort_engine.llm.token_counts import op3_token_counts
from cohort_engine.llm.toxicity import op2_toxicity
from cohort_engine.llm.vector_search import op9_graph_search
from cohort_engine.llm.warc import op6_warc_derivatives

QUERIES = {f.__name__: f for f in (op1_html_text, op2_toxicity, op3_token_counts, op4_linear_grouping, op5_decontamination, op6_warc_derivatives,
                                    op7_near_duplicates, op8_ring_sharding, op9_graph_search, op10_quality, op11_personal_data, op12_merkle_manifest,
                                    op13_phrases)}
ORACLE: dict[str, str] = {"op5_decontamination": decontaminate.ORACLE_SQL,
                          "op6_warc_derivatives": warc.ORACLE_SQL,
                          "op7_near_duplicates": near_duplicates.ORACLE_SQL,
                          "op12_merkle_manifest": merkle.ORACLE_SQL,
                          "op13_phrases": phrases.ORACLE_SQL}

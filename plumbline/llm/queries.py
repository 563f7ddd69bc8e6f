"""The corpus queries, one for each operator, and their SQL oracles."""

from __future__ import annotations

from plumbline.llm.decontaminate import OP2_SQL, op2_benchmark_decontamination
from plumbline.llm.embedding_dedup import OP1_SQL, op1_embedding_near_dedup
from plumbline.llm.html_content import op9_html_extraction
from plumbline.llm.impact_search import OP12_SQL, op12_ranked_lexical_search
from plumbline.llm.katz import op5_katz_backoff
from plumbline.llm.langid import op10_language_id
from plumbline.llm.line_templates import OP3_SQL, op3_line_template_dedup
from plumbline.llm.minhash_dedup import OP4_SQL, op4_minhash_near_dedup
from plumbline.llm.packing import op11_harmonic_packing
from plumbline.llm.pii import op6_personal_data
from plumbline.llm.suffix_dedup import op8_suffix_array_dedup
from plumbline.llm.unigram import op7_sentencepiece
from plumbline.llm.whitening import op13_embedding_whitening

ALL = [op1_embedding_near_dedup, op2_benchmark_decontamination, op3_line_template_dedup, op4_minhash_near_dedup, op5_katz_backoff, op6_personal_data, op7_sentencepiece, op8_suffix_array_dedup, op9_html_extraction, op10_language_id, op11_harmonic_packing, op12_ranked_lexical_search, op13_embedding_whitening]


def queries():
    return {f.__name__: f for f in ALL}


def oracle_sql():
    return {"op1_embedding_near_dedup": OP1_SQL, "op2_benchmark_decontamination": OP2_SQL, "op3_line_template_dedup": OP3_SQL, "op4_minhash_near_dedup": OP4_SQL, "op12_ranked_lexical_search": OP12_SQL}

"""Registered queries of the subpackage and their DuckDB SQL, by name."""

from __future__ import annotations

from tessera.llm import fp_search, hard_negatives, quality_rules, topk, url_filter
from tessera.llm.fp_search import op13_ranked_search
from tessera.llm.hard_negatives import op11_hard_negatives
from tessera.llm.ngram_join import op1_ngram_jaccard_join
from tessera.llm.packing import op10_cost_balanced_packing
from tessera.llm.page_text import op8_page_text
from tessera.llm.pieces import op7_sentencepiece
from tessera.llm.quality_model import op3_quality_model
from tessera.llm.quality_rules import op5_quality_rules
from tessera.llm.secrets import op2_secret_scan
from tessera.llm.suffix_family import op12_suffix_dedup
from tessera.llm.token_files import op4_token_files
from tessera.llm.topk import op6_exact_topk
from tessera.llm.url_filter import op9_url_filter

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_secret_scan": op2_secret_scan,
    "op3_quality_model": op3_quality_model,
    "op4_token_files": op4_token_files,
    "op5_quality_rules": op5_quality_rules,
    "op6_exact_topk": op6_exact_topk,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_page_text": op8_page_text,
    "op9_url_filter": op9_url_filter,
    "op10_cost_balanced_packing": op10_cost_balanced_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE_SQL: dict[str, str] = {
    "op5_quality_rules": quality_rules.ORACLE,
    "op6_exact_topk": topk.ORACLE,
    "op9_url_filter": url_filter.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op13_ranked_search": fp_search.ORACLE,
}

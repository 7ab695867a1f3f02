"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from riverlog.llm import op1_token_output, op2_decontamination, op3_best_fit_packing, op4_chat_format, op5_topk_search
from riverlog.llm import op6_language_id, op7_repeated_strings, op8_toxicity, op9_url_filter, op10_minhash_dedup
from riverlog.llm import op11_embedding_dedup, op12_importance_resample, op13_ranked_search

_MODULES = (op1_token_output, op2_decontamination, op3_best_fit_packing, op4_chat_format, op5_topk_search, op6_language_id, op7_repeated_strings, op8_toxicity, op9_url_filter, op10_minhash_dedup, op11_embedding_dedup, op12_importance_resample, op13_ranked_search)
QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: s for m in _MODULES for k, s in m.ORACLES.items()}

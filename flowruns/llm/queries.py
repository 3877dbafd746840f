"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from flowruns.llm.chat import OP6_SQL, op6_prefix_chat
from flowruns.llm.classifier import op8_rule_quality
from flowruns.llm.decontaminate import op5_seed_align
from flowruns.llm.divergence_audit import OP12_SQL, op12_level_products
from flowruns.llm.importance import op11_byte_importance
from flowruns.llm.mixing import OP2_SQL, op2_pareto_mix
from flowruns.llm.pseudonyms import op3_feistel_pseudonyms
from flowruns.llm.quality_rules import op7_divergence_rules
from flowruns.llm.sharding import op9_ring_shards
from flowruns.llm.simhash import op4_simhash_trie
from flowruns.llm.substring import op10_sentence_spans
from flowruns.llm.token_files import op1_token_files
from flowruns.llm.vector_cells import OP13_SQL, op13_cell_topk

QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_pareto_mix, op3_feistel_pseudonyms, op4_simhash_trie, op5_seed_align, op6_prefix_chat,
    op7_divergence_rules, op8_rule_quality, op9_ring_shards, op10_sentence_spans, op11_byte_importance,
    op12_level_products, op13_cell_topk)}
ORACLES = {"op2_pareto_mix": OP2_SQL, "op6_prefix_chat": OP6_SQL, "op12_level_products": OP12_SQL, "op13_cell_topk": OP13_SQL}

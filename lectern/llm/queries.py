"""The training-data operators as queries over the driver's tables, and their DuckDB text where SQL can express them."""

from __future__ import annotations

from lectern.llm import (chat_format, flow_reshard, merkle_manifest, ordinal_quality, outlier_rules, pii_surrogates, prefix_decontam,
                         prefix_trie, source_mix, suffix_dedup, tensor_dedup, url_templates, wavelet_shards)

QUERIES = {
    "op1_url_templates": url_templates.q_op1,
    "op2_pii_surrogates": pii_surrogates.q_op2,
    "op3_wavelet_shards": wavelet_shards.q_op3,
    "op4_chat_format": chat_format.q_op4,
    "op5_flow_reshard": flow_reshard.q_op5,
    "op6_prefix_decontam": prefix_decontam.q_op6,
    "op7_tensor_dedup": tensor_dedup.q_op7,
    "op8_ordinal_quality": ordinal_quality.q_op8,
    "op9_outlier_rules": outlier_rules.q_op9,
    "op10_source_mix": source_mix.q_op10,
    "op11_merkle_manifest": merkle_manifest.q_op11,
    "op12_suffix_dedup": suffix_dedup.q_op12,
    "op13_prefix_trie": prefix_trie.q_op13,
}
ORACLE = {
    "op1_url_templates": url_templates.ORACLE_OP1,
    "op4_chat_format": chat_format.ORACLE_OP4,
    "op6_prefix_decontam": prefix_decontam.ORACLE_OP6,
    "op10_source_mix": source_mix.ORACLE_OP10,
    "op11_merkle_manifest": merkle_manifest.ORACLE_OP11,
    "op13_prefix_trie": prefix_trie.ORACLE_OP13,
}

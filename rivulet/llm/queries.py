"""The operators as queries over the whole test tables, and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import bagminhash, chat, decontaminate, line_dedup, mixing, paragraph_dedup, pii, prefix_trie, quality_crf, quality_rules, ranked_search, sharding, suffix_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        line_dedup.op1_line_dedup,
        quality_crf.op2_quality_classifier,
        pii.op3_pii,
        mixing.op4_mixing,
        decontaminate.op5_decontamination,
        chat.op6_chat_formatting,
        quality_rules.op7_quality_rules,
        paragraph_dedup.op8_substring_dedup,
        bagminhash.op9_minhash_near_dedup,
        suffix_dedup.op10_suffix_array_dedup,
        sharding.op11_sharding,
        prefix_trie.op12_conversation_trie,
        ranked_search.op13_ranked_search,
    )
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op4_mixing": mixing.OP4_SQL,
    "op5_decontamination": decontaminate.OP5_SQL,
    "op6_chat_formatting": chat.OP6_SQL,
    "op10_suffix_array_dedup": suffix_dedup.OP10_SQL,
    "op11_sharding": sharding.OP11_SQL,
    "op12_conversation_trie": prefix_trie.OP12_SQL,
    "op13_ranked_search": ranked_search.OP13_SQL,
}

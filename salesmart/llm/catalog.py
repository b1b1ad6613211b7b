"""The text operators' queries by name, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import (
    decontaminate,
    exact_dedup,
    filter_audit,
    html_extract,
    jaccard_join,
    language,
    line_dedup,
    near_dedup,
    prefix_trie,
    secrets,
    sentencepieces,
    toxicity,
    urls,
)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extract": html_extract.op1_html_extract,
        "op2_line_dedup": line_dedup.op2_line_dedup,
        "op3_sentencepiece": sentencepieces.op3_sentencepiece,
        "op4_near_dedup": near_dedup.op4_near_dedup,
        "op5_decontaminate": decontaminate.op5_decontaminate,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_language": language.op7_language,
        "op8_url_filters": urls.op8_url_filters,
        "op9_secrets": secrets.op9_secrets,
        "op10_exact_dedup": exact_dedup.op10_exact_dedup,
        "op11_prefix_trie": prefix_trie.op11_prefix_trie,
        "op12_jaccard_join": jaccard_join.op12_jaccard_join,
        "op13_filter_audit": filter_audit.op13_filter_audit,
    }


def all_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": line_dedup.SQL,
        "op4_near_dedup": near_dedup.SQL,
        "op5_decontaminate": decontaminate.SQL,
        "op10_exact_dedup": exact_dedup.SQL,
        "op11_prefix_trie": prefix_trie.SQL,
        "op12_jaccard_join": jaccard_join.SQL,
        "op13_filter_audit": filter_audit.SQL,
    }

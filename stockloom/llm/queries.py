"""Registered queries of the training-data operators and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stockloom.llm.bounded_packing import op8_packing
from stockloom.llm.chat import OP1_SQL, op1_chat_format
from stockloom.llm.crf_language import op9_language
from stockloom.llm.extendible import OP10_SQL, op10_extendible_shards
from stockloom.llm.golay_simhash import op11_simhash_components
from stockloom.llm.grammar_store import op3_token_files
from stockloom.llm.jaccard_rtree import OP5_SQL, op5_jaccard_components
from stockloom.llm.multi_index import op7_nearest_vectors
from stockloom.llm.nra_search import OP13_SQL, op13_ranked_search
from stockloom.llm.ordinal_quality import op4_quality
from stockloom.llm.quartile_digest import op6_fingerprints
from stockloom.llm.soft_mixing import op2_mixing
from stockloom.llm.token_alignment import op12_token_alignment

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_chat_format,
        op2_mixing,
        op3_token_files,
        op4_quality,
        op5_jaccard_components,
        op6_fingerprints,
        op7_nearest_vectors,
        op8_packing,
        op9_language,
        op10_extendible_shards,
        op11_simhash_components,
        op12_token_alignment,
        op13_ranked_search,
    )
}
LLM_STATEMENTS: dict[str, str] = {
    "op1_chat_format": OP1_SQL,
    "op5_jaccard_components": OP5_SQL,
    "op10_extendible_shards": OP10_SQL,
    "op13_ranked_search": OP13_SQL,
}

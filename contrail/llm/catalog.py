"""The operators' named queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import (
    chat,
    exact_dedup,
    hilbert,
    language_id,
    licenses,
    mixing,
    ngram_join,
    packing,
    prefix_trie,
    resampling,
    secrets,
    sharding,
    token_store,
)
from contrail.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_mixing": lambda spark, d: mixing.op1(table(spark, d, "documents")),
    "op2_exact_dedup": lambda spark, d: exact_dedup.op2(table(spark, d, "documents")),
    "op3_hilbert": lambda spark, d: hilbert.op3(table(spark, d, "embeddings")),
    "op4_packing": lambda spark, d: packing.op4(table(spark, d, "documents")),
    "op5_language_id": lambda spark, d: language_id.op5(table(spark, d, "documents")),
    "op6_ngram_join": lambda spark, d: ngram_join.op6(table(spark, d, "documents")),
    "op7_licenses": lambda spark, d: licenses.op7(table(spark, d, "documents")),
    "op8_token_store": lambda spark, d: token_store.op8(table(spark, d, "documents")),
    "op9_chat": lambda spark, d: chat.op9(table(spark, d, "conversations")),
    "op10_secrets": lambda spark, d: secrets.op10(table(spark, d, "documents")),
    "op11_prefix_trie": lambda spark, d: prefix_trie.op11(table(spark, d, "conversations")),
    "op12_sharding": lambda spark, d: sharding.op12(table(spark, d, "documents")),
    "op13_resampling": lambda spark, d: resampling.op13(table(spark, d, "documents"), table(spark, d, "benchmark")),
}
SQL: dict[str, str] = {
    "op1_mixing": mixing.OP1_SQL,
    "op2_exact_dedup": exact_dedup.OP2_SQL,
    "op6_ngram_join": ngram_join.OP6_SQL,
    "op7_licenses": licenses.sql(),
    "op9_chat": chat.OP9_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op12_sharding": sharding.OP12_SQL,
    "op13_resampling": resampling.OP13_SQL,
}

"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from abspark.llm import oracle
from abspark.llm.byte_bpe import op13_byte_bpe
from abspark.llm.common import table
from abspark.llm.heap_kmeans import op11_heap_kmeans
from abspark.llm.kk_packing import op4_kk_packing
from abspark.llm.language_id import op2_marginal_unigrams
from abspark.llm.line_dedup import op5_line_dedup
from abspark.llm.nn_descent import op3_nn_descent
from abspark.llm.permutation_index import op8_permutation_index
from abspark.llm.prefix_trie import op12_prefix_trie
from abspark.llm.secret_ledger import op9_secret_ledger
from abspark.llm.sentencepiece_ffbs import op1_sentencepiece_ffbs
from abspark.llm.simhash_ball import op6_simhash_ball
from abspark.llm.suffix_tree_lm import op10_suffix_tree
from abspark.llm.warc_bundles import op7_warc_bundles

_OPERATORS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    f.__name__: (name, f)
    for name, f in (
        ("documents", op1_sentencepiece_ffbs),
        ("documents", op2_marginal_unigrams),
        ("embeddings", op3_nn_descent),
        ("documents", op4_kk_packing),
        ("documents", op5_line_dedup),
        ("documents", op6_simhash_ball),
        ("pages", op7_warc_bundles),
        ("embeddings", op8_permutation_index),
        ("documents", op9_secret_ledger),
        ("documents", op10_suffix_tree),
        ("embeddings", op11_heap_kmeans),
        ("conversations", op12_prefix_trie),
        ("documents", op13_byte_bpe),
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def query(name: str, f: Callable[[DataFrame], DataFrame]):
        return lambda spark, sf_dir: f(table(spark, sf_dir, name))

    return {key: query(name, f) for key, (name, f) in _OPERATORS.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_nn_descent": oracle.NEAR_VECTORS,
        "op5_line_dedup": oracle.LINE_DEDUP,
        "op7_warc_bundles": oracle.WARC,
        "op9_secret_ledger": oracle.SECRETS,
        "op11_heap_kmeans": oracle.HEAP_KMEANS,
        "op12_prefix_trie": oracle.PREFIX_TRIE,
    }

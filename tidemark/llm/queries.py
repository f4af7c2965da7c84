"""Queries of the operators in this package, by name, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    ann,
    bitplane,
    bpe,
    exact_dedup,
    html_extract,
    langid,
    mixing,
    near_dedup,
    packing,
    pii,
    pitman_yor,
    prefix_trie,
    token_align,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.op1_pii,
    "op2_minhash": near_dedup.op2_minhash,
    "op3_packing": packing.op3_packing,
    "op4_bitplane_ids": bitplane.op4_bitplane_ids,
    "op5_html": html_extract.op5_html,
    "op6_mixing": mixing.op6_mixing,
    "op7_ann": ann.op7_ann,
    "op8_pitman_yor": pitman_yor.op8_pitman_yor,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_language": langid.op10_language,
    "op11_bpe": bpe.op11_bpe,
    "op12_alignment": token_align.op12_alignment,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}
ORACLE: dict[str, str] = {
    "op9_exact_dedup": exact_dedup.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}

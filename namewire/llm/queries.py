"""The queries of this subpackage by name, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from namewire.llm import (
    decontamination, html, minhash, mixing, neighbours, packing, passages, quality, repair, rules, secrets, toxicity, trie,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": html.op1_html,
    "op2_minhash": minhash.op2_minhash,
    "op3_mixing": mixing.op3_mixing,
    "op4_secrets": secrets.op4_secrets,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_packing": packing.op6_packing,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_quality": quality.op8_quality,
    "op9_passages": passages.op9_passages,
    "op10_neighbours": neighbours.op10_neighbours,
    "op11_rules": rules.op11_rules,
    "op12_trie": trie.op12_trie,
    "op13_repair": repair.op13_repair,
}

ORACLE: dict[str, str] = {"op3_mixing": mixing.OP3_SQL, "op12_trie": trie.OP12_SQL, "op13_repair": repair.OP13_SQL}

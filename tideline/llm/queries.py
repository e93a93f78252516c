"""Queries of this package by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import chat, phrases, topk
from tideline.llm.ann import op7_ann
from tideline.llm.byte_bpe import op4_byte_bpe
from tideline.llm.licenses import op8_licenses
from tideline.llm.lines import op9_lines
from tideline.llm.packing import op1_best_fit_packing
from tideline.llm.pii import op3_pii
from tideline.llm.quality import op5_quality
from tideline.llm.rules import op13_quality_rules
from tideline.llm.simhash import op2_simhash
from tideline.llm.variants import op12_variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_simhash": op2_simhash,
    "op3_pii": op3_pii,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality": op5_quality,
    "op6_top_k": topk.op6_top_k,
    "op7_ann": op7_ann,
    "op8_licenses": op8_licenses,
    "op9_lines": op9_lines,
    "op10_chat": chat.op10_chat,
    "op11_collocations": phrases.op11_collocations,
    "op12_variants": op12_variants,
    "op13_quality_rules": op13_quality_rules,
}

# What SQL cannot express is tested against brute force in tests/llm.
ORACLE: dict[str, str] = {"op6_top_k": topk.ORACLE_SQL, "op10_chat": chat.ORACLE_SQL,
                          "op11_collocations": phrases.ORACLE_SQL}

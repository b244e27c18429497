"""The queries of this subpackage, by name, and their SQL where SQL can express them.

A module is imported when its query runs or is listed; nothing here swallows import errors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, html, langid, lines, media, mixing, rules, simhash, suffix, token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_progressive_jpeg": media.op2_progressive_jpeg,
    "op3_weighted_mixing": mixing.op3_weighted_mixing,
    "op4_repeated_passages": suffix.op4_repeated_passages,
    "op5_main_text": html.op5_main_text,
    "op6_simhash": simhash.op6_simhash,
    "op7_language": langid.op7_language,
    "op8_quality_rules": rules.op8_quality_rules,
    "op9_byte_bpe": bpe.op9_byte_bpe,
    "op10_line_dedup": lines.op10_line_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op3_weighted_mixing": mixing.ORACLE_SQL,
    "op10_line_dedup": lines.ORACLE_SQL,
}

"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmart.llm.decontam import OP11_SQL, op11_decontamination
from gridmart.llm.exact_dedup import OP3_SQL, op3_exact_dedup
from gridmart.llm.html_text import op5_main_text
from gridmart.llm.langid import op1_language_id
from gridmart.llm.merkle import OP13_SQL, op13_merkle_manifest
from gridmart.llm.mixing import OP10_SQL, op10_mix_sources
from gridmart.llm.packing import op8_binary_packing
from gridmart.llm.pii import op4_personal_data
from gridmart.llm.quality import op7_quality
from gridmart.llm.secrets import op6_secret_scan
from gridmart.llm.simhash import op2_simhash_dedup
from gridmart.llm.spelling import OP12_SQL, op12_spelling_variants
from gridmart.llm.winnow import op9_winnowing

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_personal_data": op4_personal_data,
    "op5_main_text": op5_main_text,
    "op6_secret_scan": op6_secret_scan,
    "op7_quality": op7_quality,
    "op8_binary_packing": op8_binary_packing,
    "op9_winnowing": op9_winnowing,
    "op10_mix_sources": op10_mix_sources,
    "op11_decontamination": op11_decontamination,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE: dict[str, str] = {
    "op3_exact_dedup": OP3_SQL,
    "op10_mix_sources": OP10_SQL,
    "op11_decontamination": OP11_SQL,
    "op12_spelling_variants": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}

"""The registered queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opslake.llm import (conversation_repair, embedding_dedup, language_model, licenses, line_dedup, mixing, packing, quality,
                         secrets, simhash, substring_dedup, url_filter, whitening)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_embedding_dedup": embedding_dedup.op2_embedding_dedup,
        "op3_line_dedup": line_dedup.op3_line_dedup,
        "op4_source_mixing": mixing.op4_source_mixing,
        "op5_secret_scan": secrets.op5_secret_scan,
        "op6_url_filter": url_filter.op6_url_filter,
        "op7_lm_scoring": language_model.op7_lm_scoring,
        "op8_quality_rules": quality.op8_quality_rules,
        "op9_packing": packing.op9_packing,
        "op10_license_scan": licenses.op10_license_scan,
        "op11_substring_dedup": substring_dedup.op11_substring_dedup,
        "op12_whitening": whitening.op12_whitening,
        "op13_conversation_repair": conversation_repair.op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {}

"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vacatia.llm import chat, decontaminate, langid, mixing, neardup, search, secrets, toxicity, urls, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_search": search.op1_search,
        "op2_secret_scan": secrets.op2_secret_scan,
        "op3_decontaminate": decontaminate.op3_decontaminate,
        "op4_near_duplicates": neardup.op4_near_duplicates,
        "op5_chat_rotation": chat.op5_chat_rotation,
        "op6_mix": mixing.op6_mix,
        "op7_merkle_audit": warc.op7_merkle_audit,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_url_filter": urls.op9_url_filter,
        "op10_language_id": langid.op10_language_id,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_secret_scan": secrets.oracle(),
        "op5_chat_rotation": chat.oracle(),
        "op7_merkle_audit": warc.oracle(),
        "op9_url_filter": urls.oracle(),
    }

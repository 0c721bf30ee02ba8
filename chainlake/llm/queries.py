"""The queries opN_ of this subpackage, each over its whole table, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chainlake.llm import decontam, htmlextract, langid, license, linedup, neardup, packing, quality, urlfilter, warc
from chainlake.session import ship


def _shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": _shipped(decontam.query),
    "op2_warc": _shipped(warc.query),
    "op3_language": _shipped(langid.query),
    "op4_near_duplicates": _shipped(neardup.query),
    "op5_quality": _shipped(quality.query),
    "op6_packing": _shipped(packing.query),
    "op7_line_dedup": _shipped(linedup.query),
    "op8_url_filter": _shipped(urlfilter.query),
    "op9_main_text": _shipped(htmlextract.query),
    "op10_licenses": _shipped(license.query),
}
#: Where SQL is missing, it can't express the operator; tests/llm holds it against brute force.
ORACLE_SQL: dict[str, str] = {"op2_warc": warc.ORACLE_SQL, "op8_url_filter": urlfilter.ORACLE_SQL}

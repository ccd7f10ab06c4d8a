"""Query of the licence scan over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playstats.llm.common import read_table
from playstats.llm.license_scan import license_scan


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))

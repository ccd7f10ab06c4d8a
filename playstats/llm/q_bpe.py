"""Query of the byte-level BPE over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from playstats.llm.bpe import bpe_round_trip
from playstats.llm.common import read_table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = bpe_round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

"""A corpus pipeline: from raw documents to token ids, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all documents that the
stage before it kept. All but the last return the columns of ``documents``;
the last returns the encoded texts.
"""

from pyspark.sql import functions as F

from playstats.llm.bpe import bpe_round_trip
from playstats.llm.common import read_table
from playstats.llm.jaccard_join import drop_near_copies
from playstats.llm.line_dedup import line_dedup
from playstats.llm.mixing import mix_sources
from playstats.llm.quality_rules import quality_filter
from playstats.session import cut_lineage

RANK_FILE = "byte_bpe_multi_50k.tiktoken"

#: Decisions depend on models of whole tables and on other stages' rows; tests compare with a brute-force version.
ORACLE_SQL = None


def keep_quality(spark, docs, sf_dir):
    """Documents that the quality rules keep."""
    return quality_filter(docs)


def drop_repeated_lines(spark, docs, sf_dir):
    """Lines that an earlier document holds are taken out of the texts."""
    return line_dedup(docs)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return drop_near_copies(docs, words=5, percent=80)


def mix(spark, docs, sf_dir):
    """Documents as often as the mixture of sources takes them."""
    return mix_sources(docs)


def encode(spark, docs, sf_dir):
    """doc_id, token ids, their number, and the SHA-256 of the bytes that they decode to."""
    import public_tokenizers

    decoded = bpe_round_trip(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", encode),
]


def run(spark, sf_dir):
    """The last stage's rows; every stage before it is stored and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

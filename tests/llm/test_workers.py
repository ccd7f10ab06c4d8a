"""Operators in a session whose Python workers cannot import this package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = f"""
import sys
sys.path.append({ROOT!r})  # of the driver only
from pyspark.sql import functions as F
from playstats.session import build_session
from playstats.llm import bpe, clustering, lm_scoring, merkle
import public_tokenizers

spark = build_session("local[2]", 2)

def missing(batches):
    for batch in batches:
        try:
            import playstats
        except ModuleNotFoundError:
            yield batch

assert spark.range(1).mapInArrow(missing, "id bigint").count() == 1, "workers find the package"
rank_file, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
docs = spark.createDataFrame([(i, f"some words {{i}} of a text", "en", "s", 5) for i in range(20)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
done = bpe.bpe_round_trip(docs, rank_file, pattern)
assert done.where(F.col("decoded").cast("string") == F.lit("some words 3 of a text")).count() == 1
assert bpe.bpe_decode(done.select("doc_id", "ids"), rank_file).count() == 20
assert lm_scoring.score_documents(docs, docs.where("doc_id % 2 = 0"), rank_file, pattern).count() == 20
assert merkle.merkle_manifest(docs, ["doc_id", "text"], block_levels=2).count() == 20
vectors = docs.select(F.col("doc_id").alias("vec_id"), F.array(F.col("doc_id").cast("double"), F.lit(0.5)).alias("embedding"))
assert clustering.cluster_vectors(vectors, dims=2, k=3)[0].count() == 20
print("all went through")
"""


def test_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    kept = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and os.path.abspath(p) != ROOT]
    if kept:
        env["PYTHONPATH"] = os.pathsep.join(kept)
    run = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0 and "all went through" in run.stdout, run.stderr[-3000:]

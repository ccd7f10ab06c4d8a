"""Metadata dumps (SRC6-8): newline-delimited JSON, one object per line.

Keys are selected by a fixed schema (never inferred) and renamed to the
table's columns in DDL order. A nested value read into a string field keeps
its raw JSON text, which is how the recording's artist credit is stored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from playstats.schemas import (
    ARTIST_DUMP_COLUMNS,
    ARTIST_DUMP_SCHEMA,
    CORRUPT,
    RECORDING_DUMP_COLUMNS,
    RECORDING_DUMP_SCHEMA,
    UUID_RE,
)
from playstats.session import cut_lineage

#: Why a line of a dump does not load.
DUMP_REJECTS = ("line", "no_key", "bad_key")


@dataclass(frozen=True)
class DumpSource:
    table: str
    schema: StructType
    columns: dict[str, str]
    key: str


DUMPS = {
    "artist": DumpSource("artist_metadata", ARTIST_DUMP_SCHEMA, ARTIST_DUMP_COLUMNS, "artist_id"),
    "recording": DumpSource("recording_metadata", RECORDING_DUMP_SCHEMA, RECORDING_DUMP_COLUMNS, "rec_id"),
}


def read_dump(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """SRC6/SRC7: one dump as a table. A missing path raises Spark's
    path-not-found error (SRC8); a malformed line fails the read."""
    src = DUMPS[kind]
    raw = spark.read.schema(src.schema).option("mode", "FAILFAST").json(path)
    cols = [F.col(f"`{k}`").alias(v) for k, v in src.columns.items()]
    df = raw.select(*cols)
    # UUID keys are compared in lower case
    return df.withColumn(src.key, F.lower(F.col(src.key)))


def scan_dump(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """SRC6/SRC7, C2-3: every line of a dump as a row of its table, with the
    ``reject`` reason of a line that does not load, NULL for a good row.

    A line that is no JSON object, or whose values do not have the schema's
    types, is kept whole in ``corrupt_line``. The key must be a UUID. Nested
    values of text columns stay JSON text.
    """
    src = DUMPS[kind]
    schema = StructType([*src.schema.fields, StructField(CORRUPT, StringType())])
    raw = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    df = raw.select(*[F.col(f"`{k}`").alias(v) for k, v in src.columns.items()], CORRUPT)
    df = df.withColumn(src.key, F.lower(F.col(src.key)))
    reject = (
        F.when(F.col(CORRUPT).isNotNull(), "line")
        .when(F.col(src.key).isNull(), "no_key")
        .when(~F.col(src.key).rlike(UUID_RE), "bad_key")
    )
    return df.withColumn("reject", reject)


def load_dump(spark: SparkSession, path: str, kind: str, out_path: str, strict: bool = False) -> dict[str, int]:
    """SNK5, PIPE4: a dump as a Parquet table; returns its counts.

    The lines are read once: rows that load are written while all lines are
    counted by reason. Keys that occur more than once are then counted in the
    key column of what was written, before the table is put in place. ``strict``
    makes any reject an error, a repeated key always is one.
    """
    src, seen = DUMPS[kind], Observation()
    rows = scan_dump(spark, path, kind)
    count = lambda reason: F.count(F.when(F.col("reject") == reason, 1)).alias(reason)
    observed = rows.observe(seen, F.count(F.lit(1)).alias("lines"), *[count(r) for r in DUMP_REJECTS])
    good = cut_lineage(observed.where("reject IS NULL").drop("reject", CORRUPT), f"dump-{kind}")
    counts = {name: seen.get[name] or 0 for name in ("lines", *DUMP_REJECTS)}
    rejected = {r: counts[r] for r in DUMP_REJECTS if counts[r]}
    if strict and rejected:
        raise ValueError(f"lines of {path} that cannot be loaded: {rejected}")
    counts["repeated_keys"] = good.groupBy(src.key).count().where("count > 1").count()
    if counts["repeated_keys"]:
        raise ValueError(f"{counts['repeated_keys']} keys of {path} occur more than once")
    good.write.mode("overwrite").option("compression", "zstd").parquet(out_path)
    return counts


def read_dumps(spark: SparkSession, paths: dict[str, str], only: str | None = None) -> dict[str, DataFrame]:
    """SRC7: import all dumps, or only the one named by ``only``."""
    kinds = [only] if only else list(paths)
    return {k: read_dump(spark, paths[k], k) for k in kinds}

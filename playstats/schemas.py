"""Schemas, id ranges and the fixed values the results depend on."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for the same results)
# ---------------------------------------------------------------------------
# Integer code ranges per entity type: code = base + position within type.
ID_RANGES = {
    "user_id": 100_000_000,
    "artist_ids": 200_000_000,
    "release_id": 300_000_000,
    "rec_id": 400_000_000,
}
ENTITY_TYPES = ("user_id", "artist_ids", "release_id", "rec_id")
# Width of one code range; a type with more members would run into the next.
ID_RANGE_WIDTH = 100_000_000
INT32_MAX = 2**31 - 1

# Artist dimension values used by the exclusion rules.
PERSON_TYPE = "Person"
NOT_APPLICABLE_GENDER = "Not applicable"
UNKNOWN_LABEL = "Unknown"

# Exclusion reasons, in the order the reference applies its deletes.
REASONS = ("group", "late", "nonperson", "nullgender", "na")
KEEP = "keep"

# Plays on or after this instant are "late" in the reference's run.
DEFAULT_LATE_CUT = "2014-01-01"

# Recommender evaluation defaults (reference parameters).
EVAL_STEP_MONTHS = 2
EVAL_WINDOW_MONTHS = 24
EVAL_LIST_LENGTH = 100
EVAL_MIN_WINDOW_ROWS = 10
EVAL_MIN_TEST_ROWS = 2
EVAL_MIN_USER_ACTIONS = 5
RBP_PATIENCE = 0.85

# Raw play-file paths end in "/<segment dir>/<user uuid>.txt.zst".
PLAY_FILE_RE = r"/([a-f0-9]+)/([a-f0-9-]+)\.txt\.zst$"
UUID_RE = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"

# A comma list of such keys, tested as one text.
UUID_LIST_RE = UUID_RE[:-1] + "(," + UUID_RE[1:-1] + ")*$"

# Rows per output file of the chunked writer.
ROWS_PER_FILE = 20_000_000
# ---------------------------------------------------------------------------


def epoch_seconds(day: str) -> int:
    """UTC epoch seconds of a 'YYYY-MM-DD' date (time zone independent)."""
    return int(datetime.strptime(day, "%Y-%m-%d").replace(tzinfo=timezone.utc).timestamp())


# Raw headerless TSV of one user's plays; types are fixed, never inferred.
RAW_PLAY_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("artist_ids", T.StringType()),
        T.StructField("release_id", T.StringType()),
        T.StructField("rec_id", T.StringType()),
    ]
)

#: Beside the columns of a text source: the whole line, if it does not parse.
CORRUPT = "corrupt_line"

# Staging plays with UUID keys.
UUID_PLAY_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("artist_ids", T.ArrayType(T.StringType())),
        T.StructField("release_id", T.StringType()),
        T.StructField("rec_id", T.StringType()),
    ]
)

# Plays after encoding with integer codes.
CODED_PLAY_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("artist_ids", T.ArrayType(T.IntegerType())),
        T.StructField("release_id", T.IntegerType()),
        T.StructField("rec_id", T.IntegerType()),
    ]
)

ID_DICTIONARY_SCHEMA = T.StructType(
    [
        T.StructField("entity_type", T.StringType(), False),
        T.StructField("entity_uuid", T.StringType(), False),
        T.StructField("id_num", T.IntegerType(), False),
    ]
)

# Metadata dumps (NDJSON). Source key -> column, in DDL order.
ARTIST_DUMP_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("type", T.StringType()),
    ]
)
ARTIST_DUMP_COLUMNS = {"id": "artist_id", "name": "name", "gender": "gender", "type": "type"}

# "artist-credit" is nested JSON; reading it as a string keeps its raw text.
RECORDING_DUMP_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("artist-credit", T.StringType()),
    ]
)
RECORDING_DUMP_COLUMNS = {"id": "rec_id", "title": "title", "artist-credit": "artist_credit"}

# Shape of an artist credit, only the part the genre path reads.
ARTIST_CREDIT_DDL = "array<struct<artist:struct<genres:array<struct<name:string>>>>>"

"""Queries over real files: they write the fixture's plays and metadata in the
reference's input and output forms, read them back by the library's scans, and
return what a user would see.

The files are written once for each session and table folder (``Fixtures.shared``)
under the checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from playstats.functions import credit_genres
from playstats.operators.encode import check_code_capacity
from playstats.plans.catalog import CATALOG, CLEAN_CTE, EVAL_CTES, IDS_CTE, LATE_CUT, _stored_ids, register
from playstats.plans.fixtures import Fixtures, uuid_sql
from playstats.plans.oracle_fixtures import with_fixtures
from playstats.schemas import ID_RANGE_WIDTH
from playstats.session import cut_lineage, slices_of, stage_path
from playstats.sources import drop_database, list_columns, load_rows, read_loads, read_segments, read_text_partitions, save_table, stage_load
from playstats.sources.dumps import DUMP_REJECTS, scan_dump
from playstats.sources.playfiles import ARCHIVE_GLOB, parse_plays, reject_counts, scan_play_files, split_rejects
from playstats.sources.sinks import write_audit, write_csv_report, write_play_files, write_recommendations, write_segmented_plays
from playstats.streaming import compact_rollup, parsed_stream, read_clean_rollup, start_clean_rollup

#: Rows that close a chunk file; small, so that the test tables fill several.
CHUNK_ROWS = 5_000
#: Rows that close an archive of play files, and archives of a micro-batch.
ARCHIVE_ROWS, BATCH_ARCHIVES = 200_000, 400
#: Segment folder names: hexadecimal, some of which look like numbers.
SEGMENTS = ("00", "1d", "2f", "1e3")


def _segment_names(df: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(s) for s in SEGMENTS])
    return df.withColumn("segment", F.get(names, F.col("segment").cast("int")))


_SEGMENT_SQL = "[" + ", ".join(f"'{s}'" for s in SEGMENTS) + "][segment + 1]"

# ---------------------------------------------------------------------------
# SNK1: whole users in chunk files
# ---------------------------------------------------------------------------
_USERS_SQL = {
    "users": "select segment, user_id, count(*) as n from plays group by segment, user_id",
    "started": "select *, coalesce(sum(n) over (partition by segment order by user_id rows between unbounded preceding "
    "and 1 preceding), 0) as before from users",
    "packed": f"select *, dense_rank() over (partition by segment order by before // {CHUNK_ROWS}) as chunk from started",
}


@register(
    "play_chunks",
    with_fixtures(
        "select cast(segment as varchar) as segment, cast(chunk as bigint) as chunk, cast(1 as bigint) as files, "
        "count(*) as users, cast(sum(n) as bigint) as rows from packed group by segment, chunk",
        _USERS_SQL,
    ),
)
def q_play_chunks(fx: Fixtures) -> DataFrame:
    """SNK1: chunk files of whole users, counted from what was written."""
    path = stage_path(fx.spark, "play-chunks")
    write_segmented_plays(fx.plays, path, CHUNK_ROWS)
    rows = read_segments(fx.spark, path).select("segment", "chunk", "user_id", F.col("_metadata.file_path").alias("file"))
    # a user's rows are in one file, so users and files of a chunk are few rows
    users = rows.groupBy("segment", "chunk", "user_id", "file").agg(F.count(F.lit(1)).alias("n"))
    return users.groupBy("segment", F.col("chunk").cast("bigint").alias("chunk")).agg(
        F.countDistinct("file").alias("files"), F.count(F.lit(1)).alias("users"), F.sum("n").alias("rows")
    )


# ---------------------------------------------------------------------------
# SRC1, SRC3-5, SRC10-11: play files
# ---------------------------------------------------------------------------
def _play_files(fx: Fixtures) -> str:
    """Archives of play files: every user's, and in each segment one whose name is no user's."""

    def build():
        root = stage_path(fx.spark, "play-files")
        plays = _segment_names(fx.plays_uuid)
        stray = plays.groupBy("segment").agg(
            F.lit("notes").alias("user_id"), F.min("timestamp").alias("timestamp"),
            F.lit(None).cast("array<string>").alias("artist_ids"), F.min("release_id").alias("release_id"), F.min("rec_id").alias("rec_id"),
        )
        write_play_files(plays.unionByName(stray), root, ARCHIVE_ROWS, slices_of(plays))
        return root

    return fx.shared("play files", build)


#: A play file has an empty field for an empty list as well as for none.
FILE_PLAYS_CTE = {
    "file_plays": f"select {_SEGMENT_SQL} as segment, user_id, timestamp, "
    "case when len(artist_ids) > 0 then artist_ids end as artist_ids, release_id, rec_id from plays_uuid",
}


@register(
    "scanned_plays",
    with_fixtures("select * from file_plays", FILE_PLAYS_CTE),
)
def q_scanned_plays(fx: Fixtures) -> DataFrame:
    """SRC1, SRC3-5, PRJ1: plays out of zstd text files, one a user and segment."""
    return split_rejects(parse_plays(scan_play_files(fx.spark, _play_files(fx), ARCHIVE_GLOB)))[0]


@register(
    "scanned_rejects",
    with_fixtures("select 'file_name' as reject, count(distinct segment) as n_rows from plays"),
)
def q_scanned_rejects(fx: Fixtures) -> DataFrame:
    """SRC4: rows of files whose name is no play file's."""
    return reject_counts(parse_plays(scan_play_files(fx.spark, _play_files(fx), ARCHIVE_GLOB)))


@register(
    "segment_plays",
    with_fixtures(
        f"select {_SEGMENT_SQL} as segment, count(*) as n_rows, count(distinct user_id) as n_users from plays group by segment"
    ),
)
def q_segment_plays(fx: Fixtures) -> DataFrame:
    """SRC10-11: plays of stored segments by name, names such as ``1d``, ``00`` and ``1e3`` as they are."""

    def build():
        path = stage_path(fx.spark, "segment-plays")
        write_segmented_plays(_segment_names(fx.plays), path, CHUNK_ROWS)
        return path

    stored = read_segments(fx.spark, fx.shared("segments", build))
    return stored.groupBy("segment").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user_id").alias("n_users"))


# ---------------------------------------------------------------------------
# SRC6-8, C2-3, PIPE4: metadata dump
# ---------------------------------------------------------------------------
def _recording_dump(fx: Fixtures) -> str:
    """The recording dump as JSON lines: every recording, and beside some a
    line that is cut off, has no key, or a key that is no UUID."""

    def build():
        path = stage_path(fx.spark, "recording-dump")
        key = F.expr(uuid_sql("c", "rec_id"))
        credit = F.coalesce("artist_credit", F.lit("null"))
        plain = F.to_json(F.struct(F.upper(key).alias("id"), "title", F.lit(1).alias("length")))
        # the nested credit goes in as JSON, not as text
        line = F.concat(F.expr("substring(plain, 1, length(plain) - 1)"), F.lit(',"artist-credit":'), credit, F.lit("}"))
        rows = fx.recording.withColumn("plain", plain).withColumn("line", line)
        every = lambda n: F.col("rec_id") % n == 0
        lines = F.array(
            F.col("line"),
            F.when(every(19), F.expr("substring(line, 1, 40)")),
            F.when(every(23), F.lit('{"title":"no key"}')),
            F.when(every(29), F.lit('{"id":"xyz","title":"bad key"}')),
        )
        rows.select(F.explode(F.array_compact(lines)).alias("value")).write.option("compression", "gzip").text(path)
        return path

    return fx.shared("recording dump", build)


@register(
    "dump_recordings",
    with_fixtures(
        f"""
select {uuid_sql('c', 'r.rec_id')} as rec_id, any_value(r.title) as title, count(g.genre_name) as n_genres,
       coalesce(string_agg(g.genre_name, '|' order by g.genre_name), '') as genres
from recording r left join genres g on g.rec_id = r.rec_id group by r.rec_id""",
        {
            "genres": """select rec_id, genre_name from
   (select rec_id, unnest(json_extract_string(artist_credit, '$[*].artist.genres[*].name')) as genre_name
    from recording) where genre_name is not null"""
        },
    ),
)
def q_dump_recordings(fx: Fixtures) -> DataFrame:
    """SRC6-7, JSN1: recordings of a JSON dump, with the genres in their nested credit."""
    good = scan_dump(fx.spark, _recording_dump(fx), "recording").where("reject IS NULL")
    genres = F.array_sort(credit_genres("artist_credit"))
    return good.select("rec_id", "title", F.size(genres).cast("bigint").alias("n_genres"), F.array_join(genres, "|").alias("genres"))


@register(
    "dump_rejects",
    with_fixtures(
        """
select 'line' as reject, count(*) filter (where rec_id % 19 = 0) as n_rows from recording
union all select 'no_key', count(*) filter (where rec_id % 23 = 0) from recording
union all select 'bad_key', count(*) filter (where rec_id % 29 = 0) from recording"""
    ),
)
def q_dump_rejects(fx: Fixtures) -> DataFrame:
    """C2-3: lines of the dump that do not load, by reason."""
    rows = scan_dump(fx.spark, _recording_dump(fx), "recording")
    counts = rows.agg(*[F.count(F.when(F.col("reject") == r, 1)).alias(r) for r in DUMP_REJECTS])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(r).alias("reject"), F.col(r).alias("n_rows")) for r in DUMP_REJECTS])))


# ---------------------------------------------------------------------------
# SNK7: loads with a commit list
# ---------------------------------------------------------------------------
@register(
    "reloaded_plays",
    with_fixtures(
        f"select {_SEGMENT_SQL} as segment, user_id, timestamp, artist_ids, release_id, rec_id from plays "
        "where len(artist_ids) = 1 and (user_id % 8 < 4 or segment >= 2)"
    ),
)
def q_reloaded_plays(fx: Fixtures) -> DataFrame:
    """SNK7, FLT2: single-artist plays of two loads, the first of them loaded
    again with fewer segments, then once more by a write that ends before its commit."""
    path = stage_path(fx.spark, "reloaded-plays")
    solo = _segment_names(fx.plays.where(F.size("artist_ids") == 1))
    first = solo.where("user_id % 8 >= 4")
    load_rows(first, path, "a")
    load_rows(solo.where("user_id % 8 < 4"), path, "b")
    load_rows(first.where(F.col("segment").isin(list(SEGMENTS[2:]))), path, "a")
    stage_load(first, path, ["segment"])
    return read_loads(fx.spark, path).select(*solo.columns)


# ---------------------------------------------------------------------------
# STR1-2: rollup of clean plays from a stream of files
# ---------------------------------------------------------------------------
@register(
    "streamed_rollup",
    with_fixtures(
        f"select {uuid_sql('u', 'user_id')} as user_id, case when artist_id is not null then {uuid_sql('a', 'artist_id')} end as artist_id, "
        "count(*) as count, min(timestamp) as first_time, max(timestamp) as last_time from clean_files group by user_id, artist_id",
        {
            "clean_files": CLEAN_CTE["clean_plays"].replace(
                "from plays where", "from (select * replace (case when len(artist_ids) > 0 then artist_ids end as artist_ids) from plays) where"
            )
        },
    ),
)
def q_streamed_rollup(fx: Fixtures) -> DataFrame:
    """STR1-2, AGG2: the rollup of clean plays from play files that arrive in
    three parts, the first of them twice; compacted after the first."""
    root, table, progress = (stage_path(fx.spark, f"streamed-{name}") for name in ("files", "rollup", "progress"))
    plays = _segment_names(fx.plays_uuid)
    part = F.pmod(F.hash("user_id"), F.lit(3))
    arrival = 0
    for parts in ((0,), (1, 0, 2)):
        for of in parts:
            write_play_files(plays.where(part == of), f"{root}/arrival-{arrival}", ARCHIVE_ROWS)
            arrival += 1
        parsed = parsed_stream(fx.spark, root, f"arrival-*/{ARCHIVE_GLOB}", BATCH_ARCHIVES)
        start_clean_rollup(parsed, fx.artist_uuid, table, progress, LATE_CUT).awaitTermination()
        if len(parts) == 1:
            compact_rollup(fx.spark, table)
    return read_clean_rollup(fx.spark, table)


# ---------------------------------------------------------------------------
# SNK5, SRC13, SRC16: tables of the catalog
# ---------------------------------------------------------------------------
@register(
    "catalog_columns",
    with_fixtures(
        "\nunion all ".join(
            f"select '{table}' as table_name, '{column}' as column_name, '{kind}' as data_type, count({column}) as n_values from {table}"
            for table, columns in (
                ("artist", {"artist_id": "bigint", "name": "string", "gender": "string", "type": "string"}),
                ("recording", {"rec_id": "bigint", "title": "string", "artist_credit": "string"}),
            )
            for column, kind in columns.items()
        )
    ),
)
def q_catalog_columns(fx: Fixtures) -> DataFrame:
    """SNK5, SRC13, SRC16: columns of the metadata tables in a database, as the
    catalog lists them after one was replaced by another form, and how many
    values each holds, read by qualified name."""
    name = f"metadata_{uuid.uuid4().hex[:12]}"
    save_table(fx.recording.select("rec_id", F.lit(1).alias("old")), name, "recording", stage_path(fx.spark, "database"))
    tables = {"artist": save_table(fx.artist, name, "artist"), "recording": save_table(fx.recording, name, "recording")}
    columns = list_columns(fx.spark, name)
    values = None
    for table, df in tables.items():
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        one = counts.select(F.inline(F.array(*[F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("n_values")) for c in df.columns])))
        values = one if values is None else values.unionByName(one)
    out = cut_lineage(columns.join(values, ["table_name", "column_name"]), "catalog-columns")
    drop_database(fx.spark, name)
    return out.select("table_name", "column_name", "data_type", "n_values")


# ---------------------------------------------------------------------------
# SNK8-11, C5: reports as they are written
# ---------------------------------------------------------------------------
@register(
    "recommendation_files",
    with_fixtures(
        "select cast(window_start as date) as window_start, count(distinct user_id) as n_users, count(*) as n_rows, "
        "cast(max(rank) as bigint) as longest from recs group by window_start",
        EVAL_CTES,
    ),
)
def q_recommendation_files(fx: Fixtures) -> DataFrame:
    """SNK9: recommendation lists by window, counted from one window's folder after another."""
    path = stage_path(fx.spark, "recommendations")
    write_recommendations(CATALOG["top_n"].build(fx), path)
    rows = read_text_partitions(fx.spark, path, ["window_start"], path)
    return rows.groupBy(F.to_date("window_start").alias("window_start")).agg(
        F.countDistinct("user_id").alias("n_users"), F.count(F.lit(1)).alias("n_rows"), F.max("rank").cast("bigint").alias("longest")
    )


@register("metrics_report", CATALOG["eval_metrics"].sql)
def q_metrics_report(fx: Fixtures) -> DataFrame:
    """SNK10: the metrics of all windows, out of the CSV report."""
    metrics, path = CATALOG["eval_metrics"].build(fx), stage_path(fx.spark, "metrics")
    write_csv_report(metrics, path)
    return fx.spark.read.schema(metrics.schema).option("header", "true").csv(path)


@register(
    "audit_log",
    "select step || ': ' || format('{:,}', n_rows) as line from (" + CATALOG["exclusion_audit"].sql + ") a",
)
def q_audit_log(fx: Fixtures) -> DataFrame:
    """SNK8, SNK11: the lines of the exclusion log that was written."""
    path = stage_path(fx.spark, "exclusion-log")
    write_audit(CATALOG["exclusion_audit"].build(fx), path)
    return fx.spark.read.text(path).select(F.col("value").alias("line"))


@register(
    "code_capacity",
    with_fixtures(
        "select entity_type, count(*) as n_codes, cast(100000000 - count(*) as bigint) as n_free from ids group by entity_type",
        IDS_CTE,
    ),
)
def q_code_capacity(fx: Fixtures) -> DataFrame:
    """C5: codes of each entity type and what is left of its range; a type beyond its range is an error."""
    ids = _stored_ids(fx)
    check_code_capacity(ids)
    counts = ids.groupBy("entity_type").agg(F.count(F.lit(1)).alias("n_codes"))
    return counts.withColumn("n_free", F.lit(ID_RANGE_WIDTH) - F.col("n_codes"))

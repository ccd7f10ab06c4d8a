"""Named queries: a Spark builder and the equivalent DuckDB SQL for each.

A builder takes the lazy ``Fixtures`` of one table folder and returns a
DataFrame. The SQL runs in DuckDB on the driver's base tables (fixture views
are inlined as CTEs) and serves as the oracle. Column names match exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from playstats.functions import fill_unknown
from playstats.operators import clean, encode, inequality, recsys, rollups, stats
from playstats.plans.fixtures import Fixtures
from playstats.plans.oracle_fixtures import with_fixtures
from playstats.schemas import epoch_seconds
from playstats.session import stage_path
from playstats.sources.playfiles import parse_plays, reject_counts
from playstats.sources.sinks import append_segments

# Parameters of the registered queries on the test tables. Orders run from
# 1995-01-01 to 2001-08-01, so the reference's 2014 cut would remove nothing;
# the cut is moved inside the data's span (FIXTURES.md notes).
LATE_CUT = "1999-01-01"
AFTER_DAY = "1998-06-01"
EVAL_START = "1995-01-01"
EVAL_DATA_FROM = "1995-01-01"
EVAL_DATA_TO = "2001-12-31"
LOOKUP_ARTIST_KEY = 7  # the UUID looked up by ``id_lookup`` is artist 7's


@dataclass(frozen=True)
class Query:
    build: Callable[[Fixtures], DataFrame]
    sql: str | None
    doc: str


CATALOG: dict[str, Query] = {}


def register(name: str, sql: str | None, doc: str = ""):
    def deco(fn):
        CATALOG[name] = Query(fn, sql, doc or (fn.__doc__ or "").strip())
        return fn

    return deco


desc = F.desc
asc = F.asc

# ---------------------------------------------------------------------------
# Oracle SQL pieces shared by several statements
# ---------------------------------------------------------------------------
EXPLODED = "(select unnest(artist_ids) as artist_id, user_id from plays)"
FIRST = "(select artist_ids[1] as artist_id, user_id from plays)"
SOLO_EXPLODED = "(select unnest(artist_ids) as artist_id, user_id from plays where len(artist_ids) = 1)"
GENRES = """(select rec_id, genre_name from
   (select rec_id, unnest(json_extract_string(artist_credit, '$[*].artist.genres[*].name')) as genre_name
    from recording) where genre_name is not null)"""
LATE = epoch_seconds(LATE_CUT)
REASON_SQL = f"""case
  when (len(artist_ids) > 1) is true then 'group'
  when (timestamp >= {LATE}) is true then 'late'
  when (artist_ids[1] not in (select artist_id from artist where type = 'Person')) is true then 'nonperson'
  when (artist_ids[1] in (select artist_id from artist where gender is null)) is true then 'nullgender'
  when (artist_ids[1] in (select artist_id from artist where gender = 'Not applicable')) is true then 'na'
  else 'keep' end"""
# The reference's sequential deletes: a row stays unless a delete predicate is TRUE.
CLEAN_CTE = {
    "clean_plays": f"""
select distinct user_id, timestamp, artist_ids[1] as artist_id, release_id, rec_id, segment, artist_ids
from plays where ({REASON_SQL}) = 'keep'""",
}


def _attr_dist_sql(attr: str, source: str, where: str = "") -> str:
    return with_fixtures(
        f"""
select a.{attr} as {attr}, count(p.user_id) as n_plays, count(distinct p.user_id) as n_users,
       count(distinct p.artist_id) as unique_count
from {source} p left join artist a using (artist_id)
{where}
group by a.{attr}"""
    )


# ---------------------------------------------------------------------------
# Statistics suite (AGG6-20)
# ---------------------------------------------------------------------------
@register("gender_distribution", _attr_dist_sql("gender", EXPLODED))
def q_gender_distribution(fx: Fixtures) -> DataFrame:
    """AGG6: plays, users and artists per artist gender (all credited artists)."""
    return stats.gender_distribution(fx.plays, fx.artist).orderBy(desc("n_plays"), asc("gender"))


@register(
    "gender_distribution_active",
    _attr_dist_sql(
        "gender",
        EXPLODED,
        "where p.user_id in (select user_id from plays group by user_id having count(*) >= 5)",
    ),
)
def q_gender_distribution_active(fx: Fixtures) -> DataFrame:
    """AGG7, JN8, FLT8: AGG6 for users with at least 5 play rows."""
    return stats.gender_distribution_active(fx.plays, fx.artist, 5).orderBy(desc("n_plays"), asc("gender"))


@register(
    "release_popularity",
    with_fixtures(
        "select release_id, count(user_id) as n_plays, count(distinct user_id) as n_users "
        "from plays group by release_id"
    ),
)
def q_release_popularity(fx: Fixtures) -> DataFrame:
    """AGG8."""
    return stats.release_popularity(fx.plays).orderBy(desc("n_plays"), asc("release_id"))


@register("type_distribution", _attr_dist_sql("type", EXPLODED))
def q_type_distribution(fx: Fixtures) -> DataFrame:
    """AGG9."""
    return stats.type_distribution(fx.plays, fx.artist).orderBy(desc("n_plays"), asc("type"))


@register(
    "genre_distribution",
    with_fixtures(
        f"""
select g.genre_name, count(p.user_id) as n_plays, count(distinct p.user_id) as n_users
from (select rec_id, user_id from plays) p left join {GENRES} g using (rec_id)
group by g.genre_name"""
    ),
)
def q_genre_distribution(fx: Fixtures) -> DataFrame:
    """AGG10, JSN1, JN7."""
    return stats.genre_distribution(fx.plays, fx.recording).orderBy(desc("n_plays"), asc("genre_name"))


@register(
    "artist_popularity",
    with_fixtures(
        f"select artist_id, count(user_id) as n_plays, count(distinct user_id) as n_users "
        f"from {EXPLODED} p group by artist_id"
    ),
)
def q_artist_popularity(fx: Fixtures) -> DataFrame:
    """AGG11."""
    return stats.artist_popularity(fx.plays).orderBy(desc("n_plays"), asc("artist_id"))


@register(
    "plays_per_user",
    with_fixtures(
        "select user_id, count(rec_id) as play_count, count(distinct rec_id) as unique_play_count "
        "from plays group by user_id"
    ),
)
def q_plays_per_user(fx: Fixtures) -> DataFrame:
    """AGG12."""
    return stats.plays_per_user(fx.plays)


@register(
    "track_popularity",
    with_fixtures("select rec_id, count(user_id) as n_plays from plays group by rec_id"),
)
def q_track_popularity(fx: Fixtures) -> DataFrame:
    """AGG13."""
    return stats.track_popularity(fx.plays).orderBy(desc("n_plays"), asc("rec_id"))


@register(
    "distinct_counts",
    with_fixtures(
        """
select count(distinct rec_id) as n_tracks, count(distinct artist_id) as n_artists,
       count(distinct release_id) as n_releases, count(distinct user_id) as n_users
from (select rec_id, unnest(artist_ids) as artist_id, release_id, user_id from plays) t"""
    ),
)
def q_distinct_counts(fx: Fixtures) -> DataFrame:
    """AGG14."""
    return stats.distinct_counts(fx.plays)


@register("gender_distribution_first", _attr_dist_sql("gender", FIRST))
def q_gender_distribution_first(fx: Fixtures) -> DataFrame:
    """AGG15, PRJ2."""
    return stats.gender_distribution_first(fx.plays, fx.artist).orderBy(desc("n_plays"), asc("gender"))


def _artist_users_sql(source: str) -> str:
    return f"""
select p.artist_id, a.gender, count(distinct p.user_id) as unique_users
from {source} p left join artist a using (artist_id)
group by p.artist_id, a.gender"""


@register(
    "gender_mean_users",
    with_fixtures(
        f"select gender, avg(unique_users) as avg_unique_users from ({_artist_users_sql(EXPLODED)}) t "
        "group by gender"
    ),
)
def q_gender_mean_users(fx: Fixtures) -> DataFrame:
    """AGG16."""
    return stats.gender_mean_users(fx.plays, fx.artist).orderBy(desc("avg_unique_users"), asc("gender"))


@register("artist_users", with_fixtures(_artist_users_sql(EXPLODED)))
def q_artist_users(fx: Fixtures) -> DataFrame:
    """AGG17."""
    return stats.artist_users(fx.plays, fx.artist).orderBy(desc("unique_users"), asc("artist_id"))


@register(
    "gender_mean_users_solo",
    with_fixtures(
        f"select gender, avg(unique_users) as avg_unique_users from ({_artist_users_sql(SOLO_EXPLODED)}) t "
        "group by gender"
    ),
)
def q_gender_mean_users_solo(fx: Fixtures) -> DataFrame:
    """AGG18, FLT2."""
    return stats.gender_mean_users(fx.plays, fx.artist, solo_only=True).orderBy(
        desc("avg_unique_users"), asc("gender")
    )


@register("artist_users_solo", with_fixtures(_artist_users_sql(SOLO_EXPLODED)))
def q_artist_users_solo(fx: Fixtures) -> DataFrame:
    """AGG19."""
    return stats.artist_users(fx.plays, fx.artist, solo_only=True).orderBy(
        desc("unique_users"), asc("artist_id")
    )


@register(
    "monthly_plays",
    with_fixtures(
        """
select year(epoch_ms(timestamp * 1000)) as year, month(epoch_ms(timestamp * 1000)) as month,
       min(cast(epoch_ms(timestamp * 1000) as date)) as start_date, count(*) as row_count
from plays group by 1, 2"""
    ),
)
def q_monthly_plays(fx: Fixtures) -> DataFrame:
    """AGG20."""
    return stats.monthly_plays(fx.plays).orderBy("year", "month")


@register(
    "duplicate_rows",
    with_fixtures(
        "select user_id, rec_id, timestamp, count(*) as n_records from plays "
        "group by user_id, rec_id, timestamp having count(*) > 1"
    ),
)
def q_duplicate_rows(fx: Fixtures) -> DataFrame:
    """AGG21: the useful form of the reference's duplicate probe."""
    return stats.duplicate_rows(fx.plays).orderBy(desc("n_records"), "user_id", "rec_id", "timestamp")


@register(
    "rec_stats",
    with_fixtures(
        "select rec_id, count(*) as n_records, min(timestamp) as first_time, max(timestamp) as last_time "
        "from plays group by rec_id"
    ),
)
def q_rec_stats(fx: Fixtures) -> DataFrame:
    """AGG3."""
    return rollups.entity_stats(fx.plays, "rec_id")


@register(
    "user_stats",
    with_fixtures(
        "select user_id, count(*) as n_records, min(timestamp) as first_time, max(timestamp) as last_time "
        "from plays group by user_id"
    ),
)
def q_user_stats(fx: Fixtures) -> DataFrame:
    """AGG4."""
    return rollups.entity_stats(fx.plays, "user_id").orderBy(F.asc_nulls_last("first_time"), asc("user_id"))


@register(
    "release_stats",
    with_fixtures(
        "select release_id, count(*) as n_records, min(timestamp) as first_time, max(timestamp) as last_time "
        "from plays group by release_id"
    ),
)
def q_release_stats(fx: Fixtures) -> DataFrame:
    """AGG5."""
    return rollups.entity_stats(fx.plays, "release_id").orderBy(F.asc_nulls_last("first_time"), asc("release_id"))


@register("type_histogram", with_fixtures("select type, count(*) as count from artist group by type"))
def q_type_histogram(fx: Fixtures) -> DataFrame:
    """AGG23."""
    return stats.type_histogram(fx.artist).orderBy(desc("count"), asc("type"))


@register(
    "key_check",
    with_fixtures("select count(distinct artist_id) as distinct_count, count(*) as total_count from artist"),
)
def q_key_check(fx: Fixtures) -> DataFrame:
    """AGG24, C1."""
    return stats.key_check(fx.artist)


# ---------------------------------------------------------------------------
# Exclusion waterfall and row filters (PIPE1, AGG1, SET4, FLT2-6, AGG2, AGG25-26)
# ---------------------------------------------------------------------------
def _clean(fx: Fixtures) -> DataFrame:
    return clean.clean_plays(fx.plays, fx.artist, LATE_CUT)


def _audited(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    """Clean plays, stored, and the audit: one pass over plays makes both."""

    def build():
        coded = _stored_ids(fx).where("entity_type = 'artist_ids'")
        return clean.clean_with_audit(fx.plays, fx.artist, LATE_CUT, {"artists": fx.artist, "coded_artists": coded})

    return fx.shared("audited", build)


@register(
    "clean_plays",
    with_fixtures(
        "select user_id, timestamp, artist_id, release_id, rec_id from clean_plays", CLEAN_CTE
    ),
)
def q_clean_plays(fx: Fixtures) -> DataFrame:
    """PIPE1: distinct plays that pass every exclusion, artist as a scalar."""
    return _clean(fx)


@register(
    "exclusion_audit",
    with_fixtures(
        f"""
select 'initial' as step, cast(sum(copies) as bigint) as n_rows from r
union all select 'duplicates', cast(sum(copies) - count(*) as bigint) from r
union all select 'group', count(*) filter (where reason = 'group') from r
union all select 'late', count(*) filter (where reason = 'late') from r
union all select 'nonperson', count(*) filter (where reason = 'nonperson') from r
union all select 'nullgender', count(*) filter (where reason = 'nullgender') from r
union all select 'na', count(*) filter (where reason = 'na') from r
union all select 'final', count(*) filter (where reason = 'keep') from r
union all select 'artists', count(*) from artist
union all select 'coded_artists', count(distinct artist_id) from (select unnest(artist_ids) as artist_id from plays) u""",
        {
            "d": "select segment, user_id, timestamp, artist_ids, release_id, rec_id, count(*) as copies "
            "from plays group by all",
            "r": f"select copies, {REASON_SQL} as reason from d",
        },
    ),
)
def q_exclusion_audit(fx: Fixtures) -> DataFrame:
    """AGG1: row counts of every exclusion step (corrected duplicate count)."""
    return _audited(fx)[1]


@register(
    "audited_plays",
    with_fixtures("select segment, user_id, timestamp, artist_id, release_id, rec_id from clean_plays", CLEAN_CTE),
)
def q_audited_plays(fx: Fixtures) -> DataFrame:
    """PIPE1, MUT1: the clean plays that the audit's pass has written."""
    return _audited(fx)[0]


@register(
    "distinct_plays",
    with_fixtures("select distinct segment, user_id, timestamp, artist_ids, release_id, rec_id from plays"),
)
def q_distinct_plays(fx: Fixtures) -> DataFrame:
    """SET4: full-row DISTINCT with the list column, scoped by segment."""
    return clean.distinct_plays(fx.plays)


# ---------------------------------------------------------------------------
# Ingestion (SRC2-4, PRJ1, FN1-2, C2-3, SNK7)
# ---------------------------------------------------------------------------
_UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
_NAME = "/([a-f0-9]+)/([a-f0-9-]+)[.]txt[.]zst$"
PARSED_CTE = {
    "named": f"""
select case when regexp_matches(file_path, '{_NAME}') then regexp_extract(file_path, '{_NAME}', 1) end as segment,
       case when regexp_matches(file_path, '{_NAME}') then regexp_extract(file_path, '{_NAME}', 2) end as user_id,
       timestamp, string_split(lower(artist_ids), ',') as artist_ids, lower(release_id) as release_id, lower(rec_id) as rec_id
from raw_plays""",
    "parsed": f"""
select *, case when user_id is null then 'file_name'
               when not regexp_full_match(user_id, '{_UUID}') then 'user_id'
               when timestamp is null then 'timestamp'
               when len(list_filter(artist_ids, lambda x: not regexp_full_match(x, '{_UUID}'))) > 0 then 'artist_ids'
               when not regexp_full_match(release_id, '{_UUID}') then 'release_id'
               when not regexp_full_match(rec_id, '{_UUID}') then 'rec_id' end as reject
from named""",
}


@register(
    "parsed_plays",
    with_fixtures("select segment, user_id, timestamp, artist_ids, release_id, rec_id from parsed where reject is null", PARSED_CTE),
)
def q_parsed_plays(fx: Fixtures) -> DataFrame:
    """SRC2-3, PRJ1, FN1-2: raw rows that load, as plays."""
    return parse_plays(fx.raw_plays).where("reject is null").drop("reject", "file_path")


@register(
    "rejected_rows",
    with_fixtures("select reject, count(*) as n_rows from parsed where reject is not null group by reject", PARSED_CTE),
)
def q_rejected_rows(fx: Fixtures) -> DataFrame:
    """SRC4, C2-3: raw rows that do not load, by reason."""
    return reject_counts(parse_plays(fx.raw_plays))


@register("appended_solo_plays", with_fixtures("select * from plays where len(artist_ids) = 1"))
def q_appended_solo_plays(fx: Fixtures) -> DataFrame:
    """SNK7: single-artist plays of two files appended to the same segments,
    the first of them loaded twice, and read back."""
    path = stage_path(fx.spark, "appended-solo")
    solo, odd = clean.solo_plays(fx.plays), F.col("user_id") % 8 >= 4
    for load, part in (("a", odd), ("b", ~odd), ("a", odd)):
        append_segments(solo.where(part), path, load)
    # a partition folder's value is read back as an int
    return fx.spark.read.parquet(path).select(*[F.col(c).cast(solo.schema[c].dataType) for c in solo.columns])


@register(
    "artist_labels",
    with_fixtures("select artist_id, coalesce(gender, 'Unknown') as gender, coalesce(type, 'Unknown') as type from artist"),
)
def q_artist_labels(fx: Fixtures) -> DataFrame:
    """FN16: artists with the label for unknown values."""
    return fx.artist.select("artist_id", fill_unknown("gender").alias("gender"), fill_unknown("type").alias("type"))


@register("solo_plays", with_fixtures("select * from plays where len(artist_ids) = 1"))
def q_solo_plays(fx: Fixtures) -> DataFrame:
    """SNK7, FLT2: single-artist plays (what the incremental append keeps)."""
    return clean.solo_plays(fx.plays)


@register(
    "plays_after",
    with_fixtures(
        "select user_id, timestamp, artist_id, release_id, rec_id from clean_plays "
        f"where epoch_ms(timestamp * 1000) >= timestamp '{AFTER_DAY}'",
        CLEAN_CTE,
    ),
)
def q_plays_after(fx: Fixtures) -> DataFrame:
    """FLT4: clean plays at or after a day."""
    return clean.plays_after(_clean(fx), AFTER_DAY)


@register(
    "artists_without_gender",
    with_fixtures("select * from artist where gender is null or gender = 'Not applicable'"),
)
def q_artists_without_gender(fx: Fixtures) -> DataFrame:
    """FLT6."""
    return clean.artists_without_gender(fx.artist)


@register(
    "user_artist_rollup",
    with_fixtures(
        "select user_id, artist_id, count(*) as count, min(timestamp) as first_time, "
        "max(timestamp) as last_time from clean_plays group by user_id, artist_id",
        CLEAN_CTE,
    ),
)
def q_user_artist_rollup(fx: Fixtures) -> DataFrame:
    """AGG2: the solo-artist rollup of clean plays."""
    return rollups.user_artist_rollup(_clean(fx))


@register(
    "clean_gender_distribution",
    with_fixtures(
        """
select a.gender as gender, count(p.user_id) as n_plays, count(distinct p.user_id) as n_users,
       count(distinct p.artist_id) as unique_count
from clean_plays p left join artist a using (artist_id) group by a.gender""",
        CLEAN_CTE,
    ),
)
def q_clean_gender_distribution(fx: Fixtures) -> DataFrame:
    """AGG25."""
    return stats.clean_gender_distribution(_clean(fx), fx.artist).orderBy(desc("n_plays"), asc("gender"))


@register(
    "clean_distinct_counts",
    with_fixtures(
        "select count(distinct rec_id) as n_tracks, count(distinct artist_id) as n_artists, "
        "count(distinct release_id) as n_releases, count(distinct user_id) as n_users from clean_plays",
        CLEAN_CTE,
    ),
)
def q_clean_distinct_counts(fx: Fixtures) -> DataFrame:
    """AGG26."""
    return stats.clean_distinct_counts(_clean(fx))


# ---------------------------------------------------------------------------
# Overview numbers (AGG27-29)
# ---------------------------------------------------------------------------
PPU_CTE = {
    "ppu": "select user_id, count(rec_id) as play_count, count(distinct rec_id) as unique_play_count "
    "from plays group by user_id"
}


@register(
    "density",
    with_fixtures(
        "select cast(sum(unique_play_count) as double) / cast(sum(play_count) as double) as density from ppu",
        PPU_CTE,
    ),
)
def q_density(fx: Fixtures) -> DataFrame:
    """AGG27."""
    return stats.density(stats.plays_per_user(fx.plays))


@register(
    "overview",
    with_fixtures(
        """
select 'Tracks (rec_id)' as metric, format('{:,}', n_tracks) as value from dc
union all select 'Artists', format('{:,}', n_artists) from dc
union all select 'Releases', format('{:,}', n_releases) from dc
union all select 'Users', format('{:,}', n_users) from dc
union all select 'Density', format('{:,.6f}', round(cast(sum(unique_play_count) as double)
                                   / cast(sum(play_count) as double), 6)) from ppu
union all select 'Start Date', strftime(min(start_date), '%Y-%m-%d') from mp
union all select 'End Date', strftime(max(start_date), '%Y-%m-%d') from mp""",
        {
            **PPU_CTE,
            "dc": "select count(distinct rec_id) as n_tracks, count(distinct artist_id) as n_artists, "
            "count(distinct release_id) as n_releases, count(distinct user_id) as n_users "
            "from (select rec_id, unnest(artist_ids) as artist_id, release_id, user_id from plays) t",
            "mp": "select year(epoch_ms(timestamp * 1000)) as year, month(epoch_ms(timestamp * 1000)) as month, "
            "min(cast(epoch_ms(timestamp * 1000) as date)) as start_date from plays group by 1, 2",
        },
    ),
)
def q_overview(fx: Fixtures) -> DataFrame:
    """AGG28: the headline table (counts, density, first and last month)."""
    dens = stats.density(stats.plays_per_user(fx.plays)).select(F.round("density", 6).alias("density"))
    return stats.overview(stats.distinct_counts(fx.plays), dens, stats.monthly_plays(fx.plays))


def _profile_sql(col: str, src: str = "ppu") -> str:
    return (
        f"select '{col}' as variable, round_even(cast(count({col}) as double), 2) as count, "
        f"round_even(avg({col}), 2) as mean, round_even(stddev_samp({col}), 2) as std, "
        f"round_even(cast(min({col}) as double), 2) as min, "
        f"round_even(quantile_cont({col}, 0.25), 2) as p25, round_even(quantile_cont({col}, 0.5), 2) as p50, "
        f"round_even(quantile_cont({col}, 0.75), 2) as p75, round_even(cast(max({col}) as double), 2) as max "
        f"from {src}"
    )


@register(
    "play_count_profile",
    with_fixtures(_profile_sql("play_count") + "\nunion all\n" + _profile_sql("unique_play_count"), PPU_CTE),
)
def q_play_count_profile(fx: Fixtures) -> DataFrame:
    """AGG29: describe().round(2) of plays per user."""
    return stats.numeric_profile(stats.plays_per_user(fx.plays), ["play_count", "unique_play_count"])


# ---------------------------------------------------------------------------
# Inequality, ranks, Lorenz, histograms (AGG30-31, WIN2-4) and top-k (TOP1-2)
# ---------------------------------------------------------------------------
RP_CTE = {
    "rp": "select release_id, count(user_id) as n_plays, count(distinct user_id) as n_users "
    "from plays group by release_id"
}
AUS_CTE = {"aus": _artist_users_sql(SOLO_EXPLODED)}


def _gini_sql(src: str, value: str, group: str | None = None) -> str:
    part = f"partition by {group} " if group else ""
    g_sel = f"{group}, " if group else ""
    return f"""
select {g_sel}n as n_items,
       cast(sum((2 * i - n - 1) * x) as double) / (cast(n as double) * cast(s as double)) as gini
from (select {g_sel}{value} as x, row_number() over ({part}order by {value}) as i,
             count(*) over ({part.strip()}) as n, sum({value}) over ({part.strip()}) as s
      from {src} where {value} is not null) t
group by {g_sel}n, s"""


@register("gini_release_users", with_fixtures(_gini_sql("rp", "n_users"), RP_CTE))
def q_gini_release_users(fx: Fixtures) -> DataFrame:
    """AGG30: Gini of distinct users per release."""
    return inequality.gini(stats.release_popularity(fx.plays), "n_users")


@register("gini_release_plays", with_fixtures(_gini_sql("rp", "n_plays"), RP_CTE))
def q_gini_release_plays(fx: Fixtures) -> DataFrame:
    """AGG30: Gini of plays per release."""
    return inequality.gini(stats.release_popularity(fx.plays), "n_plays")


@register("gini_by_gender", with_fixtures(_gini_sql("aus", "unique_users", "gender"), AUS_CTE))
def q_gini_by_gender(fx: Fixtures) -> DataFrame:
    """AGG30 by group: Gini of distinct users per solo artist, per gender."""
    return inequality.gini(stats.artist_users(fx.plays, fx.artist, solo_only=True), "unique_users", ["gender"])


@register(
    "track_count_profile",
    with_fixtures(_profile_sql("n_plays", "tp"), {"tp": "select rec_id, count(user_id) as n_plays from plays group by rec_id"}),
)
def q_track_count_profile(fx: Fixtures) -> DataFrame:
    """AGG29: describe().round(2) of plays per track."""
    return stats.numeric_profile(stats.track_popularity(fx.plays), ["n_plays"])


@register(
    "gini_order_price",
    """
select o_orderpriority as priority, n as n_items, round(sum((2 * i - n - 1) * x) / (n * s), 9) as gini
from (select o_orderpriority, o_totalprice as x, row_number() over (partition by o_orderpriority order by o_totalprice) as i,
             count(*) over (partition by o_orderpriority) as n, sum(o_totalprice) over (partition by o_orderpriority) as s
      from orders where o_totalprice is not null) t
group by o_orderpriority, n, s""",
)
def q_gini_order_price(fx: Fixtures) -> DataFrame:
    """AGG30 on a double column: Gini of order prices, per priority."""
    prices = fx.table("orders").select(F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price"))
    return inequality.gini(prices, "price", ["priority"]).withColumn("gini", F.round("gini", 9))


@register("order_price_rank", "select o_orderkey, cume_dist() over (order by o_totalprice desc) as rank from orders")
def q_order_price_rank(fx: Fixtures) -> DataFrame:
    """WIN2 on a double column: share of orders at or above each order's price."""
    orders = fx.table("orders").select("o_orderkey", "o_totalprice")
    return inequality.fractional_rank(orders, "o_totalprice", "rank").select("o_orderkey", "rank")


@register(
    "log_play_histogram",
    with_fixtures(
        """
select bin, round(lo + bin * w, 9) as bin_start, round(lo + (bin + 1) * w, 9) as bin_end,
       coalesce(users, 0) as users
from (select cast(unnest(range(100)) as integer) as bin) every left join (select cast(case when w > 0 then least(floor((x - lo) / w), 99) else 0 end as integer) as bin,
             count(*) as users
      from l, b group by 1) t using (bin), b""",
        {
            **PPU_CTE,
            "l": "select ln(cast(play_count as double)) as x from ppu where play_count > 0",
            "b": "select min(x) as lo, (max(x) - min(x)) / cast(100 as double) as w from l",
        },
    ),
)
def q_log_play_histogram(fx: Fixtures) -> DataFrame:
    """AGG31: 100-bin histogram of log plays per user."""
    return inequality.log_histogram(stats.plays_per_user(fx.plays), "play_count", 100)


def _rank_sql(src: str, cols: str, ranks: dict[str, str], where: str = "") -> str:
    r = ", ".join(f"cume_dist() over (order by {v} desc) as {name}" for name, v in ranks.items())
    return f"select {cols}, {r} from {src} {where}"


def _ranked(df: DataFrame, ranks: dict[str, str]) -> DataFrame:
    return inequality.fractional_ranks(df, ranks, descending=True)


@register(
    "artist_rank",
    with_fixtures(
        _rank_sql("ap", "artist_id, n_plays, n_users", {"rank_inplay": "n_plays", "rank_inuser": "n_users"}),
        {"ap": f"select artist_id, count(user_id) as n_plays, count(distinct user_id) as n_users "
               f"from {EXPLODED} p group by artist_id"},
    ),
)
def q_artist_rank(fx: Fixtures) -> DataFrame:
    """WIN2: fractional popularity ranks of artists (descending, ties max)."""
    return _ranked(stats.artist_popularity(fx.plays), {"rank_inplay": "n_plays", "rank_inuser": "n_users"})


@register(
    "release_rank",
    with_fixtures(
        _rank_sql("rp", "release_id, n_plays, n_users", {"rank_inuser": "n_users", "rank_inplay": "n_plays"}),
        RP_CTE,
    ),
)
def q_release_rank(fx: Fixtures) -> DataFrame:
    """WIN2 for releases."""
    return _ranked(stats.release_popularity(fx.plays), {"rank_inuser": "n_users", "rank_inplay": "n_plays"})


GD_CTE = {
    "gd": f"""select g.genre_name, count(p.user_id) as n_plays, count(distinct p.user_id) as n_users
from (select rec_id, user_id from plays) p left join {GENRES} g using (rec_id) group by g.genre_name"""
}


@register(
    "genre_rank",
    with_fixtures(
        _rank_sql("gd", "genre_name, n_plays, n_users", {"rank_inuser": "n_users", "rank_inplay": "n_plays"},
                  "where genre_name is not null"),
        GD_CTE,
    ),
)
def q_genre_rank(fx: Fixtures) -> DataFrame:
    """WIN2 for genres, the unknown-genre group dropped (FLT12)."""
    gd = stats.genre_distribution(fx.plays, fx.recording).dropna(subset=["genre_name"])
    return _ranked(gd, {"rank_inuser": "n_users", "rank_inplay": "n_plays"})


@register(
    "track_rank",
    with_fixtures(
        _rank_sql("tp", "rec_id, n_plays", {"rank": "n_plays"}),
        {"tp": "select rec_id, count(user_id) as n_plays from plays group by rec_id"},
    ),
)
def q_track_rank(fx: Fixtures) -> DataFrame:
    """WIN2 for tracks."""
    return _ranked(stats.track_popularity(fx.plays), {"rank": "n_plays"})


@register(
    "gender_rank",
    with_fixtures(
        "select artist_id, gender, unique_users, "
        "cume_dist() over (partition by gender order by unique_users) as rank_artist from aus",
        AUS_CTE,
    ),
)
def q_gender_rank(fx: Fixtures) -> DataFrame:
    """WIN3: ascending fractional rank of solo artists within their gender."""
    return inequality.fractional_rank(
        stats.artist_users(fx.plays, fx.artist, solo_only=True), "unique_users", "rank_artist",
        descending=False, groups=["gender"],
    )


@register(
    "lorenz_by_gender",
    with_fixtures(
        """
select gender, unique_users, count(*) as n_items, max(r) as rank, max(cf) as cum_fraction
from (select gender, unique_users,
             cume_dist() over (partition by gender order by unique_users) as r,
             cast(sum(unique_users) over (partition by gender order by unique_users
                  range between unbounded preceding and current row) as double)
               / cast(sum(unique_users) over (partition by gender) as double) as cf
      from aus) t
group by gender, unique_users""",
        AUS_CTE,
    ),
)
def q_lorenz_by_gender(fx: Fixtures) -> DataFrame:
    """WIN4: Lorenz curve points of distinct users per solo artist, by gender."""
    return inequality.lorenz_points(
        stats.artist_users(fx.plays, fx.artist, solo_only=True), "unique_users", ["gender"]
    )


@register(
    "latest_plays",
    with_fixtures(
        "select * from plays order by timestamp desc, user_id, rec_id, release_id, segment, "
        "artist_ids asc nulls first limit 20"
    ),
)
def q_latest_plays(fx: Fixtures) -> DataFrame:
    """TOP1: the 20 latest plays."""
    return fx.plays.orderBy(
        desc("timestamp"), "user_id", "rec_id", "release_id", "segment", F.asc_nulls_first("artist_ids")
    ).limit(20)


@register(
    "top_genres_users",
    with_fixtures(
        "select genre_name, n_users from gd where genre_name is not null "
        "order by n_users desc, genre_name limit 5",
        GD_CTE,
    ),
)
def q_top_genres_users(fx: Fixtures) -> DataFrame:
    """TOP2: five genres with the most users."""
    gd = stats.genre_distribution(fx.plays, fx.recording).dropna(subset=["genre_name"])
    return gd.orderBy(desc("n_users"), "genre_name").limit(5).select("genre_name", "n_users")


@register(
    "top_genres_plays",
    with_fixtures(
        "select genre_name, n_plays from gd where genre_name is not null "
        "order by n_plays desc, genre_name limit 5",
        GD_CTE,
    ),
)
def q_top_genres_plays(fx: Fixtures) -> DataFrame:
    """TOP2: five most played genres."""
    gd = stats.genre_distribution(fx.plays, fx.recording).dropna(subset=["genre_name"])
    return gd.orderBy(desc("n_plays"), "genre_name").limit(5).select("genre_name", "n_plays")


@register(
    "props_extract",
    with_fixtures(
        "select event_id, event_type, try_cast(json_extract_string(props, '$.k') as bigint) as k from events"
    ),
)
def q_props_extract(fx: Fixtures) -> DataFrame:
    """JSN1 on a scalar path: ``$.k`` of each event's JSON properties."""
    from playstats.functions import json_scalar

    ev = fx.table("events")
    return ev.select("event_id", "event_type", json_scalar("props", "$.k").try_cast("bigint").alias("k"))


# ---------------------------------------------------------------------------
# Id dictionary and play encoding (SET1-3, WIN1, JN1-5, FLT5)
# ---------------------------------------------------------------------------
IDS_CTE = {
    "ents": """
select distinct entity_type, entity_uuid from (
  select 'user_id' as entity_type, lower(trim(user_id)) as entity_uuid from plays_uuid
  union all select 'release_id', lower(trim(release_id)) from plays_uuid
  union all select 'rec_id', lower(trim(rec_id)) from plays_uuid
  union all select 'artist_ids', lower(trim(a)) from (select unnest(artist_ids) as a from plays_uuid) x
) t where entity_uuid is not null and entity_uuid <> ''""",
    "ids": """
select entity_type, entity_uuid,
  cast(case entity_type when 'user_id' then 100000000 when 'artist_ids' then 200000000
                        when 'release_id' then 300000000 else 400000000 end
       + row_number() over (partition by entity_type order by entity_uuid) - 1 as integer) as id_num
from ents""",
}


def _ids(fx: Fixtures) -> DataFrame:
    return encode.build_id_dictionary(fx.plays_uuid)


def _stored_ids(fx: Fixtures) -> DataFrame:
    """The dictionary as a stored table (the reference writes it to Parquet
    before encoding); encoding reads it once per key type."""
    from playstats.session import cut_lineage

    return fx.shared("ids", lambda: cut_lineage(_ids(fx), "ids"))


@register("entity_ids", with_fixtures("select * from ids", IDS_CTE))
def q_entity_ids(fx: Fixtures) -> DataFrame:
    """SET1-3, WIN1: the id dictionary with dense codes in UUID order."""
    return _ids(fx)


@register(
    "encoded_plays",
    with_fixtures(
        """
select p.segment, u.id_num as user_id, p.timestamp, coalesce(enc.coded, []::integer[]) as artist_ids,
       r.id_num as release_id, c.id_num as rec_id
from plays_uuid p
left join ids u on u.entity_type = 'user_id' and u.entity_uuid = lower(trim(p.user_id))
left join ids r on r.entity_type = 'release_id' and r.entity_uuid = lower(trim(p.release_id))
left join ids c on c.entity_type = 'rec_id' and c.entity_uuid = lower(trim(p.rec_id))
left join enc on enc.artist_ids = p.artist_ids""",
        {
            **IDS_CTE,
            "lists": "select distinct artist_ids from plays_uuid where artist_ids is not null",
            "elems": "select artist_ids, unnest(artist_ids) as uuid, "
            "unnest(generate_series(1, len(artist_ids))) as pos from lists",
            "enc": "select e.artist_ids, list(m.id_num order by e.pos) as coded from elems e "
            "left join ids m on m.entity_type = 'artist_ids' and m.entity_uuid = lower(trim(e.uuid)) "
            "group by e.artist_ids",
        },
    ),
)
def q_encoded_plays(fx: Fixtures) -> DataFrame:
    """JN1-4: plays with integer codes; list order and misses kept."""
    return encode.encode_plays(fx.plays_uuid, _stored_ids(fx))


@register(
    "coded_artists",
    with_fixtures(
        "select i.id_num as artist_id, a.gender, a.type from ids i "
        "left join artist_uuid a on i.entity_uuid = lower(a.artist_id) where i.entity_type = 'artist_ids'",
        IDS_CTE,
    ),
)
def q_coded_artists(fx: Fixtures) -> DataFrame:
    """JN5: every coded artist with its gender and type (NULL if unknown)."""
    return encode.coded_artists(_stored_ids(fx), fx.artist_uuid)


def _lookup_uuid() -> str:
    import hashlib

    h = hashlib.md5(f"a{LOOKUP_ARTIST_KEY}".encode()).hexdigest()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


@register("id_lookup", with_fixtures(f"select * from ids where entity_uuid = '{_lookup_uuid()}'", IDS_CTE))
def q_id_lookup(fx: Fixtures) -> DataFrame:
    """FLT5: dictionary entry of one UUID."""
    return encode.id_lookup(_stored_ids(fx), _lookup_uuid())


# ---------------------------------------------------------------------------
# Recommender evaluation (REC1-7, FLT9-11, JN12-13, AGG32-33)
# ---------------------------------------------------------------------------
EVAL_N = 100
_EVAL_LO = epoch_seconds(EVAL_DATA_FROM)
_EVAL_HI = epoch_seconds(EVAL_DATA_TO) + 86400
EVAL_CTES = {
    "a1": f"""select "user" as user_id, item as item_id, epoch_ms(first_time * 1000) as ts from actions
where first_time >= {_EVAL_LO} and first_time < {_EVAL_HI}""",
    "a2": "select * from a1 where user_id in (select user_id from a1 group by user_id having count(*) >= 5)",
    "mx": "select max(ts) as max_ts from a2",
    "win": f"""select window_start, window_end from (
  select timestamp '{EVAL_START}' + to_months(cast(2 * k as integer)) as window_start,
         timestamp '{EVAL_START}' + to_months(cast(2 * k + 24 as integer)) as window_end, max_ts
  from (select unnest(generate_series(0, cast(floor(datediff('month', timestamp '{EVAL_START}', max_ts) / 2)
                                             as bigint))) as k, max_ts from mx) g) w
where window_end <= max_ts""",
    "wd": """select w.window_start, w.window_end, a.user_id, a.item_id, a.ts
from win w join a2 a on a.ts >= w.window_start and a.ts <= w.window_end - interval 1 day""",
    "ws": """select window_start, max(ts) - interval 2 month as test_start from wd
group by window_start having count(*) >= 10""",
    "train0": "select wd.* from wd join ws using (window_start) where wd.ts <= ws.test_start - interval 1 day",
    "test0": """select wd.* from wd join ws using (window_start) where wd.ts >= ws.test_start
and exists (select 1 from train0 r where r.window_start = wd.window_start and r.user_id = wd.user_id)""",
    "ts_": "select window_start, count(*) as test_size from test0 group by window_start having count(*) >= 2",
    "train": "select * from train0 where window_start in (select window_start from ts_)",
    "test": "select * from test0 where window_start in (select window_start from ts_)",
    "sizes": """select t.window_start, min(t.window_end) as window_end, count(*) as train_size,
  min(s.test_size) as test_size from train t join ts_ s using (window_start) group by t.window_start""",
    "pop": """select window_start, item_id, row_number() over (partition by window_start
  order by count(*) desc, item_id) as pop_rank from train group by window_start, item_id""",
    "cand": """select u.window_start, u.user_id, p.item_id, p.pop_rank
from (select distinct window_start, user_id from test) u join pop p using (window_start)
where not exists (select 1 from train r where r.window_start = u.window_start
                  and r.user_id = u.user_id and r.item_id = p.item_id)""",
    "recs": f"""select window_start, user_id, item_id,
  row_number() over (partition by window_start, user_id order by pop_rank) as rank
from cand qualify rank <= {EVAL_N}""",
    "hits": """select r.window_start, r.user_id, r.rank from recs r join test t
  on t.window_start = r.window_start and t.user_id = r.user_id and t.item_id = r.item_id""",
    "hagg": """select window_start, user_id,
  sum(cast(1 as double) / greatest(cast(1 as double), log2(rank))) as dcg,
  sum(pow(cast(0.85 as double), rank - 1)) as rbp_sum, max(cast(1 as double) / rank) as rr
from hits group by window_start, user_id""",
    "ideal": """select window_start, user_id, sum(cast(1 as double) / greatest(cast(1 as double), log2(g))) as idcg
from (select window_start, user_id, unnest(generate_series(1, n_test)) as g
      from (select window_start, user_id, count(*) as n_test from test group by all) c) x
group by window_start, user_id""",
    "pu": """select i.window_start, coalesce(h.dcg, 0) / i.idcg as ndcg,
  (cast(1 as double) - cast(0.85 as double)) * coalesce(h.rbp_sum, 0) as rbp, coalesce(h.rr, 0) as reciprank
from ideal i left join hagg h using (window_start, user_id)""",
}


def _evaluation(fx: Fixtures) -> dict[str, DataFrame]:
    """The evaluation's stages, stored once and read by all its queries."""
    return fx.shared("evaluation", lambda: recsys.evaluate(fx.actions, EVAL_START, EVAL_DATA_FROM, EVAL_DATA_TO, n=EVAL_N))


def _day(c: str):
    return F.col(c).cast("date").alias(c)


@register(
    "eval_windows",
    with_fixtures("select cast(window_start as date) as window_start, cast(window_end as date) as window_end "
                  "from win", EVAL_CTES),
)
def q_eval_windows(fx: Fixtures) -> DataFrame:
    """REC1: 24-month windows every 2 months, ending before the last action."""
    prepared = recsys.prepare_actions(fx.actions, EVAL_DATA_FROM, EVAL_DATA_TO)
    return recsys.eval_windows(prepared, EVAL_START).select(_day("window_start"), _day("window_end"))


@register(
    "window_split_sizes",
    with_fixtures("select cast(window_start as date) as window_start, cast(window_end as date) as window_end, "
                  "train_size, test_size from sizes", EVAL_CTES),
)
def q_window_split_sizes(fx: Fixtures) -> DataFrame:
    """REC2, FLT9-11, JN12-13, AGG32: train and test rows of every kept window."""
    sizes = _evaluation(fx)["sizes"]
    return sizes.select(_day("window_start"), _day("window_end"), "train_size", "test_size").orderBy("window_start")


@register(
    "top_n",
    with_fixtures("select cast(window_start as date) as window_start, user_id, item_id, rank from recs",
                  EVAL_CTES),
)
def q_top_n(fx: Fixtures) -> DataFrame:
    """REC3: top-100 unseen popular items for each test user of each window."""
    ev = _evaluation(fx)
    starts = ev["windows"].select("k", _day("window_start"))
    return ev["recs"].join(F.broadcast(starts), "k").select("window_start", "user_id", "item_id", "rank")


@register(
    "eval_metrics",
    with_fixtures(
        """
select cast(s.window_start as date) as window_start, cast(s.window_end as date) as window_end,
       round(avg(pu.ndcg), 9) as ndcg, round(avg(pu.rbp), 9) as rbp, round(avg(pu.reciprank), 9) as reciprank,
       s.train_size, s.test_size
from pu join sizes s using (window_start)
group by s.window_start, s.window_end, s.train_size, s.test_size""",
        EVAL_CTES,
    ),
)
def q_eval_metrics(fx: Fixtures) -> DataFrame:
    """REC4-7, AGG33: mean NDCG, RBP and reciprocal rank per window, with sizes."""
    m = _evaluation(fx)["metrics"]
    return m.select(
        _day("window_start"), _day("window_end"),
        F.round("ndcg", 9).alias("ndcg"), F.round("rbp", 9).alias("rbp"), F.round("reciprank", 9).alias("reciprank"),
        "train_size", "test_size",
    ).orderBy("window_start")


# queries over files that are written first; they register themselves
from playstats.plans import file_queries  # noqa: E402, F401

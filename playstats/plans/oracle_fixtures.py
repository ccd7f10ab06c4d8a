"""The fixture views of ``fixtures.py`` as DuckDB CTE text.

The oracle runs each query in DuckDB on the driver's base tables only, so
every oracle statement starts with these CTEs. The text follows FIXTURES.md
§2; only the engine-specific parts differ from the Spark side.
Times are built with ``epoch``/``epoch_ms`` so no DuckDB session time zone is
involved.
"""

from __future__ import annotations

from playstats.plans.fixtures import UNKNOWN_ARTIST, uuid_sql

FIXTURE_CTES = {
    "artist": """
select cast(s_suppkey as bigint) as artist_id, s_name as name,
  case s_suppkey % 5 when 0 then 'Male' when 1 then 'Female' when 2 then 'Non-binary'
       when 3 then 'Not applicable' end as gender,
  case when s_suppkey % 7 < 5 then 'Person' when s_suppkey % 7 = 5 then 'Group' end as type
from supplier""",
    "recording": """
select p_partkey as rec_id, p_name as title,
  case when p_partkey % 11 = 0 then null
       when p_partkey % 13 = 0 then '[]'
       when p_partkey % 17 = 0 then '[{"artist":{"genres":null}}]'
       else concat('[{"artist":{"genres":[{"name":"', split_part(p_name, ' ', 1), '"},{"name":"',
                   lower(p_type), '"}]}},{"artist":{"genres":[{"name":"', lower(p_type), '"}]}}]')
  end as artist_credit
from part""",
    "plays_base": """
select o_custkey % 4 as segment, o_custkey as user_id,
       cast(epoch(o_orderdate) as bigint) + 60 * l_linenumber as timestamp,
       case when l_linenumber % 2 = 0
            then [l_suppkey::bigint, ((7 * l_suppkey + l_linenumber) % 10 + 1)::bigint]
            else [l_suppkey::bigint] end as artist_ids,
       cast(p_size as bigint) as release_id, l_partkey as rec_id, o_orderkey, l_linenumber
from lineitem join orders on o_orderkey = l_orderkey join part on p_partkey = l_partkey""",
    "plays": f"""
select segment, user_id, timestamp, artist_ids, release_id, rec_id from plays_base
union all
select segment, user_id, timestamp, artist_ids, release_id, rec_id from plays_base
where o_orderkey % 50 = 0
union all
select segment, user_id, timestamp, []::bigint[], release_id, rec_id from plays_base
where l_linenumber = 1 and o_orderkey % 23 = 0
union all
select segment, user_id, timestamp, [{UNKNOWN_ARTIST} + user_id % 50]::bigint[], release_id, rec_id from plays_base
where l_linenumber = 1 and o_orderkey % 29 = 0
union all
select segment, user_id, timestamp, null::bigint[], release_id, rec_id from plays_base
where l_linenumber = 1 and o_orderkey % 31 = 0""",
    "actions": """
select user_id as "user", artist_id as item, min(timestamp) as first_time
from (select user_id, timestamp, unnest(artist_ids) as artist_id from plays) t
group by 1, 2""",
    "plays_uuid": f"""
select segment, {uuid_sql('u', 'user_id')} as user_id, timestamp,
       list_transform(artist_ids, lambda x: {uuid_sql('a', 'x')}) as artist_ids,
       {uuid_sql('r', 'release_id')} as release_id,
       {uuid_sql('c', 'rec_id')} as rec_id
from plays""",
    "raw_plays": """
with t as (select concat('/data/0', segment, '/', user_id, '.txt.zst') as file_path, timestamp,
                  case when len(artist_ids) = 0 then '' else array_to_string(artist_ids, ',') end as artist_ids,
                  release_id, rec_id from plays_uuid)
select * from t
union all select file_path, timestamp, artist_ids, upper(release_id), upper(rec_id) from t where timestamp % 101 = 0
union all select file_path, timestamp, artist_ids || ',x', release_id, rec_id from t where timestamp % 103 = 0
union all select file_path, timestamp, artist_ids, 'bad', rec_id from t where timestamp % 107 = 0
union all select file_path, null, artist_ids, release_id, rec_id from t where timestamp % 109 = 0
union all select replace(file_path, '/data/', '/data/xyz'), timestamp, artist_ids, release_id, rec_id
          from t where timestamp % 113 = 0""",
    "artist_uuid": f"""
select {uuid_sql('a', 'artist_id')} as artist_id, name, gender, type from artist""",
}


def with_fixtures(body: str, ctes: dict[str, str] | None = None) -> str:
    """``WITH <fixture views>, <query CTEs> <body>``."""
    parts = [f"{name} as ({sql}\n)" for name, sql in FIXTURE_CTES.items()]
    for name, sql in (ctes or {}).items():
        parts.append(f"{name} as ({sql}\n)")
    return "with " + ",\n".join(parts) + "\n" + body

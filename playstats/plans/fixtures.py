"""Play-history views derived from the driver's test tables.

The test tables are TPC-H shaped; these views give them the shape of the
reference's inputs (FIXTURES.md §2): a line of an order is a play, its
supplier the first artist, its part the recording; even lines have a second
artist. Modulo rules below do not subset data; they add rows with the edge
cases that the reference's rules must handle (unknown artists, empty and NULL
lists, duplicate rows).

Every view is lazy and derived from whole tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from playstats.session import apply_runtime_conf, cut_lineage, follow_table_sizes

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


#: ``plays_uuid`` is derived from the stored plays by whoever reads it: as text it is several times the tables.
MATERIALIZED_VIEWS = ("artist", "recording", "plays", "actions", "artist_uuid", "raw_plays")
#: The test tables are single files that one task reads; a stored view is several that many tasks read.
VIEW_ROWS_PER_FILE = 40_000
#: Tables that the views are derived from.
VIEW_TABLES = ("supplier", "part", "orders", "lineitem")
#: Planted artists have keys from here on; no supplier has.
UNKNOWN_ARTIST = 1_000_000_000
_STORED: dict[tuple[str, str], "Fixtures"] = {}


class Fixtures:
    """Fixture views for one table folder, lazy by default.

    ``Fixtures.on_demand`` derives a view when it is first asked for, once per
    session and folder, and writes it under the checkpoint folder, the way the
    real plays are a stored Parquet dataset; queries then scan it like any
    table, and none waits for views that it does not read. ``Fixtures.stored``
    is the same with all views derived.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = apply_runtime_conf(spark)
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}
        self._to_store: tuple[str, ...] = ()

    @classmethod
    def on_demand(cls, spark: SparkSession, sf_dir: str) -> "Fixtures":
        key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
        follow_table_sizes(spark, [os.path.join(sf_dir, f"{t}.parquet") for t in VIEW_TABLES])
        if key not in _STORED:
            _STORED[key] = cls(spark, sf_dir)
            _STORED[key]._to_store = MATERIALIZED_VIEWS
        return _STORED[key]

    @classmethod
    def stored(cls, spark: SparkSession, sf_dir: str) -> "Fixtures":
        fx = cls.on_demand(spark, sf_dir)
        for name in MATERIALIZED_VIEWS:
            getattr(fx, name)
        return fx

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    def _memo(self, name, build):
        if name not in self._cache:
            view = build()  # from the views below it, which are stored then
            if name in self._to_store:
                view = cut_lineage(view, f"fixture-{name}", VIEW_ROWS_PER_FILE)
            self._cache[name] = view
        return self._cache[name]

    def shared(self, name: str, build):
        """What several queries derive from the same views, made once for these views: stored tables, files, reports."""
        return self._memo(f"shared {name}", build)

    # -- metadata -----------------------------------------------------------
    @property
    def artist(self) -> DataFrame:
        """Artist dimension: every supplier. Planted plays refer to artists
        beyond it."""
        return self._memo(
            "artist",
            lambda: self.spark.sql(
                """
                select cast(s_suppkey as bigint) as artist_id, s_name as name,
                  case s_suppkey % 5 when 0 then 'Male' when 1 then 'Female'
                       when 2 then 'Non-binary' when 3 then 'Not applicable' end as gender,
                  case when s_suppkey % 7 < 5 then 'Person'
                       when s_suppkey % 7 = 5 then 'Group' end as type
                from {supplier}
                """,
                supplier=self.table("supplier"),
            ),
        )

    @property
    def recording(self) -> DataFrame:
        """Recording dimension with a raw JSON artist credit (NULL, [],
        genres null and a repeated genre all occur). Braces are doubled
        because ``spark.sql`` formats the text with its DataFrame arguments."""
        return self._memo(
            "recording",
            lambda: self.spark.sql(
                """
                select p_partkey as rec_id, p_name as title,
                  case when p_partkey % 11 = 0 then null
                       when p_partkey % 13 = 0 then '[]'
                       when p_partkey % 17 = 0 then '[{{"artist":{{"genres":null}}}}]'
                       else concat('[{{"artist":{{"genres":[{{"name":"', split_part(p_name, ' ', 1),
                                   '"}},{{"name":"', lower(p_type),
                                   '"}}]}}}},{{"artist":{{"genres":[{{"name":"', lower(p_type), '"}}]}}}}]')
                  end as artist_credit
                from {part}
                """,
                part=self.table("part"),
            ),
        )

    # -- plays --------------------------------------------------------------
    @property
    def plays_base(self) -> DataFrame:
        def build():
            return self.spark.sql(
                """
                select o_custkey % 4 as segment, o_custkey as user_id,
                       unix_timestamp(cast(o_orderdate as timestamp)) + 60 * l_linenumber as timestamp,
                       case when l_linenumber % 2 = 0
                            then array(cast(l_suppkey as bigint), cast((7 * l_suppkey + l_linenumber) % 10 + 1 as bigint))
                            else array(cast(l_suppkey as bigint)) end as artist_ids,
                       cast(p_size as bigint) as release_id, l_partkey as rec_id, o_orderkey, l_linenumber
                from {lineitem} join {orders} on o_orderkey = l_orderkey
                     join {part} on p_partkey = l_partkey
                """,
                lineitem=self.table("lineitem"),
                orders=self.table("orders"),
                part=self.table("part"),
            )

        return self._memo("plays_base", build)

    @property
    def plays(self) -> DataFrame:
        """Plays with integer keys, a ``segment`` and exact duplicate rows."""
        def build():
            # one pass that emits every row, and beside the first line of some
            # orders a copy of it with no, an unknown, a NULL or the same artist
            cols = ["segment", "user_id", "timestamp", "release_id", "rec_id"]
            first, order = F.col("l_linenumber") == 1, F.col("o_orderkey")
            unknown = F.array((F.lit(UNKNOWN_ARTIST) + F.col("user_id") % 50).cast("bigint"))
            added = [
                F.when(first & (order % 23 == 0), F.struct(F.array().cast("array<bigint>").alias("artist_ids"))),
                F.when(first & (order % 29 == 0), F.struct(unknown.alias("artist_ids"))),
                F.when(first & (order % 31 == 0), F.struct(F.lit(None).cast("array<bigint>").alias("artist_ids"))),
                F.when(order % 50 == 0, F.struct("artist_ids")),
            ]
            lists = F.array_compact(F.array(F.struct("artist_ids"), *added))
            rows = self.plays_base.select(*cols, F.explode(lists).alias("x"))
            return rows.select(*cols[:3], "x.artist_ids", *cols[3:])

        return self._memo("plays", build)

    @property
    def actions(self) -> DataFrame:
        """Recommender input: first time each user played each artist."""
        return self._memo(
            "actions",
            lambda: self.spark.sql(
                """
                select user_id as `user`, artist_id as item, min(timestamp) as first_time
                from (select user_id, timestamp, explode(artist_ids) as artist_id from {plays}) t
                group by 1, 2
                """,
                plays=self.plays,
            ),
        )

    @property
    def plays_uuid(self) -> DataFrame:
        """Plays with UUID keys (md5 of tag + key, cut 8-4-4-4-12)."""
        return self._memo(
            "plays_uuid",
            lambda: self.spark.sql(
                f"""
                select segment, {_cut_once("'u'", "user_id")} as user_id, timestamp,
                       transform(artist_ids, x -> {_cut_once("'a'", "x")}) as artist_ids,
                       {_cut_once("'r'", "release_id")} as release_id,
                       {_cut_once("'c'", "rec_id")} as rec_id
                from {{plays}}
                """,
                plays=self.plays,
            ),
        )

    @property
    def raw_plays(self) -> DataFrame:
        """Raw text rows of play files: every play, and added rows with
        upper-case keys, bad keys, no time, or a bad file name."""
        def build():
            # one pass that emits every row and beside it those added to some times
            row = self.plays_uuid.select(
                F.concat(F.lit("/data/0"), "segment", F.lit("/"), "user_id", F.lit(".txt.zst")).alias("file_path"),
                "timestamp", F.array_join("artist_ids", ",").alias("artist_ids"), "release_id", "rec_id",
            )
            c, every = {name: F.col(name) for name in row.columns}, lambda n: F.col("timestamp") % n == 0

            def variant(**changed):
                return F.struct(*[changed.get(name, c[name]).alias(name) for name in row.columns])

            added = [
                F.when(every(101), variant(release_id=F.upper("release_id"), rec_id=F.upper("rec_id"))),
                F.when(every(103), variant(artist_ids=F.concat("artist_ids", F.lit(",x")))),
                F.when(every(107), variant(release_id=F.lit("bad"))),
                F.when(every(109), variant(timestamp=F.lit(None).cast("bigint"))),
                F.when(every(113), variant(file_path=F.replace("file_path", F.lit("/data/"), F.lit("/data/xyz")))),
            ]
            return row.select(F.inline(F.array_compact(F.array(variant(), *added))))

        return self._memo("raw_plays", build)

    @property
    def artist_uuid(self) -> DataFrame:
        """Artist metadata keyed by UUID, as the metadata dump provides it."""
        return self._memo(
            "artist_uuid",
            lambda: self.spark.sql(
                f"select {_uuid_sql(chr(39) + 'a' + chr(39), 'artist_id')} as artist_id, "
                "name, gender, type from {artist}",
                artist=self.artist,
            ),
        )


def _uuid_sql(tag: str, key: str) -> str:
    """UUID-shaped md5 of tag || key; the same text runs in Spark and DuckDB."""
    h = f"md5(concat({tag}, cast({key} as string)))"
    return (
        f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), "
        f"substr({h}, 17, 4), substr({h}, 21, 12))"
    )


def _cut_once(tag: str, key: str) -> str:
    """``_uuid_sql`` for Spark, with one md5 also in filters and lambdas, where it shares no expressions."""
    parts = "^(.{{8}})(.{{4}})(.{{4}})(.{{4}})"  # braces are doubled for spark.sql
    return f"coalesce(regexp_replace(md5(concat({tag}, cast({key} as string))), '{parts}', '$1-$2-$3-$4-'), '')"


def uuid_sql(tag: str, key: str) -> str:
    return _uuid_sql(f"'{tag}'", key)

"""Sources, sinks, table builds and the incremental load, fed from the given tables.

What a query writes goes to a fresh folder in the shared folder of the session.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bindings.common import EVENTS_CTE, events, in_folders, query, table
from bindings.relational import LOG_CTE, UNIQUE_LINES, game_log, unique_lines
from courtstats.operators.dealing import parts_for
from courtstats.operators.projection import conform
from courtstats.operators.quality import health
from courtstats.plans import builds
from courtstats.plans.reports import missing_dates
from courtstats.schemas import ALIASES, TABLE_DDL, table_schema
from courtstats.session import materialize, new_folder
from courtstats.sources import landing as L
from courtstats.sources import tables as T
from courtstats.sources.drift import drift_report, footers, scan_drifting
from courtstats.sources.snapshots import SnapshotTables
from courtstats.streaming.incremental import (
    Endpoint,
    complete_keys,
    incremental_load,
    load_batch,
    load_endpoints,
    loaded_keys,
    read_loaded,
    unique_rows,
)

# --- Sources and sinks -----------------------------------------------------------------


@query(
    "csv_round_trip",
    "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders",
)
@in_folders
def _csv_round_trip(spark, sf, folder):
    path = folder("csv")
    T.write_csv(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_custkey"), path)
    schema = "o_orderkey long, o_orderpriority string, o_totalprice double, o_custkey long"
    return T.scan_csv(spark, path, schema, ["o_orderkey", "o_orderpriority", "o_totalprice"])


@query(
    "scan_landing",
    """SELECT l_returnflag AS flag, count(*) AS n, sum(l_quantity) AS quantity, true AS from_files FROM lineitem
GROUP BY l_returnflag""",
)
@in_folders
def _scan_landing(spark, sf, folder):
    root = folder("landing")
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("flag"), "l_quantity")
    for index, flag in enumerate(["A", "N", "R"]):
        L.land(lines.where(F.col("flag") == flag), root, "boxscore", index)
    payload = L.scan_landing(
        spark, root, "boxscore", "l_orderkey long, flag string, l_quantity double", [0, 1, 2], with_file=True
    )
    return payload.groupBy("flag").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("quantity"),
        F.bool_and(F.col("source_file").contains("boxscore")).alias("from_files"),
    )


@query(
    "landing_reconciles",
    """SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'not a JSON object' WHEN o_orderkey % 10 = 1 THEN 'type of price'
WHEN o_orderkey % 10 = 2 THEN 'type of key, price' ELSE 'loaded' END AS outcome, count(*) AS lines,
CAST(sum(CASE WHEN o_orderkey % 10 > 2 THEN o_orderkey ELSE 0 END) AS BIGINT) AS keys, true AS adds_up
FROM orders GROUP BY outcome""",
)
@in_folders
def _landing_reconciles(spark, sf, folder):
    """Three of ten lines are broken: cut off, or with words in place of numbers. Two runs, a file each."""
    root, target, lane = folder("landing"), folder("good"), folder("lane")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    line, kind = F.to_json(F.struct("key", "price")), F.col("key") % 10
    broken = (
        F.when(kind == 0, F.expr("left(l, length(l) - 3)"))
        .when(kind == 1, F.concat(F.lit('{"key":'), F.col("key"), F.lit(',"price":"oops"}')))
        .when(kind == 2, F.lit('{"key":"x","price":[1]}'))
        .otherwise(F.col("l"))
    )
    lines = o.withColumn("l", line).select("key", broken.alias("value"))
    schema, progress = "key long, price double", folder("progress")
    for part in (0, 1):
        lines.where(F.col("key") % 2 == part).select("value").coalesce(2).write.mode("append").text(L.landing_path(root, "log"))
        L.load_landing(spark, root, "log", schema, target, lane, progress, files_per_batch=1)
    good = spark.read.schema("key long, price double, source_file string").parquet(target)
    kept = spark.read.schema("source_file string, line string, reason string").parquet(lane)
    counts = L.reconcile(L.parse_lines(L.landing_lines(spark, root, "log"), schema), good, kept)
    whole = counts.agg(F.bool_and("adds_up").alias("adds_up"))
    loaded = good.select(F.lit("loaded").alias("outcome"), "key")
    refused = kept.select(F.col("reason").alias("outcome"), F.lit(0).cast("long").alias("key"))
    outcomes = loaded.unionByName(refused).groupBy("outcome").agg(F.count(F.lit(1)).alias("lines"), F.sum("key").alias("keys"))
    return outcomes.withColumn("adds_up", whole.scalar())


def _drifting_loads(spark, sf, path):
    """Three loads of the line items: whole numbers that grow, then get fractions; codes that turn from numbers to text."""
    lines = table(spark, sf, "lineitem")
    loads = [
        ("A", [F.col("l_orderkey").cast("int"), F.col("l_linenumber").alias("code"), F.col("l_quantity").cast("int")]),
        ("N", [F.col("l_orderkey"), F.concat(F.lit("x"), F.col("l_linenumber")).alias("code"), F.col("l_quantity").cast("long")]),
        ("R", [F.col("l_orderkey"), F.col("l_quantity"), F.col("l_returnflag").alias("flag")]),
    ]
    for name, columns in loads:
        part = lines.where(F.col("l_returnflag") == name)
        part.select(*columns, "l_linenumber").write.parquet(f"{path}/load={name}")


@query(
    "scan_drifting_types",
    """SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN CAST(l_linenumber AS VARCHAR)
  WHEN 'N' THEN 'x' || l_linenumber END AS code, l_quantity, CASE WHEN l_returnflag = 'R' THEN 'R' END AS flag FROM lineitem""",
)
@in_folders
def _scan_drifting_types(spark, sf, folder):
    path = folder("drift")
    _drifting_loads(spark, sf, path)
    return scan_drifting(spark, path).select("l_orderkey", "l_linenumber", "code", "l_quantity", "flag")


@query(
    "drift_report",
    """WITH f AS (SELECT l_returnflag AS load, count(*) AS n FROM lineitem GROUP BY l_returnflag), c AS (
  SELECT * FROM (VALUES ('A', 'l_orderkey', 'int'), ('A', 'code', 'int'), ('A', 'l_quantity', 'int'),
    ('A', 'l_linenumber', 'int'), ('N', 'l_orderkey', 'bigint'), ('N', 'code', 'string'), ('N', 'l_quantity', 'bigint'),
    ('N', 'l_linenumber', 'int'), ('R', 'l_orderkey', 'bigint'), ('R', 'l_quantity', 'double'), ('R', 'flag', 'string'),
    ('R', 'l_linenumber', 'int')) v(load, col, kind))
SELECT col AS "column", CASE WHEN bool_or(kind = 'string') THEN 'string' WHEN bool_or(kind = 'double') THEN 'double'
  WHEN bool_or(kind = 'bigint') THEN 'bigint' ELSE 'int' END AS type,
  string_agg(DISTINCT kind, ',' ORDER BY kind) AS types, CAST(sum(n) AS BIGINT) AS rows, count(DISTINCT kind) > 1 AS widened,
  bool_or(kind = 'double') AND bool_or(kind = 'bigint') AS inexact
FROM c JOIN f USING (load) GROUP BY col""",
)
@in_folders
def _drift_report(spark, sf, folder):
    path = folder("drift")
    _drifting_loads(spark, sf, path)
    return drift_report(footers(spark, path))


@query(
    "append_and_replace",
    """SELECT 'appended' AS step, count(*) * 2 AS rows FROM orders
UNION ALL SELECT 'replaced', count(*) FROM orders WHERE o_orderstatus = 'F'""",
)
@in_folders
def _append_and_replace(spark, sf, folder):
    o = table(spark, sf, "orders")
    appended, replaced = folder("append"), folder("replace")
    T.write_append(o, appended)
    T.write_append(o, appended)
    T.write_replace(o, replaced)
    T.write_replace(o.where("o_orderstatus = 'F'"), replaced)
    count = F.count(F.lit(1)).alias("rows")
    both = T.scan(spark, appended).agg(count).select(F.lit("appended").alias("step"), "rows")
    return both.unionByName(T.scan(spark, replaced).agg(count).select(F.lit("replaced").alias("step"), "rows"))


@query(
    "replace_by_key",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN -o_totalprice ELSE o_totalprice END AS price FROM orders""",
)
@in_folders
def _replace_by_key(spark, sf, folder):
    path = folder("by-key")
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    fixes = o.where("o_orderkey % 3 = 0").withColumn("price", -F.col("price"))
    for batch_id, batch in enumerate([o, fixes, fixes]):
        T.replace_by_key(batch, path, ["o_orderkey"], batch_id, buckets=8)
    return T.scan(spark, path).drop("bucket")


@query(
    "replace_by_key_seasons",
    """SELECT nullif(o_orderkey, 0) AS game, o_orderstatus AS season,
CASE WHEN o_orderstatus = 'F' OR o_orderkey = 0 THEN -o_totalprice ELSE o_totalprice END AS price,
CASE WHEN o_orderstatus = 'F' OR o_orderkey = 0 THEN 2 ELSE 1 END AS version FROM orders""",
)
@in_folders
def _replace_by_key_seasons(spark, sf, folder):
    """A null key and one whole season are sent again, twice; the other seasons stay as written."""
    path = folder("by-season")
    games = table(spark, sf, "orders").select(
        F.nullif("o_orderkey", F.lit(0)).alias("game"),
        F.col("o_orderstatus").alias("season"),
        F.col("o_totalprice").alias("price"),
        F.lit(1).alias("version"),
    )
    fixes = games.where("season = 'F' OR game IS NULL").withColumns(
        {"price": -F.col("price"), "version": F.lit(2)}
    )
    for batch_id, batch in enumerate([games, fixes, fixes]):
        T.replace_by_key(batch, path, ["game"], batch_id, buckets=4, partition_by=["season"])
    return T.scan(spark, path).drop("bucket")


@query(
    "create_and_reset_tables",
    """SELECT 'hustle_stats' AS table_name, 0 AS rows, 'EMPTY' AS status
UNION ALL SELECT 'teams', count(*), 'OK' FROM nation UNION ALL SELECT 'games', 0, 'EMPTY'
UNION ALL SELECT 'injuries', NULL, 'NOT_FOUND'""",
)
def _create_and_reset_tables(spark, sf):
    place = new_folder(spark, "warehouse")
    database = place.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{place}'")
    T.create_all(spark, {t: table_schema(t) for t in ("teams", "hustle_stats", "games")}, database)
    nation = table(spark, sf, "nation")
    teams = nation.select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("nickname"))
    conform(teams, table_schema("teams"), {}).write.insertInto(f"{database}.teams")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("gameId"), F.col("l_suppkey").alias("teamId"))
    conform(lines, table_schema("hustle_stats"), ALIASES).write.insertInto(f"{database}.hustle_stats")
    T.reset_table(spark, "hustle_stats", database)
    known = {t: spark.table(f"{database}.{t}") for t in ("teams", "hustle_stats", "games")}
    found = materialize(health(spark, known, ["teams", "hustle_stats", "games", "injuries"]))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return found


# --- Builds ----------------------------------------------------------------------------


@query(
    "build_games",
    f"""WITH {LOG_CTE} SELECT CAST(h."GAME_ID" AS VARCHAR) AS game_id, DATE '2024-01-01' + CAST(h.wk AS INTEGER) AS game_date,
CAST(h.user_id % 5 AS VARCHAR) || '2024' AS season_id, h."MATCHUP" AS matchup,
CAST(CAST(h."PTS" AS BIGINT) AS INTEGER) AS home_pts, CAST(CAST(a."PTS" AS BIGINT) AS INTEGER) AS away_pts,
(SELECT CAST(n_nationkey AS BIGINT) FROM nation WHERE n_name = h."TEAM") AS home_team_id,
(SELECT CAST(n_nationkey AS BIGINT) FROM nation WHERE n_name = a."TEAM") AS away_team_id
FROM (SELECT * REPLACE (floor("PTS") AS "PTS") FROM log) h JOIN (SELECT * REPLACE (floor("PTS") AS "PTS") FROM log) a
ON h."GAME_ID" = a."GAME_ID" WHERE contains(h."MATCHUP", 'vs.') AND contains(a."MATCHUP", '@')""",
)
@in_folders
def _build_games(spark, sf, folder):
    nation = table(spark, sf, "nation").select(
        F.col("n_name").alias("TEAM"), F.col("n_nationkey").cast("long").alias("TEAM_ID")
    )
    log = game_log(spark, sf).join(nation, "TEAM").select(
        F.concat((F.col("user_id") % 5).cast("string"), F.lit("2024")).alias("SEASON_ID"),
        "TEAM_ID",
        F.col("GAME_ID").cast("string").alias("GAME_ID"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("week")).cast("string").alias("GAME_DATE"),
        "MATCHUP",
        F.lit("W").alias("WL"),
        F.floor("PTS").alias("PTS"),
    )
    # The log lands once, by season type; a payload is then one partition of it.
    path = folder("game-log")
    log.withColumn("kind", F.substring("SEASON_ID", 1, 1)).write.partitionBy("kind").parquet(path)
    landed = spark.read.schema(StructType([*log.schema.fields]).add("kind", "string")).parquet(path)
    games = builds.build_games([landed.where(F.col("kind") == d).drop("kind") for d in "01234"])
    return games.select(
        "game_id", "game_date", "season_id", "matchup", "home_pts", "away_pts", "home_team_id", "away_team_id"
    )


@query(
    "build_box_score",
    f"""SELECT CAST(l_orderkey AS VARCHAR) AS game_id, CAST(l_linenumber AS BIGINT) AS player_id, l_suppkey AS team_id,
CAST(l_quantity AS INTEGER) AS pts, l_extendedprice AS off_rating, l_discount AS pace, CAST(l_partkey AS INTEGER) AS pf,
CAST(NULL AS INTEGER) AS reb FROM ({UNIQUE_LINES})""",
)
def _build_box_score(spark, sf):
    lines = unique_lines(spark, sf).select(
        F.col("l_orderkey").cast("string").alias("gameId"),
        F.col("l_linenumber").cast("long").alias("personId"),
        F.col("l_suppkey").alias("teamId"),
        "l_quantity", "l_extendedprice", "l_discount", "l_partkey",
    )
    keys = ["gameId", "personId", "teamId"]
    trad = lines.select(*keys, F.col("l_quantity").alias("points"), F.lit("12:00").alias("minutes"))
    adv = lines.select(
        *keys, F.col("l_extendedprice").alias("offensiveRating"), F.col("l_discount").alias("pace"),
        F.lit("overlap").alias("minutes"),
    )
    misc = lines.select(*keys, F.col("l_partkey").alias("foulsPersonal"))
    box = builds.build_box_score(trad, adv, misc)
    return box.select("game_id", "player_id", "team_id", "pts", "off_rating", "pace", "pf", "reb")


def _event_payload(spark, sf):
    """Play-by-play payload, numbered within the game, with every third event sent twice."""
    nr = F.row_number().over(Window.partitionBy("game_id").orderBy("event_num"))
    ev = events(spark, sf).select(
        F.col("game_id").cast("string").alias("gameId"),
        nr.alias("actionNumber"),
        "period",
        F.col("score_home").cast("string").alias("scoreHome"),
        F.col("score_away").alias("scoreAway"),
        F.col("event_type").alias("actionType"),
    )
    copies = F.when(F.col("actionNumber") % 3 == 0, F.lit(2)).otherwise(F.lit(1))
    sent = ev.withColumn("sent", F.explode(F.sequence(F.lit(1), copies)))
    return sent.withColumn(
        "actionType", F.when(F.col("sent") == 2, F.lit("resent")).otherwise(F.col("actionType"))
    )


_PLAYS_SQL = f"""WITH {EVENTS_CTE} SELECT CAST(game_id AS VARCHAR) AS game_id,
CAST(row_number() OVER (PARTITION BY game_id ORDER BY event_num) AS INTEGER) AS event_num,
CAST(period AS INTEGER) AS period, event_type AS action_type, h AS score_home, a AS score_away FROM ev"""


def _plays_out(df):
    return df.select(
        "game_id", "event_num", "period", "action_type",
        F.col("score_home").cast("double").alias("score_home"),
        F.col("score_away").cast("double").alias("score_away"),
    )


@query("build_play_by_play", _PLAYS_SQL)
def _build_play_by_play(spark, sf):
    return _plays_out(builds.build_play_by_play(_event_payload(spark, sf), ["sent"]))


@query("load_play_by_play", _PLAYS_SQL)
@in_folders
def _load_play_by_play(spark, sf, folder):
    """Build, then write twice by game: the reload changes nothing."""
    path = folder("play-by-play")
    plays = builds.build_play_by_play(_event_payload(spark, sf), ["sent"])
    for batch_id in (1, 2):
        T.replace_by_key(plays, path, ["game_id"], batch_id, buckets=8)
    return _plays_out(T.scan(spark, path))


@query("incremental_load", _PLAYS_SQL)
@in_folders
def _incremental_load(spark, sf, folder):
    """Events spread over four batches of as many files as their number needs: every game spans batches.

    Then a fifth of the events are sent again with another type, which changes nothing,
    and the checkpoint is lost, which loses and doubles nothing.
    """
    landing, root = folder("landing"), folder("loaded")
    # The number orders the events of a game and is what the rows are told apart by.
    payload = _event_payload(spark, sf).where("sent = 1").drop("sent")
    files = parts_for(table(spark, sf, "events").count() // 4)
    # By number alone few tasks would get rows: a game has few numbers.
    by = ["actionNumber"] if files == 1 else ["gameId", "actionNumber"]
    payload.repartition(4 * files, *by).write.parquet(landing)

    def load(progress, files):
        stream = L.stream_landing(spark, landing, payload.schema, "parquet", files)
        keyed = stream.withColumn("game_id", F.col("gameId"))
        plays = unique_rows(
            lambda df: builds.build_play_by_play(df.drop("game_id")), ["game_id", "event_num"], ["action_type"]
        )
        incremental_load(keyed, root, progress, {"play_by_play": plays}, ["game_id"], buckets=4)

    first = folder("progress")
    load(first, files)
    again = payload.where("actionNumber % 5 = 0").withColumn("actionType", F.lit("resent"))
    again.repartition(2 * files).write.mode("append").parquet(landing)
    load(first, files)
    load(folder("progress"), 1000)
    loaded = read_loaded(spark, root, "play_by_play")
    return _plays_out(loaded.join(loaded_keys(spark, root, ["game_id"]), "game_id"))


@query("load_many_batches", _PLAYS_SQL)
@in_folders
def _load_many_batches(spark, sf, folder):
    """Events in twelve batches by time; each batch sends a part of the one before again, with another type.

    Buckets gather folders and are written as one on the way; a new run sends a batch again.
    """
    root = folder("loaded")
    payload = _event_payload(spark, sf).where("sent = 1").drop("sent")
    payload = payload.withColumn("game_id", F.col("gameId"))
    plays = unique_rows(
        lambda df: builds.build_play_by_play(df.drop("game_id")), ["game_id", "event_num"], ["action_type"]
    )
    stored = folder("payload")
    payload.withColumn("turn", F.col("actionNumber") % 12).write.partitionBy("turn").parquet(stored)
    sent = spark.read.schema(StructType([*payload.schema.fields]).add("turn", "integer")).parquet(stored)
    for turn in range(12):
        again = sent.where((F.col("turn") == turn - 1) & (F.col("period") == 1))
        batch = sent.where(F.col("turn") == turn).unionByName(again.withColumn("actionType", F.lit("resent")))
        load_batch(batch.drop("turn"), turn, root, {"plays": plays}, ["game_id"], "run", buckets=2)
    load_batch(sent.where("turn = 3").drop("turn"), 0, root, {"plays": plays}, ["game_id"], "another", buckets=2)
    return _plays_out(read_loaded(spark, root, "plays"))


@query(
    "snapshot_reload",
    """SELECT r.reader, o_orderkey, CASE WHEN r.changed AND o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS price
FROM orders, (VALUES ('planned before', false), ('first version', false), ('staged', false), ('after', true)) AS r(reader, changed)""",
)
@in_folders
def _snapshot_reload(spark, sf, folder):
    """Readers planned before a reload, while it is staged, and after it; and the first version read afterwards."""
    store = SnapshotTables(spark, folder("orders"), buckets=8)
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), "o_orderstatus")
    store.replace("orders", orders, ["o_orderkey"])
    readers = {"planned before": store.read("orders")}
    base = store.latest()
    fixes = orders.where("o_orderstatus = 'F'").withColumn("price", -F.col("price"))
    change = store.stage_replacement(base, "orders", fixes, ["o_orderkey"])
    readers["staged"] = store.read("orders")
    store.commit(base, [change])
    readers["after"] = store.read("orders")
    readers["first version"] = store.read("orders", 1)
    parts = [df.select(F.lit(name).alias("reader"), "o_orderkey", "price") for name, df in readers.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


#: Endpoints of a game: table, payload folder, the columns that tell its rows apart.
_ENDPOINTS = {
    "player_game_stats": ["game_id", "player_id", "pts"],
    "play_by_play": ["game_id", "event_num", "period"],
    "hustle_stats": ["game_id", "player_id"],
    "player_matchups": ["game_id", "off_player_id", "def_player_id"],
    "game_rotations": ["game_id", "player_id", "in_time_real"],
}


@query(
    "load_all_endpoints",
    """WITH g AS (SELECT DISTINCT l_orderkey FROM lineitem),
box AS (SELECT l_orderkey, count(DISTINCT (l_linenumber, CAST(l_quantity AS INTEGER))) AS n FROM lineitem GROUP BY 1),
pl AS (SELECT l_orderkey, count(DISTINCT (l_linenumber, CAST(l_quantity AS INTEGER))) AS n FROM lineitem
       WHERE l_orderkey % 7 <> 0 GROUP BY 1),
hu AS (SELECT o_orderkey AS l_orderkey, 1 AS n FROM orders WHERE o_orderstatus <> 'P'),
ma AS (SELECT l_orderkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1),
ro AS (SELECT o_orderkey AS l_orderkey, 1 AS n FROM orders)
SELECT CAST(g.l_orderkey AS VARCHAR) AS game_id, box.n AS box_rows, pl.n AS plays, CAST(hu.n AS BIGINT) AS hustle_rows,
ma.n AS matchups, CAST(ro.n AS BIGINT) AS shifts, pl.n IS NOT NULL AND hu.n IS NOT NULL AS done
FROM g LEFT JOIN box USING (l_orderkey) LEFT JOIN pl USING (l_orderkey) LEFT JOIN hu USING (l_orderkey)
LEFT JOIN ma USING (l_orderkey) LEFT JOIN ro USING (l_orderkey)""",
)
@in_folders
def _load_all_endpoints(spark, sf, folder):
    """Five payloads per game, each a stream of its own; a game is done with rows in all five tables.

    Every payload lands in two batches per endpoint that share their games, each of as many files as its rows need.
    """
    landing, root, progress = folder("landing"), folder("loaded"), folder("progress")
    lines = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders")
    game = F.col("l_orderkey").cast("string").alias("gameId")
    order_game = F.col("o_orderkey").cast("string").alias("gameId")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    payloads = {
        "player_game_stats": lines.select(
            game, F.col("l_linenumber").cast("long").alias("personId"), F.col("l_quantity").cast("int").alias("points")
        ),
        "play_by_play": lines.where("l_orderkey % 7 <> 0").select(
            game, F.col("l_linenumber").alias("actionNumber"), F.col("l_quantity").cast("int").alias("period")
        ),
        "hustle_stats": orders.where("o_orderstatus <> 'P'").select(order_game, F.col("o_custkey").alias("PLAYER_ID")),
        "player_matchups": joined.select(
            game, F.col("o_custkey").alias("personIdOff"), F.col("l_suppkey").alias("personIdDef")
        ),
        "game_rotations": orders.select(
            order_game, F.col("o_custkey").alias("PERSON_ID"), F.col("o_totalprice").alias("IN_TIME_REAL")
        ),
    }
    files = parts_for(lines.count() // 2)
    ends = {}
    for name, payload in payloads.items():
        path = L.landing_path(landing, name)
        payload.repartition(2 * files).write.parquet(path)
        stream = L.stream_landing(spark, path, payload.schema, "parquet", files)
        keyed = stream.withColumn("game_id", F.col("gameId"))
        row_keys = _ENDPOINTS[name]

        def build(df, name=name):
            return conform(df.drop("game_id"), table_schema(name), ALIASES)

        ends[name] = Endpoint(keyed, {name: unique_rows(build, row_keys, row_keys)})
    load_endpoints(ends, root, progress, ["game_id"], buckets=2)
    tables = {name: f"{name}/{name}" for name in payloads}
    out = read_loaded(spark, root, tables["player_game_stats"]).select("game_id").distinct()
    labels = ("box_rows", "plays", "hustle_rows", "matchups", "shifts")
    for name, label in zip(payloads, labels):
        counts = read_loaded(spark, root, tables[name]).groupBy("game_id").agg(F.count(F.lit(1)).alias(label))
        out = out.join(counts, "game_id", "left")
    done = complete_keys(spark, root, list(tables.values()), ["game_id"]).withColumn("done", F.lit(True))
    return out.join(done, "game_id", "left").withColumn("done", F.coalesce("done", F.lit(False)))


@query(
    "build_hustle",
    """SELECT CAST(o_orderkey AS VARCHAR) AS game_id, o_custkey AS player_id,
CAST(length(o_orderpriority) AS INTEGER) AS deflections FROM orders""",
)
def _build_hustle(spark, sf):
    payload = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("GAME_ID"),
        F.col("o_custkey").alias("PLAYER_ID"),
        F.length("o_orderpriority").alias("DEFLECTIONS"),
    )
    return builds.build_hustle(payload).select("game_id", "player_id", "deflections")


@query(
    "build_matchups",
    """WITH m AS (SELECT CAST(l_orderkey AS VARCHAR) AS game_id, o_custkey AS off_player_id, l_suppkey AS def_player_id,
round(CASE WHEN l_linenumber = 7 THEN l_quantity ELSE l_quantity + l_linenumber / 60.0 END, 6) AS matchup_minutes
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_suppkey % 10 <> 0)
SELECT game_id, off_player_id, def_player_id, max(matchup_minutes) AS matchup_minutes FROM m GROUP BY ALL""",
)
def _build_matchups(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem")
    quantity = F.col("l_quantity").cast("int").cast("string")
    payload = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").cast("string").alias("gameId"),
        F.col("o_custkey").alias("personIdOff"),
        F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey").cast("double")).alias("personIdDef"),
        F.when(F.col("l_linenumber") == 7, "").otherwise(
            F.concat(quantity, F.lit(":0"), F.col("l_linenumber").cast("string"))
        ).alias("matchupMinutes"),
        F.col("l_quantity").alias("matchupMinutesSort"),
    )
    return builds.build_matchups(payload).select(
        "game_id", "off_player_id", "def_player_id", F.round("matchup_minutes", 6).alias("matchup_minutes")
    )


@query(
    "build_rotations",
    """SELECT CAST(o_orderkey AS VARCHAR) AS game_id, o_custkey AS player_id, o_totalprice AS in_time_real,
o_totalprice * 2 AS out_time_real, 1 AS ids FROM orders""",
)
def _build_rotations(spark, sf):
    shifts = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("GAME_ID"),
        F.col("o_custkey").alias("PERSON_ID"),
        F.col("o_totalprice").alias("IN_TIME_REAL"),
        (F.col("o_totalprice") * 2).alias("OUT_TIME_REAL"),
    )
    both = [shifts.where(F.col("PERSON_ID") % 2 == side) for side in (0, 1)]
    rotations = builds.build_rotations(both)
    once = rotations.groupBy("game_id", "row_id").agg(F.count(F.lit(1)).cast("int").alias("ids"))
    return rotations.join(once, ["game_id", "row_id"]).select(
        "game_id", "player_id", "in_time_real", "out_time_real", "ids"
    )


def _line_payloads(spark, sf):
    """Both payload shapes, camel case for even users, upper case for odd ones, each with overtimes.

    Camel case: the first, sixth and tenth overtime (periods 5, 10 and 14). Upper case: the first and fifth.
    """
    sums = events(spark, sf).groupBy("user_id", "week").agg(
        *[
            F.sum(F.when(F.col("period") == q, F.floor("score_home"))).alias(f"q{q}")
            for q in range(1, 5)
        ]
    )
    game = (F.col("user_id") * 100 + F.col("week")).cast("string")
    camel = sums.where("user_id % 2 = 0").select(
        game.alias("gameId"), F.col("user_id").alias("teamId"),
        *[F.col(f"q{q}").alias(f"period{q}Score") for q in range(1, 5)],
        F.lit(None).cast("int").alias("period5Score"),
        F.nullif(F.col("week"), F.lit(2)).alias("period10Score"),
        (F.col("week") + 1).alias("period14Score"),
    )
    upper = sums.where("user_id % 2 = 1").select(
        game.alias("GAME_ID"), F.col("user_id").alias("TEAM_ID"),
        *[F.col(f"q{q}").alias(f"PTS_QTR{q}") for q in range(1, 5)],
        F.nullif(F.col("week"), F.lit(1)).alias("PTS_OT1"),
        (F.col("week") + 2).alias("PTS_OT5"),
    )
    return [camel, upper]


_LINE_CTE = EVENTS_CTE + """,
ls AS (SELECT CAST(game_id AS VARCHAR) AS g, user_id, wk,
       CAST(sum(floor(h)) FILTER (period = 1) AS INTEGER) AS q1, CAST(sum(floor(h)) FILTER (period = 2) AS INTEGER) AS q2,
       CAST(sum(floor(h)) FILTER (period = 3) AS INTEGER) AS q3, CAST(sum(floor(h)) FILTER (period = 4) AS INTEGER) AS q4
       FROM ev GROUP BY game_id, user_id, wk),
ot AS (SELECT *, CAST(CASE WHEN user_id % 2 = 1 AND wk <> 1 THEN wk END AS INTEGER) AS o1,
       CAST(CASE WHEN user_id % 2 = 1 THEN wk + 2 END AS INTEGER) AS o5,
       CAST(CASE WHEN user_id % 2 = 0 AND wk <> 2 THEN wk END AS INTEGER) AS o6,
       CAST(CASE WHEN user_id % 2 = 0 THEN wk + 1 END AS INTEGER) AS o10 FROM ls)"""


@query(
    "build_line_scores",
    f"""WITH {_LINE_CTE} SELECT CAST(NULL AS VARCHAR) AS "GAME_DATE_EST", g AS "GAME_ID", user_id AS "TEAM_ID",
CAST(NULL AS VARCHAR) AS "TEAM_ABBREVIATION", q1 AS "PTS_QTR1", q2 AS "PTS_QTR2", q3 AS "PTS_QTR3", q4 AS "PTS_QTR4",
coalesce(o1, 0) AS "PTS_OT1", 0 AS "PTS_OT2", 0 AS "PTS_OT3", 0 AS "PTS_OT4", coalesce(o5, 0) AS "PTS_OT5",
coalesce(o6, 0) AS "PTS_OT6", 0 AS "PTS_OT7", 0 AS "PTS_OT8", 0 AS "PTS_OT9", coalesce(o10, 0) AS "PTS_OT10",
CAST(NULL AS INTEGER) AS "PTS" FROM ot""",
)
def _build_line_scores(spark, sf):
    return builds.build_line_scores(_line_payloads(spark, sf))


@query(
    "line_scores_long",
    f"""WITH {_LINE_CTE}, r AS (SELECT g, user_id, unnest([1, 2, 3, 4, 5, 9, 10, 14]) AS p,
unnest([q1, q2, q3, q4, o1, o5, o6, o10]) AS pts FROM ot)
SELECT g AS "GAME_ID", user_id AS "TEAM_ID", p AS period, pts FROM r WHERE p <= 4 OR pts IS NOT NULL""",
)
def _line_scores_long(spark, sf):
    return builds.line_scores_long(_line_payloads(spark, sf)).select("GAME_ID", "TEAM_ID", "period", "pts")


@query(
    "line_score_dates_missing",
    """SELECT CAST(o_orderdate AS DATE) AS game_date, count(*) AS games FROM orders
WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 5 = 0)
GROUP BY 1""",
)
def _line_score_dates_missing(spark, sf):
    orders = table(spark, sf, "orders")
    games = orders.select(F.to_date("o_orderdate").alias("game_date"))
    scores = orders.where("o_orderkey % 5 = 0").select(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("GAME_DATE_EST")
    )
    return missing_dates(games, scores)


@query(
    "build_dimensions",
    """SELECT 'team' AS kind, CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation
UNION ALL SELECT 'player', c_custkey, c_name FROM customer""",
)
@in_folders
def _build_dimensions(spark, sf, folder):
    root = folder("landing")
    teams = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("id"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("abbreviation"),
        F.col("n_name").alias("full_name"),
        F.lit("short").alias("nickname"),
        F.lit("city").alias("city"),
        F.lit("state").alias("state"),
        F.lit(1946).alias("year_founded"),
    )
    players = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        (F.col("c_acctbal") > 0).alias("is_active"),
    )
    team_records = L.scan_dimension(spark, L.land(teams, root, "teams"), teams.schema)
    player_records = L.scan_dimension(spark, L.land(players, root, "players"), players.schema)
    team_path, player_path = f"{root}/silver/teams", f"{root}/silver/players"
    T.write_replace(builds.build_teams(team_records), team_path)
    T.write_replace(builds.build_players(player_records), player_path)
    named_teams = spark.read.schema(TABLE_DDL["teams"]).parquet(team_path).select(
        F.lit("team").alias("kind"), F.col("team_id").alias("id"), F.col("nickname").alias("name")
    )
    named_players = spark.read.schema(TABLE_DDL["players"]).parquet(player_path).select(
        F.lit("player").alias("kind"), F.col("player_id").alias("id"), F.col("full_name").alias("name")
    )
    return named_teams.unionByName(named_players)

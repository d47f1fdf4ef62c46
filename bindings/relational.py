"""Scalar, relational, window, ordering and set operators on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.common import POINTS_CTE, game_rows, query, r, sql_round, table
from courtstats.functions import columns as C
from courtstats.operators import aggregates as A
from courtstats.operators import joins as J
from courtstats.operators import keysets as K
from courtstats.operators import ordering as O
from courtstats.operators import projection as P
from courtstats.operators import quality as Q
from courtstats.operators import quantiles as N
from courtstats.operators import sets as U
from courtstats.operators import windows as W
from courtstats.operators.dealing import dealt
from courtstats.plans import reports
from courtstats.schemas import ALIASES, table_schema
from courtstats.sources.tables import scan, scan_query

# --- Scans, projections, scalar expressions --------------------------------------------


@query("scan_table", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 400000")
def _scan_table(spark, sf):
    return scan(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_orderstatus", "o_totalprice"]).where(
        "o_totalprice > 400000"
    ).drop("o_totalprice")


@query(
    "scan_query",
    "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
)
def _scan_query(spark, sf):
    return scan_query(
        spark,
        "SELECT n_name, count(*) AS customers FROM {c} JOIN {n} ON c_nationkey = n_nationkey GROUP BY n_name",
        c=table(spark, sf, "customer"),
        n=table(spark, sf, "nation"),
    )


@query(
    "conform",
    """SELECT CAST(l_orderkey AS VARCHAR) AS game_id, l_partkey AS player_id, l_suppkey AS team_id,
CAST(l_quantity AS INTEGER) AS screen_assists, l_linenumber AS deflections,
CAST(NULL AS INTEGER) AS loose_balls_recovered, CAST(NULL AS INTEGER) AS charges_drawn,
CAST(NULL AS INTEGER) AS contested_shots, CAST(NULL AS INTEGER) AS box_outs FROM lineitem""",
)
def _conform(spark, sf):
    payload = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("gameId"),
        F.col("l_partkey").alias("PERSON_ID"),
        F.col("l_suppkey").alias("TEAM_ID"),
        F.col("l_quantity").alias("SCREEN_ASSISTS"),
        F.col("l_linenumber").cast("string").alias("DEFLECTIONS"),
        F.col("l_tax").alias("unknown_column"),
    )
    return P.conform(payload, table_schema("hustle_stats"), ALIASES)


@query(
    "conform_coalesce",
    """SELECT o_orderkey AS event_num,
CASE WHEN o_orderstatus = 'F' THEN o_orderstatus ELSE o_orderpriority END AS description FROM orders""",
)
def _conform_coalesce(spark, sf):
    payload = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("EVENTNUM"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus")).alias("HOMEDESCRIPTION"),
        F.col("o_orderpriority").alias("VISITORDESCRIPTION"),
    )
    schema = table_schema("play_by_play")
    return P.conform(payload, schema, ALIASES, mode="coalesce").select(
        F.col("event_num").cast("long").alias("event_num"), "description"
    )


@query("project", "SELECT c_name, c_custkey FROM customer")
def _project(spark, sf):
    return P.project(table(spark, sf, "customer"), ["c_name", "c_custkey"])


@query("project_available", "SELECT s_suppkey, s_name FROM supplier")
def _project_available(spark, sf):
    return P.project_available(table(spark, sf, "supplier"), ["s_suppkey", "s_phone", "s_name"])


@query("rename", "SELECT p_partkey AS part_id, p_name AS part_name FROM part")
def _rename(spark, sf):
    renamed = P.rename(table(spark, sf, "part"), {"p_partkey": "part_id", "p_name": "part_name"})
    return renamed.select("part_id", "part_name")


@query("with_constant", "SELECT o_orderkey, '0022300001' AS game_id FROM orders")
def _with_constant(spark, sf):
    return P.with_constant(table(spark, sf, "orders").select("o_orderkey"), "game_id", "0022300001")


@query(
    "ensure_columns",
    """SELECT l_orderkey, coalesce(nullif(l_linenumber, 7), 0) AS l_linenumber, 0 AS overtime FROM lineitem""",
)
def _ensure_columns(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", F.nullif("l_linenumber", F.lit(7)).alias("l_linenumber")
    )
    return P.ensure_columns(li, ["l_linenumber", "overtime"], 0)


@query(
    "to_number",
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS score FROM events""",
)
def _to_number(spark, sf):
    ev = table(spark, sf, "events")
    slot = F.col("event_id") % 4
    text = F.when(slot == 0, F.when(F.col("event_id") % 8 == 0, "").otherwise("12d")).otherwise(
        F.col("value").cast("string")
    )
    return P.to_numbers(ev.select("event_id", text.alias("score")), ["score"])


@query("to_number_strict", "SELECT event_id, value AS score FROM events")
def _to_number_strict(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.col("value").cast("string").alias("score"))
    return P.to_numbers(ev, ["score"], errors="raise")


@query("to_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders")
def _to_date(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf, "orders").select("o_orderkey", F.to_date(text).alias("d"))


@query("date_part_of_iso", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders")
def _date_part_of_iso(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "orders").select("o_orderkey", C.iso_date(text).alias("d"))


@query(
    "cast_int",
    "SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS player_id FROM lineitem WHERE l_quantity <> 50",
)
def _cast_int(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", F.nullif("l_quantity", F.lit(50.0)).alias("player_id")
    )
    return P.drop_nulls(li, ["player_id"]).withColumn("player_id", F.col("player_id").cast("long"))


@query("filter_not_null", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O'")
def _filter_not_null(spark, sf):
    o = table(spark, sf, "orders").withColumn("WL", F.nullif("o_orderstatus", F.lit("O")))
    return P.filter_not_null(o, "WL").select("o_orderkey")


@query(
    "drop_nulls",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'O' AND o_custkey % 3 <> 0",
)
def _drop_nulls(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.nullif("o_orderstatus", F.lit("O")).alias("status"),
    )
    return P.drop_nulls(o).drop("status")


@query("filter_eq", "SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def _filter_eq(spark, sf):
    return P.filter_eq(table(spark, sf, "orders"), "o_orderpriority", "1-URGENT").select("o_orderkey")


@query("filter_in", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P')")
def _filter_in(spark, sf):
    return P.filter_in(table(spark, sf, "orders"), "o_orderstatus", ["F", "P"]).select("o_orderkey")


LOG_CTE = f"""{POINTS_CTE},
log AS (
  SELECT game_id AS "GAME_ID", home_team AS "TEAM", home_team || ' vs. ' || away_team AS "MATCHUP",
         q3_h + f_h AS "PTS", user_id, wk FROM game
  UNION ALL
  SELECT game_id, away_team, away_team || ' @ ' || home_team, q3_a + f_a, user_id, wk FROM game
)"""


def game_log(spark, sf):
    """Two log rows per game of the binding, with the text of either side."""
    g = game_rows(spark, sf)

    def side(team, other, marker, q3, final):
        text = F.concat(F.col(team), F.lit(f" {marker} "), F.col(other))
        return F.struct(
            F.col(team).alias("TEAM"),
            text.alias("MATCHUP"),
            (F.col(q3) + F.col(final)).alias("PTS"),
        )

    rows = g.select(
        F.col("game_id").alias("GAME_ID"),
        "user_id",
        "week",
        F.explode(
            F.array(
                side("home_team", "away_team", "vs.", "q3_h", "f_h"),
                side("away_team", "home_team", "@", "q3_a", "f_a"),
            )
        ).alias("side"),
    )
    return rows.select("GAME_ID", "user_id", "week", "side.*")


@query(
    "split_by_marker",
    f"""WITH {LOG_CTE} SELECT 'home' AS side, "GAME_ID", "MATCHUP" FROM log WHERE contains("MATCHUP", 'vs.')
UNION ALL SELECT 'away', "GAME_ID", "MATCHUP" FROM log WHERE contains("MATCHUP", '@')""",
)
def _split_by_marker(spark, sf):
    home, away = P.split_by_marker(game_log(spark, sf), "MATCHUP")
    return home.select(F.lit("home").alias("side"), "GAME_ID", "MATCHUP").unionByName(
        away.select(F.lit("away").alias("side"), "GAME_ID", "MATCHUP")
    )


@query(
    "margin_and_flag",
    """SELECT l_orderkey, l_linenumber, l_partkey - l_suppkey AS margin, l_suppkey - l_partkey AS mirrored,
CASE WHEN l_partkey > l_suppkey THEN 'win' ELSE 'loss' END AS outcome FROM lineitem""",
)
def _margin_and_flag(spark, sf):
    m = C.margin(F.col("l_partkey"), F.col("l_suppkey"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        m.alias("margin"),
        C.negate(m).alias("mirrored"),
        C.sign_flag(m).alias("outcome"),
    )


@query(
    "cut",
    """SELECT l_orderkey, l_quantity, CASE WHEN l_quantity > 1 AND l_quantity <= 10 THEN 'low'
WHEN l_quantity > 10 AND l_quantity <= 25 THEN 'mid' WHEN l_quantity > 25 AND l_quantity <= 49 THEN 'high'
END AS band FROM lineitem""",
)
def _cut(spark, sf):
    band = C.cut(F.col("l_quantity"), [1, 10, 25, 49], ["low", "mid", "high"])
    return table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", band.alias("band"))


@query(
    "label_if",
    """SELECT l_orderkey, CASE WHEN avg(l_quantity) < 25 THEN 'Linear' ELSE 'Complex' END AS label
FROM lineitem GROUP BY l_orderkey""",
)
def _label_if(spark, sf):
    means = A.mean_by(table(spark, sf, "lineitem"), ["l_orderkey"], "l_quantity", "m")
    return means.select("l_orderkey", C.label_if(F.col("m"), 25, "Linear", "Complex").alias("label"))


@query(
    "format_number",
    """SELECT o_custkey, printf('%.1f', CAST(count(*) * 3 AS DOUBLE)) AS plain,
printf('%+.2f', CAST(count(*) - 10 AS DOUBLE)) AS signed FROM orders GROUP BY o_custkey""",
)
def _format_number(spark, sf):
    n = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return n.select(
        "o_custkey",
        C.format_number(F.col("n") * 3, 1).alias("plain"),
        C.format_number(F.col("n") - 10, 2, signed=True).alias("signed"),
    )


@query(
    "decode_season",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'preseason' WHEN 1 THEN 'regular' WHEN 2 THEN 'playoffs'
ELSE 'playin' END AS season_type, CAST(year(o_orderdate) AS INTEGER) AS start_year FROM orders""",
)
def _decode_season(spark, sf):
    digit = F.element_at(F.array(*[F.lit(d) for d in "1245"]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    season = F.concat(digit, F.year("o_orderdate").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", C.decode_season(season).alias("s")).select(
        "o_orderkey", "s.season_type", "s.start_year"
    )


@query(
    "parse_minutes",
    """SELECT l_orderkey, l_linenumber, round(CASE WHEN l_linenumber = 1 THEN l_tax
WHEN l_linenumber = 2 THEN l_quantity ELSE l_quantity + l_linenumber / 60.0 END, 6) AS minutes FROM lineitem""",
)
def _parse_minutes(spark, sf):
    quantity = F.col("l_quantity").cast("int").cast("string")
    text = (
        F.when(F.col("l_linenumber") == 1, "n/a")
        .when(F.col("l_linenumber") == 2, quantity)
        .otherwise(F.concat(quantity, F.lit(":0"), F.col("l_linenumber").cast("string")))
    )
    minutes = C.parse_minutes(text, F.col("l_tax"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(minutes, 6).alias("minutes")
    )


# --- Joins -----------------------------------------------------------------------------


@query(
    "star_join",
    """SELECT o_orderkey, c_name, n_name AS nation, r_name AS region FROM orders
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey""",
)
def _star_join(spark, sf):
    joined = J.star_join(
        table(spark, sf, "orders"),
        [
            ("o_custkey", table(spark, sf, "customer"), "c_custkey", {"c_name": "c_name", "c_nationkey": "nk"}),
            ("nk", table(spark, sf, "nation"), "n_nationkey", {"n_name": "nation", "n_regionkey": "rk"}),
            ("rk", table(spark, sf, "region"), "r_regionkey", {"r_name": "region"}),
        ],
    )
    return joined.select("o_orderkey", "c_name", "nation", "region")


@query(
    "pair_sides",
    f"""WITH {LOG_CTE} SELECT h."GAME_ID", h."MATCHUP", h."TEAM" AS "TEAM_home", {sql_round('h."PTS"', 2)} AS "PTS_home",
a."TEAM" AS "TEAM_away", {sql_round('a."PTS"', 2)} AS "PTS_away" FROM log h JOIN log a ON h."GAME_ID" = a."GAME_ID"
WHERE contains(h."MATCHUP", 'vs.') AND contains(a."MATCHUP", '@')""",
)
def _pair_sides(spark, sf):
    home, away = P.split_by_marker(game_log(spark, sf), "MATCHUP")
    paired = J.pair_sides(home, away, "GAME_ID", ["TEAM", "PTS"])
    return paired.select(
        "GAME_ID", "MATCHUP", "TEAM_home", r("PTS_home", 2), "TEAM_away", r("PTS_away", 2)
    )


UNIQUE_LINES = """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
l_shipdate) = 1"""

_LINE_ORDER = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus", "l_shipdate",
]


def unique_lines(spark, sf):
    return W.dedupe(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER)


@query("dedupe", f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM ({UNIQUE_LINES})")
def _dedupe(spark, sf):
    return unique_lines(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "merge_facets",
    f"""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag
FROM ({UNIQUE_LINES})""",
)
def _merge_facets(spark, sf):
    keys = ["l_orderkey", "l_linenumber"]
    lines = unique_lines(spark, sf)
    first = lines.select(*keys, "l_quantity")
    second = lines.select(*keys, "l_extendedprice", F.lit(-1.0).alias("l_quantity"))
    third = lines.select(*keys, "l_discount", "l_returnflag", F.lit(-2.0).alias("l_extendedprice"))
    return J.merge_facets([first, second, third], keys)


# Matchups: game = order, attacker = customer, defender = supplier, team = nation.
_MATCH_CTE = """m AS (SELECT CAST(l_orderkey AS VARCHAR) AS game_id, o_custkey AS off_id, l_suppkey AS def_id,
  l_quantity AS mins, CAST(round(l_extendedprice * 100) AS BIGINT) AS pts, l_linenumber AS ast, CAST(round(l_tax * 100) AS BIGINT) AS tov
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
j AS (SELECT m.*, c_name AS attacker, s_name AS defender, sn.n_name AS team FROM m
  JOIN customer ON c_custkey = off_id JOIN supplier ON s_suppkey = def_id
  JOIN nation sn ON sn.n_nationkey = s_nationkey
  WHERE c_nationkey <> s_nationkey),
d AS (SELECT def_id, defender, arg_max(team, game_id) AS team, count(DISTINCT game_id) AS games_faced,
  sum(mins) AS mins_guarded, CAST(sum(pts) AS BIGINT) AS pts_scored, CAST(sum(ast) AS BIGINT) AS ast_allowed,
  CAST(sum(tov) AS BIGINT) AS tov_forced FROM {j} GROUP BY def_id, defender)"""


def matchup_tables(spark, sf, attacker="o_custkey"):
    orders = table(spark, sf, "orders").select("o_orderkey", F.expr(attacker).alias("o_custkey"))
    lines = table(spark, sf, "lineitem")
    # Dealt by the number of lines, as tasks sort what they join.
    size = lines.count()
    lines, orders = dealt(lines, ["l_orderkey"], size), dealt(orders, ["o_orderkey"], size)
    has_order = lines.l_orderkey == orders.o_orderkey
    games = lines.join(orders, has_order)
    game_id = F.col("l_orderkey").cast("string").alias("game_id")
    # Suppliers and customers share one player table: supplier ids are shifted below zero.
    defender = -F.col("l_suppkey") - 1
    matchups = games.select(
        game_id,
        F.lit(None).cast("long").alias("team_id"),
        F.col("o_custkey").alias("off_player_id"),
        defender.alias("def_player_id"),
        F.col("l_quantity").alias("matchup_minutes"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("points_allowed"),
        F.col("l_linenumber").alias("matchup_ast"),
        F.round(F.col("l_tax") * 100).cast("long").alias("matchup_tov"),
    )
    customer = table(spark, sf, "customer")
    supplier = table(spark, sf, "supplier").withColumn("sid", -F.col("s_suppkey") - 1)
    players = customer.select(
        F.col("c_custkey").alias("player_id"), F.col("c_name").alias("full_name")
    ).unionByName(
        supplier.select(F.col("sid").alias("player_id"), F.col("s_name").alias("full_name"))
    )
    # An attacker needs one row a game, not one a line.
    attackers, defenders = orders.join(lines, has_order, "left_semi"), lines.join(orders, has_order, "left_semi")
    order_game = F.col("o_orderkey").cast("string").alias("game_id")
    off_stats = attackers.select(order_game, F.col("o_custkey").alias("player_id")).join(
        customer.select(F.col("c_custkey").alias("player_id"), F.col("c_nationkey").alias("team_id")),
        "player_id",
    )
    def_stats = defenders.select(game_id, defender.alias("player_id")).join(
        supplier.select(F.col("sid").alias("player_id"), F.col("s_nationkey").alias("team_id")), "player_id"
    )
    box_scores = dealt(off_stats.unionByName(def_stats), ["game_id", "player_id"], size).distinct()
    teams = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("abbreviation")
    )
    return matchups, players, box_scores, teams


@query(
    "matchup_join",
    f"""WITH {_MATCH_CTE.format(j='j')} SELECT game_id, attacker, defender, team, mins AS matchup_minutes FROM j""",
)
def _matchup_join(spark, sf):
    rows = J.matchup_join(*matchup_tables(spark, sf))
    return rows.select("game_id", "attacker", "defender", "team", "matchup_minutes")


# One attacker with a third of all matchups.
_STAR = "CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END"


@query(
    "matchup_join_hot_attacker",
    f"""WITH {_MATCH_CTE.format(j='j').replace("o_custkey AS off_id", _STAR + " AS off_id")}
SELECT game_id, attacker, defender, team, mins AS matchup_minutes FROM j""",
)
def _matchup_join_hot_attacker(spark, sf):
    rows = J.matchup_join(*matchup_tables(spark, sf, _STAR), split_hot=True)
    return rows.select("game_id", "attacker", "defender", "team", "matchup_minutes")


@query(
    "star_join_hot_key",
    """SELECT p_name, s_name, count(*) AS n, sum(l_quantity) AS quantity FROM (
  SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 5 ELSE l_partkey END AS pk FROM lineitem) l
JOIN part ON p_partkey = pk JOIN supplier ON s_suppkey = l_suppkey GROUP BY p_name, s_name""",
)
def _star_join_hot_key(spark, sf):
    part_key = F.expr("CASE WHEN l_orderkey % 3 = 0 THEN 5 ELSE l_partkey END").alias("pk")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", part_key, "l_suppkey", "l_quantity")
    joined = J.star_join(
        lines,
        [
            ("pk", table(spark, sf, "part"), "p_partkey", {"p_name": "p_name"}),
            ("l_suppkey", table(spark, sf, "supplier"), "s_suppkey", {"s_name": "s_name"}),
        ],
        split_hot=True,
    )
    return joined.groupBy("p_name", "s_name").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query(
    "defender_totals",
    f"""WITH {_MATCH_CTE.format(j='j')} SELECT -def_id - 1 AS def_player_id, defender, team, games_faced,
mins_guarded, pts_scored, ast_allowed, tov_forced FROM d""",
)
def _defender_totals(spark, sf):
    matchups, players, box_scores, teams = matchup_tables(spark, sf)
    return reports.defender_totals(J.matchup_sides(matchups, box_scores), players, teams)


@query(
    "nemesis_report",
    f"""WITH {_MATCH_CTE.format(j="(SELECT * FROM j WHERE attacker = 'Customer#000000007')")}
SELECT -def_id - 1 AS def_player_id, defender, team, games_faced, printf('%.1f', mins_guarded) AS mins_guarded,
pts_scored, ast_allowed, tov_forced FROM d ORDER BY d.mins_guarded DESC, -def_id LIMIT 10""",
)
def _nemesis_report(spark, sf):
    return reports.nemesis_report(*matchup_tables(spark, sf), attacker="Customer#000000007", k=10)


_CUTOFF = "1998-01-01"


def _load_frames(spark, sf):
    target = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    lines = table(spark, sf, "lineitem")
    done = lines.where(F.col("l_shipdate") < F.lit(_CUTOFF).cast("timestamp_ntz"))
    return target, done.select(F.col("l_orderkey").alias("k"))


_TODO_SQL = f"""SELECT DISTINCT o_orderkey AS k FROM orders WHERE NOT EXISTS
(SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate < TIMESTAMP '{_CUTOFF}')"""


@query("missing_keys", _TODO_SQL)
def _missing_keys(spark, sf):
    return J.missing_keys(*_load_frames(spark, sf), ["k"])


@query(
    "key_difference",
    "SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45",
)
def _key_difference(spark, sf):
    return U.key_difference(
        table(spark, sf, "part").select(F.col("p_partkey").alias("k")),
        table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("k")),
        ["k"],
    )


@query(
    "feature_join",
    """SELECT s_nationkey AS nation, count(*) AS suppliers, any_value(customers) AS customers FROM supplier
JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey) ON c_nationkey = s_nationkey
GROUP BY s_nationkey""",
)
def _feature_join(spark, sf):
    n = F.count(F.lit(1))
    s = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(n.alias("suppliers"))
    c = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(n.alias("customers"))
    return J.feature_join(s, c, "nation", ["customers"])


# --- Aggregates ------------------------------------------------------------------------


@query("count_rows", "SELECT count(*) AS rows FROM lineitem")
def _count_rows(spark, sf):
    return A.count_rows(table(spark, sf, "lineitem"))


@query(
    "count_distinct",
    "SELECT l_suppkey, count(DISTINCT l_orderkey) AS games FROM lineitem GROUP BY l_suppkey",
)
def _count_distinct(spark, sf):
    return A.count_distinct(table(spark, sf, "lineitem"), ["l_suppkey"], "l_orderkey", "games")


@query(
    "sum_by",
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity, CAST(sum(l_linenumber) AS BIGINT) AS lines
FROM lineitem GROUP BY ALL""",
)
def _sum_by(spark, sf):
    return A.sum_by(
        table(spark, sf, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {"l_quantity": "quantity", "l_linenumber": "lines"},
    )


@query(
    "mean_by",
    "SELECT o_orderpriority, round(avg(o_totalprice), 2) AS mean_price FROM orders GROUP BY o_orderpriority",
)
def _mean_by(spark, sf):
    m = A.mean_by(table(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice", "mean_price")
    return m.select("o_orderpriority", r("mean_price", 2))


@query("distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def _distinct(spark, sf):
    return A.distinct(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("value_counts", 'SELECT event_type, count(*) AS "count" FROM events GROUP BY event_type')
def _value_counts(spark, sf):
    return A.value_counts(table(spark, sf, "events"), "event_type")


@query(
    "min_max", 'SELECT min(l_extendedprice) AS "min", max(l_extendedprice) AS "max" FROM lineitem'
)
def _min_max(spark, sf):
    return A.min_max(table(spark, sf, "lineitem"), "l_extendedprice")


@query(
    "having_min_rows",
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) >= 10",
)
def _having_min_rows(spark, sf):
    n = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return A.having_min_rows(n, "n", 10)


@query(
    "argmax_columns",
    """SELECT l_suppkey, CASE greatest(f, o, q) WHEN f THEN 'f' WHEN o THEN 'o' ELSE 'q' END AS best,
CASE least(f, o, q) WHEN f THEN 'f' WHEN o THEN 'o' ELSE 'q' END AS worst FROM
(SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A') AS f, count(*) FILTER (l_returnflag = 'N') AS o,
count(*) FILTER (l_returnflag = 'R') AS q FROM lineitem GROUP BY l_suppkey)""",
)
def _argmax_columns(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        *[
            F.count(F.when(F.col("l_returnflag") == flag, 1)).alias(name)
            for flag, name in (("A", "f"), ("N", "o"), ("R", "q"))
        ]
    )
    return counts.select(
        "l_suppkey",
        C.argmax_name(["f", "o", "q"]).alias("best"),
        C.argmin_name(["f", "o", "q"]).alias("worst"),
    )


@query(
    "pair_by_key",
    """SELECT l_orderkey, count(*) AS rows, count(*) = 2 AS complete,
CASE WHEN count(*) = 2 THEN min(l_shipdate) END AS l_shipdate_1, CASE WHEN count(*) = 2 THEN max(l_shipdate) END AS l_shipdate_2
FROM lineitem GROUP BY l_orderkey""",
)
def _pair_by_key(spark, sf):
    return A.pair_by_key(table(spark, sf, "lineitem"), "l_orderkey", "l_shipdate", ["l_shipdate"])


# --- Windows, ordering, sets -----------------------------------------------------------


@query(
    "forward_fill",
    """SELECT event_id, user_id, last_value(CASE WHEN event_id % 3 = 0 THEN value END IGNORE NULLS) OVER (
PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM events""",
)
def _forward_fill(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id", "user_id", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value")
    )
    return W.forward_fill(ev, ["value"], ["user_id"], "event_id", chunk=1_000)


@query(
    "rank_within",
    """SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority
ORDER BY md5(CAST(o_orderkey AS VARCHAR))) AS rank, count(*) OVER (PARTITION BY o_orderpriority) AS size FROM orders""",
)
def _rank_within(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return W.rank_within(o, ["o_orderpriority"], ["o_orderkey"], "rank", "size")


@query(
    "top_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def _top_k(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return O.top_k(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@query(
    "latest_keys",
    """SELECT o_custkey, max(o_orderdate) AS latest FROM orders GROUP BY o_custkey
ORDER BY latest DESC, o_custkey LIMIT 10""",
)
def _latest_keys(spark, sf):
    latest = table(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("latest"))
    return O.top_k(latest, [F.col("latest").desc(), F.col("o_custkey")], 10)


@query(
    "best_and_worst",
    """WITH v AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
b AS (SELECT 'best' AS side, row_number() OVER (ORDER BY n DESC, o_custkey) AS place, o_custkey, n FROM v),
w AS (SELECT 'worst' AS side, row_number() OVER (ORDER BY n, o_custkey DESC) AS place, o_custkey, n FROM v)
SELECT * FROM (SELECT * FROM b UNION ALL SELECT * FROM w) WHERE place <= 5""",
)
def _best_and_worst(spark, sf):
    n = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return O.best_and_worst(n, "n", "o_custkey", 5)


@query(
    "sort_by",
    "SELECT n_name, CASE WHEN n_nationkey % 4 <> 0 THEN n_regionkey END AS score FROM nation",
)
def _sort_by(spark, sf):
    n = table(spark, sf, "nation").select(
        "n_name", F.when(F.col("n_nationkey") % 4 != 0, F.col("n_regionkey")).alias("score")
    )
    return O.sort_by(n, "score", "n_name")


@query("sample_head")
def _sample_head(spark, sf):
    return O.sample_head(table(spark, sf, "orders"), 5)


@query(
    "sample_head_facts",
    "SELECT least(count(*), 5) AS rows, true AS all_known FROM orders",
)
def _sample_head_facts(spark, sf):
    orders = table(spark, sf, "orders")
    head = O.sample_head(orders, 5)
    known = head.join(orders.withColumn("known", F.lit(True)), orders.columns, "left")
    return known.agg(
        F.count(F.lit(1)).alias("rows"), F.bool_and(F.coalesce("known", F.lit(False))).alias("all_known")
    )


@query(
    "union_all",
    """SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier""",
)
def _union_all(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    s = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"))
    return U.union_all([c, s])


@query(
    "stack_sides",
    """SELECT l_orderkey, l_partkey AS side, l_quantity AS lead FROM lineitem
UNION ALL SELECT l_orderkey, l_suppkey, -l_quantity FROM lineitem""",
)
def _stack_sides(spark, sf):
    li = table(spark, sf, "lineitem")
    return U.stack_sides(li, "l_partkey", "l_suppkey", {"l_quantity": "lead"}, ["l_orderkey"], "side")


# --- Reports and quality ---------------------------------------------------------------


@query(
    "scoreboard",
    f"""WITH {LOG_CTE}, top AS (SELECT *, row_number() OVER (ORDER BY "GAME_ID" DESC, "MATCHUP") AS rn FROM log
WHERE "GAME_ID" IN (SELECT DISTINCT "GAME_ID" FROM log ORDER BY "GAME_ID" DESC LIMIT 11))
SELECT "GAME_ID", count(*) AS rows, count(*) = 2 AS complete,
CASE WHEN count(*) = 2 THEN any_value(wk) END AS "GAME_DATE_1", CASE WHEN count(*) = 2 THEN arg_min("MATCHUP", rn) END AS "MATCHUP_1",
{sql_round('CASE WHEN count(*) = 2 THEN arg_min("PTS", rn) END', 2)} AS "PTS_1",
CASE WHEN count(*) = 2 THEN any_value(wk) END AS "GAME_DATE_2", CASE WHEN count(*) = 2 THEN arg_max("MATCHUP", rn) END AS "MATCHUP_2",
{sql_round('CASE WHEN count(*) = 2 THEN arg_max("PTS", rn) END', 2)} AS "PTS_2" FROM top GROUP BY "GAME_ID" """,
)
def _scoreboard(spark, sf):
    log = game_log(spark, sf).withColumnRenamed("week", "GAME_DATE")
    board = reports.scoreboard(log, 11)
    return board.select(
        "GAME_ID", "rows", "complete", "GAME_DATE_1", "MATCHUP_1", r("PTS_1", 2), "GAME_DATE_2", "MATCHUP_2",
        r("PTS_2", 2),
    )


@query(
    "incomplete_games",
    """SELECT l_orderkey AS "GAME_ID", count(*) AS rows FROM lineitem GROUP BY l_orderkey HAVING count(*) <> 2""",
)
def _incomplete_games(spark, sf):
    return reports.incomplete_games(
        table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("GAME_ID"))
    )


def _schedule(spark, sf):
    """Three season types of a schedule from orders, unfinished ones without a result."""
    o = table(spark, sf, "orders")
    log = o.select(F.col("o_orderkey").alias("GAME_ID"), F.nullif("o_orderstatus", F.lit("O")).alias("WL"), "o_custkey")
    return [log.where(F.col("o_custkey") % 3 == i).drop("o_custkey") for i in range(3)]


_PLAN_SQL = f"""target AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'O'),
done AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_shipdate < TIMESTAMP '{_CUTOFF}')"""


@query(
    "load_plan",
    f'WITH {_PLAN_SQL} SELECT k AS "GAME_ID" FROM target EXCEPT SELECT k FROM done',
)
def _load_plan(spark, sf):
    done = _load_frames(spark, sf)[1].withColumnRenamed("k", "game_id")
    return reports.load_plan(_schedule(spark, sf), done)


@query(
    "load_plan_status",
    f"""WITH {_PLAN_SQL} SELECT (SELECT count(*) FROM target) AS target, (SELECT count(*) FROM done) AS done,
(SELECT count(*) FROM (SELECT k FROM target EXCEPT SELECT k FROM done)) AS to_do""",
)
def _load_plan_status(spark, sf):
    done = _load_frames(spark, sf)[1].withColumnRenamed("k", "game_id")
    return reports.load_plan_status(_schedule(spark, sf), done)


@query(
    "completeness",
    "SELECT l_orderkey, count(*) AS rows FROM lineitem GROUP BY l_orderkey HAVING count(*) <> 4",
)
def _completeness(spark, sf):
    return Q.completeness(table(spark, sf, "lineitem"), "l_orderkey", 4)


@query(
    "unique_key",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1""",
)
def _unique_key(spark, sf):
    return Q.unique_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "orphan_keys",
    """SELECT DISTINCT l_partkey AS "key" FROM lineitem WHERE NOT EXISTS
(SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 25)""",
)
def _orphan_keys(spark, sf):
    return Q.orphan_keys(
        table(spark, sf, "lineitem"), "l_partkey", table(spark, sf, "part").where("p_size > 25"), "p_partkey"
    )


def _given(spark, sf, names):
    return {n: table(spark, sf, n) for n in names}


@query(
    "health",
    """SELECT 'orders' AS table_name, count(*) AS rows, 'OK' AS status FROM orders
UNION ALL SELECT 'lineitem', count(*), 'OK' FROM lineitem
UNION ALL SELECT 'no_orders', 0, 'EMPTY' UNION ALL SELECT 'partsupp', NULL, 'NOT_FOUND'""",
)
def _health(spark, sf):
    tables = _given(spark, sf, ["orders", "lineitem"])
    tables["no_orders"] = tables["orders"].where("o_totalprice < 0")
    return Q.health(spark, tables, ["orders", "lineitem", "no_orders", "partsupp"])


@query(
    "profile",
    """WITH c AS (SELECT 'supplier' AS t, count(*) AS n FROM supplier UNION ALL SELECT 'nation', count(*) FROM nation)
SELECT t AS table_name, p AS position, col AS column_name, ty AS data_type, n AS rows, CAST(NULL AS VARCHAR) AS error
FROM c JOIN (VALUES ('supplier', 0, 's_suppkey', 'bigint'), ('supplier', 1, 's_name', 'string'),
('supplier', 2, 's_nationkey', 'int'), ('supplier', 3, 's_acctbal', 'double'), ('nation', 0, 'n_nationkey', 'int'),
('nation', 1, 'n_name', 'string'), ('nation', 2, 'n_regionkey', 'int')) v(tt, p, col, ty) ON tt = t
UNION ALL SELECT 'partsupp', NULL, NULL, NULL, NULL, 'no such table'""",
)
def _profile(spark, sf):
    return Q.profile(spark, _given(spark, sf, ["supplier", "nation"]), {"partsupp": "no such table"})


@query(
    "audit_schema",
    """SELECT 'part' AS table_name, 'MISSING_COLUMNS' AS status, 'p_container,p_mfgr' AS missing, 'p_name' AS extra,
'p_size' AS retyped, count(*) AS rows FROM part
UNION ALL SELECT 'nation', 'OK', '', '', '', count(*) FROM nation
UNION ALL SELECT 'partsupp', 'MISSING_TABLE', 'ps_partkey,ps_suppkey', '', '', NULL""",
)
def _audit_schema(spark, sf):
    from pyspark.sql.types import StructType

    declared = {
        "part": "p_partkey bigint, p_mfgr string, p_brand string, p_type string, p_size bigint, "
        "p_container string, p_retailprice double",
        "nation": "n_nationkey int, n_name string, n_regionkey int",
        "partsupp": "ps_partkey bigint, ps_suppkey bigint",
    }
    registry = {t: StructType.fromDDL(ddl) for t, ddl in declared.items()}
    return Q.audit_schema(spark, registry, _given(spark, sf, ["part", "nation"]), with_rows=True)


# --- Key sets, quantiles, column reports -----------------------------------------------


@query(
    "count_distinct_keys",
    "SELECT l_suppkey, count(DISTINCT l_orderkey) AS games FROM lineitem GROUP BY l_suppkey",
)
def _count_distinct_keys(spark, sf):
    return K.count_distinct_keys(table(spark, sf, "lineitem"), ["l_suppkey"], "l_orderkey", "games")


@query("key_set_difference", _TODO_SQL)
def _key_set_difference(spark, sf):
    return K.key_difference(*_load_frames(spark, sf), "k")


@query(
    "key_set_sizes",
    f"""WITH t AS (SELECT DISTINCT o_orderkey - 700 AS k FROM orders WHERE o_orderkey % 9 <> 0),
d AS (SELECT DISTINCT l_orderkey - 700 AS k FROM lineitem WHERE l_shipdate < TIMESTAMP '{_CUTOFF}')
SELECT (SELECT count(*) FROM t) AS target, (SELECT count(*) FROM d) AS done,
(SELECT count(*) FROM t JOIN d USING (k)) AS both, (SELECT count(*) FROM t ANTI JOIN d USING (k)) AS to_do,
(SELECT count(*) FROM d ANTI JOIN t USING (k)) AS surplus""",
)
def _key_set_sizes(spark, sf):
    """Also below zero; some loaded games are not in the plan."""
    target, done = (df.withColumn("k", F.col("k") - 700) for df in _load_frames(spark, sf))
    return K.set_sizes(target.where((F.col("k") + 700) % 9 != 0), done, "k")


_NATION_PRICES = """SELECT n_name AS nation, o_totalprice AS price FROM orders JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey"""


def _nation_prices(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    prices = table(spark, sf, "orders").join(customer, F.col("c_custkey") == F.col("o_custkey"))
    prices = prices.join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
    return prices.select(F.col("n_name").alias("nation"), F.col("o_totalprice").alias("price"))


@query(
    "quantiles_by_group",
    f"""WITH p AS ({_NATION_PRICES}), q AS (SELECT unnest([0.0, 0.25, 0.5, 0.75, 0.99, 1.0]) AS share),
ranked AS (SELECT nation, price, row_number() OVER (PARTITION BY nation ORDER BY price) AS nr,
count(*) OVER (PARTITION BY nation) AS n FROM p)
SELECT nation, CAST(share AS DOUBLE) AS share, min(price) AS value FROM ranked JOIN q ON nr >= greatest(ceil(CAST(share AS DOUBLE) * n), 1)
GROUP BY ALL""",
)
def _quantiles_by_group(spark, sf):
    return N.exact_quantiles(_nation_prices(spark, sf), ["nation"], "price", [0, 0.25, 0.5, 0.75, 0.99, 1], bins=16, bin_rows=8)


@query(
    "quartiles_by_group",
    f"""WITH p AS ({_NATION_PRICES}) SELECT nation, quantile_disc(price, 0.25) AS q1, median(price) AS median,
quantile_disc(price, 0.75) AS q3 FROM p GROUP BY nation""",
)
def _quartiles_by_group(spark, sf):
    prices = _nation_prices(spark, sf)
    ends = N.exact_quantiles(prices, ["nation"], "price", [0.25, 0.75])
    both = ends.groupBy("nation").agg(
        F.max(F.when(F.col("share") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("share") == 0.75, F.col("value"))).alias("q3"),
    )
    return both.join(N.exact_medians(prices, ["nation"], "price"), "nation")


@query(
    "has_columns",
    """SELECT c.name AS column_name, d.data_type IS NOT NULL AS found, CASE d.data_type WHEN 'BIGINT' THEN 'bigint'
WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' END AS data_type
FROM (VALUES ('o_orderkey'), ('o_totalprice'), ('o_orderstatus'), ('o_referee')) AS c(name)
LEFT JOIN (SELECT column_name, data_type FROM duckdb_columns() WHERE table_name = 'orders' UNION
           SELECT column_name, column_type FROM (DESCRIBE orders)) d ON d.column_name = c.name""",
)
def _has_columns(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return Q.column_report(orders, ["o_orderkey", "o_totalprice", "o_orderstatus", "o_referee"])


def _profile_sql(column: str) -> str:
    text = {"o_orderpriority": "v", "o_orderstatus": "v"}.get(column, "CAST(v AS VARCHAR)")
    value = f"CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE {column} END"
    return f"""SELECT '{column}' AS column_name, count(*) AS rows, count(*) - count(v) AS nulls,
round((count(*) - count(v)) / count(*), 4) AS null_share, {text.replace('v', 'min(v)', 1)} AS smallest,
{text.replace('v', 'max(v)', 1)} AS largest, count(DISTINCT v) AS distinct_values,
(SELECT max(c) FROM (SELECT count(*) AS c FROM (SELECT {value} AS v FROM orders) WHERE v IS NOT NULL GROUP BY v)) AS most
FROM (SELECT {value} AS v FROM orders)"""


@query(
    "column_profile",
    " UNION ALL ".join(_profile_sql(c) for c in ("o_orderstatus", "o_orderpriority")),
)
def _column_profile(spark, sf):
    """Columns of few values, so that the sketches are exact."""
    cols = ["o_orderstatus", "o_orderpriority"]
    orders = table(spark, sf, "orders").select(*[F.when(F.col("o_orderkey") % 8 != 0, F.col(c)).alias(c) for c in cols])
    found = Q.column_profile(orders)
    return found.select(
        "column_name", "rows", "nulls", F.round("null_share", 4).alias("null_share"), "smallest", "largest",
        "distinct_values", F.array_max(F.transform("frequent", lambda e: e["count"])).alias("most"),
    )

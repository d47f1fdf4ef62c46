"""Registry, table access and the closing-points binding shared by the queries.

A game is (user, ISO week of ts): its id is user * 100 + week, its home team the
nation of that customer, its away team the nation of supplier (user + week) % suppliers.
The period is the quarter of the day, the event number the event id, the home
score the event's value and the away score ``k`` of its props.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtstats.operators.joins import star_join
from courtstats.plans.closing import closing_points, period_end_scores
from courtstats.session import drop_folder, materialize, new_folder, path_exists

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its oracle SQL if SQL can state it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


# Declared schemas of the given tables: a read then starts without an inference job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def in_folders(fn: Callable) -> Query:
    """A query that writes: ``fn`` also gets a maker of fresh shared folders, which are removed again.

    The result is stored first, so that it doesn't need the folders any more.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made: list[str] = []

        def folder(label: str) -> str:
            made.append(new_folder(spark, label))
            return made[-1]

        result = materialize(fn(spark, sf_dir, folder))
        for path in made:
            if path_exists(spark, path):
                drop_folder(spark, path)
        return result

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play-by-play rows of the binding, one per event."""
    week = F.weekofyear("ts")
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") * 100 + week).alias("game_id"),
        "user_id",
        week.alias("week"),
        (F.floor(F.hour("ts") / 6) + 1).cast("int").alias("period"),
        F.col("event_id").alias("event_num"),
        F.col("value").alias("score_home"),
        F.get_json_object("props", "$.k").alias("score_away"),
        "event_type",
    )


def with_teams(games: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds home_team and away_team to rows that hold user_id and week."""
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier")
    suppliers = supplier.agg(F.count(F.lit(1)).alias("n")).scalar()
    keyed = games.withColumn("away_key", (F.col("user_id") + F.col("week")) % suppliers)
    return star_join(
        keyed,
        [
            ("user_id", customer, "c_custkey", {"c_nationkey": "home_nation"}),
            ("away_key", supplier, "s_suppkey", {"s_nationkey": "away_nation"}),
            ("home_nation", nation, "n_nationkey", {"n_name": "home_team"}),
            ("away_nation", nation, "n_nationkey", {"n_name": "away_team"}),
        ],
    ).drop("away_key", "home_nation", "away_nation")


def game_rows(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """One row per game: keys, q3 and final scores, both teams."""
    ends = period_end_scores(events(spark, sf_dir), keys=["user_id", "week"], **options)
    named = ends.withColumn("game_id", F.col("user_id") * 100 + F.col("week"))
    return with_teams(named, spark, sf_dir)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closing points of the binding: game_id, Team, Side, Q3_Lead, Final_Result."""
    return closing_points(game_rows(spark, sf_dir), keep=["game_id"])


def r(name: str, decimals: int = 4, alias: str | None = None):
    """Rounded output column without a negative zero."""
    short = f"round(`{name}`, {decimals})"
    return F.expr(f"if({short} = 0, 0D, {short})").alias(alias or name)


# --- Oracle text ---------------------------------------------------------------------

EVENTS_CTE = """
ev AS (
  SELECT user_id * 100 + week(ts) AS game_id, user_id, week(ts) AS wk,
         hour(ts) // 6 + 1 AS period, event_id AS event_num, event_type,
         value AS h, CAST(regexp_extract(props, '"k": *([0-9.]+)', 1) AS DOUBLE) AS a
  FROM events
)"""

ENDS_CTE = EVENTS_CTE + """,
q3 AS (
  SELECT game_id, user_id, wk, h, a FROM ev WHERE period = 3
  QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY event_num DESC) = 1
),
fin AS (
  SELECT game_id, h, a FROM ev WHERE period = 4
  QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY event_num DESC) = 1
),
game AS (
  SELECT q3.game_id, q3.user_id, q3.wk, q3.h AS q3_h, q3.a AS q3_a, fin.h AS f_h, fin.a AS f_a,
         hn.n_name AS home_team, an.n_name AS away_team
  FROM q3 JOIN fin ON q3.game_id = fin.game_id
  JOIN customer c ON c.c_custkey = q3.user_id JOIN nation hn ON hn.n_nationkey = c.c_nationkey
  JOIN supplier s ON s.s_suppkey = (q3.user_id + q3.wk) % (SELECT count(*) FROM supplier)
  JOIN nation an ON an.n_nationkey = s.s_nationkey
)"""

POINTS_CTE = ENDS_CTE + """,
pts AS (
  SELECT game_id, home_team AS team, 'home' AS side, q3_h - q3_a AS x, f_h - f_a AS y FROM game
  UNION ALL
  SELECT game_id, away_team, 'away', -(q3_h - q3_a), -(f_h - f_a) FROM game
)"""


def sql_round(expr: str, decimals: int = 4) -> str:
    """Rounded double without a negative zero."""
    return f"(CASE WHEN round({expr}, {decimals}) = 0 THEN 0.0 ELSE round({expr}, {decimals}) END)"


def ladder_ctes(source: str, name: str, degree: int, by: Sequence[str] = (), scale: float = 64.0) -> str:
    """CTEs that fit a polynomial in SQL: sums, one elimination step per column, coefficients.

    ``source`` has columns x and y and those in ``by``. The result CTE ``name`` has the
    ``by`` columns, n and b0..bd (in powers of x).
    """
    keys = "".join(f"{c}, " for c in by)
    group = f" GROUP BY {', '.join(by)}" if by else ""
    size = degree + 1
    cells = [f"sum(pow(x / {scale}, {i + j})) AS m_{i}_{j}" for i in range(size) for j in range(size)]
    cells += [f"sum(pow(x / {scale}, {i}) * y) AS m_{i}_{size}" for i in range(size)]
    out = [f"{name}_e0 AS (SELECT {keys}count(*) AS n, {', '.join(cells)} FROM {source}{group})"]
    for k in range(size):
        nxt = []
        for i in range(size):
            for j in range(size + 1):
                if i == k:
                    nxt.append(f"m_{k}_{j} / m_{k}_{k} AS m_{i}_{j}")
                else:
                    nxt.append(f"m_{i}_{j} - m_{i}_{k} * m_{k}_{j} / m_{k}_{k} AS m_{i}_{j}")
        out.append(f"{name}_e{k + 1} AS (SELECT {keys}n, {', '.join(nxt)} FROM {name}_e{k})")
    coefs = ", ".join(f"m_{i}_{size} / pow({scale}, {i}) AS b{i}" for i in range(size))
    out.append(f"{name} AS (SELECT {keys}n, {coefs} FROM {name}_e{size})")
    return ",\n".join(out)


def horner_sql(degree: int, alias: str, x: str = "x") -> str:
    text = f"{alias}.b{degree}"
    for k in range(degree - 1, -1, -1):
        text = f"({text} * {x} + {alias}.b{k})"
    return text

"""Join operators.

No join carries a broadcast hint: Spark broadcasts a side only when its size,
estimated or measured by AQE, is under ``spark.sql.autoBroadcastJoinThreshold``,
and AQE splits skewed partitions of the joins that shuffle. ``split_hot`` splits the
frequent keys of the fact table beforehand (:mod:`courtstats.operators.hot_keys`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtstats.operators.hot_keys import HotKeys, hot_join, hot_keys


def star_join(
    fact: DataFrame, dims: Sequence[tuple[str, DataFrame, str, Mapping[str, str]]], split_hot: bool = False
) -> DataFrame:
    """Inner-join dimensions to a fact.

    Each entry is (fact column, dimension, dimension key, {dimension column: output name});
    one dimension may appear several times, e.g. for the home and the away team. ``split_hot`` reads the
    fact's own key columns once more to find frequent keys; columns that a dimension adds are joined as they are.
    """
    hot = hot_keys(fact, list({(d[0],): None for d in dims if d[0] in fact.columns})) if split_hot else {}
    out = fact
    for i, (fact_col, dim, key, columns) in enumerate(dims):
        join_key = f"__dim_key_{i}"
        side = dim.select(
            F.col(key).alias(join_key), *[F.col(c).alias(name) for c, name in columns.items()]
        )
        if hot.get((fact_col,)):
            joined = hot_join(out, side.withColumnRenamed(join_key, fact_col), [fact_col], hot)
            out = joined.select(*out.columns, *columns.values())
        else:
            out = out.join(side, out[fact_col] == side[join_key], "inner")
    return out.drop(*[f"__dim_key_{i}" for i in range(len(dims))])


def pair_sides(
    home: DataFrame,
    away: DataFrame,
    key: str,
    suffixed: Sequence[str],
    suffixes: tuple[str, str] = ("_home", "_away"),
) -> DataFrame:
    """One row per game: home rows keep all columns, away rows add the suffixed ones."""
    left = home.withColumnsRenamed({c: c + suffixes[0] for c in suffixed})
    right = away.select(key, *[F.col(c).alias(c + suffixes[1]) for c in suffixed])
    return left.join(right, key, "inner")


def merge_facets(facets: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Inner-join frames on a composite key; the earliest frame owns a shared column.

    Each later frame is cut to the columns no earlier frame has, so nothing gets
    a suffix and nothing is lost to one.
    """
    out = facets[0]
    owned = set(out.columns)
    for facet in facets[1:]:
        fresh = [c for c in facet.columns if c not in owned]
        out = out.join(facet.select(*keys, *fresh), list(keys), "inner")
        owned.update(fresh)
    return out


def one_player(players: DataFrame, player: str | int) -> int:
    """Id of a player given by id or by a full name that only one player bears.

    A name of several players is refused, as their rows would be added up.
    """
    if isinstance(player, int):
        return player
    found = [r[0] for r in players.where(F.col("full_name") == player).select("player_id").distinct().take(2)]
    if len(found) != 1:
        raise ValueError(f"{player!r} is the name of {'several players' if found else 'no player'}; give an id")
    return found[0]


def matchup_sides(
    matchups: DataFrame, box_scores: DataFrame, attacker_id: int | None = None, hot: HotKeys | None = None
) -> DataFrame:
    """Matchups with both team ids, teammates removed. Only numbers beside the game id.

    A report on one attacker first cuts all three inputs: the matchups and the attackers' box scores
    to that player, the defenders' box scores to the player's games. ``hot``: frequent keys of the matchups.
    """
    stats = box_scores.select("game_id", "player_id", "team_id")
    off_team = stats.withColumnsRenamed({"player_id": "off_player_id", "team_id": "off_team_id"})
    def_team = stats.withColumnsRenamed({"player_id": "def_player_id", "team_id": "def_team_id"})
    if attacker_id is not None:
        matchups = matchups.where(F.col("off_player_id") == attacker_id)
        off_team = off_team.where(F.col("off_player_id") == attacker_id)
        def_team = def_team.join(off_team.select("game_id"), "game_id", "left_semi")
    named = _split_join(matchups.drop("team_id"), off_team, ["game_id", "off_player_id"], hot)
    both = _split_join(named, def_team, ["game_id", "def_player_id"], hot)
    return both.where(F.col("def_team_id") != F.col("off_team_id"))


def _split_join(big: DataFrame, other: DataFrame, keys: list[str], hot: HotKeys | None) -> DataFrame:
    return big.join(other, keys) if hot is None else hot_join(big, other, keys, hot)


def defender_names(
    rows: DataFrame, players: DataFrame, teams: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Adds the defender's name and team by their ids; the team id goes."""
    names = players.select(
        F.col("player_id").alias("def_player_id"), F.col("full_name").alias("defender")
    )
    abbr = teams.select(F.col("team_id").alias("def_team_id"), F.col("abbreviation").alias("team"))
    return _split_join(rows, names, ["def_player_id"], hot).join(abbr, "def_team_id").drop("def_team_id")


_MATCHUP_KEYS = [["game_id", "off_player_id"], ["game_id", "def_player_id"], ["def_player_id"], ["off_player_id"]]


def matchup_join(
    matchups: DataFrame,
    players: DataFrame,
    box_scores: DataFrame,
    teams: DataFrame,
    attacker: str | int | None = None,
    split_hot: bool = False,
) -> DataFrame:
    """Matchup rows with both names and the defender's team, teammates removed.

    ``split_hot`` finds the frequent keys of all four joins in one pass over the matchups.
    """
    chosen = None if attacker is None else one_player(players, attacker)
    hot = hot_keys(matchups, _MATCHUP_KEYS) if split_hot else None
    named = defender_names(matchup_sides(matchups, box_scores, chosen, hot), players, teams, hot)
    off = players.select(
        F.col("player_id").alias("off_player_id"), F.col("full_name").alias("attacker")
    )
    return _split_join(named, off, ["off_player_id"], hot)


def missing_keys(target: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct target keys that ``done`` does not hold."""
    keys = list(keys)
    return target.select(*keys).distinct().join(done.select(*keys), keys, "left_anti")


def feature_join(features: DataFrame, extra: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Inner join of two per-group feature tables."""
    return features.join(extra.select(key, *cols), key, "inner")

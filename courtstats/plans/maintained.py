"""Closing analyses kept up to date: a reload costs its own games, not the seasons before it.

Two snapshot tables share their versions. ``points`` is a log of closing points with a sign: a reloaded game's old points
are entered again with a minus, its new ones with a plus, and points that stay as they were not at all. ``sums`` holds the power sums per group
and situation; a reload adds the signed sums of its own points to the groups it touches. Both change in one commit, so
readers never see points without their sums, and a batch that is run again changes nothing.

Sums that are subtracted again must be those that were added, so x is divided by a fixed ``scale`` about zero instead of the data's own mean
and deviation. With whole numbers below about 2^9 and a scale that is a power of two all sums are exact, however often games
are reloaded; other numbers gather rounding of a few units in the last digits per reload.

Not maintained: cross-validated degrees. Their folds are balanced by rank, so a new game moves others between folds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtstats.functions.columns import cut
from courtstats.functions.polynomial import add_up, lower_degree, power_sums
from courtstats.operators import fit
from courtstats.operators.aggregates import pivot_mean
from courtstats.plans import closing
from courtstats.plans.closing import TEAM, X, Y
from courtstats.schemas import SITUATION_EDGES, SITUATION_LABELS
from courtstats.session import materialize
from courtstats.sources.snapshots import ATTEMPTS, Conflict, SnapshotTables, Version, same

SIDE, SITUATION, SIGN = "Side", "Situation", "sign"


class MaintainedClosing:
    """Ranking, matrix and curves of all games loaded so far, from power sums."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        by: Sequence[str] = (),
        key: str = "game_id",
        degree: int = 3,
        scale: float = 16.0,
        edges: Sequence[float] = SITUATION_EDGES,
        labels: Sequence[str] = SITUATION_LABELS,
        buckets: int = 64,
    ):
        """``by`` names columns that separate leagues (say, the season); points and analyses have them beside the team."""
        self.store = SnapshotTables(spark, root, buckets)
        self.by, self.key, self.degree, self.scale = list(by), key, degree, scale
        self.edges, self.labels = edges, labels
        self.groups = [*self.by, TEAM, SITUATION]
        self.columns = [key, *self.by, TEAM, SIDE, X, Y]

    def _sums(self, signed: DataFrame) -> DataFrame:
        """Power sums of signed points per group and situation."""
        z = signed.withColumn(SITUATION, cut(F.col(X), self.edges, self.labels)).withColumn("__z", F.col(X) / self.scale)
        by_sign = z.groupBy(*self.groups, SIGN).agg(power_sums("__z", Y, self.degree).alias("moments"))
        times = by_sign.withColumn("moments", F.transform("moments", lambda m: m * F.col(SIGN)))
        return self._added(times)

    def _added(self, sums: DataFrame) -> DataFrame:
        return sums.groupBy(*self.groups).agg(add_up("moments", self.degree).alias("moments"))

    def reload(
        self, points: DataFrame, games: DataFrame | None = None, run_id: str | None = None, batch_id: int | None = None
    ) -> Version:
        """Replace the points of the games that ``points`` holds, and remove those of further ``games``.

        Games are rows of the key. Points lacking a team, x or y count as not there; null keys are keys like any other.
        Only folders that may hold one of the games are read, only groups with a changed point are written.
        """
        points = points.select(
            *[F.col(c).cast("double").alias(c) if c in (X, Y) else F.col(c) for c in self.columns]
        )
        sent = points.select(self.key)
        sent = (sent if games is None else sent.union(games.select(self.key))).distinct()
        full = points.dropna(subset=[TEAM, X, Y]).withColumn(SIGN, F.lit(1))
        for attempt in range(ATTEMPTS):
            base = self.store.latest()
            if run_id is not None and base.applied.get(run_id, -1) >= batch_id:
                return base
            change = full
            if "points" in base.tables:
                stored = self.store.candidates(base, "points", sent)
                old = stored.join(sent, same(stored, sent, [self.key]), "left_semi")
                change = full.unionByName(old.withColumn(SIGN, -F.col(SIGN)))
            # Equal points of a game count as often as they occur; what cancels out is no change.
            net = change.groupBy(*self.columns).agg(F.sum(SIGN).cast("int").alias(SIGN)).where(F.col(SIGN) != 0)
            net = materialize(net)
            try:
                return self.store.commit(base, [self._points(base, net), self._changed(base, net)], run_id, batch_id)
            except Conflict:
                if attempt == ATTEMPTS - 1:
                    raise
        raise AssertionError

    def _points(self, base: Version, net: DataFrame):
        return self.store.stage(base, "points", net, [self.key])

    def _changed(self, base: Version, net: DataFrame):
        """The sums of all groups of the teams that the change touches."""
        keys = [*self.by, TEAM]
        touched = net.select(*keys).distinct()
        now = self._sums(net)
        if "sums" in base.tables:
            stored = self.store.candidates(base, "sums", touched)
            before = stored.join(touched, same(stored, touched, keys), "left_semi")
            now = self._added(now.unionByName(before.select(*now.columns)))
        # A situation that no point is left in has no sums.
        return self.store.stage_replacement(base, "sums", now.where("round(moments[0]) > 0"), keys, gone=touched)

    # --- Analyses -----------------------------------------------------------------------

    def points(self, version: Version | int | None = None) -> DataFrame:
        """The closing points of all games, as of a version."""
        held = self.store.read("points", version).groupBy(*self.columns).agg(F.sum(SIGN).alias(SIGN))
        return held.where(F.col(SIGN) > 0).withColumn("__n", F.explode(F.sequence(F.lit(1), F.col(SIGN)))).select(*self.columns)

    def sums(self, degree: int, by: Sequence[str], version: Version | int | None = None) -> DataFrame:
        """Power sums of a degree up to the kept one, per group: rows as :func:`fit.moment_sums` gives them."""
        if degree > self.degree:
            raise ValueError(f"sums are kept for degrees up to {self.degree}")
        lower = self.store.read("sums", version).withColumn("moments", lower_degree("moments", self.degree, degree))
        placed = lower.withColumns({"centre": F.lit(0.0), "scale": F.lit(float(self.scale))})
        return fit.roll_up(placed, degree, list(by))

    def closer_ranking(self, version: Version | int | None = None) -> DataFrame:
        """As :func:`closing.closer_ranking`, within each league."""
        by = [*self.by, TEAM]
        means = fit.residual_means_of(self.sums(1, by, version), 1, by, self.by)
        return means.select(*by, "n", F.col("mean_residual").alias("points_gained"))

    def situational_matrix(
        self, degree: int = 3, fill: float | None = None, version: Version | int | None = None
    ) -> DataFrame:
        """As :func:`closing.situational_matrix`, over all games."""
        by = [TEAM, SITUATION]
        means = fit.residual_means_of(self.sums(degree, by, version), degree, by)
        return pivot_mean(means, TEAM, SITUATION, "mean_residual", list(self.labels), fill)

    def team_shapes(
        self, low: float = -25.0, high: float = 25.0, grid: int = 100, more_than: int = 4, version: Version | int | None = None
    ) -> DataFrame:
        """As :func:`closing.team_shapes`, over all games."""
        return closing.shapes_of(self.sums(self.degree, [TEAM], version), self.degree, low, high, grid, more_than)

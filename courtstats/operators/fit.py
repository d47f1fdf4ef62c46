"""Regression operators. Points stay distributed; only sums of powers move."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtstats.functions.polynomial import (
    add_up,
    collapsed_sums,
    error_sum,
    fit_ladder,
    horner,
    horner_array,
    mean_gap,
    power_sums,
    shift_back,
    sigmoid,
    y_variation,
)
from courtstats.operators.windows import rank_within


def linear_fit(points: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Ordinary least squares slope and intercept, with the point count and R2."""
    return points.groupBy(*by).agg(
        F.regr_count(y, x).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which a null key meets a null key; the keys of ``left`` stay."""
    renamed = right.withColumnsRenamed({k: f"__on_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__on_{k}"]) for k in keys])
    return left.join(renamed, same).drop(*[f"__on_{k}" for k in keys])


def moment_sums(
    points: DataFrame,
    x: str,
    y: str,
    degree: int,
    by: Sequence[str] = (),
    centre_by: Sequence[str] | None = None,
) -> DataFrame:
    """Column ``moments`` of power sums per group, with ``centre`` and ``scale``.

    The sums are those of (x - centre) / scale, with the mean and the deviation of x from a first small
    aggregate: powers of columns far from zero would lose all digits. Sums that are to be
    added up must share a centre, that of the coarser groups ``centre_by`` (default: the groups
    themselves). Rows lacking x or y are left out.
    """
    outer = list(by if centre_by is None else centre_by)
    xy = points.select(
        *by, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y")
    ).dropna(subset=["__x", "__y"])
    spread = F.stddev_pop("__x")
    at = [F.avg("__x").alias("centre"), F.when(spread > 0, spread).otherwise(1.0).alias("scale")]
    if outer:
        placed = _null_safe_join(xy, xy.groupBy(*outer).agg(*at), outer)
    else:
        placed = xy.withColumn("__at", xy.agg(F.struct(*at).alias("at")).scalar()).select(
            *xy.columns, "__at.centre", "__at.scale"
        )
    scaled = placed.withColumn("__x", (F.col("__x") - F.col("centre")) / F.col("scale"))
    return scaled.groupBy(*by).agg(
        power_sums("__x", "__y", degree).alias("moments"),
        F.max("centre").alias("centre"),
        F.max("scale").alias("scale"),
    )


def roll_up(sums: DataFrame, degree: int, by: Sequence[str] = ()) -> DataFrame:
    """Power sums of coarser groups from those of finer ones that share a centre."""
    return sums.groupBy(*by).agg(
        add_up("moments", degree).alias("moments"),
        F.max("centre").alias("centre"),
        F.max("scale").alias("scale"),
    )


def _point_count() -> Column:
    return F.col("moments")[0].cast("long")


def _r2(sse: str, degree: int) -> Column:
    variation = y_variation("moments", degree)
    return F.expr(f"if({variation} > 0, 1 - {sse} / {variation}, null)")


def solve_sums(sums: DataFrame, degree: int, by: Sequence[str] = (), center: float = 0.0) -> DataFrame:
    """Fit of one degree per row of power sums: n, coef (ascending in x - center), sse, r2."""
    fits = sums.withColumn("__fit", fit_ladder("moments", degree)[degree])
    return fits.select(
        *by,
        _point_count().alias("n"),
        shift_back("__fit.coef", degree, f"centre - {float(center)!r}D", "scale").alias("coef"),
        F.col("__fit.sse").alias("sse"),
        _r2("__fit.sse", degree).alias("r2"),
    )


def poly_fit(
    points: DataFrame, x: str, y: str, degree: int, by: Sequence[str] = (), center: float = 0.0
) -> DataFrame:
    """Least-squares polynomial per group.

    ``coef`` is ascending in powers of (x - center). The fit itself is centred on the group's own mean,
    whatever ``center`` is; a center near the data keeps the coefficients small.
    """
    return solve_sums(moment_sums(points, x, y, degree, by), degree, by, center)


def solve_all_degrees(
    sums: DataFrame, degrees: Sequence[int], by: Sequence[str] = ()
) -> DataFrame:
    """Every degree solved from one set of power sums, one row per degree."""
    top = max(degrees)
    return (
        sums.select(*by, "moments", "centre", "scale", F.explode(fit_ladder("moments", top)).alias("__fit"))
        .where(F.col("__fit.degree").isin(*degrees))
        .select(
            *by,
            F.col("__fit.degree").alias("degree"),
            _point_count().alias("n"),
            shift_back("__fit.coef", top, "centre", "scale").alias("coef"),
            F.col("__fit.sse").alias("sse"),
            _r2("__fit.sse", top).alias("r2"),
        )
    )


def refit_all_degrees(points: DataFrame, x: str, y: str, degrees: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """Every degree fitted on all rows from one set of power sums, one row per degree."""
    return solve_all_degrees(moment_sums(points, x, y, max(degrees), by), degrees, by)


def refit_collapsed(collapsed: DataFrame, degrees: Sequence[int]) -> DataFrame:
    """:func:`refit_all_degrees` over the whole table, from the rows of :func:`collapse`."""
    n, x = F.col("n"), F.col("x")
    mean = F.sum(n * x) / F.sum(n)
    first = collapsed.agg(mean.alias("centre"), F.sum(n).alias("total")).select(F.struct("centre", "total").alias("at"))
    offset = collapsed.withColumn("__at", first.scalar()).withColumn("x", x - F.col("__at.centre"))
    width = F.sqrt(F.sum(n * x * x / F.col("__at.total")))
    scale = offset.agg(F.when(width > 0, width).otherwise(1.0).alias("s")).scalar()
    ready = offset.withColumn("scale", scale).withColumn("x", x / F.col("scale"))
    sums = ready.groupBy().agg(
        collapsed_sums(max(degrees)).alias("moments"),
        F.max("__at.centre").alias("centre"),
        F.max("scale").alias("scale"),
    )
    return solve_all_degrees(sums.where(F.col("moments")[0].isNotNull()), degrees)


def with_expected(
    points: DataFrame,
    fit: DataFrame,
    x: str,
    y: str,
    degree: int,
    by: Sequence[str] = (),
    center: float = 0.0,
) -> DataFrame:
    """Adds ``expected`` and ``residual`` per row.

    A league fit is one row and enters as a scalar subquery; group fits join on the group.
    """
    if by:
        rows = _null_safe_join(points, fit.select(*by, F.col("coef").alias("__coef")), list(by))
    else:
        rows = points.withColumn("__coef", fit.select("coef").scalar())
    at = f"(cast(`{x}` as double) - {float(center)!r}D)"
    return (
        rows.withColumn("expected", horner("__coef", at, degree))
        .withColumn("residual", F.col(y) - F.col("expected"))
        .drop("__coef")
    )


def residual_means(
    points: DataFrame, x: str, y: str, degree: int, by: Sequence[str], league: Sequence[str] = ()
) -> DataFrame:
    """Mean residual per group against a league-wide fit, with one pass over the points.

    Residual means are linear in the sums: mean(y) - sum(coef_k * mean(z^k)). The
    groups' power sums add up to the league's, so nothing reads the points again.
    """
    return residual_means_of(moment_sums(points, x, y, degree, by, league), degree, by, league)


def residual_means_of(sums: DataFrame, degree: int, by: Sequence[str], league: Sequence[str] = ()) -> DataFrame:
    """:func:`residual_means` from power sums per group that share a centre within their league."""
    fit = roll_up(sums, degree, league).select(
        *league, fit_ladder("moments", degree)[degree]["coef"].alias("__coef")
    )
    if league:
        rows = _null_safe_join(sums, fit, list(league))
    else:
        rows = sums.withColumn("__coef", fit.select("__coef").scalar())
    return rows.select(
        *by,
        _point_count().alias("n"),
        mean_gap("__coef", "moments", degree).alias("mean_residual"),
    )


def r2_score(df: DataFrame, actual: str, expected: str, by: Sequence[str] = ()) -> DataFrame:
    """1 - SSE/SST of given predictions; the mean is taken around a stable variance."""
    error = F.col(actual) - F.col(expected)
    return (
        df.dropna(subset=[actual, expected])
        .groupBy(*by)
        .agg(
            F.sum(error * error).alias("sse"),
            (F.var_pop(actual) * F.count(F.lit(1))).alias("sst"),
        )
        .select(*by, (F.lit(1.0) - F.col("sse") / F.col("sst")).alias("r2"))
    )


def fold_by_hash(points: DataFrame, key: Sequence[str], k: int) -> DataFrame:
    """Column ``fold`` in 0..k-1 from a hash of the key; needs no shuffle."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key]))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return points.withColumn("fold", (number % F.lit(k)).cast("int"))


def fold_balanced(
    points: DataFrame, by: Sequence[str], key: Sequence[str], k: int, min_rows: int
) -> DataFrame:
    """Column ``fold`` with sizes that differ by at most one inside each group.

    Small groups get min(k, n // 2) folds, at least 2. Groups under ``min_rows`` are left out.
    """
    ranked = rank_within(points, by, key, "__rank", "__rows")
    splits = F.greatest(F.lit(2), F.least(F.lit(k), F.floor(F.col("__rows") / 2)))
    return (
        ranked.where(F.col("__rows") >= min_rows)
        .withColumn("fold", ((F.col("__rank") - 1) % splits).cast("int"))
        .drop("__rank", "__rows")
    )


def cross_validate(
    folded: DataFrame, x: str, y: str, degrees: Sequence[int], by: Sequence[str] = ()
) -> DataFrame:
    """Mean held-out MSE and R2 per degree over the folds in column ``fold``.

    One aggregate over (group, fold) feeds every degree and fold: the training
    sums of a fold are the group's total minus the fold's own. A degree that
    cannot be fitted in some fold gets NULL scores.
    """
    top = max(degrees)
    sums = moment_sums(folded, x, y, top, [*by, "fold"], by)
    # At most k rows per group reach this window.
    keys = ", ".join(f"`{c}`" for c in by) or "0"
    parts = sums.withColumn("total", add_up("moments", top, f" over (partition by {keys})"))
    train = F.expr("zip_with(total, moments, (t, m) -> t - m)")
    scored = parts.withColumn("train", train).select(
        *by, "moments", "total", F.explode(fit_ladder("train", top)).alias("fit")
    )
    per_fold = (
        scored.where(F.col("fit.degree").isin(*degrees))
        .withColumn("sse", error_sum("fit.coef", "moments", top))
        .select(
            *by,
            F.col("fit.degree").alias("degree"),
            F.col("total")[0].cast("long").alias("total"),
            (F.col("sse") / F.col("moments")[0]).alias("mse"),
            _r2("sse", top).alias("r2"),
        )
    )
    folds = F.count(F.lit(1))
    return per_fold.groupBy(*by, "degree").agg(
        F.first("total").alias("n"),
        folds.alias("folds"),
        F.when(F.count("mse") == folds, F.avg("mse")).alias("mse"),
        F.when(F.count("r2") == folds, F.avg("r2")).alias("r2"),
    )


def poly_cv(
    points: DataFrame, x: str, y: str, degrees: Sequence[int], k: int, key: Sequence[str]
) -> DataFrame:
    """k-fold cross-validation of several degrees over the whole table."""
    return cross_validate(fold_by_hash(points, key, k), x, y, degrees)


def poly_cv_by(
    points: DataFrame,
    x: str,
    y: str,
    by: Sequence[str],
    degrees: Sequence[int],
    k: int,
    key: Sequence[str],
    min_rows: int = 10,
) -> DataFrame:
    """Cross-validation per group with balanced folds."""
    return cross_validate(fold_balanced(points, by, key, k, min_rows), x, y, degrees, by)


def best_degree(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Degree with the smallest MSE; the lower degree wins a tie."""
    rank = F.struct(F.col("mse"), F.col("degree"))
    return scores.where(F.col("mse").isNotNull()).groupBy(*by).agg(
        F.min_by("degree", rank).alias("degree"), F.min("mse").alias("mse")
    )


def best_model(scores: DataFrame, name: str, score: str, order: str) -> DataFrame:
    """Row of the model with the largest score; the first in ``order`` wins a tie."""
    rank = F.struct(F.col(score), -F.col(order))
    return scores.where(F.col(score).isNotNull()).agg(
        F.max_by(name, rank).alias(name), F.max(score).alias(score)
    )


def linspace(low: float, high: float, points: int) -> Column:
    """Array of evenly spaced values, both ends included."""
    low, high, last = float(low), float(high), points - 1
    return F.expr(
        f"transform(sequence(0, {last}), "
        f"i -> if(i = {last}, {high!r}D, {low!r}D + i * ({high!r}D - {low!r}D) / {last}))"
    )


def curve_points(
    fit: DataFrame,
    low: float,
    high: float,
    points: int,
    keep: Sequence[str] = (),
    coef: str = "coef",
) -> DataFrame:
    """Fitted curves on an even grid: one row per kept key and x."""
    return (
        fit.where(F.col(coef).isNotNull())
        .select(*keep, F.col(coef).alias("__coef"), F.explode(linspace(low, high, points)).alias("x"))
        .select(*keep, "x", horner_array("__coef", "x").alias("y"))
    )


# --- Sigmoid -------------------------------------------------------------------------

_PARAMS = ("height", "x0", "k", "base")
_DAMPING_STEPS = (0.1, 1.0, 10.0, 100.0, 1000.0, 10000.0)


# Sums behind one trial: error, gradient g, and curvature h (upper triangle).
_STEP_SUMS = ["sum(syy - 2 * f * sy + n * f * f) as sse"]
_STEP_SUMS += [f"sum(d{i} * (sy - n * f)) as g{i}" for i in range(4)]
_STEP_SUMS += [f"sum(n * d{i} * d{j}) as h{i}{j}" for i in range(4) for j in range(i, 4)]


#: Distinct x up to which all steps run on the collapsed rows themselves, held as four arrays (2 MB).
LOCAL_ROWS = 65_536

# (error sum, gradient, curvature) of every trial parameter vector, by its number.
Step = Callable[[list[np.ndarray]], dict[int, tuple[float, np.ndarray, np.ndarray]]]


def _spark_step(collapsed: DataFrame) -> Step:
    """Several trials at once, in one job over all rows."""

    def step(trials: list[np.ndarray]):
        literals = [
            f"named_struct('i', {i}, " + ", ".join(f"'{p}', {float(v)!r}D" for p, v in zip(_PARAMS, t)) + ")"
            for i, t in enumerate(trials)
        ]
        each = (
            collapsed.selectExpr("x", "n", "sy", "syy", f"explode(array({', '.join(literals)})) as t")
            .selectExpr("*", "1 / (1 + exp(-t.k * (x - t.x0))) as s")
            .selectExpr(
                "t.i as i", "n", "sy", "syy",
                "t.height * s + t.base as f",
                "s as d0",
                "-t.k * t.height * s * (1 - s) as d1",
                "(x - t.x0) * t.height * s * (1 - s) as d2",
                "1D as d3",
            )
        )
        sums = [F.expr(text) for text in _STEP_SUMS]
        out = {}
        for row in each.groupBy("i").agg(*sums).collect():  # one row per trial
            gradient = np.array([row[f"g{i}"] for i in range(4)])
            curvature = np.array([[row[f"h{min(i, j)}{max(i, j)}"] for j in range(4)] for i in range(4)])
            out[row["i"]] = (row["sse"], gradient, curvature)
        return out

    return step


def _array_step(rows: np.ndarray) -> Step:
    """The same sums over rows (x, n, sy, syy) at hand."""
    x, n, sy, syy = rows

    def step(trials: list[np.ndarray]):
        out = {}
        for i, (height, x0, k, base) in enumerate(trials):
            with np.errstate(over="ignore", invalid="ignore"):
                s = 1 / (1 + np.exp(-k * (x - x0)))
                f = height * s + base
                slope = height * s * (1 - s)
                d = np.stack([s, -k * slope, (x - x0) * slope, np.ones_like(s)])
                sse = float(np.sum(syy - 2 * f * sy + n * f * f))
                out[i] = (sse, d @ (sy - n * f), (d * n) @ d.T)
        return out

    return step


def _rows(collapsed: DataFrame) -> np.ndarray:
    """Columns x, n, sy, syy in the order of x, so that sums don't depend on the layout."""
    found = collapsed.select("x", "n", "sy", "syy").toPandas().sort_values("x", kind="stable")
    return found.to_numpy(np.float64).T


def collapse(points: DataFrame, x: str, y: str) -> DataFrame:
    """Points as (x, n, sy, syy, low, high) per distinct x, which loses nothing for a function of x."""
    return (
        points.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
        .dropna()
        .groupBy("x")
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.sum("y").alias("sy"),
            F.sum(F.col("y") * F.col("y")).alias("syy"),
            F.min("y").alias("low"),
            F.max("y").alias("high"),
        )
    )


def sigmoid_fit(
    points: DataFrame,
    x: str,
    y: str,
    start: Sequence[float],
    max_steps: int = 200,
    tolerance: float = 1e-8,
) -> DataFrame:
    """Least-squares height / (1 + exp(-k (x - x0))) + base by damped Gauss-Newton."""
    collapsed = collapse(points, x, y).persist()
    try:
        return sigmoid_fit_collapsed(collapsed, start, max_steps, tolerance)
    finally:
        collapsed.unpersist()


def sigmoid_fit_collapsed(
    collapsed: DataFrame, start: Sequence[float], max_steps: int = 200, tolerance: float = 1e-8
) -> DataFrame:
    """:func:`sigmoid_fit` on the rows of :func:`collapse`.

    With up to ``LOCAL_ROWS`` distinct x, one job brings their sums and all steps run on them. With more, x is
    nearly continuous: the steps run on one in so many x, chosen by hash, and what they find only starts the exact
    descent, in which every step is one aggregate over all rows that tries several dampings; a few remain. If the
    part doesn't converge, the descent starts from ``start``. The result is one row; its parameters are NULL when the
    steps do not converge.
    """
    spark = collapsed.sparkSession
    first = np.array(start, dtype=float)
    rows = _rows(collapsed.limit(LOCAL_ROWS + 1))
    params, fitted = None, None
    if rows.shape[1] <= LOCAL_ROWS:
        n, sy, syy = (float(v) for v in rows[1:].sum(axis=1))
        if n:
            params, fitted = _descend(_array_step(rows), first, max_steps, tolerance)
    else:
        count, n, sy, syy = collapsed.agg(F.count(F.lit(1)), F.sum("n"), F.sum("sy"), F.sum("syy")).first()
        one_in = math.ceil(2 * count / LOCAL_ROWS)
        part = _rows(collapsed.where(F.pmod(F.xxhash64("x"), F.lit(one_in)) == 0))
        near, found = _descend(_array_step(part), first, max_steps, tolerance)
        params, fitted = _descend(_spark_step(collapsed), first if found is None else near, max_steps, tolerance)
    schema = (
        "n long, height double, x0 double, k double, base double, sse double, r2 double, "
        "converged boolean"
    )
    if fitted is None:
        return spark.createDataFrame(
            [(int(n or 0), None, None, None, None, None, None, False)], schema
        )
    sst = syy - sy * sy / n
    r2 = 1.0 - fitted / sst if sst > 0 else None
    return spark.createDataFrame(
        [(int(n), *[float(v) for v in params], float(fitted), r2, True)], schema
    )


def _descend(step_sums: Step, params: np.ndarray, max_steps: int, tolerance: float):
    """Damped Gauss-Newton steps: (parameters, error sum), the latter None without convergence."""
    damping = 1e-3
    sse, gradient, curvature = step_sums([params])[0]
    for _ in range(max_steps):
        trials, used = [], []
        for factor in _DAMPING_STEPS:
            damped = curvature + damping * factor * np.diag(np.diag(curvature))
            try:
                step = np.linalg.solve(damped, gradient)
            except np.linalg.LinAlgError:
                continue
            if np.all(np.isfinite(step)):
                trials.append(params + step)
                used.append(damping * factor)
        if not trials:
            return params, None
        results = step_sums(trials)
        better = [
            (r[0], i)
            for i, r in results.items()
            if r[0] is not None and math.isfinite(r[0]) and r[0] <= sse
        ]
        if not better:
            # No damping improves: a flat gradient is a minimum, else damp harder.
            scale = np.sqrt(np.diag(curvature) * max(sse, 1e-300))
            if np.all(np.abs(gradient) <= 1e-6 * np.maximum(scale, 1e-300)):
                return params, sse
            damping *= _DAMPING_STEPS[-1]
            if damping > 1e12:
                return params, None
            continue
        best, i = min(better)
        gain = sse - best
        params, damping = trials[i], max(used[i] * 0.3, 1e-12)
        sse, gradient, curvature = results[i]
        if gain <= tolerance * max(sse, 1e-300):
            return params, sse
    return params, None


def sigmoid_values(df: DataFrame, x: str, fit: DataFrame, name: str = "expected") -> DataFrame:
    """Fitted sigmoid at each row; the one-row fit enters as a scalar subquery."""
    row = fit.select(F.struct(*_PARAMS).alias("p")).scalar()
    return (
        df.withColumn("__p", row)
        .withColumn(name, sigmoid(f"`{x}`", *[f"__p.{p}" for p in _PARAMS]))
        .drop("__p")
    )

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtstats.operators import fit
from courtstats.plans import closing


def frame(spark, xs, ys, **extra):
    names = ["x", "y", *extra]
    columns = [list(map(float, xs)), list(map(float, ys)), *extra.values()]
    return spark.createDataFrame([tuple(r) for r in zip(*columns)], names)


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(1, 11, 400))
    return x, 2 + 1.1 * x - 0.02 * x**2 + 0.001 * x**3 + rng.normal(0, 9, 400)


def test_poly_fit_equals_numpy(spark, cloud):
    x, y = cloud
    df = frame(spark, x, y)
    for degree in range(1, 6):
        row = fit.poly_fit(df, "x", "y", degree).first()
        expect = np.polyfit(x, y, degree)[::-1]
        assert np.allclose(row.coef, expect, rtol=1e-7, atol=1e-10)
        sse = ((y - np.polyval(expect[::-1], x)) ** 2).sum()
        assert row.n == 400 and row.sse == pytest.approx(sse, rel=1e-9)
        assert row.r2 == pytest.approx(1 - sse / ((y - y.mean()) ** 2).sum(), rel=1e-9)


def test_center_helps_far_from_zero(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(10_000, 10_010, 200)
    y = 3 * (x - 10_005) ** 2 + rng.normal(0, 1, 200)
    row = fit.poly_fit(frame(spark, x, y), "x", "y", 2, center=10_005).first()
    assert np.allclose(row.coef, np.polyfit(x - 10_005, y, 2)[::-1], rtol=1e-8)


def test_too_few_distinct_x_gives_null(spark):
    df = frame(spark, [1, 1, 2, 2], [1, 2, 3, 4])
    fits = {r.degree: r.coef for r in fit.refit_all_degrees(df, "x", "y", [1, 2, 3]).collect()}
    assert np.allclose(fits[1], [-0.5, 2.0]) and fits[2] is None and fits[3] is None


def test_rows_lacking_a_value_are_left_out(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (None, 9.0)], "x double, y double")
    row = fit.poly_fit(df, "x", "y", 1).first()
    assert row.n == 2 and np.allclose(row.coef, [0, 2])


def test_error_falls_with_degree(spark, cloud):
    fits = fit.refit_all_degrees(frame(spark, *cloud), "x", "y", [1, 2, 3, 4, 5])
    sse = [r.sse for r in fits.orderBy("degree").collect()]
    assert all(a >= b - 1e-6 for a, b in zip(sse, sse[1:]))


def test_mirrored_points_have_odd_fits_only(spark, cloud):
    x, y = cloud
    coef = fit.poly_fit(frame(spark, np.r_[x, -x], np.r_[y, -y]), "x", "y", 3).first().coef
    assert abs(coef[0]) < 1e-9 and abs(coef[2]) < 1e-9 and abs(coef[1]) > 0.1


def test_fits_far_from_zero_keep_their_digits(spark):
    x = np.repeat(np.arange(1000.0, 1200.0), 2)
    y = 50 + np.sin(x / 25) * 20 + np.tile([-1.0, 1.0], 200)
    df = frame(spark, x, y, k=list(range(len(x))))
    z = (x - x.mean()) / x.std()
    for r in fit.refit_all_degrees(df, "x", "y", [1, 2, 3, 4, 5]).collect():
        c = np.polyfit(z, y, r.degree)
        assert r.sse == pytest.approx(((y - np.polyval(c, z)) ** 2).sum(), rel=1e-9)
    at = fit.with_expected(df, fit.poly_fit(df, "x", "y", 5, center=1100.0), "x", "y", 5, center=1100.0)
    c = np.polyfit(z, y, 5)
    got = {r.k: r.expected for r in at.collect()}
    assert [got[k] for k in range(400)] == pytest.approx(np.polyval(c, z), rel=1e-9)
    grouped = df.withColumn("g", F.when(F.col("k") % 2 == 0, "a"))  # null is a group as well
    assert fit.poly_fit(grouped, "x", "y", 5, ["g"]).where("coef IS NOT NULL").count() == 2
    folds = fit.poly_cv(df, "x", "y", [5], 5, ["k"]).first()
    assert folds.mse is not None and folds.folds == 5


def test_residuals_and_their_means(spark, cloud):
    x, y = cloud
    group = [("a", "b", "c")[i % 3] for i in range(len(x))]
    df = frame(spark, x, y, g=group)
    rows = fit.with_expected(df, fit.poly_fit(df, "x", "y", 3), "x", "y", 3)
    assert abs(rows.agg(F.avg("residual")).first()[0]) < 1e-8
    slow = {r.g: r.m for r in rows.groupBy("g").agg(F.avg("residual").alias("m")).collect()}
    fast = {r.g: r.mean_residual for r in fit.residual_means(df, "x", "y", 3, ["g"]).collect()}
    assert fast == pytest.approx(slow)
    per_group = fit.with_expected(df, fit.poly_fit(df, "x", "y", 1, ["g"]), "x", "y", 1, ["g"])
    means = per_group.groupBy("g").agg(F.avg("residual")).collect()
    assert all(abs(r[1]) < 1e-8 for r in means)


def test_linear_fit_and_r2(spark, cloud):
    x, y = cloud
    df = frame(spark, x, y)
    row = fit.linear_fit(df, "x", "y").first()
    slope, intercept = np.polyfit(x, y, 1)
    assert (row.slope, row.intercept) == pytest.approx((slope, intercept))
    scored = df.withColumn("e", F.col("x") * row.slope + row.intercept)
    assert fit.r2_score(scored, "y", "e").first().r2 == pytest.approx(row.r2)


def brute_cv(x, y, fold, degrees):
    out = {}
    for d in degrees:
        mse, r2 = [], []
        for f in sorted(set(fold)):
            held = fold == f
            c = np.polyfit(x[~held], y[~held], d)
            err = ((y[held] - np.polyval(c, x[held])) ** 2).sum()
            mse.append(err / held.sum())
            r2.append(1 - err / ((y[held] - y[held].mean()) ** 2).sum())
        out[d] = (np.mean(mse), np.mean(r2))
    return out


def digest(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def test_poly_cv_equals_refitting_every_fold(spark, cloud):
    x, y = cloud
    keys = list(range(len(x)))
    fold = np.array([int(digest(k)[:8], 16) % 5 for k in keys])
    expect = brute_cv(x, y, fold, [1, 2, 3, 4, 5])
    got = fit.poly_cv(frame(spark, x, y, k=keys), "x", "y", [1, 2, 3, 4, 5], 5, ["k"]).collect()
    for r in got:
        assert (r.mse, r.r2) == pytest.approx(expect[r.degree], rel=1e-7)
    assert {r.folds for r in got} == {5} and {r.n for r in got} == {400}


def test_team_best_fits_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    data, expect = [], {}
    for team, n in (("AAA", 53), ("BBB", 10), ("CCC", 9), ("DDD", 31)):
        x = np.round(rng.normal(0, 10, n))
        y = 0.9 * x + (0.01 * x**2 if team == "DDD" else 0) + rng.normal(0, 4, n)
        data += [(f"g{team}{i}", "home", team, float(x[i]), float(y[i])) for i in range(n)]
        if n >= 10:
            order = sorted(range(n), key=lambda i: digest(f"g{team}{i}", "home"))
            fold = np.empty(n, int)
            fold[order] = np.arange(n) % min(5, n // 2)
            scores = brute_cv(x, y, fold, [1, 2, 3])
            best = min((1, 2, 3), key=lambda d: (scores[d][0], d))
            expect[team] = (n, scores, best)
    df = spark.createDataFrame(data, "game_id string, Side string, Team string, Q3_Lead double, Final_Result double")
    got = {r.Team: r for r in closing.team_best_fits(df).collect()}
    assert set(got) == set(expect)
    for team, (n, scores, best) in expect.items():
        r = got[team]
        assert r.Games == n and r.Best_Degree == best
        assert [r.MSE_D1, r.MSE_D2, r.MSE_D3] == pytest.approx([scores[d][0] for d in (1, 2, 3)], rel=1e-6)
    counts = {r.Best_Degree: r.teams for r in closing.degree_distribution(closing.team_best_fits(df)).collect()}
    assert sum(counts.values()) == len(expect)


def test_small_groups_get_fewer_folds(spark):
    df = spark.createDataFrame([("t", i, float(i), float(i * i)) for i in range(6)], "t string, k int, x double, y double")
    folded = fit.fold_balanced(df, ["t"], ["k"], 5, 1)
    assert sorted(r[0] for r in folded.groupBy("fold").count().select("count").collect()) == [2, 2, 2]
    assert fit.fold_balanced(df, ["t"], ["k"], 5, 7).count() == 0


def test_a_degree_that_fails_in_one_fold_is_not_selectable(spark):
    df = spark.createDataFrame(
        [("t", i, float(i % 2), float(i)) for i in range(12)], "t string, k int, x double, y double"
    )
    scores = {r.degree: r.mse for r in fit.poly_cv_by(df, "x", "y", ["t"], [1, 2, 3], 5, ["k"]).collect()}
    assert scores[1] is not None and scores[2] is None and scores[3] is None


def test_best_degree_prefers_the_lower_on_ties(spark):
    scores = spark.createDataFrame([(3, 1.0), (2, 1.0), (1, 2.0), (4, None)], "degree int, mse double")
    assert tuple(fit.best_degree(scores).first()) == (2, 1.0)
    models = spark.createDataFrame([("B", 2, 0.5), ("A", 1, 0.5), ("C", 3, 0.1)], "model string, place int, r2 double")
    assert tuple(fit.best_model(models, "model", "r2", "place").first()) == ("A", 0.5)


def test_sigmoid_fit_recovers_the_curve(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(0, 15, 1500))
    y = 60 / (1 + np.exp(-0.08 * (x - 2))) - 30 + rng.normal(0, 2, len(x))
    df = frame(spark, x, y)
    start = closing.sigmoid_start(df, "x", "y")
    assert start == pytest.approx([y.max() - y.min(), np.median(x), 0.1, y.min()])
    row = fit.sigmoid_fit(df, "x", "y", start).first()
    assert row.converged
    # At a minimum the residuals are orthogonal to the slope along every parameter.
    s = 1 / (1 + np.exp(-row.k * (x - row.x0)))
    resid = y - (row.height * s + row.base)
    slope = row.height * s * (1 - s)
    for direction in (s, -row.k * slope, (x - row.x0) * slope, np.ones_like(s)):
        assert abs(resid @ direction) < 1e-3 * np.linalg.norm(resid) * np.linalg.norm(direction)
    assert row.sse == pytest.approx((resid**2).sum(), rel=1e-9)
    assert row.height == pytest.approx(60, rel=0.15) and row.k == pytest.approx(0.08, rel=0.15)
    values = fit.sigmoid_values(df, "x", fit.sigmoid_fit(df, "x", "y", start)).select("x", "expected").first()
    assert values.expected == pytest.approx(row.height / (1 + np.exp(-row.k * (values.x - row.x0))) + row.base)


def test_sigmoid_of_continuous_x_takes_few_passes(spark, monkeypatch):
    """Above the bound a part of the rows finds the start, and the exact descent ends where all rows lead."""
    rng = np.random.default_rng(6)
    x = rng.normal(0, 15, 4000)
    y = 60 / (1 + np.exp(-0.08 * (x - 2))) - 30 + rng.normal(0, 2, len(x))
    df = frame(spark, x, y)
    start = [float(np.ptp(y)), float(np.median(x)), 0.1, float(y.min())]
    whole = fit.sigmoid_fit(df, "x", "y", start).first()
    jobs = []
    spark_step = fit._spark_step

    def counted(collapsed):
        step = spark_step(collapsed)
        return lambda trials: jobs.append(1) or step(trials)

    monkeypatch.setattr(fit, "_spark_step", counted)
    monkeypatch.setattr(fit, "LOCAL_ROWS", 500)
    row = fit.sigmoid_fit(df, "x", "y", start).first()
    assert row.converged and 0 < len(jobs) <= 6
    for name in ("height", "x0", "k", "base", "sse", "r2"):
        assert row[name] == pytest.approx(whole[name], rel=1e-3)


def test_sums_at_hand_equal_those_of_spark(spark):
    rng = np.random.default_rng(7)
    rows = fit.collapse(frame(spark, np.round(rng.normal(0, 9, 300)), rng.normal(0, 5, 300)), "x", "y")
    trials = [np.array(t) for t in ([30.0, 1.0, 0.1, -9.0], [5.0, -400.0, 2.0, 1.0])]
    near, far = fit._array_step(fit._rows(rows))(trials), fit._spark_step(rows)(trials)
    for i in range(2):
        for a, b in zip(near[i], far[i]):
            assert np.allclose(a, b, rtol=1e-9, atol=1e-9)


def test_sigmoid_fit_without_data_or_hope(spark):
    empty = spark.createDataFrame([], "x double, y double")
    assert fit.sigmoid_fit(empty, "x", "y", [1, 0, 0.1, 0]).first().converged is False


def test_model_comparison_names_the_winner(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(0, 20, 800))
    y = 40 / (1 + np.exp(-0.3 * x)) - 20 + rng.normal(0, 0.5, len(x))
    df = frame(spark, x, y)
    got = {r.model: r for r in closing.model_comparison(df, "x", "y").collect()}
    assert set(got) == {"Linear", "Polynomial", "Sigmoid"}
    assert [m for m, r in got.items() if r.winner] == ["Sigmoid"]
    curves = closing.comparison_curves(df, 50, "x", "y")
    assert {r["model"]: r["count"] for r in curves.groupBy("model").count().collect()} == {
        "Linear": 50, "Polynomial": 50, "Sigmoid": 50,
    }


def test_curves_cover_the_grid(spark, cloud):
    df = frame(spark, *cloud)
    got = fit.curve_points(fit.poly_fit(df, "x", "y", 2), -5, 5, 11).orderBy("x").collect()
    assert [r.x for r in got] == pytest.approx(np.linspace(-5, 5, 11))
    assert [r.y for r in got] == pytest.approx(np.polyval(np.polyfit(*cloud, 2), np.linspace(-5, 5, 11)))

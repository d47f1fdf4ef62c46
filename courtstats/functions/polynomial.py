"""Least-squares polynomials as expressions over power sums.

A polynomial of degree d needs only n, sums of x^k (k <= 2d), sums of x^k*y
(k <= d) and the sum of y^2. Those sums add up across tasks, groups and folds,
so points are read once and never leave their partitions. The normal equations
of every degree from 0 to d are then solved by one Gauss-Jordan pass written
with Spark's array functions: after k+1 pivots the leading rows hold the
coefficients of degree k and the last row holds its error sum.

The expressions are SQL text: a lambda in text costs the driver one call, one
built from Column objects costs it hundreds. Arguments are SQL expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# A pivot this small against its own diagonal means fewer distinct x than
# coefficients: the fit is reported as NULL.
_RANK_TOLERANCE = 1e-11


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def moments_size(degree: int) -> int:
    return 3 * degree + 3


def power_sums(x: str, y: str, degree: int) -> Column:
    """Aggregate array: n, sums of x^1..x^2d, sums of x^0*y..x^d*y, sum of y^2.

    One array rather than one column per sum: every branch of a plan then asks
    for the same aggregate, and Spark computes and shuffles it once.
    """
    cells = ["cast(count(1) as double)"]
    cells += [f"sum({' * '.join([x] * k)})" for k in range(1, 2 * degree + 1)]
    cells += [f"sum({' * '.join([x] * k + [y])})" for k in range(degree + 1)]
    cells.append(f"sum({y} * {y})")
    return F.expr(f"array({', '.join(cells)})")


def collapsed_sums(degree: int) -> Column:
    """The same array from points collapsed to (x, n, sy, syy) per distinct x."""
    cells = [f"sum({' * '.join(['n'] + ['x'] * k)})" for k in range(2 * degree + 1)]
    cells += [f"sum({' * '.join(['x'] * k + ['sy'])})" for k in range(degree + 1)]
    cells.append("sum(syy)")
    return F.expr(f"array({', '.join(cells)})")


def shift_back(coef: str, degree: int, center: str, scale: str) -> Column:
    """Coefficients in powers of x from those in powers of (x - center) / scale."""
    rows = [[math.comb(k, j) for j in range(k + 1)] for k in range(degree + 1)]
    table = "array(" + ", ".join("array(" + ", ".join(f"{c}D" for c in row) + ")" for row in rows) + ")"
    term = f"cs[k] / pow({scale}, k) * {table}[k][j] * pow(-({center}), k - j)"
    total = f"aggregate(sequence(j, size(cs) - 1), 0D, (acc, k) -> acc + {term})"
    return F.expr(f"if({coef} is null, null, {_let('cs', coef, f'transform(cs, (c, j) -> {total})')})")


def add_up(moments: str, degree: int, over: str = "") -> Column:
    """Element-wise sum of moment arrays; ``over`` makes it a window sum."""
    cells = [f"sum({moments}[{i}]){over}" for i in range(moments_size(degree))]
    return F.expr(f"array({', '.join(cells)})")


def lower_degree(moments: str, degree: int, to: int) -> Column:
    """The moment array of degree ``to`` out of that of a higher degree."""
    parts = [f"slice({moments}, 1, {2 * to + 1})", f"slice({moments}, {2 * degree + 2}, {to + 1})"]
    return F.expr(f"concat({', '.join(parts)}, array({yy_sum(moments, degree)}))")


def _x_sums(moments: str, degree: int) -> str:
    return f"slice({moments}, 1, {2 * degree + 1})"


def _xy_sums(moments: str, degree: int) -> str:
    return f"slice({moments}, {2 * degree + 2}, {degree + 1})"


def yy_sum(moments: str, degree: int) -> str:
    return f"{moments}[{3 * degree + 2}]"


def y_sum(moments: str, degree: int) -> str:
    return f"{moments}[{2 * degree + 1}]"


def y_variation(moments: str, degree: int) -> str:
    """Sum of squares of y around its mean."""
    sy = y_sum(moments, degree)
    return f"({yy_sum(moments, degree)} - {sy} * {sy} / {moments}[0])"


def fit_ladder(moments: str, degree: int) -> Column:
    """array<struct<degree, coef, sse>> for degrees 0..d from a moment array.

    ``coef`` is ascending in powers of x. A rank-deficient degree, and every
    degree above it, has NULL coefficients.
    """
    d = degree
    # The normal equations in z = x / scale, divided by n, with the y row last.
    rows = (
        f"concat(transform(sequence(0, {d}), i -> concat(slice(zs, i + 1, {d + 1}), array(zt[i]))), "
        f"array(concat(zt, array({yy_sum('m', d)} / m[0]))))"
    )
    pivot = f"if(s.rows[k][k] > s.start[k][k] * {_RANK_TOLERANCE}D, s.rows[k][k], null)"
    lead = f"transform(s.rows[k], v -> v / {pivot})"
    reduced = (
        "transform(s.rows, (line, i) -> if(i = k, lead, "
        "zip_with(line, lead, (a, b) -> a - line[k] * b)))"
    )
    fit = (
        f"named_struct('degree', k, 'coef', transform(slice(next, 1, k + 1), line -> line[{d + 1}]), "
        f"'sse', next[{d + 1}][{d + 1}])"
    )
    step = _let(
        "lead",
        lead,
        _let(
            "next",
            reduced,
            f"named_struct('rows', next, 'start', s.start, 'fits', concat(s.fits, array({fit})))",
        ),
    )
    start = (
        "named_struct('rows', eq, 'start', eq, "
        "'fits', cast(array() as array<struct<degree:int,coef:array<double>,sse:double>>))"
    )
    solved = f"aggregate(sequence(0, {d}), {start}, (s, k) -> {step}, s -> s.fits)"
    unscaled = (
        f"transform({solved}, f -> named_struct('degree', f.degree, 'coef', "
        "if(forall(f.coef, c -> c is not null), transform(f.coef, (c, j) -> c / pow(scale, j)), null), "
        "'sse', if(f.sse is null, null, greatest(f.sse, 0D) * m[0])))"
    )
    with_rows = _let("eq", rows, unscaled)
    with_zt = _let(
        "zt", f"transform({_xy_sums('m', d)}, (t, k) -> t / m[0] / pow(scale, k))", with_rows
    )
    with_zs = _let(
        "zs", f"transform({_x_sums('m', d)}, (t, k) -> t / m[0] / pow(scale, k))", with_zt
    )
    with_scale = _let("scale", "if(m[2] > 0, sqrt(m[2] / m[0]), 1D)", with_zs)
    return F.expr(_let("m", moments, with_scale))


def _dot(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (p, q) -> p * q), 0D, (s, v) -> s + v)"


def error_sum(coef: str, moments: str, degree: int) -> Column:
    """Sum of squared errors of ``coef`` on the points behind a moment array."""
    size = f"size({coef})"
    quadratic = (
        f"aggregate(transform({coef}, (c, i) -> "
        f"c * {_dot(coef, f'slice({_x_sums(moments, degree)}, i + 1, {size})')}), 0D, (s, v) -> s + v)"
    )
    linear = _dot(coef, f"slice({_xy_sums(moments, degree)}, 1, {size})")
    error = f"greatest({yy_sum(moments, degree)} - 2 * {linear} + {quadratic}, 0D)"
    return F.expr(f"if({coef} is null, null, {error})")


def mean_gap(coef: str, moments: str, degree: int) -> Column:
    """Mean of y minus the fitted value over the points behind a moment array."""
    expected = _dot(coef, f"slice({moments}, 1, {degree + 1})")
    return F.expr(f"({y_sum(moments, degree)} - {expected}) / {moments}[0]")


def horner(coef: str, x: str, degree: int) -> Column:
    """Value of an ascending coefficient array of fixed degree at x (stays in codegen)."""
    value = f"{coef}[{degree}]"
    for k in range(degree - 1, -1, -1):
        value = f"({value} * {x} + {coef}[{k}])"
    return F.expr(value)


def horner_array(coef: str, x: str) -> Column:
    """Like :func:`horner` for coefficient arrays of mixed length."""
    return F.expr(f"aggregate(reverse({coef}), 0D, (s, c) -> s * {x} + c)")


def sigmoid(x: str, height: str, x0: str, k: str, base: str) -> Column:
    """height / (1 + exp(-k (x - x0))) + base."""
    return F.expr(f"{height} / (1 + exp(-{k} * ({x} - {x0}))) + {base}")

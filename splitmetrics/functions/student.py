"""Two-sided p-value of Student's t as a Spark SQL expression.

p = I_x(df/2, 1/2) with x = df / (df + t^2), the regularised incomplete beta
function, from its continued fraction (Abramowitz & Stegun 26.5.8). The fraction
converges fast only below x = (a + 1) / (a + b + 2), so above that point the
mirrored form 1 - I_{1-x}(1/2, df/2) is evaluated instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FRACTION_DEPTH = 240
_SHIFT = 16

# With very many degrees of freedom x is so close to 1 that the direct form cancels. The
# mirrored one does not and is accurate for moderate t^2; beyond that the t quantile is turned into
# a normal one by an expansion in 1/df, and p is the normal tail, from its continued fraction.
_LARGE, _MODERATE = "50000D", "12D"
_TAIL_DEPTH = 100

# Asymptotic series of ln(gamma(z + 1/2) / gamma(z)) - ln(z)/2, as
# the terms in 1/z, 1/z^3, 1/z^5, 1/z^7, 1/z^9.
_HALF_STEP_SERIES = (
    "-1D/(8*{z}) + 1D/(192*pow({z},3)) - 1D/(640*pow({z},5))"
    " + 17D/(14336*pow({z},7)) - 31D/(18432*pow({z},9))"
)


def _bound(values: str, name: str, body: str) -> str:
    """``body`` with ``values`` computed once, wherever the optimizer moves it."""
    return f"transform(array(named_struct({values})), {name} -> {body})[0]"


def _gamma_half_step(a: str) -> str:
    """gamma(a + 1/2) / gamma(a); the series is used only where it is accurate."""
    shift = f"aggregate(sequence(0, {_SHIFT - 1}), 1D, (g, i) -> g * ({a} + i) / ({a} + i + 0.5D))"
    z = f"({a} + {_SHIFT})"
    return f"{shift} * sqrt{z} * exp({_HALF_STEP_SERIES.format(z=z)})"


def _beta_fraction(a: str, b: str, x: str) -> str:
    """1 + d1/(1 + d2/(1 + ...)) evaluated from its far end; level k has m = k div 2."""
    even = f"k.m * ({b} - k.m) * {x} / (({a} + 2*k.m - 1) * ({a} + 2*k.m))"
    odd = f"-({a} + k.m) * ({a} + {b} + k.m) * {x} / (({a} + 2*k.m) * ({a} + 2*k.m + 1))"
    levels = (
        f"transform(sequence({_FRACTION_DEPTH}, 1, -1),"
        " i -> named_struct('m', cast(i div 2 as double), 'even', i % 2 = 0))"
    )
    return f"aggregate({levels}, 1D, (f, k) -> 1D + if(k.even, {even}, {odd}) / f)"


def _normal_tail() -> str:
    """Both tails beyond the normal quantile that belongs to u.t2 at 2 * u.half degrees of freedom.

    With a = df - 1/2, b = 48 a^2 and w = sqrt(a ln(1 + t^2 / df)), that quantile is
    w + (w^3 + 3 w) / b - (4 w^7 + 33 w^5 + 240 w^3 + 855 w) / (10 b (b + 0.8 w^4 + 100)) (Hill 1970).
    """
    quantile = (
        "w.w + (pow(w.w, 3) + 3 * w.w) / w.b - (4 * pow(w.w, 7) + 33 * pow(w.w, 5)"
        " + 240 * pow(w.w, 3) + 855 * w.w) / (10 * w.b * (w.b + 0.8D * pow(w.w, 4) + 100))"
    )
    fraction = f"aggregate(sequence({_TAIL_DEPTH}, 1, -1), z.z, (f, k) -> z.z + k / f)"
    tail = f"sqrt(2D / pi()) * exp(-z.z * z.z / 2) / {fraction}"
    steps = (
        "'w', sqrt((2 * u.half - 0.5D) * log1p(u.t2 / (2 * u.half))),"
        " 'b', 48 * pow(2 * u.half - 0.5D, 2)"
    )
    return _bound(steps, "w", _bound(f"'z', {quantile}", "z", tail))


def t_pvalue(t: str, df: str) -> Column:
    """Two-sided p-value of ``t`` with ``df`` degrees of freedom (SQL expressions).

    Null where either is null. Meant for result frames, one row per comparison.
    """
    integral = f"p.weight / (p.a * {_beta_fraction('p.a', 'p.b', 'p.x')})"
    from_integral = _bound(
        f"'mirrored', p.mirrored, 'integral', {integral}",
        "q",
        "if(q.mirrored, 1D - q.integral, q.integral)",
    )
    from_parts = _bound(
        "'mirrored', v.mirrored, 'a', if(v.mirrored, 0.5D, v.half),"
        " 'b', if(v.mirrored, v.half, 0.5D),"
        " 'x', if(v.mirrored, v.t2, 2 * v.half) / (2 * v.half + v.t2),"
        f" 'weight', {_gamma_half_step('v.half')} / sqrt(pi())"
        " * exp(-v.half * log1p(v.t2 / (2 * v.half))) * sqrt(v.t2 / (2 * v.half + v.t2))",
        "p",
        from_integral,
    )
    mirrored = (
        "(u.t2 * (u.half + 2.5D) < 1.5D * (2 * u.half + u.t2))"
        f" or (u.half > {_LARGE} and u.t2 < {_MODERATE})"
    )
    from_square = _bound(
        f"'t2', u.t2, 'half', u.half, 'mirrored', {mirrored}",
        "v",
        from_parts,
    )
    return F.expr(
        _bound(
            f"'t2', ({t}) * ({t}), 'half', ({df}) / 2D",
            "u",
            f"case when u.t2 is null or not u.half > 0 then null"
            f" when u.half > {_LARGE} and u.t2 >= {_MODERATE} then {_normal_tail()}"
            f" else {from_square} end",
        )
    )

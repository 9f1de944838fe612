"""Tail probabilities of the t, F and chi-square laws as SQL expressions.

They run on result rows (one per test), stay on the JVM and need no Python
worker.  Arguments are the names of double columns, or SQL expressions over
them.  Published methods: Lanczos' approximation of log-gamma, the power series
and continued fractions (evaluated by Lentz's method) of the incomplete gamma
and beta functions, and, for a large first beta argument, the gamma limit with
the shifted argument ``a + (b - 1) / 2`` (relative error of order 1 / a**2).
Where both beta arguments are large the factor in front of the fraction is
taken from Stirling's series and a cancellation-free log term, since a
difference of log-gammas of size 1e12 keeps only four digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos coefficients for g = 7, nine terms.
_LANCZOS = [
    0.99999999999980993,
    676.5203681218851,
    -1259.1392167224028,
    771.32342877765313,
    -176.61502916214059,
    12.507343278686905,
    -0.13857109526572012,
    9.9843695780195716e-6,
    1.5056327351493116e-7,
]
_TINY = "1E-300D"
_LARGE_BETA = "20000D"
_LARGE_GAMMA = "100000D"


def _let(name: str, fields: dict[str, str], body: str) -> str:
    """Binds values to a lambda variable, so that each is evaluated once."""
    packed = ", ".join(f"'{field}', cast({value} as double)" for field, value in fields.items())
    return f"element_at(transform(array(named_struct({packed})), {name} -> {body}), 1)"


def _log_gamma(z: str) -> str:
    """Natural log of gamma for z >= 0.5."""
    series = " + ".join(
        [f"{_LANCZOS[0]!r}D", *[f"{c!r}D / ({z} + {i}D)" for i, c in enumerate(_LANCZOS[1:])]]
    )
    return f"(0.5D * ln(2D * pi()) + ({z} - 0.5D) * ln({z} + 6.5D) - ({z} + 6.5D) + ln({series}))"


def _nonzero(x: str) -> str:
    return f"if(abs({x}) < {_TINY}, {_TINY}, {x})"


def _steps(size: str) -> str:
    """Enough terms: the fractions converge in a few times sqrt(size) of them."""
    return f"sequence(1, cast(least(200D + 12D * sqrt({size}), 200000D) as int))"


def _wide_upper_gamma(s: str, x: str) -> str:
    """Q(s, x) for s above ``_LARGE_GAMMA``: Temme's uniform expansion.

    Half a complementary error function plus the first coefficients in powers of
    eta; beyond |eta| = 0.2 both tails are below 1e-300 at such s.
    """
    mu = f"(({x} - {s}) / {s})"
    # mu - log(1 + mu), by its series where the difference would lose digits
    gap = _let(
        "t",
        {"m": mu},
        "if(abs(t.m) < 1E-4D, t.m * t.m * (0.5D - t.m * (1D / 3D - t.m * (0.25D - t.m * 0.2D))), t.m - log1p(t.m))",
    )
    eta = f"(if({x} < {s}, -1D, 1D) * sqrt(2D * {gap}))"
    first = "(-1D / 3D + e.v * (1D / 12D - e.v * (2D / 135D - e.v * (1D / 864D + e.v * (1D / 2835D)))))"
    tail = _upper_gamma("0.5D", "e.s * e.v * e.v / 2D", "h", wide=False)
    body = (
        f"if(e.v < 0D, 1D - {tail} / 2D, {tail} / 2D) "
        f"+ exp(-e.s * e.v * e.v / 2D) / sqrt(2D * pi() * e.s) * ({first} - 1D / 540D / e.s)"
    )
    return _let("e", {"v": eta, "s": s}, body)


def _upper_gamma(s: str, x: str, name: str = "g", wide: bool = True) -> str:
    """Regularised upper incomplete gamma function Q(s, x)."""
    s_, x_ = f"{name}.s", f"{name}.x"
    scale = f"exp({s_} * ln({x_}) - {x_} - {_log_gamma(s_)})"
    series = (
        f"aggregate({_steps(f'{s_} + {x_}')}, named_struct('term', 1D / {s_}, 'total', 1D / {s_}), "
        f"(p, k) -> named_struct('term', p.term * {x_} / ({s_} + k), 'total', p.total + p.term * {x_} / ({s_} + k)), "
        f"p -> p.total)"
    )
    # one step of Lentz's method: b, c, d and the value h
    grown = "q.b + 2D"
    numerator = f"(k * ({s_} - k))"
    next_d = f"1D / {_nonzero(f'({numerator} * q.d + {grown})')}"
    next_c = _nonzero(f"({grown} + {numerator} / q.c)")
    step = f"named_struct('b', {grown}, 'c', {next_c}, 'd', {next_d}, 'h', q.h * {next_c} * {next_d})"
    start = f"1D / {_nonzero(f'({x_} + 1D - {s_})')}"
    fraction = (
        f"aggregate({_steps(s_)}, named_struct('b', {x_} + 1D - {s_}, 'c', 1D / {_TINY}, 'd', {start}, 'h', {start}), "
        f"(q, k) -> {step}, q -> q.h)"
    )
    body = (
        f"CASE WHEN {x_} <= 0D THEN 1D "
        + (f"WHEN {s_} > {_LARGE_GAMMA} THEN {_wide_upper_gamma(s_, x_)} " if wide else "")
        + f"WHEN {x_} < {s_} + 1D THEN 1D - {scale} * {series} "
        f"ELSE {scale} * {fraction} END"
    )
    return _let(name, {"s": s, "x": x}, body)


def _beta_fraction(a: str, b: str, x: str) -> str:
    def lentz(acc: str, coefficient: str) -> str:
        d = f"1D / {_nonzero(f'(1D + {coefficient} * {acc}.d)')}"
        c = _nonzero(f"(1D + {coefficient} / {acc}.c)")
        return f"named_struct('c', {c}, 'd', {d}, 'h', {acc}.h * {c} * {d})"

    even = f"(k * ({b} - k) * {x} / (({a} + 2D * k - 1D) * ({a} + 2D * k)))"
    odd = f"(-({a} + k) * ({a} + {b} + k) * {x} / (({a} + 2D * k) * ({a} + 2D * k + 1D)))"
    step = f"element_at(transform(array({lentz('p', even)}), m -> {lentz('m', odd)}), 1)"
    start = f"1D / {_nonzero(f'(1D - ({a} + {b}) * {x} / ({a} + 1D))')}"
    return (
        f"aggregate({_steps(f'greatest({a}, {b})')}, named_struct('c', 1D, 'd', {start}, 'h', {start}), "
        f"(p, k) -> {step}, p -> p.h)"
    )


#: from this smaller beta argument on, the front factor is taken in the form without cancellation
_STIRLING_FROM = "50D"


def _stirling_rest(z: str) -> str:
    """log Gamma(z) minus Stirling's leading terms, by its series (below 1e-15 from z = 50 on)."""
    return f"(1D / (12D * {z}) - 1D / (360D * power({z}, 3)) + 1D / (1260D * power({z}, 5)))"


def _stable_front() -> str:
    """x^a y^b / B(a, b) for large a and b, without the cancellation of log-gammas near 1e12.

    With s = a + b, p = a / s, q = b / s and e = x - p (taken as (x b - y a) / s),
    log front = log(ab / (2 pi s)) / 2 - r(a) - r(b) + r(s) - a phi(e / p) - b phi(-e / q),
    phi(t) = t - log(1 + t) by its series near 0; the first-order terms cancel exactly.
    """

    def phi(t: str, name: str) -> str:
        return _let(name, {"t": t}, f"if(abs({name}.t) < 1E-4D, {name}.t * {name}.t * (0.5D - {name}.t * (1D / 3D - {name}.t * (0.25D - {name}.t * 0.2D))), {name}.t - log1p({name}.t))")

    body = (
        f"exp(0.5D * ln(v.a * v.b / (2D * pi() * u.s)) - {_stirling_rest('v.a')} - {_stirling_rest('v.b')} + {_stirling_rest('u.s')} "
        f"- v.a * {phi('u.e * u.s / v.a', 'ta')} - v.b * {phi('-u.e * u.s / v.b', 'tb')})"
    )
    return _let("u", {"s": "v.a + v.b", "e": "(v.x * v.b - v.y * v.a) / (v.a + v.b)"}, body)


def _lower_beta(a: str, b: str, x: str, complement: str) -> str:
    """Regularised incomplete beta function I_x(a, b); ``complement`` is 1 - x.

    The complement is an argument because callers know it without cancellation.
    """
    plain = (
        f"exp({_log_gamma('(v.a + v.b)')} - {_log_gamma('v.a')} - {_log_gamma('v.b')} + v.a * ln(v.x) + v.b * ln(v.y))"
    )
    front = f"if(least(v.a, v.b) >= {_STIRLING_FROM}, {_stable_front()}, {plain})"
    # the fraction converges fast below the mean of the law; above it the
    # arguments are mirrored
    mirrored = "v.x >= (v.a + 1D) / (v.a + v.b + 2D)"
    turned = {
        "a": f"if({mirrored}, v.b, v.a)",
        "b": f"if({mirrored}, v.a, v.b)",
        "x": f"if({mirrored}, v.y, v.x)",
        "front": front,
    }
    share = _let("w", turned, f"w.front * {_beta_fraction('w.a', 'w.b', 'w.x')} / w.a")
    # log(x) from the complement: x is close to one when a is large
    limit = _upper_gamma("v.b", "-(v.a + (v.b - 1D) / 2D) * log1p(-v.y)")
    body = (
        f"CASE WHEN v.x <= 0D THEN 0D WHEN v.y <= 0D THEN 1D "
        f"WHEN v.a > {_LARGE_BETA} AND v.b < sqrt(v.a) THEN {limit} "
        f"WHEN {mirrored} THEN 1D - {share} ELSE {share} END"
    )
    return _let("v", {"a": a, "b": b, "x": x, "y": complement}, body)


def f_upper(f: str, dof1: str, dof2: str) -> Column:
    """P(F > f) for Fisher's F; NULL in, NULL out."""
    spread = f"(({dof2}) + ({dof1}) * ({f}))"
    p = _lower_beta(f"({dof2}) / 2D", f"({dof1}) / 2D", f"({dof2}) / {spread}", f"({dof1}) * ({f}) / {spread}")
    return F.expr(f"CASE WHEN ({f}) >= 0 AND ({dof1}) > 0 AND ({dof2}) > 0 THEN {p} END")


def t_two_sided(t: str, dof: str) -> Column:
    """P(|T| > |t|) for Student's t: the square of T follows F with 1 and dof."""
    return f_upper(f"({t}) * ({t})", "1D", dof)


def chi2_upper(x: str, dof: str) -> Column:
    """P(X > x) for chi-square."""
    return F.expr(f"CASE WHEN ({x}) >= 0 AND ({dof}) > 0 THEN {_upper_gamma(f'({dof}) / 2D', f'({x}) / 2D')} END")


def correlation_p(r: str, n: str) -> Column:
    """Two-sided p-value of a correlation coefficient over n pairs."""
    # r*r = t*t / (dof + t*t), so the beta arguments need no division by 1 - r*r
    p = _lower_beta(f"(({n}) - 2D) / 2D", "0.5D", f"1D - ({r}) * ({r})", f"({r}) * ({r})")
    return F.expr(f"CASE WHEN ({n}) >= 3 AND ({r}) IS NOT NULL THEN {p} END")

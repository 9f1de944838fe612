"""Tail probabilities as SQL: Simpson's rule over the densities.

Independent of the continued fractions used on the Spark side.  The densities
of chi-square and F are integrated in the square root of their argument, which
removes the pole at zero.
"""

PANELS = 20_000


def _integral(upper: str, density: str) -> str:
    """Simpson's rule for ``density`` (an expression in ``u``) from 0 to ``upper``."""
    weight = f"CASE WHEN i IN (0, {PANELS}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return (
        f"(SELECT sum({weight} * ({density})) * ({upper}) / {3 * PANELS} FROM "
        f"(SELECT i, ({upper}) * i / {PANELS}.0::DOUBLE AS u FROM range({PANELS + 1}) r(i)))"
    )


def _power(exponent: str, dof: str) -> str:
    """``exp(exponent) * u ** (dof - 1)``, also at u = 0."""
    at_zero = f"CASE WHEN {dof} = 1 THEN exp({exponent}) ELSE 0 END"
    return f"CASE WHEN u = 0 THEN {at_zero} ELSE exp({exponent} + ({dof} - 1) * ln(u)) END"


def t_two_sided(t: str, dof: str) -> str:
    scale = f"exp(lgamma(({dof} + 1) / 2.0) - lgamma({dof} / 2.0)) / sqrt({dof} * pi())"
    inner = _integral(f"abs({t})", f"exp(-({dof} + 1) / 2.0 * ln(1 + u * u / {dof}))")
    return f"(1 - 2 * ({scale}) * {inner})"


def chi2_upper(x: str, dof: str) -> str:
    # the whole density in one exponential: its parts overflow when dof is large
    scale = f"-({dof} / 2.0) * ln(2.0) - lgamma({dof} / 2.0)"
    return f"(1 - 2 * {_integral(f'sqrt({x})', _power(f'{scale} - u * u / 2', dof))})"


def f_upper(f: str, dof1: str, dof2: str) -> str:
    scale = (
        f"lgamma(({dof1} + {dof2}) / 2.0) - lgamma({dof1} / 2.0) - lgamma({dof2} / 2.0) "
        f"+ {dof1} / 2.0 * ln({dof1} / {dof2})"
    )
    decay = f"-({dof1} + {dof2}) / 2.0 * ln(1 + {dof1} * u * u / {dof2})"
    return f"(1 - 2 * {_integral(f'sqrt({f})', _power(f'{scale} {decay}', dof1))})"

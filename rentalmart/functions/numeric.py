"""Numeric expressions with the reference's exact semantics.

The reference runs on an embedded columnar database whose numeric rules differ from
Spark's in a few places. Each helper returns Spark SQL text of built-in expressions (for
``selectExpr`` / ``expr``), so whole-stage codegen is kept.

* ``round_half`` - ROUND on a DOUBLE: half away from zero on ``x * 10^n``, then divided
  back. Spark's ``round`` on a double rounds the shortest decimal form of its argument
  half-up, so scaling first gives the same result as the reference.
* ``avg_double`` - AVG of a DECIMAL is a DOUBLE: exact unscaled sum over count x scale.
* ``to_int`` - DOUBLE to INT rounds half to even in the reference; Spark truncates, so
  ``rint`` first.
* ``money`` - ``$1,234.50`` text to DECIMAL(10,2), NULL when it does not parse.
* ``pct`` - ``a * 100.0 / NULLIF(b, 0)`` as a DOUBLE.
"""

from __future__ import annotations

MONEY_TYPE = "decimal(10,2)"


def _d(x: float) -> str:
    """A DOUBLE literal (a bare ``100.0`` is a DECIMAL literal in Spark SQL)."""
    return f"{float(x)!r}D"


# ---------------------------------------------------------------- SQL text forms
def round_half_sql(e: str, n: int = 0) -> str:
    """ROUND(double, n) of the reference: half away from zero, on the scaled value."""
    x = f"CAST({e} AS DOUBLE)"
    if n == 0:
        return f"round({x}, 0)"
    s = _d(10 ** n)
    return f"(round({x} * {s}, 0) / {s})"


def avg_double_sql(e: str, scale: int = 0) -> str:
    """AVG as a DOUBLE for integers or decimals of ``scale``: the sum stays exact and the
    quotient is taken on the unscaled value, ``double(sum*10^s) / double(count*10^s)``,
    which is how the reference's engine averages decimals (dividing the already scaled
    double differs in the last bit and then flips ROUND at .5 ties)."""
    if scale == 0:
        return f"(CAST(sum({e}) AS DOUBLE) / CAST(count({e}) AS DOUBLE))"
    p = 10 ** scale
    return f"(CAST(sum({e}) * {p} AS DOUBLE) / CAST(count({e}) * {p} AS DOUBLE))"


def avg_of_sums_sql(total: str, n: str, scale: int) -> str:
    """``avg_double_sql`` from partial sums ``total`` of ``scale`` decimals and counts ``n``."""
    if scale == 0:
        return f"(CAST(sum({total}) AS DOUBLE) / CAST(sum({n}) AS DOUBLE))"
    p = 10 ** scale
    return f"(CAST(sum({total}) * {p} AS DOUBLE) / CAST(sum({n}) * {p} AS DOUBLE))"


def avg_rounded_sql(e: str, scale: int) -> str:
    """AVG of a DOUBLE column whose values are already rounded to ``scale`` decimals
    (a mart's rounded averages and percentages).

    Each value is read back as the decimal it was rounded to and summed exactly, so the
    result does not depend on the order in which tasks add doubles; a true ``.5`` tie
    then rounds the way the reference's engine rounds it.
    """
    return avg_double_sql(f"CAST({e} AS DECIMAL(24,{scale}))", scale)


def to_int_sql(e: str) -> str:
    """DOUBLE -> INT with half-to-even rounding (2.5 -> 2, 1.5 -> 2)."""
    return f"CAST(rint(CAST({e} AS DOUBLE)) AS INT)"


def money_sql(e: str) -> str:
    """Money text such as ``$12,345.00`` to DECIMAL(10,2); NULL on text that is no number."""
    return f"try_cast(translate({e}, '$,', '') AS {MONEY_TYPE})"


def pct_sql(num: str, den: str, n: int = 1) -> str:
    """ROUND(num * 100.0 / NULLIF(den, 0), n) as a DOUBLE."""
    return round_half_sql(
        f"CAST({num} AS DOUBLE) * {_d(100)} / CAST(nullif({den}, 0) AS DOUBLE)", n)


def ratio_sql(num: str, den: str) -> str:
    """num / den as a DOUBLE, NULL when the denominator is 0 or NULL."""
    return f"try_divide(CAST({num} AS DOUBLE), CAST({den} AS DOUBLE))"


def score_sql(e: str, n: int) -> str:
    """Rescale a 0-5 score to 0-100: quantize to one decimal first, then times 20."""
    return f"round(CAST({e} AS DECIMAL(3,1)) * 20, {n})"


def count_true_sql(e: str) -> str:
    """SUM(CASE WHEN e THEN 1 ELSE 0 END): NULL counts as not true."""
    return f"CAST(sum(CASE WHEN {e} THEN 1 ELSE 0 END) AS BIGINT)"


def count_not_true_sql(e: str) -> str:
    """SUM(CASE WHEN e THEN 0 ELSE 1 END): NULL counts as not true."""
    return f"CAST(sum(CASE WHEN {e} THEN 0 ELSE 1 END) AS BIGINT)"

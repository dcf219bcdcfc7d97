"""Column expressions (H1–H18).  All are JVM-side ``pyspark.sql.functions``
compositions so they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Employment-length labels and their years, in natural order:
EMP_LENGTH_YEARS: dict[str, int] = {
    "< 1 year": 0, "1 year": 1, "2 years": 2, "3 years": 3, "4 years": 4,
    "5 years": 5, "6 years": 6, "7 years": 7, "8 years": 8, "9 years": 9,
    "10+ years": 10,
}
# Sub-grades A1..G5 map to 0..34; unknown or missing sub-grades map to 17.
SUB_GRADE_LETTERS = "ABCDEFG"
SUB_GRADE_STEPS = 5
ORDINAL_FALLBACK = 17
# Term text read by its first digit run; a missing term column means 36.
TERM_PATTERN = r"(\d+)"
TERM_DEFAULT = 36.0
# Threshold grid of the sweep: numpy.arange(0.05, 0.95, 0.01) (90 values).
THRESHOLD_GRID: list[float] = [float(t) for t in np.arange(0.05, 0.95, 0.01)]
# Calibration: 10 uniform bins on [0, 1], inner edges numpy.linspace(0, 1, 11)[1:-1].
CALIBRATION_EDGES: list[float] = [float(e) for e in np.linspace(0.0, 1.0, 11)[1:-1]]
# Business costs per error.
COST_FALSE_NEGATIVE = 300.0
COST_FALSE_POSITIVE = 45.0
# ---------------------------------------------------------------------------


def sub_grade_levels() -> list[str]:
    """A1, A2, ..., G5 — the rule the ordinal map is built from."""
    return [f"{g}{n}" for g in SUB_GRADE_LETTERS for n in range(1, SUB_GRADE_STEPS + 1)]


def literal_map(mapping: dict) -> Column:
    """A literal MapType column built once on the driver (bounded size)."""
    items: list[Column] = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def as_missing(c: Column) -> Column:
    """Normalise NaN to NULL so that pandas-style 'missing' tests agree."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def emp_length_num(c: Column) -> Column:
    """H1: employment text → 0..10; unknown labels and NULL → NULL."""
    return F.try_element_at(literal_map(EMP_LENGTH_YEARS), c).cast("double")


def sub_grade_ordinal(c: Column, mapping: dict[str, int] | None = None,
                      fallback: int = ORDINAL_FALLBACK) -> Column:
    """H2: A1..G5 → 0..34 via the fitted map; unknown or NULL → fallback."""
    mapping = mapping or {s: i for i, s in enumerate(sub_grade_levels())}
    return F.coalesce(F.try_element_at(literal_map(mapping), c).cast("double"),
                      F.lit(float(fallback)))


def term_months(c: Column) -> Column:
    """H3: first digit run as a double; no digits or NULL → NULL."""
    digits = F.regexp_extract(c, TERM_PATTERN, 1)
    return F.when(digits == "", F.lit(None)).otherwise(digits).try_cast("double")


def clip_upper(c: Column, cap: float) -> Column:
    """H4: upper clip that keeps NULL (``least`` would drop it)."""
    return F.when(c > F.lit(cap), F.lit(float(cap))).otherwise(c)


def was_missing(c: Column) -> Column:
    """H5 flag, computed before the fill."""
    return c.isNull().cast("int")


def one_hot(c: Column, category: str) -> Column:
    """H6: null-safe equality; NULL or unseen → 0."""
    return c.eqNullSafe(F.lit(category)).cast("int")


def number_or_zero(c: Column) -> Column:
    """H7: numeric coercion, failure or NULL → 0.0."""
    return F.coalesce(as_missing(c.try_cast("double")), F.lit(0.0))


def md5_bucket(c: Column, modulus: int = 100) -> Column:
    """``int(md5(text), 16) % modulus`` without 128-bit integers.

    The hex digest is folded 32 bits at a time with Horner's rule modulo
    ``modulus``; every intermediate value fits in a BIGINT.
    """
    h = F.md5(c.cast("string"))
    step = (1 << 32) % modulus
    acc: Column = F.lit(0).cast("bigint")
    for i in range(4):
        chunk = F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint")
        acc = (acc * F.lit(step) + chunk) % F.lit(modulus)
    return acc.cast("int")


def decision(p: Column, threshold: Column | float, upper: bool = True) -> Column:
    """P ≥ t → DENY else APPROVE."""
    deny, approve = ("DENY", "APPROVE") if upper else ("deny", "approve")
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(p >= t, F.lit(deny)).otherwise(F.lit(approve))


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def safe_ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """``num/den`` with ``default`` when the denominator is 0 or NULL."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(default))


def threshold_bucket(p: Column, grid: Iterable[float] | None = None) -> Column:
    """Number of grid thresholds ≤ p, in O(1) per row for a uniform grid.

    A floor guess from the nominal step is corrected against the exact grid
    doubles (they are not ``0.05 + i*0.01``), so the result equals
    ``Σ (p >= t_i)`` exactly.
    """
    grid = list(grid or THRESHOLD_GRID)
    n = len(grid)
    lo, step = grid[0], (grid[-1] - grid[0]) / (n - 1)
    arr = F.array(*[F.lit(t) for t in grid])
    guess = F.greatest(F.least(F.floor((p - F.lit(lo)) / F.lit(step)) + 1, F.lit(n)), F.lit(0)).cast("int")
    up = F.when((guess < n) & (p >= F.element_at(arr, F.least(guess + 1, F.lit(n)))), guess + 1).otherwise(guess)
    return F.when((up > 0) & (p < F.element_at(arr, F.greatest(up, F.lit(1)))), up - 1).otherwise(up)


def names_with_prefix(columns: Iterable[str], prefixes: Iterable[str]) -> list[str]:
    """H8: driver-side prefix match on column names (metadata only)."""
    prefixes = tuple(prefixes)
    return [c for c in columns if c.startswith(prefixes)]


def round_ratio(num: Column, den: Column, decimals: int = 4) -> Column:
    """Half-up rounding of an integer ratio, done in integer arithmetic.

    ``floor((2·num·10^d + den) / (2·den)) / 10^d`` is exact, so Spark and any
    SQL engine agree bit for bit (double rounding of ``num/den`` can differ at
    decimal ties).  0 when ``den`` is 0.
    """
    scale = 10 ** decimals
    n, d = wide(num), wide(den)
    a = n * wide(F.lit(2 * scale)) + d
    b = F.when(d == 0, wide(F.lit(1))).otherwise(d * wide(F.lit(2)))
    # a - pmod(a, b) is an exact multiple of b, so the quotient is an integer
    q = F.round((a - F.pmod(a, b)) / b)
    return F.when(d == 0, F.lit(0.0)).otherwise(q.cast("double") / F.lit(float(scale)))


def wide(c: Column) -> Column:
    """An integer as ``decimal(38,0)``: products of row counts and money units don't overflow."""
    return c.cast("decimal(38,0)")


def round_ratio_sql(num: str, den: str, decimals: int = 4) -> str:
    """SQL twin of :func:`round_ratio` (integer division ``//``)."""
    scale = 10 ** decimals
    return (f"(case when ({den}) = 0 then 0.0 else cast(((({num})::hugeint * {2 * scale} + ({den})) "
            f"// (({den})::hugeint * 2)) as double) / {float(scale)!r} end)")


def units(c: Column, decimals: int = 4) -> Column:
    """A value with at most ``decimals`` places as an exact integer count of units."""
    return F.round(c * F.lit(float(10 ** decimals))).cast("bigint")

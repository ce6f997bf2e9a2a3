"""Row-wise Catalyst expressions.  No UDFs: every helper returns a Column.

NULL is the only missing marker.  NaN and +-inf are normalised to NULL on
entry (``finite``), because Spark treats NaN as a value (NaN = NaN is true,
NaN > 0.97 is true) while the reference treats it as missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

INF = float("inf")

# Fixed value: a numeric literal as the reference's coercion accepts it
# (optional sign, digits with optional point, optional exponent, blanks around).
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c) -> Column:
    """P12 for one column: NaN, +inf, -inf -> NULL.  ``abs(c) < inf`` is false
    for both infinities and for NaN (Spark orders NaN above every value), so
    the argument is referenced twice, not three times - nested derivations
    would otherwise grow the expression tree geometrically."""
    c = _c(c)
    return F.when(F.abs(c) < F.lit(INF), c)


def finite_only(df: DataFrame) -> DataFrame:
    """P12 over the whole table: every float/double column through ``finite``."""
    out = [
        finite(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*out)


def to_number(c, dtype=None) -> Column:
    """P5: numeric coercion.  Numbers pass through (as double, non-finite ->
    NULL); text is cast only when it looks like a number ('1d' is NULL here
    although Spark's cast would accept it)."""
    c = _c(c)
    if dtype is not None and isinstance(dtype, NumericType):
        return finite(c.cast("double"))
    if dtype is not None and not isinstance(dtype, StringType):
        return F.lit(None).cast("double")
    s = c.cast("string")
    return finite(F.when(s.rlike(NUMERIC_TEXT), F.trim(s).try_cast("double")))


def coerce_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P5 over a table: listed (default all) columns become nullable doubles."""
    cols = list(df.columns) if cols is None else [c for c in cols if c in df.columns]
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[to_number(c, types[c]).alias(c) if c in cols else F.col(c) for c in df.columns])


def safe_div(num, den, check: bool = True) -> Column:
    """num / den; NULL when den is 0 or NULL or the quotient is not
    finite.  ``check=False`` leaves the finite test to an enclosing
    projection that applies it once (see ``features.engineer``)."""
    q = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return finite(q) if check else q


def clipped_log(c) -> Column:
    """ln(1 + max(c, 0)); missing stays missing (greatest(NULL, 0) = 0)."""
    c = _c(c)
    return F.when(c.isNotNull(), F.log1p(F.greatest(c, F.lit(0.0))))


def ordinal_bin(c, edges: Sequence[float]) -> Column:
    """right-closed bins (-inf, e1], (e1, e2], ..., (ek, inf) -> 0..k as
    double; NULL, NaN and -inf -> missing.  ``Bucketizer`` is left-closed, so not used."""
    c = _c(c)
    out = F.when(c.isNull() | F.isnan(c.cast("double")) | (c == F.lit(-INF)), F.lit(None).cast("double"))
    for i, e in enumerate(edges):
        out = out.when(c <= F.lit(float(e)), F.lit(float(i)))
    return out.otherwise(F.lit(float(len(edges))))


def range_flag(c, lo: float, hi: float) -> Column:
    """1.0 when lo <= c <= hi else 0.0; missing -> 0.0."""
    return F.coalesce(_c(c).between(F.lit(lo), F.lit(hi)), F.lit(False)).cast("double")


def label_encode(c, order: Sequence[str]) -> Column:
    """P10: class text -> code by position in ``order``; unknown -> NULL."""
    c = _c(c)
    out = None
    for i, v in enumerate(order):
        out = F.when(c == F.lit(v), F.lit(i)) if out is None else out.when(c == F.lit(v), F.lit(i))
    return out.cast("int")


def label_decode(c, order: Sequence[str]) -> Column:
    """P10: code -> class text; out-of-range -> NULL."""
    c = _c(c)
    out = None
    for i, v in enumerate(order):
        out = F.when(c == F.lit(i), F.lit(v)) if out is None else out.when(c == F.lit(i), F.lit(v))
    return out


def binary_target(c, negative: str) -> Column:
    """1 when the label is not ``negative`` (e.g. REAL vs FALSE POSITIVE)."""
    return (_c(c) != F.lit(negative)).cast("int")


def first_argmax(cols: Sequence[str]) -> Column:
    """Index of the largest of ``cols``; ties go to the first (lowest index)."""
    arr = F.array(*[F.col(c) for c in cols])
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")

"""Pure Column expressions (no Python UDFs): numeric-text parsing, safe
ratios, z-scores, null-aware row means, clipping, bands.

Null semantics follow pandas, which the formulas were written against:
missing values are skipped by row means and aggregates, and propagate
through plain arithmetic. NaN is treated as missing (normalised to NULL).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Tokens pandas' CSV reader reads as missing by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Python's str.strip() whitespace: Unicode White_Space plus the four ASCII
# separators \x1c-\x1f (Java's \s alone would leave tabs' cousins behind).
_WS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_STRIP = rf"(?U)^{_WS}+|{_WS}+$"
# Python float() grammar (digits may be grouped with single underscores).
_DIGITS = r"[0-9](?:_?[0-9])*"
_FLOAT_RE = (
    rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))$"
)

INF = float("inf")


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(x: float) -> Column:
    """A DOUBLE literal (a bare 1.0 in Spark SQL is a DECIMAL)."""
    return F.lit(float(x)).cast("double")


def nan_to_null(c: ColumnOrName) -> Column:
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def strip_ws(c: ColumnOrName) -> Column:
    return F.regexp_replace(col(c), _STRIP, "")


def parse_numeric(c: ColumnOrName) -> Column:
    """Messy numeric text -> DOUBLE.

    Strip whitespace; blank or '-' -> NULL; drop every '$', '%' and ','; strip
    again; parse with Python's float grammar; anything else -> NULL (the
    reference coerces unparseable text to missing). NaN -> NULL.
    Percent stays on its own scale ('58.10%' -> 58.1).
    """
    s = strip_ws(F.regexp_replace(strip_ws(c), r"[$%,]", ""))
    parsed = F.regexp_replace(s, "_", "").try_cast("double")
    v = F.when(s.rlike(_FLOAT_RE), parsed)
    return nan_to_null(v)


def safe_divide(num: ColumnOrName, den: ColumnOrName, fill: float = 0.0) -> Column:
    """Num / den with zero, missing, infinite and NaN results -> ``fill``."""
    q = F.try_divide(col(num), col(den))
    bad = q.isNull() | F.isnan(q) | (F.abs(q) == F.lit(INF))
    return F.when(bad, dbl(fill)).otherwise(q)


def zscore(x: ColumnOrName, mean: ColumnOrName, sd: ColumnOrName) -> Column:
    """(x - mean) / sd; an undefined or zero sd gives 0.0 for every row,
    missing rows included (pandas-reference behaviour)."""
    sd = col(sd)
    return F.when(sd.isNull() | (sd == 0) | F.isnan(sd), dbl(0.0)).otherwise(
        (col(x) - col(mean)) / sd)


def row_mean(cols: Sequence[ColumnOrName]) -> Column:
    """Mean of the non-missing values in a row; NULL when all are missing."""
    cols = [col(c) for c in cols]
    if not cols:
        return dbl(0.0)
    total = None
    count = None
    for c in cols:
        s = F.coalesce(c, dbl(0.0))
        n = c.isNotNull().cast("int")
        total = s if total is None else total + s
        count = n if count is None else count + n
    return F.when(count > 0, total / count)


def clip(x: ColumnOrName, lower: float | Column | None = None,
         upper: float | Column | None = None) -> Column:
    """Clip keeping NULL as NULL (``greatest``/``least`` would skip it)."""
    x = col(x)
    out = x
    if lower is not None:
        lo = dbl(lower) if not isinstance(lower, Column) else lower
        out = F.when(out < lo, lo).otherwise(out)
    if upper is not None:
        hi = dbl(upper) if not isinstance(upper, Column) else upper
        out = F.when(out > hi, hi).otherwise(out)
    return out


def log1p_clipped(x: ColumnOrName) -> Column:
    """X5 + X6: log(1 + max(x, 0)), NULL stays NULL."""
    return F.log1p(clip(x, 0.0))


def reverse_scale(x: ColumnOrName, top: float = 100.0, fill: float = 50.0) -> Column:
    """``top - fillna(fill)``."""
    return dbl(top) - F.coalesce(col(x), dbl(fill))


def mean_propagating(cols: Sequence[ColumnOrName]) -> Column:
    """Plain arithmetic mean; any missing term makes the result missing."""
    cols = [col(c) for c in cols]
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total / F.lit(float(len(cols)))


def signed_mean(positive: Sequence[Column], negative: Sequence[Column]) -> Column:
    """X10 combination: mean(positive terms) - mean(negative terms), each side
    skipping missing terms; an absent side counts as 0."""
    pos = row_mean(positive) if positive else dbl(0.0)
    neg = row_mean(negative) if negative else dbl(0.0)
    return pos - neg


def band(x: ColumnOrName, cuts: Sequence[tuple[float, str]], otherwise: str,
         descending: bool = True) -> Column:
    """X11: threshold banding. ``cuts`` are (threshold, level) checked in order
    with ``x > threshold`` (descending) or ``x < threshold`` (ascending)."""
    x = col(x)
    expr = None
    for thr, level in cuts:
        cond = (x > dbl(thr)) if descending else (x < dbl(thr))
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    return expr.otherwise(F.lit(otherwise)) if expr is not None else F.lit(otherwise)


def pct_text(x: ColumnOrName, decimals: int = 0) -> Column:
    """A share shown as a percentage, e.g. 0.734 -> '73%'."""
    return F.concat(F.format_number(col(x) * 100.0, decimals), F.lit("%"))


def fixed_text(x: ColumnOrName, decimals: int = 3) -> Column:
    """Fixed-decimal display without thousands separators, halves to the even digit (N7); missing stays missing."""
    x = col(x)
    return F.when(x.isNotNull(), F.format_string(f"%.{decimals}f", F.bround(x, decimals)))


def lookup(key: ColumnOrName, mapping: dict, default: str = "Unknown") -> Column:
    """Map a class id to a display value, ``default`` when unmapped."""
    items: list[Column] = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.coalesce(F.create_map(*items)[col(key)], F.lit(default))


def names_present(columns: Iterable[str], wanted: Iterable[str]) -> list[str]:
    """The wanted names that exist, in wanted order."""
    have = set(columns)
    return [w for w in wanted if w in have]

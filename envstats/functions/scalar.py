"""Column expressions (SCL-*, CASE-*).  All native, all inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from envstats import constants as C


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN -> null, so that null filters, ``avg`` and thresholds agree (T13)."""
    x = col(c)
    return F.when(~F.isnan(x), x)


def parse_date(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> date; malformed text gives null instead of failing (SCL-1, T2)."""
    return F.try_to_date(col(c).cast("string"), fmt)


def pad_key(c: str | Column, width: int = 5) -> Column:
    """Integer key -> zero-padded text of ``width`` (SCL-7).

    Keys longer than ``width`` are kept whole instead of being cut, so two
    distinct keys never collapse into one.
    """
    s = col(c).cast("long").cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def month_bucket(c: str | Column) -> Column:
    """First seven characters, ``yyyy-MM``, of a date or date text (SCL-3)."""
    return F.substring(col(c).cast("string"), 1, 7)


def month_start(year: str | Column, month: str | Column) -> Column:
    """First day of the month (SCL-6)."""
    return F.make_date(col(year), col(month), F.lit(1))


def pct(num: str | Column, den: str | Column) -> Column:
    """100 * num / den as double; null when den is 0 or null (SCL-10, T1)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double")) * F.lit(100.0)


def pct_decimal(num: str | Column, den: str | Column, digits: int) -> Column:
    """round(num * 100.0 / den, digits) in exact decimal arithmetic, HALF_UP,
    returned as double; null when den is 0 or null (AGG-17)."""
    q = F.try_divide(col(num).cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)"),
                     col(den).cast("decimal(20,0)"))
    return F.round(q, digits).cast("double")


def flag_at_least(c: str | Column, threshold: float) -> Column:
    """1 when c >= threshold else 0 (CASE-2, CASE-3); null compares as 0."""
    return F.when(col(c) >= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def severity_label(c: str | Column, labels=C.SEVERITY_LABELS,
                   unknown: str = C.UNKNOWN_LABEL, mode: str = "exact") -> Column:
    """Score label (CASE-1).  ``exact``: 0..5 map to D0..D5, anything else is
    Unknown; ``floor``: a fractional score takes the label below it (T3)."""
    if mode not in ("exact", "floor"):
        raise ValueError(f"mode {mode!r}")
    x = F.floor(col(c)) if mode == "floor" else col(c)
    out = None
    for value, text in labels:
        out = (F.when(x == F.lit(float(value)), F.lit(text)) if out is None
               else out.when(x == F.lit(float(value)), F.lit(text)))
    return out.otherwise(F.lit(unknown))


def place_label(sub: str | Column, region: str | Column) -> Column:
    """``"<sub>, <region>"``, null when either is null (SCL-13)."""
    return F.concat(col(sub), F.lit(", "), col(region))


def count_where(cond: Column) -> Column:
    """Number of rows where ``cond`` holds, as bigint (sum(when(..,1,0)))."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")

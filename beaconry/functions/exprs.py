"""Column functions: cleaning, typing, units, labels and calendar parts.

All of them return plain ``Column`` expressions over built-in functions, so
they stay inside whole-stage code generation.  Bad input never raises: casts
use the ``try_`` forms and divisions return null on a zero divisor.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"
UNKNOWN_CODE = -1
# Display labels of severity codes; other codes show blank.
SEVERITY_DISPLAY = {n: f"Severity Level {n}" for n in range(1, 10)}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- text ------------------------------------------------------------------

def blank_to_null(c) -> Column:
    """Trimmed text; text of only blanks becomes null."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def norm_code(c, unknown: str = UNKNOWN) -> Column:
    """Trimmed upper-case code, null or blank replaced by ``unknown``."""
    return F.coalesce(F.upper(blank_to_null(c)), F.lit(unknown))


def or_unknown(c, unknown=UNKNOWN) -> Column:
    """Null replaced by the controlled unknown member (text or -1 for codes)."""
    return F.coalesce(_c(c), F.lit(unknown))


def group_of(c, pattern: str, group: int = 1) -> Column:
    """One regex group of the text; null where the pattern does not match."""
    return F.nullif(F.regexp_extract(_c(c), pattern, group), F.lit(""))


# --- typing ----------------------------------------------------------------

def to_ts(c) -> Column:
    """Text to local timestamp, null on failure."""
    return _c(c).try_cast("timestamp_ntz")


def convert(c, type_name: str) -> Column:
    """Text to a type, null on failure.

    Whole numbers go through a decimal, so that ``"2.0"`` counts as 2 and long keys keep all digits; NaN and infinity are
    no measures and count as failures.
    """
    c = _c(c)
    if type_name in ("int", "long"):
        return c.try_cast("decimal(38,18)").try_cast(type_name)
    return to_double(c) if type_name == "double" else c.try_cast(type_name)


def to_int(c) -> Column:
    return convert(c, "int")


def to_double(c) -> Column:
    d = _c(c).try_cast("double")
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def yn_to_bool(c) -> Column:
    """Y/N to a three-valued boolean; anything else is null."""
    c = _c(c)
    return F.when(c == "Y", True).when(c == "N", False)


# --- measures --------------------------------------------------------------

def valid_measure(value, flag=None) -> Column:
    """The value where it is a non-negative number and, if given, its flag is true."""
    value = _c(value)
    ok = (value >= 0) & (value < F.lit(float("inf")))
    return F.when(ok if flag is None else (_c(flag) & ok), value)


def elapsed_seconds(start, end) -> Column:
    """Whole seconds from start to end; null when negative or incomplete."""
    secs = F.timestamp_diff("SECOND", _c(start), _c(end))
    return F.when(secs >= 0, secs.cast("double"))


def minutes_of(seconds) -> Column:
    """Seconds to minutes in double arithmetic, two digits."""
    return F.round(_c(seconds) / 60.0, 2)


def quotient(n, d=None, factor=1, digits: int | None = None, decimal: str | None = None, positive: bool = False) -> Column:
    """``factor * n / d``; null where the divisor is missing or zero, with ``positive`` also where it is negative.

    Both sides are doubles, or of the type ``decimal`` so that rounding to ``digits`` is exact and half up; the result is a
    double. Without ``d`` there is no division.
    """
    kind = decimal or "double"
    value = _c(n).cast(kind) * F.lit(factor)
    if d is not None:
        bottom = (_c(d) if isinstance(d, (str, Column)) else F.lit(d)).cast(kind)
        value = F.when(bottom > 0, value / bottom) if positive else F.try_divide(value, bottom)
    return (value if digits is None else F.round(value, digits)).cast("double")


def sec_to_min(seconds) -> Column:
    """Seconds to minutes, two exact digits."""
    return quotient(seconds, 60, digits=2, decimal="decimal(24,6)")


def pct(n, total, scale: int = 2) -> Column:
    """``n`` of ``total`` in percent, exact digits; null unless the total is positive."""
    return quotient(n, total, 100, scale, "decimal(20,0)", positive=True)


def ratio(a, b) -> Column:
    """Division that is null on a zero or missing divisor."""
    return quotient(a, b)


def cv_ratio(sd, mean) -> Column:
    """Coefficient of variation; null unless the mean is positive."""
    return quotient(sd, mean, positive=True)


def cv_pct(cv) -> Column:
    """Coefficient of variation in percent, two exact digits."""
    return quotient(cv, factor=100, digits=2, decimal="decimal(38,10)")


def changed(a, b) -> Column:
    """True/false when both sides are known, null otherwise."""
    return _c(a) != _c(b)


def at_least_zero(c) -> Column:
    return F.greatest(F.lit(0.0), _c(c))


def same(a, b) -> Column:
    """Null-safe equality."""
    return _c(a).eqNullSafe(_c(b))


def near(a, b, tol: float) -> Column:
    """Absolute difference within the tolerance."""
    return F.abs(_c(a) - _c(b)) <= tol


def n_if(cond) -> Column:
    """Number of rows for which the condition is true (false and null skip)."""
    return F.count_if(cond)


# --- calendar and labels ---------------------------------------------------

def time_bucket(hour) -> Column:
    """Six-hour part of the day; a missing hour stays null."""
    h = _c(hour)
    return (F.when(h.between(0, 5), "Overnight").when(h.between(6, 11), "Morning")
            .when(h.between(12, 17), "Afternoon").when(h.between(18, 23), "Evening"))


def time_bucket_sort(hour) -> Column:
    return (F.floor(_c(hour) / 6) + 1).cast("int")


def is_weekend(date) -> Column:
    return F.dayofweek(_c(date)).isin(1, 7)


def monday_first(date) -> Column:
    """Weekday number from 1 for Monday to 7 for Sunday."""
    return F.weekday(_c(date)) + 1


def month_start(date) -> Column:
    return F.trunc(_c(date), "month")


def date_key(date) -> Column:
    """``yyyyMMdd`` as an integer."""
    d = _c(date)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_of_key(key) -> Column:
    """Inverse of :func:`date_key`."""
    k = _c(key)
    return F.make_date(F.floor(k / 10000).cast("int"), F.floor(k / 100).cast("int") % 100, k % 100)


def year_month(date) -> Column:
    d = _c(date)
    return F.concat_ws("-", F.lpad(F.year(d).cast("string"), 4, "0"), F.lpad(F.month(d).cast("string"), 2, "0"))


def severity_label(code) -> Column:
    c = _c(code)
    return (F.when(c == UNKNOWN_CODE, "Unknown")
            .otherwise(F.concat(F.lit("Severity Level "), c.cast("string"))))


def hour_label(hour) -> Column:
    return F.concat(F.lpad(_c(hour).cast("string"), 2, "0"), F.lit(":00"))


def mapped_label(code, labels: dict, other=None) -> Column:
    """Label of a code through a fixed map."""
    pairs = [x for k, v in labels.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _c(code)), F.lit(other))


def first_match(rules, other=None) -> Column:
    """``[(condition, value), ...]``: value of the first true condition."""
    out = None
    for cond, value in rules:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(other)

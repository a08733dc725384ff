"""Column expressions shared by the operators.

All of these are native Catalyst expressions (no Python UDFs), so they stay
inside whole-stage codegen.

Float comparisons: Spark orders NaN above every number (``NaN > 1`` is true),
while the reference's language treats every comparison with NaN as false.
The ``gt``/``lt``/``ge`` helpers reproduce the latter where the reference
semantics depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")
INF = float("inf")
MICROS = 1_000_000


def c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)




def gt(a, b) -> Column:
    a, b = lit(a), lit(b)
    return ~F.isnan(a) & ~F.isnan(b) & (a > b)


def lt(a, b) -> Column:
    a, b = lit(a), lit(b)
    return ~F.isnan(a) & ~F.isnan(b) & (a < b)


def ge(a, b) -> Column:
    a, b = lit(a), lit(b)
    return ~F.isnan(a) & ~F.isnan(b) & (a >= b)


def ieee_div(a, b) -> Column:
    """a / b with IEEE results for a zero divisor (x/0 = ±Inf, 0/0 = NaN).

    Plain ``/`` raises under ANSI mode and ``try_divide`` yields NULL, while
    the reference arithmetic yields Inf/NaN.
    """
    a, b = lit(a), lit(b)
    return (F.when(b != 0, F.try_divide(a, b))
            .when(F.isnan(a) | (a == 0), F.lit(NAN))
            .when(a > 0, F.lit(INF))
            .otherwise(F.lit(-INF)))


def r6(x) -> Column:
    """Round to 6 decimals as ``round(x * 1e6) / 1e6``.

    Rounding the scaled value to an integer gives the same answer in Spark
    and DuckDB (both round half away from zero on the exact double), unlike
    ``round(x, 6)`` whose decimal conversion differs between engines.
    """
    # + 0.0 turns a rounded -0.0 into 0.0 (IEEE), in both engines
    return F.round(c(x).cast("double") * F.lit(1e6)) / F.lit(1e6) + F.lit(0.0)


def _floor_div(a: Column, b: Column) -> Column:
    return F.try_divide(a - F.pmod(a, b), b).cast("long")


def ceil_div(a, b) -> Column:
    """Exact ceil(a / b) on longs for b > 0 (any sign of a)."""
    a, b = lit(a), lit(b)
    return F.try_divide(a + F.pmod(-a, b), b).cast("long")


def fdiv(a, b) -> Column:
    """Exact floor(a / b) on longs for b > 0 (any sign of a)."""
    a, b = lit(a), lit(b)
    return _floor_div(a, b)


def ntz_micros(col) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ (or TIMESTAMP) column.

    Measured as a difference from the NTZ epoch, which does not depend on the
    session time zone.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, c(col).cast("timestamp_ntz"))




def epoch_s(us) -> Column:
    """Whole epoch seconds (floor) of a microsecond column, as BIGINT."""
    return fdiv(c(us), F.lit(MICROS))


def rfc3339_from_seconds(sec) -> Column:
    """Epoch seconds (fraction truncated toward zero) → ``YYYY-MM-DDTHH:MM:SSZ``,
    whatever the session time zone."""
    return F.concat(F.translate(utc_ntz(c(sec).cast("long")).cast("string"), " ", "T"), F.lit("Z"))


def utc_ntz(sec) -> Column:
    """Epoch seconds → the UTC wall clock as TIMESTAMP_NTZ (zone-free)."""
    return F.timestamp_add("SECOND", sec, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def utc_day(ts) -> Column:
    """Text ``YYYY-MM-DD`` of a TIMESTAMP's UTC day, whatever the session time zone."""
    return utc_ntz(epoch_s(F.unix_micros(c(ts)))).cast("date").cast("string")


# The float-text grammar accepted by the reference's parser
# (decimal or exponent notation, optional sign, inf/infinity/nan words).
FLOAT_TEXT_RE = r"(?i)\A(nan|[+-]?(inf|infinity|([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?))\z"
_INF_WORD_RE = r"(?i)^[+-]?inf(inity)?$"


def parse_float_text(s) -> Column:
    """Strict text → double: NULL where the reference parser would reject.

    ``try_cast`` alone also accepts padded text, ``5d``/``5f`` suffixes and
    overflows to Infinity; the guard rejects those.
    """
    s = c(s)
    v = F.try_cast(s, "double") if hasattr(F, "try_cast") else s.try_cast("double")
    ok = s.rlike(FLOAT_TEXT_RE) & (~F.isnull(v))
    overflow = (F.abs(v) == F.lit(INF)) & ~s.rlike(_INF_WORD_RE)
    return F.when(ok & ~overflow, v)


# The RFC 3339 grammar as the reference's layout reads it: date, ``T``, time of
# day, an optional fraction, and ``Z`` or a signed offset of hours and minutes; nothing else.
RFC3339_RE = (r"\A([0-9]{4})-([0-9]{2})-([0-9]{2})T([0-9]{2}):([0-9]{2}):([0-9]{2})(?:[.,]([0-9]+))?"
              r"(?:Z|([+-])([0-9]{2}):([0-9]{2}))\z")


def parse_rfc3339(s) -> Column:
    """Strict RFC 3339 text → epoch microseconds (digits beyond are cut off); NULL where it is
    refused: another form, a day that the month does not have, an hour above 23, a minute or
    second above 59, an offset of more than 23 hours or 59 minutes. No session zone is involved."""
    s = c(s)
    g = lambda i: F.nullif(F.regexp_extract(s, RFC3339_RE, i), F.lit(""))
    n = lambda i: F.coalesce(g(i).cast("int"), F.lit(0))
    day = F.try_to_date(F.concat_ws("-", g(1), g(2), g(3)), "yyyy-MM-dd")
    days = F.date_diff(day, F.lit("1970-01-01").cast("date")).cast("long")
    offset = (n(9) * 60 + n(10)) * F.when(g(8) == "-", F.lit(-1)).otherwise(F.lit(1))
    ok = (s.rlike(RFC3339_RE) & day.isNotNull() & (n(4) <= 23) & (n(5) <= 59) & (n(6) <= 59)
          & (n(9) <= 23) & (n(10) <= 59))
    seconds = days * 86400 + n(4) * 3600 + n(5) * 60 + n(6) - offset * 60
    micros = F.rpad(F.left(F.coalesce(g(7), F.lit("0")), F.lit(6)), 6, "0").cast("long")
    return F.when(ok, seconds * MICROS + micros)

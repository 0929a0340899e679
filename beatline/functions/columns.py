"""Scalar helpers used across operators.

Every helper returns a plain ``Column`` built from ``pyspark.sql.functions``
so that Catalyst folds and code-generates it; none of them is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_SECOND = 1_000_000
MICROS_PER_HOUR = 3_600 * MICROS_PER_SECOND
MICROS_PER_DAY = 24 * MICROS_PER_HOUR


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den, default: float | None = 0.0) -> Column:
    """``num/den``; ``default`` when the denominator is 0, NaN or NULL.

    ``try_divide`` keeps ANSI mode from raising on a zero denominator.
    """
    num, den = _c(num), _c(den)
    bad = den.isNull() | F.isnan(den.cast("double")) | (den == 0)
    return F.when(bad, F.lit(default)).otherwise(F.try_divide(num, den))


def present(df: DataFrame, name: str) -> Column:
    """A column of ``df`` with NaN and ±inf of floating types as NULL.

    Frames that come from pandas mark missing cells so; integer casts of such
    values would raise.
    """
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
    return c


def finite_or_zero(c) -> Column:
    """NaN, ±inf and NULL become 0.0."""
    c = _c(c).cast("double")
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.when(bad, F.lit(0.0)).otherwise(c)


def clamp(c, lo: float | None = 0.0, hi: float | None = 100.0) -> Column:
    """Bound a value to [lo, hi] (either side optional)."""
    c = _c(c)
    if lo is not None:
        c = F.greatest(c, F.lit(float(lo)))
    if hi is not None:
        c = F.least(c, F.lit(float(hi)))
    return c


def round_half_up(c, digits: int) -> Column:
    """``floor(x·10^d + 0.5) / 10^d``.

    Written as plain arithmetic so the DuckDB oracle can state the very same
    IEEE operations (the engines' ``round`` built-ins differ on halves).
    """
    scale = float(10 ** digits)
    return F.floor(_c(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def epoch_micros(c, dtype: T.DataType) -> Column:
    """Time column → bigint microseconds since the epoch, time-zone free.

    * ``timestamp`` (an instant) → ``unix_micros``;
    * ``timestamp_ntz`` / naive text → wall clock read as UTC;
    * text with an offset (``Z``, ``+00:00``) → the instant it names;
    * numbers → epoch seconds.
    """
    c = _c(c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return ntz_micros(c)
    if isinstance(dtype, T.StringType):
        s = F.trim(c)
        has_offset = s.rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})$")
        with_offset = F.unix_micros(F.try_to_timestamp(s))
        naive = ntz_micros(F.to_timestamp_ntz(s))
        return F.when(has_offset, with_offset).otherwise(naive)
    if isinstance(dtype, T.NumericType):
        return (c.cast("double") * F.lit(float(MICROS_PER_SECOND))).cast("bigint")
    raise TypeError(f"cannot read a time from a {dtype.simpleString()} column")


def ntz_micros(c) -> Column:
    """Wall clock of a ``timestamp_ntz`` as µs since 1970-01-01 00:00, read as UTC.

    Built from the date and time-of-day parts, which for ``timestamp_ntz`` do
    not depend on the session time zone (a cast to ``timestamp`` would, and
    would be off by an hour across daylight-saving changes).
    """
    c = _c(c).cast("timestamp_ntz")
    days = F.unix_date(c.cast("date")).cast("bigint")
    secs = F.date_part(F.lit("SECOND"), c)           # decimal(8,6): seconds with fraction
    return (days * F.lit(MICROS_PER_DAY) + F.hour(c).cast("bigint") * F.lit(MICROS_PER_HOUR)
            + F.minute(c).cast("bigint") * F.lit(60 * MICROS_PER_SECOND)
            + (secs * F.lit(MICROS_PER_SECOND)).cast("bigint"))


def hour_of_day_utc(us) -> Column:
    """Hour 0..23 of an epoch-microsecond value, in UTC."""
    return F.floor(F.pmod(_c(us), F.lit(MICROS_PER_DAY)) / F.lit(MICROS_PER_HOUR)).cast("int")


def strip_trailing_dots(c) -> Column:
    """DNS names lose their trailing dot(s)."""
    return F.regexp_replace(_c(c), r"\.+$", "")


def require_columns(df: DataFrame, required, what: str) -> None:
    """Fail at plan time, before any job runs."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what}: input is missing required columns: {missing}")

"""Scalar column functions (null-safe arithmetic, parsing, dates, casts)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "blank_to_null", "safe_double", "safe_int", "parse_day_first_date",
    "vendor_ticker", "index_key", "volume_or_zero", "local_date", "sdiv",
    "finite_or_null", "clip_lower0", "sign_label", "next_business_day",
    "or_unknown", "round_double", "truncate_text", "to_bigint", "to_decimal", "to_double",
    "DATE_FORMATS",
]

# Accepted day-first date layouts of the equity master file.
DATE_FORMATS = ("dd-MMM-yyyy", "dd-MM-yyyy", "dd/MM/yyyy", "yyyy-MM-dd")


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """trim, empty string -> NULL."""
    return F.nullif(F.trim(col_of(c)), F.lit(""))


def safe_double(c) -> Column:
    """numeric parse, anything unparsable -> NULL (never raises)."""
    return blank_to_null(col_of(c).cast("string")).try_cast("double")


def safe_int(c, zero_is_null: bool = False) -> Column:
    """integer parse; optionally 0 -> NULL (market lot)."""
    v = blank_to_null(col_of(c).cast("string")).try_cast("double").try_cast("int")
    return F.nullif(v, F.lit(0)) if zero_is_null else v


def parse_day_first_date(c, formats=DATE_FORMATS) -> Column:
    """day-first dates such as 06-OCT-2008; bad text -> NULL.

    Month names are matched case-insensitively by upper-casing the month
    part into the ``MMM`` title-case form Spark expects.
    """
    s = blank_to_null(c)
    # "06-OCT-2008" -> "06-Oct-2008": title-case alphabetic runs
    titled = F.initcap(F.lower(s))
    return F.coalesce(*[F.try_to_timestamp(titled, F.lit(fmt)) for fmt in formats]).cast("date")


def vendor_ticker(symbol, suffix: str = ".NS") -> Column:
    """vendor ticker = symbol + exchange suffix."""
    return F.concat(col_of(symbol), F.lit(suffix))


def index_key(ticker) -> Column:
    """canonical index key: strip leading '^', '=' -> '_'."""
    return F.translate(F.regexp_replace(col_of(ticker), r"^\^+", ""), "=", "_")


def volume_or_zero(v) -> Column:
    """a missing, NaN or unreadable volume -> 0, integral."""
    return F.coalesce(finite_or_null(col_of(v).try_cast("double")).try_cast("bigint"), F.lit(0).cast("bigint"))


def local_date(ts, tz: str | None = None) -> Column:
    """timestamp -> exchange-local calendar date."""
    ts = col_of(ts)
    return F.to_date(F.from_utc_timestamp(ts, tz)) if tz else F.to_date(ts)


def finite_or_null(x) -> Column:
    """+-inf and NaN -> NULL."""
    x = col_of(x)
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def sdiv(a, b) -> Column:
    """F8: null-safe divide; a zero denominator gives NULL, never an error."""
    a, b = col_of(a), col_of(b)
    return finite_or_null(a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0)))


def clip_lower0(d) -> Column:
    """clip below at 0, NULL stays NULL (plain greatest would give 0)."""
    d = col_of(d)
    return F.when(d.isNotNull(), F.greatest(d, F.lit(0.0)))


def sign_label(r, legacy_zero: bool = False) -> Column:
    """1 if r > 0 else 0.  NULL stays NULL unless ``legacy_zero``
    (then NULL maps to 0, as a NaN comparison does in the original job)."""
    r = col_of(r)
    lab = (r > 0).cast("short")
    return F.coalesce(lab, F.lit(0).cast("short")) if legacy_zero else lab


def next_business_day(d) -> Column:
    """next weekday; Fri/Sat/Sun -> Monday.  Holidays are ignored."""
    d = col_of(d)
    dow = F.dayofweek(d)  # 1 = Sunday .. 7 = Saturday
    return F.date_add(d, F.when(dow == 6, 3).when(dow == 7, 2).otherwise(1))


def or_unknown(c) -> Column:
    """missing category -> 'Unknown'."""
    return F.coalesce(col_of(c), F.lit("Unknown"))


def round_double(x, digits: int) -> Column:
    """``round(x, digits)`` of a double, the same value at a fraction of the cost.

    ``round`` writes the number out in decimal.  Away from a half, the nearest
    whole number of ``x * 10^digits`` over ``10^digits`` is the same double: below
    1e13 all errors of the product are under 0.003, and a division of two exact
    numbers gives the double nearest to the decimal.  The rest is left to ``round``."""
    x, unit = col_of(x), F.lit(float(10 ** digits))
    y = x * unit
    plain = (F.abs(y) < F.lit(1e13)) & (F.abs(y - F.rint(y)) < F.lit(0.49))
    return F.when(plain, (F.rint(y) + F.lit(0.0)) / unit).otherwise(F.round(x, digits))


def truncate_text(c, n: int) -> Column:
    """keep the first ``n`` characters (error text, run id prefix)."""
    return F.substring(col_of(c), 1, n)


def to_decimal(x, precision: int, scale: int) -> Column:
    """round-on-store into DECIMAL(p, s); overflow gives NULL, no error."""
    return col_of(x).try_cast(f"decimal({precision},{scale})")


def to_double(x) -> Column:
    """numeric -> double; bad text, NaN and infinity -> NULL."""
    return finite_or_null(col_of(x).try_cast("double"))


def to_bigint(x) -> Column:
    """Numeric, or text such as 1.5e9, -> whole number; bad or out of range -> NULL."""
    return to_double(x).try_cast("bigint")

"""Column-level helpers: every function returns a Spark ``Column`` built from
built-in expressions, so it stays inside whole-stage codegen."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Whitespace stripped by strip (Python str.strip on ASCII).
_WS = " \t\r\n\f\u000b"
# A plain decimal number, optionally signed, with an exponent; underscores
# may separate digits (as Python's float() accepts).
NUMERIC_RE = r"^[+-]?(\d(_?\d)*(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?$"

# Accepted timestamp layouts, tried in this order after the
# ISO-8601 forms Spark's cast understands (month before day when ambiguous).
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm",
    "MM/dd/yyyy",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "MM-dd-yyyy HH:mm:ss",
    "MM-dd-yyyy",
    "dd-MM-yyyy HH:mm:ss",
    "dd-MM-yyyy",
    "dd MMM yyyy",
    "MMM d, yyyy",
    "yyyyMMdd",
)

# Truthy / falsy words of to_bool.
TRUE_WORDS = ("yes", "true", "1", "y")
FALSE_WORDS = ("no", "false", "0", "n")


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnLike) -> Column:
    """Trim leading/trailing whitespace (NULL stays NULL)."""
    return F.btrim(_c(c), F.lit(_WS))


def blank_to_null(c: ColumnLike) -> Column:
    return F.nullif(strip(c), F.lit(""))


def first_non_empty(*cols: ColumnLike) -> Column:
    """``a or b`` on strings: empty and NULL both fall through."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def to_float(c: ColumnLike) -> Column:
    """Drop thousands commas, trim, parse; anything else is NULL.

    NaN and infinities are rejected (they would pass ``> 0`` checks)."""
    s = strip(F.replace(_c(c).cast("string"), F.lit(","), F.lit("")))
    parsed = F.replace(s, F.lit("_"), F.lit("")).try_cast("double")
    return F.when(s.rlike(NUMERIC_RE), parsed)


def to_bool(c: ColumnLike) -> Column:
    """yes/true/1/y -> true, no/false/0/n -> false, else NULL."""
    s = F.lower(strip(_c(c).cast("string")))
    return F.when(s.isin(*TRUE_WORDS), F.lit(True)).when(s.isin(*FALSE_WORDS), F.lit(False))


def parse_ts(c: ColumnLike, formats: tuple[str, ...] = TIMESTAMP_FORMATS,
             clean: bool = False) -> Column:
    """C4: permissive timestamp parse to a UTC instant; NULL when nothing fits.

    ISO-8601 text (with ``T``, fractions and zone offsets) goes through the
    cast rules; naive values are read in the session zone, which is UTC.
    ``clean=True`` says the input is already trimmed text (or NULL); pass a
    column reference then, so the many tries refer to one value."""
    s = _c(c) if clean else blank_to_null(_c(c).cast("string"))
    tries = [F.try_to_timestamp(s)] + [F.try_to_timestamp(s, F.lit(f)) for f in formats]
    return F.coalesce(*tries)


def default_zero(c: ColumnLike) -> Column:
    """``to_float(x) or 0.0``."""
    return F.coalesce(_c(c), F.lit(0.0))


def iso_utc(ts: ColumnLike) -> Column:
    """ISO-8601 text of a UTC instant as Python's ``isoformat`` writes
    it: fraction only when non-zero, offset ``+00:00``."""
    t = _c(ts)
    frac = F.date_format(t, "SSSSSS")
    return F.when(t.isNotNull(), F.concat(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac != "000000", F.concat(F.lit("."), frac)).otherwise(F.lit("")),
        F.lit("+00:00")))


def float_text(c: ColumnLike) -> Column:
    """A double as Python's ``str(float)`` writes it. Spark's text of a double
    switches to exponent form from 1e7 (``1.0E7``); Python only from 1e16.
    Whole values in between are written plainly (``12500000.0``); other
    values keep the shortest round-trip text both languages share."""
    x = _c(c).cast("double")
    plain_whole = (F.abs(x) >= 1e7) & (F.abs(x) < 1e16) & (x == F.floor(x))
    return (F.when(plain_whole, F.concat(x.cast("decimal(17,0)").cast("string"), F.lit(".0")))
            .otherwise(F.format_string("%s", x)))


def as_of_date(as_of: str | _dt.date | None) -> Column:
    """The run date; ``None`` means today."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def as_of_ts(as_of: str | _dt.datetime | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")


def surrogate_id(key: ColumnLike, fallback_key: ColumnLike | None = None,
                 prefix: str = "CUSTOMER_") -> Column:
    """C14: document id = the key, else ``<prefix><fallback>``."""
    k = blank_to_null(key)
    if fallback_key is None:
        return k
    return F.coalesce(k, F.concat(F.lit(prefix), blank_to_null(fallback_key)))


# ---- silver derivations -------------------------------------------------

def split_timestamp(ts_text: ColumnLike) -> tuple[Column, Column]:
    """H8: text timestamp -> (date, ``HH:mm:ss`` string); text in another
    layout is read as validation reads it."""
    text = _c(ts_text).cast("string")
    ts = F.coalesce(F.try_to_timestamp(text), parse_ts(text))
    return F.to_date(ts), F.date_format(ts, "HH:mm:ss")


def age_years(d: ColumnLike, as_of=None) -> Column:
    """H9: whole years between ``d`` and the run date."""
    return F.floor(F.months_between(as_of_date(as_of), _c(d)) / 12)


def geo_part(c: ColumnLike, i: int) -> Column:
    """I-th part of ``"lat,long"`` as a string (NULL when absent)."""
    return F.get(F.split(_c(c), ","), i)


def truthy_status(c: ColumnLike, words=("verified", "true")) -> Column:
    """lower(c) in (verified, true) -> true; anything else, NULL too, false."""
    return F.coalesce(F.lower(_c(c)).isin(*words), F.lit(False))


def severity(reason: ColumnLike) -> Column:
    """Reason mentions 'mismatch' -> HIGH, 'unverified' -> MEDIUM, else LOW."""
    r = F.lower(_c(reason))
    return (F.when(r.contains("mismatch"), "HIGH")
            .when(r.contains("unverified"), "MEDIUM").otherwise("LOW"))


def validity(expiry: ColumnLike, as_of=None) -> Column:
    """NULL -> UNKNOWN, before the run date -> EXPIRED, else VALID."""
    e = _c(expiry)
    return (F.when(e.isNull(), "UNKNOWN")
            .when(e < as_of_date(as_of), "EXPIRED").otherwise("VALID"))


def file_name_of(path: ColumnLike) -> Column:
    """A10: last path segment of a URL or path."""
    return F.element_at(F.split(_c(path), "/"), -1)


# Source routing keywords, checked in this order.
SOURCE_KEYWORDS = (("atm", "ATM"), ("upi", "UPI"), ("account", "ACCOUNT"), ("customer", "CUSTOMER"))


def source_type(file_name: ColumnLike) -> Column:
    """Route by case-insensitive substring of the file name."""
    f = F.lower(_c(file_name))
    expr = None
    for needle, label in SOURCE_KEYWORDS:
        expr = (F.when(f.contains(needle), label) if expr is None
                else expr.when(f.contains(needle), label))
    return expr.otherwise("UNKNOWN")


def is_csv_name(file_name: ColumnLike) -> Column:
    """Extension gate (case-sensitive, as in the reference)."""
    return _c(file_name).endswith(".csv")

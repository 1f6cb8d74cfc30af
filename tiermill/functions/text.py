"""Text and timestamp helpers used by staging, quarantine and ingest rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output formats of the canonical hire time, the DLQ export time
# and the snapshot stamp.
CANONICAL_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
EXPORT_FORMAT = "yyyy-MM-dd HH:mm:ss"
STAMP_FORMAT = "yyyyMMdd_HHmmss"

# A timestamp text must start with a full calendar date.  Spark's cast alone
# also accepts "2021", "2021-11" and a bare time of day (taken as today).
DATE_GUARD = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ Tt].*)?$"

# The whitespace characters stripped from text fields (the
# characters for which Python's ``str.isspace`` holds), in code point order.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003"
              "\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Remove leading/trailing whitespace of any kind (plain ``trim`` strips
    only spaces); a character-set trim, much cheaper than a regex."""
    return F.trim(col_of(c), F.lit(WHITESPACE))


def is_blank(c: str | Column) -> Column:
    """True when the text is empty after stripping; null stays null."""
    return strip_ws(c) == F.lit("")


def safe_timestamp(c: str | Column) -> Column:
    """Parse text as a timestamp, or null when it is not one (never raises)."""
    text = col_of(c)
    return F.when(text.rlike(DATE_GUARD), text.try_cast("timestamp"))


def canonical_text(ts: str | Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` in UTC, fractions of a second cut."""
    return F.date_format(col_of(ts), CANONICAL_FORMAT)


def parse_canonical(c: str | Column) -> Column:
    """Strict parse of the canonical text written by :func:`canonical_text`:
    any other text raises (ANSI mode)."""
    return F.to_timestamp(col_of(c), CANONICAL_FORMAT)


def ts_literal(text: str) -> Column:
    """A timestamp literal read in the session zone (UTC); folded to a
    constant by the optimizer, so comparisons with it reach the scan."""
    return F.lit(text).cast("timestamp")


def in_year(ts: str | Column, year: int) -> Column:
    """``year(ts) = year`` written as a half-open range so that it can be
    pushed to the parquet reader and prune partitions."""
    t = col_of(ts)
    return (t >= ts_literal(f"{year:04d}-01-01 00:00:00")) & \
        (t < ts_literal(f"{year + 1:04d}-01-01 00:00:00"))


def round_to_long(c: str | Column) -> Column:
    """Float to integer the way a warehouse cast does: round half away from
    zero (a plain Spark cast truncates)."""
    return F.round(col_of(c)).cast("bigint")


def audit_time(as_of: str | None = None) -> Column:
    """Audit stamp: the query time, or a fixed ``as_of`` for reproducible runs."""
    return F.current_timestamp() if as_of is None else ts_literal(as_of)


def stamp_text(ts: str | Column) -> Column:
    """``yyyyMMdd_HHmmss`` stamp (sorts lexically in time order)."""
    return F.date_format(col_of(ts), STAMP_FORMAT)


def export_text(ts: str | Column) -> Column:
    return F.date_format(col_of(ts), EXPORT_FORMAT)

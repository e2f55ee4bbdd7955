"""Column expressions with the exact semantics the pipeline needs.

All of these are built-in Spark expressions (JVM side, whole-stage codegen);
none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date a missing high-water mark falls back to.
EPOCH_FLOOR = "1900-01-01 00:00:00"


def col_of(c: str | Column) -> Column:
    """Column for a name that may contain literal dots (``"country.id"``)."""
    if isinstance(c, Column):
        return c
    return F.col(quote(c))


def quote(name: str) -> str:
    """Backtick-quote a column name so dots are not read as struct access."""
    return "`" + name.replace("`", "``") + "`"


def trim_spaces(c: str | Column) -> Column:
    """Strip leading/trailing Unicode space separators (category Zs).

    Covers U+0020, U+00A0 (no-break space), U+2000..U+200A, U+3000 ...;
    tabs and newlines are kept, as in the reference's ``trim``.  Spark's own
    ``trim`` strips only U+0020.
    """
    return F.regexp_replace(col_of(c), r"^\p{Zs}+|\p{Zs}+$", "")


def concat_skip_null(*parts: str | Column) -> Column:
    """``concat`` that treats null parts as empty strings (never null).

    ``concat('X', ', ', NULL)`` is ``'X, '`` here; Spark's ``concat`` would
    return null.
    """
    return F.concat_ws("", *[_as_text(p) for p in parts])


def _as_text(p: str | Column) -> Column:
    if isinstance(p, Column):
        return p.cast("string")
    return F.lit(p)


# Parsers use try-casts: with ANSI mode on (the Spark 4 default) a single
# malformed time string in a landed page would otherwise fail the whole
# job; here it becomes null (and drops out of keyed loads, like a null key).


def wall_clock(c: str | Column) -> Column:
    """Local wall-clock timestamp of an ISO text or timestamp column.

    ``'2025-12-30T23:05:00+02:00'`` -> ``2025-12-30 23:05:00`` (offset
    ignored), matching a cast to a zone-less datetime.
    """
    return col_of(c).try_cast("timestamp_ntz")


def text_date(c: str | Column) -> Column:
    """Calendar date of an ISO text or timestamp column (its date part)."""
    return col_of(c).try_cast("date")


def instant(c: str | Column) -> Column:
    """Point in time of an ISO text: the offset counts (``Z``, ``+02:00``)."""
    return col_of(c).try_cast("timestamp")


def utc_lit(at: _dt.datetime) -> Column:
    """A point in time as a literal.  A time without a zone is in UTC,
    whatever the zone of the driver."""
    aware = at if at.tzinfo else at.replace(tzinfo=_dt.timezone.utc)
    micros = (aware - _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)) // _dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def hour_of(c: Column) -> Column:
    """Hour 0..23 as bigint."""
    return F.hour(c).cast("bigint")


def iso_dow(d: Column) -> Column:
    """ISO day of week, Monday = 1 ... Sunday = 7, as bigint.

    ``F.weekday`` is Monday = 0; ``F.dayofweek`` is Sunday = 1 (not ISO).
    """
    return (F.weekday(d) + F.lit(1)).cast("bigint")


def iso_text(c: Column) -> Column:
    """Instant as ISO-8601 text in UTC with microseconds and ``Z``."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def file_stamp(c: Column) -> Column:
    """Compact stamp used in landing file names: ``yyyyMMdd_HHmmssSSSSSS``."""
    return F.date_format(c, "yyyyMMdd_HHmmssSSSSSS")


def display_name(*candidates: str | Column) -> Column:
    """First non-null of the candidates (empty string is not null)."""
    return F.coalesce(*[col_of(c) for c in candidates])


def locality_name(locality: str | Column = "locality", name: str | Column = "name") -> Column:
    """Grouping name of a locality: trimmed locality, else trimmed name."""
    return trim_spaces(F.coalesce(col_of(locality), col_of(name)))


def key_text(*parts: str | Column, sep: str = "|") -> Column:
    """Composite key as text ``k1|k2|...`` (null parts become empty)."""
    pieces: list[str | Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(sep)
        pieces.append(col_of(p) if isinstance(p, str) else p)
    return concat_skip_null(*pieces)

"""Reusable column expressions. All stay inside Catalyst; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "9999-12-31 00:00:00"
FIRST_SEEN = "1970-01-01 00:00:00"
UNKNOWN_KEY = -1


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text to number -------------------------------------------------------------------------
# SQL text rather than Column, so that profile and quality rules can be written as plain strings.
# The pattern decides first: a failing try_cast builds and drops an exception per row, which on a
# column of dirty text costs far more than the match. It also refuses Java's suffixes ('12f').

_WHOLE = r"^\\s*[+-]?[0-9]{1,19}\\s*$"
_NUMBER = r"^\\s*[+-]?(([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\\s*$"


def double_text(column: str) -> str:
    """Text to double, NULL when unreadable."""
    return f"CASE WHEN {column} RLIKE '{_NUMBER}' THEN try_cast({column} AS DOUBLE) END"


def bigint_text(column: str) -> str:
    """Text to bigint; fractional text rounds half away from zero ('3.7' -> 4)."""
    return (
        f"CASE WHEN {column} RLIKE '{_WHOLE}' THEN try_cast({column} AS BIGINT) "
        f"ELSE try_cast(round({double_text(column)}) AS BIGINT) END"
    )


def int_text(column: str) -> str:
    """Text to int with the same rounding; NULL when out of range."""
    return f"try_cast({bigint_text(column)} AS INT)"


def decimal_text(column: str, precision: int, scale: int) -> str:
    """Text to decimal, rounded half away from zero to `scale`; NULL when unreadable."""
    return f"CASE WHEN {column} RLIKE '{_NUMBER}' THEN try_cast(trim({column}) AS DECIMAL({precision},{scale})) END"


def clock_text(column: str) -> str:
    """Text to timestamp, NULL unless it is yyyy-MM-dd HH:mm:ss to the letter: no lacking zeros, no other separator, nothing
    before or behind, and a day and time that exist."""
    exact = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
    return f"CASE WHEN {column} RLIKE '{exact}' THEN try_to_timestamp({column}, 'yyyy-MM-dd HH:mm:ss') END"


def blank_text(column: str) -> str:
    return f"({column} IS NULL OR trim({column}) = '')"


# --- missing values -------------------------------------------------------------------------

def is_missing(c: Column | str) -> Column:
    return _col(c).isNull() | (_col(c) == "")


def is_blank(c: Column | str) -> Column:
    return _col(c).isNull() | (F.trim(_col(c)) == "")


# --- dates ----------------------------------------------------------------------------------

def date_key(d: Column | str) -> Column:
    """Date or timestamp to the YYYYMMDD integer key (arithmetic, so no formatter per row)."""
    d = _col(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def date_key_or_unknown(d: Column | str) -> Column:
    return F.coalesce(date_key(d), F.lit(UNKNOWN_KEY))


def month_of_key(key: Column | str) -> Column:
    """YYYYMMDD -> YYYYMM, the partition value. The unknown key -1 keeps a value of its own, and
    NULL shares it."""
    key = F.coalesce(_col(key), F.lit(UNKNOWN_KEY))
    return F.when(key < 0, key).otherwise(F.floor(key / 100).cast("int"))


def sunday_zero(d: Column | str) -> Column:
    return F.dayofweek(_col(d)) - 1


def is_weekend(d: Column | str) -> Column:
    return F.dayofweek(_col(d)).isin(1, 7)


def local_time(utc: Column | str, zone: str) -> Column:
    """UTC wall clock (NTZ) to the wall clock of `zone`."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(utc))


def offset_seconds(local: Column | str, utc: Column | str) -> Column:
    return F.timestamp_diff("SECOND", _col(utc), _col(local))


# --- hashes, ratios, circular measures ------------------------------------------------------

def row_hash(columns: Sequence[str]) -> Column:
    """md5 over trimmed attributes joined with '|'. A NULL keeps its place as an empty field."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) for c in columns]))


def share_2(part: Column | str, whole: Column | str) -> Column:
    """part/whole of two counts, rounded half up to 2 decimals in integer arithmetic.

    Rounding the double quotient would turn 29/200 into 0.14 or 0.15 depending on the engine.
    """
    part, whole = _col(part).cast("bigint"), _col(whole).cast("bigint")
    scaled = F.floor((part * 200 + whole) / (whole * 2))
    return F.when(whole != 0, scaled.cast("double") / 100)


def exact_avg(c: Column | str, scale: int = 2) -> Column:
    """Average of a double holding `scale` decimals, summed as decimal so that it does not depend
    on the order in which partitions arrive."""
    c = _col(c)
    return F.sum(c.cast(f"decimal(18,{scale})")).cast("double") / F.count(c)


def circular_mean(degrees: Column | str) -> Column:
    """Mean direction in [0, 360). Averages unit vectors, since 350 and 10 must give 0, not 180.
    Directions that cancel out have no mean: NULL."""
    rad = F.radians(_col(degrees))
    y, x = F.avg(F.sin(rad)), F.avg(F.cos(rad))
    mean = F.pmod(F.round(F.degrees(F.atan2(y, x)), 6), F.lit(360.0))
    return F.when(F.sqrt(x * x + y * y) > 1e-9, mean)

"""Lenient parsing expressions: text in, typed value or NULL out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
PHONE_RE = r"(?U)^\+?[\d\s\-().]{7,20}$"
# An atom's characters are the visible ASCII ones but those listed: a range and one look into a
# table, where a union of ranges is tried one by one.
_ATOM = r"[!-~&&[^\"(),.:;<>@\[\]\\]]+"
EMAIL_RE = (
    rf"^{_ATOM}(\.{_ATOM})*"
    r"@([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}$"
)
MAX_LOCAL_PART = 64
# ----------------------------------------------------------------------------

_DATE = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}"
_CLOCK = r"\d{1,2}:\d{1,2}:\d{1,2}"
_ISO_RE = rf"{_DATE}( {_CLOCK}|T{_CLOCK}Z?)?$"
_SPACED_RE = rf"{_DATE}\s+{_CLOCK}$"
_SLASH_RE = r"^(\d{1,2})/(\d{1,2})/((?!0000)\d{4})$"
_INTEGER_RE = r"^[+-]?\d+(_\d+)*(\.0+)?$"


def is_email(text: Column) -> Column:
    """Dot-atom local part of at most 64 characters at a dotted domain."""
    short_local = F.length(F.substring_index(text, "@", 1)) <= MAX_LOCAL_PART
    return text.rlike(EMAIL_RE) & short_local


def is_phone(text: Column) -> Column:
    return text.rlike(PHONE_RE)


def _without_underscores(text: Column) -> Column:
    return F.when(text.contains("_"), F.translate(text, "_", "")).otherwise(text)


def to_decimal(text: Column) -> Column:
    """DECIMAL(38,18), or NULL for anything that is not a finite number."""
    return _without_underscores(text).try_cast("decimal(38,18)")


def to_price(text: Column) -> Column:
    """Rounded half-even to cents."""
    return F.bround(to_decimal(text), 2)


def to_integer(text: Column) -> Column:
    """Whole numbers, ``2.0`` included and ``2.5`` not."""
    whole = F.when(text.contains("."), F.substring_index(text, ".", 1)).otherwise(text)
    return F.when(text.rlike(_INTEGER_RE), _without_underscores(whole).try_cast("bigint"))


def to_timestamp(text: Column) -> Column:
    """First match of year-month-day with optional time (a space or ``T``, the
    latter with optional ``Z``), day/month/year, month/day/year.

    The patterns fix the shape and the cast checks the ranges. A cast to a
    timestamp without zone drops the ``Z`` and ignores the session time zone.
    """

    def cast(value: Column) -> Column:
        return value.try_cast("timestamp_ntz")

    return (
        F.when(text.rlike(_ISO_RE), cast(text))
        .when(text.rlike(_SPACED_RE), cast(F.regexp_replace(text, r"\s+", " ")))
        .when(
            text.rlike(_SLASH_RE),
            F.coalesce(
                cast(F.regexp_replace(text, _SLASH_RE, "$3-$2-$1")),
                cast(F.regexp_replace(text, _SLASH_RE, "$3-$1-$2")),
            ),
        )
    )

"""Column expressions for parsing raw lines; all JVM-side, no Python UDFs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shape of an integer the jobs accept (optional sign, ASCII
# digits, nothing else; Java's Long.parseLong / Integer.valueOf accept the same).
INTEGER_PATTERN = r"^[+-]?[0-9]+\z"
# The access-log time layout; the zone id is appended before parsing.
LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"


def split_fields(value: Column, sep: str) -> Column:
    """Split a line on the literal separator ``sep`` the way ``String.split``
    does: trailing empty fields are dropped, inner empty fields are kept.

    A one-character separator is trimmed off the end with ``rtrim`` (no
    regular expression per row); a longer one with an anchored replace.
    """
    pattern = re.escape(sep)
    if len(sep) == 1:
        stripped = F.rtrim(value, F.lit(sep))
    else:
        stripped = F.regexp_replace(value, f"(?:{pattern})+$", "")
    return F.split(stripped, pattern)


def field(fields: Column, index: int) -> Column:
    """0-based field, null when the line has too few fields."""
    return F.get(fields, index)


def parse_integer(text: Column, type_name: str = "bigint") -> Column:
    """Strict integer parse: null unless the whole text matches
    ``INTEGER_PATTERN`` and fits the type (so ``' 7 '``, ``'7x'`` and ``'7\\n'``
    are rejected; ``\\z`` is the very end, where ``$`` would allow a newline)."""
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast(type_name))


def parse_log_time_ms(text: Column, tz: str = "UTC") -> Column:
    """``dd/MM/yyyy:HH:mm:ss`` in zone ``tz`` -> epoch ms.

    Null when malformed, not a calendar date (``31/02/2015``), one-digit
    fields, or followed by other text. The zone is named in the parsed text
    (pattern letter ``VV``), so the session time zone plays no part.
    """
    with_zone = F.concat(text, F.lit(" " + tz))
    return F.unix_millis(F.try_to_timestamp(with_zone, F.lit(LOG_TIME_FORMAT + " VV")))

"""Zone-free time columns.

All window arithmetic in this package is done on ``bigint`` epoch
milliseconds, so results never depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz_epoch_micros(col: str) -> Column:
    """Epoch microseconds of a ``timestamp_ntz`` column read as UTC wall time.

    A plain cast to ``timestamp`` would apply the session zone; the difference
    to the NTZ epoch does not.
    """
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{col}`)")


def floor_div(col: Column, divisor: int) -> Column:
    """Exact integer floor division of a bigint by a positive constant.

    Integral ``div`` truncates toward zero; one less when the remainder is
    negative gives the floor. No floating point, no overflow.
    """
    d = F.lit(divisor)
    return F.call_function("div", col, d) - F.when(col % d < 0, F.lit(1)).otherwise(F.lit(0))


def millis_to_ntz(col: Column) -> Column:
    """Epoch ms -> ``timestamp_ntz`` holding the UTC wall time."""
    return F.timestamp_add("MILLISECOND", col, F.expr(_EPOCH_NTZ))


def java_timestamp_text(ms: Column) -> Column:
    """Epoch ms -> text as ``java.sql.Timestamp.toString`` prints it, in UTC.

    ``yyyy-MM-dd HH:mm:ss.f`` where the fraction has its trailing zeros
    stripped but keeps at least one digit (``.0`` for whole seconds).
    """
    wall = millis_to_ntz(ms)
    frac_ms = F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0")
    frac = F.when(F.pmod(ms, F.lit(1000)) == 0, F.lit("0")).otherwise(
        F.regexp_replace(frac_ms, "0+$", ""))
    return F.concat(F.date_format(wall, "yyyy-MM-dd HH:mm:ss"), F.lit("."), frac)

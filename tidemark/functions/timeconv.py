"""Epoch conversions with the open-period sentinel.

Epoch nanoseconds (LongType) are the source of truth for order,
equality and windows; timestamps (microseconds) appear only at the
edges. Everything here is a native Catalyst expression, so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The open-period end 9999-12-31 23:59:59.9999999 as epoch
# nanoseconds wrapped to signed 64 bits, and the last representable
# microsecond of that day.
SENTINEL_NS = -4852116231933722724
MAX_MICROS = 253402300799999999
NS_PER_US = 1000
NS_PER_MS = 1000000
NS_PER_S = 1000000000


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ns_div(col, n: int) -> Column:
    """Integral division truncating toward zero (like SQL ``CAST AS INT``)."""
    return F.call_function("div", _c(col), F.lit(n))


def is_open(col) -> Column:
    return _c(col) == F.lit(SENTINEL_NS)


def ns_to_ts(col) -> Column:
    """Epoch ns -> TIMESTAMP; the sentinel maps to the last microsecond of 9999."""
    c = _c(col)
    return (F.when(c == F.lit(SENTINEL_NS), F.timestamp_micros(F.lit(MAX_MICROS)))
            .otherwise(F.timestamp_micros(ns_div(c, NS_PER_US))))


def ms_to_ts(col) -> Column:
    return F.timestamp_millis(_c(col))


def epoch_to_ts(col, unit: str = "NANOSECOND") -> Column:
    """Scalar epoch conversion by unit name; any other unit gives NULL."""
    unit = unit.upper()
    if unit == "NANOSECOND":
        return ns_to_ts(col)
    if unit == "MILLISECOND":
        return ms_to_ts(col)
    return F.lit(None).cast("timestamp")


def ts_to_ns(col) -> Column:
    """TIMESTAMP or TIMESTAMP_NTZ (UTC wall clock) -> epoch ns."""
    return F.unix_micros(_c(col).cast("timestamp")) * F.lit(NS_PER_US)


def day_to_date(col) -> Column:
    """Integer days since 1970-01-01 (the wire form of DATE) -> DATE."""
    return F.date_from_unix_date(_c(col).cast("int"))


def round_seconds_ns(col) -> Column:
    """Round epoch ns to whole seconds, half up (DATETIME2(0) cast rule).

    The sentinel is tested first: as a number it would wrap.
    """
    c = _c(col)
    shifted = c + F.lit(NS_PER_S // 2)
    return F.when(c == F.lit(SENTINEL_NS), c).otherwise(shifted - F.pmod(shifted, F.lit(NS_PER_S)))

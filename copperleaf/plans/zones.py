"""Days, weeks and months of a time zone, as ranges of instants that reach the scan.

Times without a zone (timestamp_ntz) are UTC wall times, times with one are instants; the
session's zone plays no part for either. A day has 23 or 25 hours where clocks change; a local
midnight that does not exist is the first instant after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from copperleaf.plans import summaries as S

UTC = "UTC"


def _is_instant(rows: DataFrame, time: str) -> bool:
    return dict(rows.dtypes)[time] == "timestamp"


def localized(rows: DataFrame, zone: str = UTC, time: str = S.T) -> DataFrame:
    """The rows with local wall time (timestamp_ntz) in place of their time; summaries of them are the zone's."""
    if _is_instant(rows, time):
        # an instant's UTC wall time, whatever the session's zone
        seconds = F.unix_micros(time)
        wall = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (seconds / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)"))
    else:
        wall = F.col(time)
    return rows.withColumn(time, F.convert_timezone(F.lit(UTC), F.lit(zone), wall))


def bounds(kind: str, value: str, zone: str = UTC) -> tuple[Column, Column]:
    """First instant of a local day, week or month and of the one after it, as UTC wall times."""
    low, high = S.period_days(kind, value)
    instant = lambda day: F.convert_timezone(F.lit(zone), F.lit(UTC), day.cast("timestamp_ntz"))
    return instant(low), instant(high)


def in_local_period(rows: DataFrame, kind: str, value: str, zone: str = UTC, time: str = S.T) -> DataFrame:
    """Rows of a local day, week or month: a half-open range on the stored column."""
    low, high = bounds(kind, value, zone)
    if _is_instant(rows, time):
        micros = lambda x: F.timestamp_micros(F.lit(1_000_000) * F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), x))
        low, high = micros(low), micros(high)
    return rows.filter((F.col(time) >= low) & (F.col(time) < high))

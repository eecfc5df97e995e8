"""Zone-free arithmetic on TIMESTAMP_NTZ.

``timestamp_diff``/``timestamp_add`` apply the session time zone even to
TIMESTAMP_NTZ (an hour goes missing across a DST change). Subtracting two NTZ
values gives a day-time interval computed without any zone; these helpers
build everything from that.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ntz() -> Column:
    return F.lit(EPOCH).cast("timestamp_ntz")


def interval_seconds(iv: Column) -> Column:
    """Seconds (DECIMAL, microsecond precision) in a day-time interval."""
    return (F.extract(F.lit("DAY"), iv).cast("bigint") * 86400
            + F.extract(F.lit("HOUR"), iv).cast("bigint") * 3600
            + F.extract(F.lit("MINUTE"), iv).cast("bigint") * 60
            + F.extract(F.lit("SECOND"), iv))


def seconds_between(start, end) -> Column:
    return interval_seconds(_col(end) - _col(start))


def epoch_micros(c) -> Column:
    """Microseconds since 1970-01-01 00:00:00 of an NTZ wall-clock value."""
    return (seconds_between(epoch_ntz(), c) * 1_000_000).cast("bigint")


def micros_to_ntz(micros: Column) -> Column:
    secs = (micros / F.lit(1_000_000)).cast("decimal(18,6)")
    return epoch_ntz() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)

"""Time expressions of the audit trail."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the audit trail's clock pattern. ``hh`` is a 12-hour clock with
# no AM/PM mark, so 13:05 reads 01:05 and 00:05 reads 12:05.
AUDIT_PATTERN = "yyyy-MM-dd hh:mm:ss"


def audit_time(moment: Column) -> Column:
    return F.date_format(moment, AUDIT_PATTERN)


def whole_seconds(start_ms: Column, end_ms: Column) -> Column:
    """Elapsed seconds with the fraction cut off."""
    return F.call_function("div", end_ms - start_ms, F.lit(1000))

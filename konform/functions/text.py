"""Run-log text and time helpers (G5-G7) as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import LOCAL_TIME_ZONE


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def message_tail(msg, sep: str = " - ") -> Column:
    """The text after the last separator, trimmed (``' - '`` in the newest
    lineage; ``'-'`` in the older one, which also cuts hyphenated words)."""
    return F.trim(F.substring_index(_col(msg), sep, -1))


def elapsed_hms(seconds) -> Column:
    """Whole seconds as ``HH:MM:SS`` (hours may exceed 24)."""
    s = _col(seconds).cast("long")
    return F.format_string("%02d:%02d:%02d", (s / 3600).cast("long"),
                           ((s % 3600) / 60).cast("long"), s % 60)


def local_time(ts, zone: str = LOCAL_TIME_ZONE) -> Column:
    """A UTC wall-clock time shown in the local zone (Europe/Amsterdam)."""
    # convert_timezone on a zone-less timestamp does not depend on the session zone.
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts).cast("timestamp_ntz"))

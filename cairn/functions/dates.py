"""Dates and run timestamps.

``to_date(text, fmt)`` raises on bad text under ANSI mode; the reference's
jobs expect NULL, so parsing uses the ``try_`` forms.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INGEST_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_date(col, fmt: str = "yyyy-MM-dd") -> Column:
    """Text → DATE; text in another layout → NULL."""
    return F.try_to_date(_c(col), fmt) if fmt else _c(col).try_cast("date")


def parse_timestamp(col, fmt: str = INGEST_FORMAT) -> Column:
    return F.try_to_timestamp(_c(col), F.lit(fmt))


def ingestion_time(run_ts: str | None = None) -> Column:
    """Ingestion time text ``yyyy-MM-dd HH:mm:ss``: the given run time (for
    reproducible reruns) or the query's current timestamp."""
    if run_ts is not None:
        return F.lit(run_ts)
    return F.date_format(F.current_timestamp(), INGEST_FORMAT)


def run_date(run_date_text: str | None = None) -> Column:
    return F.lit(run_date_text).cast("date") if run_date_text else F.current_date()


def date_folders(ts) -> list[Column]:
    """Zero-padded ``year``, ``month``, ``day`` folder values of a timestamp;
    text that is no timestamp gives NULL (the default partition)."""
    t = _c(ts).try_cast("timestamp")
    return [F.date_format(t, "yyyy").alias("year"),
            F.date_format(t, "MM").alias("month"),
            F.date_format(t, "dd").alias("day")]

"""What has run out and what has vanished."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeflow.functions.temporal import elapsed_days, is_closed

MISSING_DAYS = 3


def _closed(now: dt.datetime) -> Column:
    return is_closed(F.col("bid_deadline_date"), F.col("bid_deadline_time"), F.lit(now).cast("timestamp_ntz"))


def close_expired(tenders: DataFrame, now: dt.datetime) -> DataFrame:
    """Open tenders past their deadline become closed; no revision is written."""
    return tenders.withColumn("status", F.when((F.col("status") == "open") & F.col("bid_deadline_date").isNotNull() & _closed(now), "closed").otherwise(F.col("status")))


def disappeared(tenders: DataFrame, now: dt.datetime, days: int = MISSING_DAYS) -> DataFrame:
    """Open tenders not yet due that no listing has shown for so many days, longest first."""
    gone = elapsed_days(F.lit(now).cast("timestamp_ntz"), F.col("last_seen_at"))
    found = tenders.where((F.col("status") == "open") & ~_closed(now)).withColumn("days_missing", gone).where(F.col("days_missing") >= days)
    return found.orderBy(F.desc("days_missing"), "natural_key")

"""Event-time helpers.

Bronze and silver keep event times as text, exactly as they landed. Two
encodings occur: epoch milliseconds (``"1743069600123"``, written by a
pandas-based extract) and ISO-8601 (``"2025-03-27T10:00:00.123Z"``, written
by Spark's JSON writer). ``parse_event_ts`` reads both, JVM-side, so every
consumer (gold day arithmetic, watermarks) works on either landing format.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_MS_PATTERN = r"^-?[0-9]+$"

# Fixed formats: run id and load date (UTC), and the dated names of
# landing files, review dumps and log files.
RUN_ID_FORMAT = "%Y%m%dT%H%M%SZ"
LOAD_DATE_FORMAT = "%Y-%m-%d"
RUN_ID_SPARK_FORMAT = "yyyyMMdd'T'HHmmss'Z'"
DAILY_FILE_SPARK_FORMAT = "ddMMyyyy"
REVIEW_FILE_SPARK_FORMAT = "yyyyMMdd"
LOG_FILE_SPARK_FORMAT = "yyyyMMddHHmmss"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_ts(c, strict: bool = True) -> Column:
    """Epoch-ms text or ISO-8601 text -> TIMESTAMP (UTC instant).

    ``strict`` keeps ANSI behaviour (malformed text fails the job, as a
    ``CAST(... AS INT64)`` does); ``strict=False`` turns it into NULL.
    """
    c = _col(c)
    text = F.trim(c.cast("string"))
    if strict:
        millis = F.timestamp_millis(text.cast("bigint"))
        iso = text.cast("timestamp")
    else:
        millis = F.timestamp_millis(F.try_to_number(text, F.lit("S" + "9" * 19)).cast("bigint"))
        iso = F.try_to_timestamp(text)
    return F.when(c.isNull(), F.lit(None).cast("timestamp")) \
        .when(text.rlike(EPOCH_MS_PATTERN), millis).otherwise(iso)


def epoch_ms_text(c) -> Column:
    """TIMESTAMP or TIMESTAMP_NTZ -> epoch milliseconds as text (the bronze encoding)."""
    return F.unix_millis(_col(c).cast("timestamp")).cast("string")


def iso_text(c) -> Column:
    """TIMESTAMP -> ISO-8601 text with milliseconds and a Z suffix (Spark's JSON encoding)."""
    return F.date_format(_col(c).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def days_between(as_of: dt.date | Column, event_text) -> Column:
    """Calendar days from the event's UTC date to ``as_of`` as BIGINT (DATE_DIFF(..., DAY))."""
    as_of_col = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.datediff(as_of_col, F.to_date(parse_event_ts(event_text))).cast("bigint")


def ts_text(c) -> Column:
    """Canonical text of an instant for reports: ``yyyy-MM-dd HH:mm:ss`` (UTC)."""
    return F.date_format(_col(c), "yyyy-MM-dd HH:mm:ss")


def run_metadata(now: dt.datetime) -> dict[str, str]:
    """Run identity from an explicit clock value (UTC)."""
    if now.tzinfo is None:
        now = now.replace(tzinfo=dt.timezone.utc)
    now = now.astimezone(dt.timezone.utc)
    return {"run_id": now.strftime(RUN_ID_FORMAT), "load_date": now.strftime(LOAD_DATE_FORMAT)}


def to_utc(value: dt.datetime) -> dt.datetime:
    if value.tzinfo is None:
        return value.replace(tzinfo=dt.timezone.utc)
    return value.astimezone(dt.timezone.utc)

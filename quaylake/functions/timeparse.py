"""Event-time parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"  # producer's timestamp text


def parse_event_time(text: Column, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """Wall-clock timestamp without zone; unparsable text gives NULL. The session
    zone takes no part, so an hour that it skips stays as written. (There is no
    lenient text-to-``timestamp_ntz`` function with a pattern; the field reader of
    the CSV codec is one, with separators that occur in no text.)"""
    options = {"timestampNTZFormat": fmt, "sep": "\u0001", "quote": "\u0002"}
    return F.from_csv(text, "t timestamp_ntz", options)["t"]

"""Date parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_timestamp_utc(col: Column, fmt: str | None = None) -> Column:
    """Parse to an instant, reading texts without a zone as UTC whatever the session zone.

    What cannot be parsed becomes null.
    """
    text = F.trim(col)
    if fmt is not None:
        return F.try_to_timestamp(F.concat(text, F.lit(" +00:00")), F.lit(fmt + " xxx"))
    zoned = text.rlike(r"(?i)\d{1,2}:\d{2}.*(Z|UTC|GMT|[+-]\d{1,2}(:?\d{2})?)$")
    date_only = text.rlike(r"^[+-]?\d{4,6}(-\d{1,2}){0,2}$")
    return (
        F.when(zoned, text.try_cast("timestamp"))
        .when(date_only, F.concat(text.try_cast("date").cast("string"), F.lit(" 00:00:00Z")).try_cast("timestamp"))
        .otherwise(F.concat(text, F.lit("Z")).try_cast("timestamp"))
    )

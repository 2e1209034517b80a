"""Text and time expressions.

Times are TIMESTAMP_NTZ and all arithmetic is done against an NTZ epoch, so
results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.constants import DATE_FOLDER_FORMAT, MESSAGE_TEXT_FORMAT

def epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def framed(message, framing: str = "line") -> Column:
    """P1/K2. ``line``: the text sink already ends each row with a newline.
    ``blank_line``: append one more newline, as the reference's map does, so a
    blank line follows every message in the file."""
    m = _col(message)
    if framing == "line":
        return m
    if framing == "blank_line":
        return F.concat(m, F.lit("\n"))
    raise ValueError("framing must be 'line' or 'blank_line'")


def epoch_micros(ts) -> Column:
    return F.timestamp_diff("MICROSECOND", epoch_ntz(), _col(ts))


def epoch_millis(ts) -> Column:
    return F.floor(epoch_micros(ts) / 1000).cast("bigint")


def epoch_seconds(ts) -> Column:
    return F.floor(epoch_micros(ts) / 1000000).cast("bigint")


def from_epoch_micros(us) -> Column:
    return F.timestamp_add("MICROSECOND", _col(us), epoch_ntz())


def truncate_to_millis(ts) -> Column:
    """P5: ``CAST(x AS TIMESTAMP(3))``, kept as TIMESTAMP_NTZ."""
    return from_epoch_micros(F.floor(epoch_micros(ts) / 1000) * 1000)


def date_text(ts) -> Column:
    """``yyyy-MM-dd`` bucket text."""
    return F.date_format(_col(ts), DATE_FOLDER_FORMAT)


def iso_text(ts) -> Column:
    """ISO-8601 local date-time text with microseconds."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def message_text(index, epoch_ms) -> Column:
    """``Message <i> at <epoch_ms>``."""
    return F.format_string(MESSAGE_TEXT_FORMAT, _col(index), _col(epoch_ms))


def padded_id(prefix: str, n, width: int = 6) -> Column:
    """``user-%06d``."""
    return F.format_string(f"{prefix}%0{width}d", _col(n))


def status_class(status) -> Column:
    """``success``, ``timeout`` or ``error`` from the status text."""
    return F.trim(F.split_part(_col(status), F.lit(":"), F.lit(1)))

"""Formatting of dates and times."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import unsupported

FORMATS = {"YYYY": "yyyy", "MM": "MM", "DD": "dd", "HH24": "HH"}


def format_datetime(column: Column, form: str) -> Column:
    """Text of a part of a date or time (text columns too: unreadable text gives NULL); an unknown form
    is the value as text."""
    if form in FORMATS:
        return F.date_format(column.try_cast("timestamp_ntz"), FORMATS[form])
    return column.cast("string")


def datetime_operation(operation: str, column: Column, form: str, *, timezone: str | None = None, epoch_storage: Any = None) -> Column:
    """Only formatting is offered: time zones and epoch storage are refused."""
    if timezone not in (None, "") or epoch_storage not in (None, False):
        raise unsupported("datetime_operation", "time zones and epoch storage are not supported", timezone=timezone, epoch_storage=epoch_storage)
    if operation != "format":
        raise unsupported("datetime_operation", f"{operation} is not supported", operation=operation)
    return format_datetime(column, form)

"""Date and time parsing, reporting dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _date(text: Column, pattern: str, strict: bool) -> Column:
    return F.to_date(text, pattern) if strict else F.try_to_date(text, pattern)


def iso_day(text: Column, strict: bool = True) -> Column:
    """``2024-03-05`` or ``2024-3-5``."""
    return _date(text, "yyyy-M-d", strict)


def slash_day(text: Column, strict: bool = True) -> Column:
    """``05/03/2024`` or ``5/3/2024``: day, month, year."""
    return _date(text, "d/M/yyyy", strict)


def compact_month(text: Column, strict: bool = True) -> Column:
    """``202403``: first day of the month."""
    return _date(text, "yyyyMM", strict)


def compact_month_start(text: Column, strict: bool = True) -> Column:
    """``202403`` completed with day ``01``."""
    return _date(F.concat(text, F.lit("01")), "yyyyMMdd", strict)


def dashed_month(text: Column, strict: bool = True) -> Column:
    """``2024-03`` completed with day ``-01``."""
    return _date(F.concat(text, F.lit("-01")), "yyyy-M-d", strict)


def epoch_millis(text: Column, strict: bool = True) -> Column:
    """Milliseconds since 1970 in UTC."""
    millis = text.cast("bigint") if strict else text.try_cast("bigint")
    return F.timestamp_millis(millis)


def month_of(day: Column | str) -> Column:
    """First day of the month, still a date."""
    return F.trunc(day, "MM")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def last_month_end(run_date: Column) -> Column:
    return F.last_day(F.add_months(run_date, -1))


def month_end_two_back(run_date: Column) -> Column:
    return F.last_day(F.add_months(run_date, -2))


def quarter_end_two_back(run_date: Column) -> Column:
    """End of the quarter before the last finished one."""
    return F.date_sub(F.add_months(F.trunc(run_date, "quarter"), -3), 1)


def reporting_date(run_date: Column, frequency: Column, conservative: bool = False) -> Column:
    """Reference date to ask a publisher for.

    Quarterly data go two quarters back. Any other frequency uses the end of the
    previous month, or of the month before that in the conservative form.
    """
    monthly = month_end_two_back(run_date) if conservative else last_month_end(run_date)
    return F.when(frequency == "quarterly", quarter_end_two_back(run_date)).otherwise(monthly)


def path_parts(moment: Column | str, hour: bool = False) -> dict[str, Column]:
    """Zero-padded partition values of a landing path."""
    parts = {
        "year": F.date_format(moment, "yyyy"),
        "month": F.date_format(moment, "MM"),
        "day": F.date_format(moment, "dd"),
    }
    if hour:
        parts["hour"] = F.date_format(moment, "HH")
    return parts

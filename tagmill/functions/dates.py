"""Dates as written on pages and in infoboxes. Impossible dates are null, never an error."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, bind

# Years 1000 to 2099, the separators behind a year and behind a month, and the days that a
# month takes (a November 31 is read as such and so is no date).
_DATE_PARTS = r"(1\d{3}|20\d{2})(?:[-./\\年](\d{1,2})(?:[-./\\月](\d{1,2}))?)?"
_SEPARATORS = r"[-./\\年月]"
_DAYS = (31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 31, 31)

_MONTH_NAMES = (
    "january february march april may june july august september october november december"
).split()


def _checked_date(year: Column, month: Column, day: Column) -> Column:
    """The date of three numbers or numerals, null if there is none or a part is null."""
    return F.try_to_date(F.concat(year.cast("string"), F.lit("-"), month.cast("string"), F.lit("-"), day.cast("string")), "y-M-d")


def _leading_number(digits: Column, largest: Column) -> Column:
    """One or two digits as a number from 1 to ``largest``, else the first of them alone, else null."""
    whole, first = digits.try_cast("int"), F.substring(digits, 1, 1).try_cast("int")
    return F.when(whole.between(1, largest), whole).when(first > 0, first)


def parse_site_date(col) -> Column:
    """Leftmost year-month-day, else year-month (day 1), else year (1 January).

    A month over 12 is its first digit, and what follows is no day then; a day too large for its month
    is its first digit.
    """
    # One search; what it found is short, so its parts are cut out and read once each.
    found = F.split(F.regexp_extract(_col(col), _DATE_PARTS, 0), _SEPARATORS)
    days = F.array(*[F.lit(n) for n in _DAYS])

    def read(parts: Column) -> Column:
        month_digits, day_digits = F.get(parts, F.lit(1)), F.get(parts, F.lit(2))

        def with_month(month: Column) -> Column:
            day = F.when(month == month_digits.try_cast("int"), _leading_number(day_digits, F.get(days, month - 1)))
            return _checked_date(F.get(parts, F.lit(0)), F.coalesce(month, F.lit(1)), F.coalesce(day, F.lit(1)))

        return bind(_leading_number(month_digits, F.lit(12)), with_month)

    return bind(found, read)


def parse_document_date(col, as_of: dt.date) -> Column:
    """Infobox dates: a bare ``2009年`` takes month and day of ``as_of``; without a day the last
    day of the month is meant; a year is required.

    Covered forms: ``2009-4-5``, ``2009/4/5``, ``2009.4.5``, ``2009年4月5日`` and the same without
    a day, ``April 5, 2009``, ``5 April 2009``, ``April 2009``, full or three-letter month names. A bare
    year takes the month of ``as_of`` and its last day. Digits may be full-width; words in brackets (a weekday)
    and a time behind the date are ignored.
    """
    text = F.translate(_col(col), "０１２３４５６７８９", "0123456789")
    text = F.regexp_replace(text, r"(?U)[(（][^()（）]+[)）]", "")
    text = F.regexp_replace(text, r"(?U)\s+\d{1,2}:\d{2}(:\d{2})?\s*$", "")
    text = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")

    names = "|".join(f"{n[:3]}(?:{n[3:]})?" if n[3:] else n for n in _MONTH_NAMES)
    known = F.array(*[F.lit(n[:3]) for n in _MONTH_NAMES])
    this_month, this_day = F.lit(str(as_of.month)), F.lit(str(as_of.day))
    # One pattern for all forms; which groups it fills says which form it is.
    forms = (
        r"(?i)^(?:(\d{4})|(\d{1,4})年|(\d{4})([-/.])(\d{1,2})(?:\4(\d{1,2}))?|(\d{4})年(\d{1,2})月(?:(\d{1,2})日)?"
        rf"|({names})\.?(?: (\d{{1,2}}))?,? (\d{{4}})|(\d{{1,2}}) ({names})\.?,? (\d{{4}}))$"
    )

    def read(text: Column) -> Column:
        def group(number: int) -> Column:
            return F.nullif(F.regexp_extract(text, forms, number), F.lit(""))

        groups = F.array(*[group(i) for i in range(1, 16)])
        return F.when(text.rlike(forms), bind(groups, dated))

    def dated(groups: Column) -> Column:
        part = [F.get(groups, F.lit(i)) for i in range(15)]

        def month_number(name: Column) -> Column:
            return F.array_position(known, F.lower(F.substring(name, 1, 3))).cast("string")

        # year, month, day of each form; a year alone with its mark is a whole date.
        kinds = [
            (0, this_month, None),
            (1, this_month, this_day),
            (2, part[4], part[5]),
            (6, part[7], part[8]),
            (11, month_number(part[9]), part[10]),
            (14, month_number(part[13]), part[12]),
        ]
        out = None
        for year, month, day in kinds:
            month_end = F.last_day(_checked_date(part[year], month, F.lit("1")))
            whole = month_end if day is None else F.when(day.isNull(), month_end).otherwise(_checked_date(part[year], month, day))
            out = F.when(part[year].isNotNull(), whole) if out is None else out.when(part[year].isNotNull(), whole)
        return out

    return bind(text, read)


def iso_date(col) -> Column:
    return F.date_format(_col(col), "yyyy-MM-dd")


def stamp_date(col) -> Column:
    """The form used in dated dataset names."""
    return F.date_format(_col(col), "yyyy_MM_dd")


def date_stamp(as_of: dt.date) -> str:
    return as_of.strftime("%Y_%m_%d")

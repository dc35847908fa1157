"""Parts of page addresses and paging rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def url_segment(col, from_end: int = 1, strip_query: bool = False) -> Column:
    """The n-th ``/``-separated part counted from the end, optionally without its query."""
    parts = F.split(_col(col), "/", -1)
    part = F.try_element_at(parts, F.lit(-from_end))
    return F.get(F.split(part, r"\?", -1), F.lit(0)) if strip_query else part


def url_id(col) -> Column:
    """The last address part as an integer, null when it is none."""
    return url_segment(col).try_cast("long")


def trailing_id(col, separator: str = "_") -> Column:
    """``item_12`` → 12."""
    return F.substring_index(_col(col), separator, -1).try_cast("long")


def page_number(col) -> Column:
    """The number after ``=`` in the address, 1 without one."""
    col = _col(col)
    given = F.get(F.split(col, "=", -1), F.lit(1))
    return F.when(F.instr(col, "=") == 0, F.lit(1).cast("long")).otherwise(given.try_cast("long"))


def next_page_url(col) -> Column:
    """``x=n`` → ``x=n+1``; any other address gets ``?page=2`` after its first ``=``-free part."""
    parts = F.split(_col(col), "=", -1)
    head = F.get(parts, F.lit(0))
    following = F.get(parts, F.lit(1)).try_cast("long") + 1
    return F.when(
        F.size(parts) == 2, F.concat(head, F.lit("="), following.cast("string"))
    ).otherwise(F.concat(head, F.lit("?page=2")))


def pages_remaining(page, total, page_size: int = 24) -> Column:
    """Whether a numbered list has more entries after this page."""
    return _col(page) * page_size < _col(total)


def offset_pages_remaining(offset, rows, total) -> Column:
    """Whether an offset-paged listing has more entries after these rows."""
    return _col(offset) + _col(rows) < _col(total)

"""Queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

from . import (  # noqa: F401
    file_checks,
    infobox_checks,
    page_checks,
    pair_checks,
    ranking_checks,
    snapshot_checks,
    subject_checks,
    tag_checks,
    text_checks,
)
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

"""Landed API answers (status, url, redirect_from, body) to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import offset_pages_remaining, url_id, url_segment
from ..schemas import API_COLLECTION_PAGE, API_SUBJECT, API_USER

# User groups whose collections are skipped, and entries per answer.
BANNED_GROUPS = (4, 5)
PAGE_SIZE = 50


def api_documents(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bodies parsed with a schema into ``body``; answers that only say "not found" are
    dropped, and so are bodies that aren't JSON. An answer without a status counts as given."""
    answered = df.where(~F.col("status").eqNullSafe(404) & F.try_parse_json("body").isNotNull())
    parsed = answered.withColumn("body", F.from_json("body", schema))
    tombstone = F.coalesce(F.col("body.code") == 404, F.lit(False))
    return parsed.where(F.col("body").isNotNull() & ~tombstone)


def origin_id(url="url", redirect_from="redirect_from") -> Column:
    """Id in the address first asked for."""
    return F.coalesce(url_id(redirect_from), url_id(url))


def api_users(df: DataFrame) -> DataFrame:
    """User profiles without pictures."""
    fields = [f.name for f in API_USER if f.name not in ("code", "error")]
    return api_documents(df, API_USER).select(*[f"body.{name}" for name in fields])


def allowed_users(users: DataFrame) -> DataFrame:
    """Users outside the banned groups."""
    banned = F.col("usergroup").isin(*BANNED_GROUPS)
    return users.where(~F.coalesce(banned, F.lit(False)))


def api_collections(df: DataFrame, users: DataFrame) -> DataFrame:
    """One row per collected subject, with the name and number of its user.

    ``df`` holds ``…/users/<username>/collections?…`` answers; ``users`` comes from ``api_users``.
    """
    owners = allowed_users(users).select(
        F.col("username").alias("user_id"), F.col("id").alias("user_order")
    )
    rows = api_documents(df, API_COLLECTION_PAGE).select(
        url_segment("url", 2).alias("user_id"), F.explode("body.data").alias("_row")
    )
    return rows.select("user_id", "_row.*").join(owners, "user_id")


def collection_pages(df: DataFrame) -> DataFrame:
    """Which listings have more entries: ``url, user_id, offset, rows, total, more, next_offset``."""
    offset = F.coalesce(
        F.regexp_extract("url", r"[?&]offset=(\d+)", 1).try_cast("long"), F.lit(0).cast("long")
    )
    pages = api_documents(df, API_COLLECTION_PAGE).select(
        "url",
        url_segment("url", 2).alias("user_id"),
        offset.alias("offset"),
        F.size("body.data").cast("long").alias("rows"),
        F.col("body.total").alias("total"),
    )
    more = offset_pages_remaining("offset", "rows", "total")
    return pages.withColumn("more", more).withColumn(
        "next_offset", F.when(more, F.col("offset") + PAGE_SIZE)
    )


def api_subjects(df: DataFrame) -> DataFrame:
    """Subject statistics: failed and locked answers dropped, ``order`` is the id asked for."""
    dropped = ("locked", "error", "code")
    fields = [f.name for f in API_SUBJECT if f.name not in dropped]
    answers = api_documents(df, API_SUBJECT).where(
        F.col("body.error").isNull() & ~F.coalesce(F.col("body.locked"), F.lit(False))
    )
    return answers.select(*[f"body.{name}" for name in fields], origin_id().alias("order"))

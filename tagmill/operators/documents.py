"""Denormalised search documents and their suggestions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.infobox import (
    ALIAS_KEY,
    PLATFORM_KEY,
    infobox_first,
    info_from_json,
    normalize_infobox,
)
from ..functions.text import _col

SUGGEST_TYPE = "array<struct<input: string, weight: bigint>>"


def tags_of_subject(tags: DataFrame) -> DataFrame:
    """``id, tags``: the tags of a subject as an ordered array of structs."""
    entry = F.struct("iid", "tags", "confidence", "tag_cnt")
    return (
        tags.where(F.col("iid").isNotNull())
        .groupBy(F.col("iid").alias("id"))
        .agg(F.sort_array(F.collect_list(entry)).alias("tags"))
    )


def suggestion_weight(fav, divisor: int = 1) -> Column:
    """At least 1; otherwise the count, divided and cut to whole numbers."""
    return F.greatest(F.lit(1).cast("long"), F.floor(_col(fav) / divisor).cast("long"))


def build_suggestions(
    name="name", name_cn="name_cn", alias="alias", tags="tags", fav="fav_count"
) -> Column:
    """``[name, name_cn?, alias…, tag…]`` with weights; tags given only once are left out."""

    def entry(text, weight):
        return F.struct(text.alias("input"), weight.alias("weight"))

    def listed(found):
        return F.coalesce(found.cast(SUGGEST_TYPE), F.array().cast(SUGGEST_TYPE))

    whole, half = suggestion_weight(fav), suggestion_weight(fav, 2)
    localised = _col(name_cn)
    return F.concat(
        F.array(entry(_col(name), whole)).cast(SUGGEST_TYPE),
        listed(F.when(localised != "", F.array(entry(localised, whole)))),
        listed(F.transform(_col(alias), lambda a: entry(a, half))),
        listed(
            F.transform(
                F.filter(_col(tags), lambda t: t["tag_cnt"] > 1),
                lambda t: entry(t["tags"], t["tag_cnt"]),
            )
        ),
    )


def build_documents(
    subjects: DataFrame,
    tags: DataFrame,
    ranking: DataFrame,
    as_of: dt.date,
    mapping: Mapping[str, str] | None = None,
) -> DataFrame:
    """Subjects with tags, custom rank, alias and platform lists, infobox map and suggestions.

    ``subjects`` is the enriched archive, its ``infobox`` the JSON text of the entries.
    """
    ranks = ranking.select(F.col("name").alias("id"), "rank_custom")
    joined = (
        subjects.join(tags_of_subject(tags), "id", "left")
        .join(ranks, "id", "left")
        .withColumn("_info", info_from_json("infobox"))
    )
    filled = joined.withColumns(
        {
            "alias": infobox_first("_info", ALIAS_KEY),
            "platform": infobox_first("_info", PLATFORM_KEY),
            "infobox": normalize_infobox("_info", mapping, as_of),
        }
    )
    return filled.withColumn("suggest", build_suggestions()).drop("_info")

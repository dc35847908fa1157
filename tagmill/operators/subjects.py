"""Subject table: statistics, types, display names, eligibility, aliases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.infobox import (
    infobox_aliases,
    infobox_subtype,
    infobox_type,
    info_json,
    read_infobox,
)
from ..functions.text import _col, normalize_tag, strip_nul
from ..sources.readers import joined_key

# Numeric media codes.
TYPE_CODES = {1: "book", 2: "anime", 3: "music", 4: "game", 6: "real"}

COUNTS = ("wish_count", "on_hold_count", "dropped_count", "do_count", "collect_count")
STATISTICS = ("rank", *COUNTS, "fav_count", "rate_count")


def flatten_stats(stats: DataFrame) -> DataFrame:
    """Nested counters to flat columns, with their sum as ``fav_count``."""
    nested = {
        "wish_count": "collection.wish",
        "on_hold_count": "collection.on_hold",
        "dropped_count": "collection.dropped",
        "do_count": "collection.doing",
        "collect_count": "collection.collect",
        "rank": "rating.rank",
        "rate_count": "rating.total",
    }
    flat = stats.withColumns({name: F.col(path) for name, path in nested.items()})
    return flat.withColumn("fav_count", fav_count())


def fav_count() -> Column:
    total = F.col(COUNTS[0])
    for name in COUNTS[1:]:
        total = total + F.col(name)
    return total


def first_non_null(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str
) -> DataFrame:
    """Per key and column, the first non-null value in the given order.

    Rows without an order come last; rows that tie are taken in one order for all columns.
    """
    place = ", ".join([f"`{order}` IS NULL", f"`{order}`", *(f"`{c}` IS NULL, `{c}`" for c in columns)])
    picked = [
        F.expr(f"min_by(`{c}`, struct({place})) FILTER (WHERE `{c}` IS NOT NULL)").alias(c)
        for c in columns
    ]
    present = df.dropna(subset=list(keys))
    return present.groupBy(*keys).agg(*picked)


def display_name(name="name", name_cn="name_cn") -> Column:
    """The localised name unless null; an empty one is kept."""
    return F.coalesce(_col(name_cn), _col(name))


def resolve_type(code="type", parsed=None) -> Column:
    """Media label of a numeric code; without a code the label parsed from the infobox."""
    code = _col(code)
    parsed = infobox_type("infobox") if parsed is None else _col(parsed)
    labelled = F.when(code.isNull(), parsed)
    for number, label in TYPE_CODES.items():
        labelled = labelled.when(code == number, label)
    return labelled


def settle_counts(df: DataFrame) -> DataFrame:
    """Missing statistics become 0 and integers; rank 0 becomes null."""
    whole = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in STATISTICS}
    whole["rank"] = F.nullif(whole["rank"], F.lit(0))
    return df.withColumns(whole)


def enrich_subjects(stats: DataFrame, archive: DataFrame, order: str = "order") -> DataFrame:
    """Archive rows with statistics, resolved type and subtype, and the infobox as JSON text."""
    chosen = first_non_null(flatten_stats(stats), ["id"], STATISTICS, order)
    parsed = archive.withColumn("_box", read_infobox(F.col("infobox")))
    typed = parsed.join(chosen, "id", "left").withColumns(
        {
            "type": resolve_type("type"),
            "subtype": infobox_subtype("infobox"),
            "infobox": info_json("_box.info"),
            "summary": strip_nul("summary"),
        }
    )
    return settle_counts(typed).drop("_box")


def subject_aliases(
    archive: DataFrame, include_infobox: bool = False, mapping: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per subject and alias: ``id, alias, alias_normalized``.

    ``include_infobox`` adds the alias keys of the infobox, read from raw template text.
    """
    names = F.array("name", "name_cn")
    if include_infobox:
        archive = archive.withColumn("_box", read_infobox(F.col("infobox")))
        names = F.concat(names, infobox_aliases("_box.info"))
    given = F.filter(names, lambda n: n != "")
    return (
        archive.select("id", F.explode(given).alias("alias"))
        .withColumn("alias", strip_nul("alias"))
        .dropDuplicates()
        .withColumn("alias_normalized", normalize_tag("alias", mapping))
    )


def eligible_subjects(
    subjects: DataFrame, media: str | None = "anime", min_ratings: int = 50
) -> DataFrame:
    """Subjects of one media type that are ranked or rated often enough."""
    known = F.col("rank").isNotNull() | (F.col("rate_count") >= min_ratings)
    return subjects.where(known if media is None else (F.col("type") == media) & known)


def subject_list(subjects: DataFrame) -> DataFrame:
    """``iid, subjectname, rank`` for the flat subject file."""
    return subjects.select(
        F.col("id").alias("iid"),
        display_name().alias("subjectname"),
        F.col("rank").cast("long").alias("rank"),
    )


def composite_key(*columns, separator: str = "_") -> Column:
    return joined_key([_col(c) for c in columns], separator)


def known_only(records: DataFrame, known: DataFrame, on: str, key: str) -> DataFrame:
    """Records whose ``on`` occurs as ``key`` in another table; duplicates there do not multiply."""
    return records.join(known.select(F.col(key).alias(on)), on, "left_semi")

"""Landed catalogue pages to tables.

What to take from a page is data: rules, all matched in one walk over the page (``functions.html``). Everything after
that is column expressions on what they took, so a page never leaves its partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import parse_site_date
from ..functions.html import Rule, child, deep, page_reader, rule
from ..functions.text import (
    bind,
    blank_to_null,
    last_per_key,
    number_in,
    second_token_lower,
    slice_tokens,
    strip_controls,
)
from ..functions.urls import (
    next_page_url,
    page_number,
    pages_remaining,
    trailing_id,
    url_id,
    url_segment,
)

# Media types with their own lists, entries per list page.
LIST_TYPES = ("anime", "game", "book", "music", "real")
LIST_PAGE_SIZE = 24


def html_pages(df: DataFrame) -> DataFrame:
    """A table of landed pages; ``redirect_from`` is null where the landing did not record it."""
    if "redirect_from" in df.columns:
        return df
    return df.withColumn("redirect_from", F.lit(None).cast("string"))


def extract_pages(pages: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """Add one column per rule to a table of pages; malformed pages give nulls and empty lists."""
    parsed = pages.withColumn("_page", page_reader(rules)(F.col("html")))
    return parsed.select(*pages.columns, *[F.col(f"_page.`{name}`") for name in rules])


# ------------------------------------------------------------- fixed values: where things stand
_PROFILE_TITLE = (
    child("html"), child("body"), child("div", 1), child("div", 3), child("div"), child("div", 1),
    child("h1"), child("div", 2),
)
PROFILE_RULES = {
    "has_profile": rule(deep(id="headerProfile"), take="any"),
    "name": rule(*_PROFILE_TITLE, child("small")),
    "nickname": rule(*_PROFILE_TITLE, child("a")),
    "timeline": rule(deep("ul", class_="timeline"), child("li"), take="count"),
    "joined": rule(
        child("html"), child("body"), child("div", 1), child("div", 4), child("div", 1),
        child("div", 1), child("div"), child("div", 1), child("ul"), child("li", 1),
        child("span", 2),
    ),
}
HOME_RULES = {
    "has_profile": rule(deep(id="headerProfile"), take="any"),
    "has_banner": rule(deep("div", class_="tipIntro"), take="any"),
    "nickname": rule(
        deep(class_="headerContainer"), deep(class_="inner"), child("a"), default=""
    ),
    "joined": rule(
        deep(id="user_home"), child("div", class_="user_box clearit"), child("ul"),
        child("li", 1), child("span", 2),
    ),
    **{kind: rule(deep(id=kind), take="any") for kind in LIST_TYPES},
}
_INDEX_HEAD = (deep(id="columnSubjectBrowserA"), child("div", 1))
INDEX_RULES = {
    "creator": rule(*_INDEX_HEAD, child("a"), take="@href"),
    "dated": rule(*_INDEX_HEAD, child("span"), child("span", 1)),
    "counters": rule(*_INDEX_HEAD, child("span"), child("span"), take="count"),
    "favourite": rule(*_INDEX_HEAD, child("span"), child("span", 2)),
    "entries": rule(
        deep(id="columnSubjectBrowserA"), child("ul"), child("li"), take="@@id"
    ),
}
_INFO = (child("div"), child("p", class_="collectInfo"))
RECORD_RULES = {
    "entries": rule(
        deep(id="browserItemList"), child("li"),
        item=rule(take="@id"),
        dated=rule(*_INFO, child("span", class_="tip_j")),
        tagged=rule(*_INFO, child("span", class_="tip")),
        stars=rule(*_INFO, child("span", class_="starstop-s"), child("span"), take="@class"),
        comment=rule(deep("div", class_="text")),
    ),
}
LIST_RULES = {
    "states": rule(
        deep("ul", class_="navSubTabs"), child("li"), child("a"), take="@@href"
    ),
    "focus": rule(
        deep("ul", class_="navSubTabs"), child("li"), child("a", class_="focus"), child("span")
    ),
}
FRIEND_RULES = {
    "friends": rule(deep(id="memberUserList"), child("li"), deep(), take="@@href"),
}
SUBJECT_RULES = {
    "has_subject": rule(deep(id="headerSubject"), take="any"),
    "title": rule(deep(id="headerSubject"), child("h1"), child("a"), take="@title"),
    "shown": rule(deep(id="headerSubject"), child("h1"), child("a")),
    "scored": rule(deep("div", class_="global_score"), child("div"), child("small", 1)),
    "facts": rule(
        deep("div", class_="infobox"), deep("li"),
        label=rule(child("span")), links=rule(child("a"), take="@@href"), said=rule(),
    ),
    "related": rule(
        deep("ul", class_="browserCoverMedium clearit"), child("li"),
        kind=rule(take="@class"), label=rule(child("span")),
        href=rule(child("a", class_="title"), take="@href"),
    ),
    "volumes": rule(
        deep("ul", class_="browserCoverSmall clearit"), child("li"), child("a"), take="@@href"
    ),
}
ALIAS_LABEL = "别名"
VOLUME_LABEL = "单行本"


def _asked_id() -> Column:
    """The numeric id first asked for, when the address was redirected."""
    return url_id("redirect_from")


def _first_word(text) -> Column:
    return F.get(F.split(text, " ", -1), F.lit(0))


def page_users(pages: DataFrame) -> DataFrame:
    """``uid, name, nickname, joindate`` of profiles with a header and some activity."""
    found = extract_pages(pages, PROFILE_RULES).where("has_profile and timeline > 0")
    name = F.substr(F.col("name"), F.lit(2))
    return found.select(
        F.coalesce(_asked_id(), name.try_cast("long")).alias("uid"),
        name.alias("name"),
        strip_controls("nickname").alias("nickname"),
        parse_site_date(_first_word(F.col("joined"))).alias("joindate"),
    )


def page_home_users(pages: DataFrame, blocked: Sequence[str] = ()) -> DataFrame:
    """The same fields from user home pages, without closed and blocked accounts, and the media
    types the user keeps lists of (``lists``)."""
    found = extract_pages(pages, HOME_RULES).where("has_profile and not has_banner")
    name = url_segment("url")
    kept = [F.when(F.col(kind), F.lit(kind)) for kind in LIST_TYPES]
    users = found.select(
        F.coalesce(_asked_id(), name.try_cast("long")).alias("uid"),
        name.alias("name"),
        strip_controls("nickname").alias("nickname"),
        parse_site_date(_first_word(F.col("joined"))).alias("joindate"),
        F.array_compact(F.array(*kept)).alias("lists"),
    )
    return users.where(~F.col("name").isin(*blocked)) if blocked else users


def page_indexes(pages: DataFrame) -> DataFrame:
    """``indexid, creator, favourite, date, items`` of user-made lists."""
    found = extract_pages(pages, INDEX_RULES).where(F.col("creator").isNotNull())
    counted = F.when(F.col("counters") == 2, F.trim("favourite").try_cast("long"))
    return found.select(
        url_id("url").alias("indexid"),
        strip_controls(url_segment("creator")).alias("creator"),
        F.coalesce(counted, F.lit(0).cast("long")).alias("favourite"),
        parse_site_date(_first_word(F.col("dated"))).alias("date"),
        F.transform("entries", lambda e: trailing_id(e)).alias("items"),
    )


def page_records(pages: DataFrame) -> DataFrame:
    """One row per entry of a user's list: ``uid, iid, typ, state, adddate, rate, tags, comment``.

    ``pages`` may carry ``uid``; without it the user part of the address is taken.
    """
    owner = F.col("uid") if "uid" in pages.columns else url_segment("url", 2)
    rows = extract_pages(pages, RECORD_RULES).select(
        owner.alias("uid"),
        url_segment("url", 4).alias("typ"),
        url_segment("url", 1, strip_query=True).alias("state"),
        F.explode("entries").alias("_entry"),
    ).select("uid", "typ", "state", "_entry.*")
    rows = rows.withColumn("iid", number_in("item", r"^item_(\d+)"))
    tags = slice_tokens("tagged")
    return rows.select(
        "uid",
        "iid",
        "typ",
        "state",
        parse_site_date("dated").alias("adddate"),
        F.nullif(number_in("stars", r"^starlight stars(\d+)"), F.lit(0)).cast("int").alias("rate"),
        F.when(F.size(tags) > 0, tags).alias("tags"),
        blank_to_null(strip_controls("comment")).alias("comment"),
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Pages worth landing next: ``url, kind, link``; ``state`` tabs and the ``next`` list page."""
    found = extract_pages(pages, LIST_RULES)
    total = number_in("focus")
    more = F.coalesce(
        pages_remaining(page_number("url"), total, LIST_PAGE_SIZE), F.lit(False)
    )

    def link(kind: str, target: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), target.alias("link"))

    following = F.when(more, F.array(link("next", next_page_url("url"))))
    links = F.concat(
        F.transform("states", lambda href: link("state", href)),
        F.coalesce(following, F.slice(F.array(link("next", F.lit(""))), 1, 0)),
    )
    return found.select("url", F.posexplode(links).alias("pos", "_link")).select(
        "url", "pos", "_link.*"
    )


def home_links(users: DataFrame) -> DataFrame:
    """Addresses of the lists a home page mentions: ``uid, link``."""
    return users.select("uid", "name", F.explode("lists").alias("_kind")).select(
        "uid", F.concat(F.lit("/"), F.col("_kind"), F.lit("/list/"), F.col("name")).alias("link")
    )


def page_friends(pages: DataFrame) -> DataFrame:
    """Directed edges ``user, friend``."""
    found = extract_pages(pages, FRIEND_RULES)
    return found.select(
        url_segment("url", 2).alias("user"), F.explode("friends").alias("_href")
    ).select("user", url_segment("_href").alias("friend"))


def _label(fact: Column) -> Column:
    """The first text of a fact's ``span`` less two signs."""
    return F.substring(fact["label"], F.lit(1), F.greatest(F.length(fact["label"]) - 2, F.lit(0)))


def _staff(facts: Column) -> Column:
    """Linked ids per label."""

    def fact(li):
        ids = F.transform(li["links"], lambda h: url_segment(h))
        return F.struct(_label(li).alias("key"), ids.alias("value"))

    return F.filter(
        F.transform(facts, fact), lambda p: p["key"].isNotNull() & (F.size(p["value"]) > 0)
    )


def _aliases(facts: Column) -> Column:
    return F.array_compact(F.transform(facts, lambda li: F.when(_label(li) == ALIAS_LABEL, li["said"])))


def fill_labels(items: Column) -> Column:
    """``array<struct<label, id>>`` to ``array<struct<key, value>>``: an item without a label belongs
    to the nearest label before it, and every label opens a new list."""

    def sections(all_items, bounds):
        def section(start, at):
            until = F.get(bounds, at + 1)
            return F.struct(
                F.get(all_items, start)["label"].alias("key"),
                F.transform(
                    F.slice(all_items, start + 1, until - start), lambda i: i["id"]
                ).alias("value"),
            )

        return F.transform(F.slice(bounds, 1, F.size(bounds) - 1), section)

    def cut(all_items):
        opening = F.filter(
            F.transform(all_items, lambda i, at: F.when(i["label"].isNotNull(), at)),
            lambda at: at.isNotNull(),
        )
        end = F.array(F.size(all_items))
        return bind(F.concat(opening, end), lambda bounds: sections(all_items, bounds))

    return bind(items, cut)


def forward_fill(
    df: DataFrame, partition: Sequence[str], order: str, column: str, name: str = "filled"
) -> DataFrame:
    """Add the last non-null ``column`` at or before each row of its page."""
    before = (
        W.partitionBy(*partition).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return df.withColumn(name, F.last(column, ignorenulls=True).over(before))


def page_subjects(pages: DataFrame) -> DataFrame:
    """``subjectid, subjecttype, subjectname, order, alias, staff, relations``."""
    found = extract_pages(pages, SUBJECT_RULES).where("has_subject")

    def relation(li):
        label = F.when(li["kind"].isNotNull(), li["label"])
        return F.struct(label.alias("label"), url_segment(li["href"]).alias("id"))

    pair_type = "array<struct<key: string, value: array<string>>>"
    none = F.array().cast(pair_type)
    related = fill_labels(F.transform("related", relation)).cast(pair_type)
    volumes = F.when(
        F.size("volumes") > 0,
        F.array(
            F.struct(
                F.lit(VOLUME_LABEL).alias("key"),
                F.transform("volumes", lambda h: url_segment(h)).alias("value"),
            )
        ),
    ).cast(pair_type)
    collected = found.select(
        url_id("url").alias("subjectid"),
        second_token_lower("scored").alias("subjecttype"),
        F.coalesce(blank_to_null("title"), F.col("shown")).alias("subjectname"),
        F.coalesce(_asked_id(), url_id("url")).alias("order"),
        _aliases(F.col("facts")).alias("alias"),
        _staff(F.col("facts")).alias("_staff"),
        F.concat(F.coalesce(related, none), F.coalesce(volumes, none)).alias("_relations"),
    )
    return collected.select(
        "subjectid",
        "subjecttype",
        "subjectname",
        "order",
        "alias",
        last_per_key(F.col("_staff")).alias("staff"),
        last_per_key(F.col("_relations")).alias("relations"),
    )

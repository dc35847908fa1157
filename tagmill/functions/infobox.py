"""Infobox text: template header types, ordered entries, and lookups over the entries."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..schemas import INFO_TYPE, TEXT, struct
from .dates import iso_date, parse_document_date
from .text import _col, bind, blank_to_null, last_per_key

# The template header that names the type, and the keys kept in documents.
HEADER = r"(?U)Infobox(\s([/\w]+))?\s?\r?\n"

DOCUMENT_KEYS = {
    "中文名": "name_cn",
    "集数": "num_episodes",
    "话数": "num_episodes",
    "放送星期": "week_onair",
    "开始": "date_onair",
    "放送开始": "date_onair",
    "结束": "date_onair_end",
    "播放结束": "date_onair_end",
    "类型": "showtype",
    "国家/地区": "country",
    "语言": "language",
    "每集长": "length_per_episode",
    "频道": "channel",
    "电视网": "tvnetwork",
    "电视台": "tvstation",
    "播放电视台": "tvstation",
    "其他电视台": "tvstation_other",
    "官方网站": "website",
    "website": "website",
    "游戏类型": "gametype",
    "游戏引擎": "engine",
    "游玩人数": "num_players",
    "发行日期": "date_release",
    "发售日期": "date_release",
    "发售日": "date_release",
    "售价": "price",
    "价格": "price",
    "版本特性": "version_characteristics",
    "播放时长": "length",
    "片长": "length",
    "录音": "recorder",
    "碟片数量": "num_disks",
    "Copyright": "copyright",
    "上映年度": "year_onair",
    "出版社": "publisher",
    "其他出版社": "publisher_other",
    "连载杂志": "magazine",
    "册数": "num_volumes",
    "页数": "num_pages",
    "ISBN": "isbn",
}

ALIAS_KEYS = ("中文名", "英文名", "别名")
ALIAS_KEY = "别名"
PLATFORM_KEY = "平台"

PARSED_TYPE = struct(info_type=TEXT, info=INFO_TYPE, error=TEXT)

_LINE_KINDS = re.compile(
    r"(?P<field>\|(?P<name>[^=]*)(?P<eq>=)?(?P<rest>.*))"
    r"|\s*(?:(?P<open>\{)|(?P<close>\})|\[(?P<item>.*)\]|(?P<blank>))\s*",
    re.S,
)


class InfoboxError(ValueError):
    pass


def _entries(lines: list[str]) -> list[dict]:
    """Entries of a template body in order.

    ``items`` is the list being filled, or None outside of one. ``head``/``skip`` give the key a
    closing brace will carry: the field's raw head with its first ``skip`` characters cut.
    """
    entries: list[dict] = []
    head, skip, items, must_close = None, 0, None, False
    for line in lines:
        kind = _LINE_KINDS.fullmatch(line)
        if kind is None:
            raise InfoboxError("text outside of a field")
        if kind["field"] is not None:
            if must_close:
                raise InfoboxError("list not closed before the next field")
            if kind["eq"] is None:
                raise InfoboxError("field without =")
            value = kind["rest"].strip()
            head, skip = "|" + kind["name"], 0
            if value == "{":
                skip, items, must_close = 1, [], True
            elif value.startswith("{"):
                raise InfoboxError("text after the opening brace")
            else:
                entries.append({"key": kind["name"], "value": value or None, "items": None})
        elif kind["open"]:
            if head is None or not entries:
                raise InfoboxError("opening brace without a field")
            entries.pop()
            skip, items = skip + 1, []
        elif kind["close"]:
            key = None if head is None else head[skip:]
            entries.append({"key": key, "value": None, "items": items})
            head, skip, items, must_close = None, 0, None, False
        elif kind["item"] is not None:
            label, bar, text = kind["item"].partition("|")
            if bar and not text:
                continue
            if items is None:
                raise InfoboxError("list item outside of a list")
            items.append({"k": label if bar else None, "v": text if bar else label})
    if must_close:
        raise InfoboxError("list not closed")
    return entries


def _read_box(text: str | None) -> dict:
    lines = (text or "").replace("\x00", "").strip().replace("\r\n", "\n").splitlines()
    if not lines:
        return {"info_type": None, "info": None, "error": None}
    try:
        opening, marker, named = lines[0].partition("{{Infobox")
        if opening or not marker:
            raise InfoboxError("no template opening")
        if lines[-1] != "}}":
            raise InfoboxError("no template closing")
        entries = _entries(lines[1:-1])
    except InfoboxError as problem:
        return {"info_type": None, "info": [], "error": str(problem)}
    return {"info_type": named.strip() or None, "info": entries or None, "error": None}


@F.arrow_udf(PARSED_TYPE)
def _read_boxes(texts: pa.Array) -> pa.Array:
    return pa.array([_read_box(t) for t in texts.to_pylist()], to_arrow_type(PARSED_TYPE))


# Template text to ``struct<info_type, info, error>``. Marked so that later filters and expressions use
# the column instead of repeating the parse: give it a column of its own with ``withColumn``.
read_infobox = _read_boxes.asNondeterministic()


def parse_infobox(df: DataFrame, col: str = "infobox") -> DataFrame:
    """Add ``info_type``, ``info`` (ordered entries) and ``error`` parsed from a text column.

    Malformed text gives an empty ``info`` and the reason; empty text gives null.
    """
    return df.withColumn("_box", read_infobox(F.col(col))).select(
        *df.columns, "_box.info_type", "_box.info", "_box.error"
    )


def infobox_subtype(col) -> Column:
    """The type named in the template header; absent, empty and ``None`` are null."""
    named = F.regexp_extract(_col(col), HEADER, 2)
    return F.nullif(F.nullif(named, F.lit("")), F.lit("None"))


def infobox_type(col) -> Column:
    """Media type from the template header."""
    subtype = infobox_subtype(col)
    printed = F.lit(False)
    for ending in ("Manga", "Novel", "Book", "BookSeries"):
        printed = printed | subtype.endswith(ending)
    return (
        F.when(subtype.startswith("animanga"), F.when(printed, "book").otherwise("anime"))
        .when(subtype == "Album", "music")
        .when(subtype == "Game", "game")
        .when(subtype.isNotNull(), "real")
    )


def info_json(info) -> Column:
    """Entries as JSON text: ``value`` is a string, a list of ``{k?, v}`` or null."""
    info = _col(info)

    def member(name, text):
        return F.concat(F.lit(f'"{name}": '), text)

    def item_json(item):
        label = F.when(item["k"].isNotNull(), member("k", _json_string(item["k"])))
        return F.concat(
            F.lit("{"), F.concat_ws(", ", label, member("v", _json_string(item["v"]))), F.lit("}")
        )

    def as_json(entry):
        value = F.when(
            entry["items"].isNotNull(), _json_list(F.transform(entry["items"], item_json))
        ).otherwise(_json_string(entry["value"]))
        key = member("key", _json_string(entry["key"]))
        return F.concat(F.lit("{"), key, F.lit(", "), member("value", value), F.lit("}"))

    return F.coalesce(_json_list(F.transform(info, as_json)), F.lit("null"))


def _json_list(members: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(members, ", "), F.lit("]"))


def _json_string(col) -> Column:
    """A JSON string literal, or ``null``."""
    boxed = F.to_json(F.array(col))
    return F.when(col.isNull(), "null").otherwise(boxed.substr(F.lit(2), F.length(boxed) - 2))


def info_from_json(col) -> Column:
    """Entries read back from their JSON text; a list does not cast to a string and vice versa."""
    parsed = F.try_parse_json(_col(col))
    entries = F.try_variant_get(parsed, "$", "array<struct<key: string, value: variant>>")

    def typed(entry):
        items = F.try_variant_get(entry["value"], "$", "array<struct<k: string, v: string>>")
        text = F.when(items.isNull(), F.try_variant_get(entry["value"], "$", "string"))
        return F.struct(entry["key"].alias("key"), text.alias("value"), items.alias("items"))

    return F.transform(entries, typed)


def infobox_first(info, key: str) -> Column:
    """Values of the first entry with ``key``: its list, its text as one element, else null."""
    def values(entry):
        return F.when(
            entry["items"].isNotNull(),
            F.when(F.size(entry["items"]) > 0, F.transform(entry["items"], lambda i: i["v"])),
        ).otherwise(F.when(entry["value"].isNotNull(), F.array(entry["value"])))

    return bind(F.get(F.filter(_col(info), lambda e: e["key"] == key), F.lit(0)), values)


def normalize_infobox(
    info, mapping: Mapping[str, str] | None = None, as_of: dt.date | None = None
) -> Column:
    """Map of the known keys with text values; dates become ISO and unreadable ones are skipped.

    Where two keys share a target the later entry wins.
    """
    mapping = DOCUMENT_KEYS if mapping is None else mapping
    info = _col(info)
    targets = F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])

    def renamed(entry):
        target = targets[entry["key"]]
        text = blank_to_null(entry["value"])
        if any(t.startswith("date_") for t in mapping.values()):
            if as_of is None:
                raise ValueError("as_of is required to read dates")
            dated = iso_date(parse_document_date(text, as_of))
            text = F.when(target.startswith("date_"), dated).otherwise(text)
        return F.struct(target.alias("key"), text.alias("value"))

    known = F.filter(
        info,
        lambda e: e["key"].isin(list(mapping)) & e["value"].isNotNull() & (e["value"] != ""),
    )
    kept = F.filter(F.transform(known, renamed), lambda e: e["value"].isNotNull())
    return F.coalesce(last_per_key(kept), F.create_map().cast("map<string,string>"))


def infobox_aliases(info) -> Column:
    """Non-empty values of the alias keys in infobox order, from text and from lists."""
    info = _col(info)
    named = F.filter(info, lambda e: e["key"].isin(*ALIAS_KEYS))
    values = F.flatten(
        F.transform(
            named,
            lambda e: F.when(
                e["items"].isNotNull(), F.transform(e["items"], lambda i: i["v"])
            ).otherwise(F.array(e["value"])),
        )
    )
    return F.coalesce(F.filter(values, lambda v: v != ""), F.array().cast("array<string>"))

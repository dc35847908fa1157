"""Explicit schemas of every source and output table. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
DOUBLE, FLAG, TIME = T.DoubleType(), T.BooleanType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def listed(element: T.DataType) -> T.ArrayType:
    return T.ArrayType(element)


_COUNTERS = struct(wish=LONG, collect=LONG, doing=LONG, on_hold=LONG, dropped=LONG)

_COLLECTED = dict(
    rate=INT,
    tags=listed(TEXT),
    type=INT,
    subject_type=INT,
    comment=TEXT,
    ep_status=INT,
    vol_status=INT,
    private=FLAG,
    updated_at=TIME,
)

COLLECTIONS = struct(subject_id=LONG, user_id=TEXT, user_order=LONG, **_COLLECTED)

SUBJECT_API = struct(
    id=LONG, order=LONG, collection=_COUNTERS, rating=struct(rank=LONG, total=LONG)
)

SUBJECT_ARCHIVE = struct(id=LONG, type=INT, name=TEXT, name_cn=TEXT, infobox=TEXT, summary=TEXT)

INFO_TYPE = listed(struct(key=TEXT, value=TEXT, items=listed(struct(k=TEXT, v=TEXT))))

SUBJECTS = struct(
    id=LONG,
    type=TEXT,
    name=TEXT,
    name_cn=TEXT,
    infobox=TEXT,
    summary=TEXT,
    rank=LONG,
    wish_count=LONG,
    on_hold_count=LONG,
    dropped_count=LONG,
    do_count=LONG,
    collect_count=LONG,
    fav_count=LONG,
    rate_count=LONG,
    subtype=TEXT,
)

SUBJECT_ENTITY = struct(id=LONG, alias=TEXT, alias_normalized=TEXT)

TAGS = struct(
    iid=LONG,
    tags=TEXT,
    tags_normalized=TEXT,
    confidence=DOUBLE,
    tag_cnt=LONG,
    tagnorm_cnt=LONG,
)

SUBJECT_TSV = struct(iid=LONG, subjectname=TEXT, rank=LONG)

PAIRS = struct(item1=LONG, item2=LONG, score1=DOUBLE, score2=DOUBLE)

RANKING = struct(name=LONG, rank_custom=LONG, rank_site=LONG, subjectname=TEXT)

DELETES = struct(id=TEXT)

API_DOCUMENTS = struct(status=INT, url=TEXT, redirect_from=TEXT, body=TEXT)

HTML_PAGES = struct(url=TEXT, redirect_from=TEXT, html=TEXT)

API_USER = struct(
    id=LONG,
    url=TEXT,
    username=TEXT,
    nickname=TEXT,
    sign=TEXT,
    usergroup=INT,
    code=INT,
    error=TEXT,
)

API_COLLECTION_PAGE = struct(
    total=LONG, code=INT, error=TEXT, data=listed(struct(subject_id=LONG, **_COLLECTED))
)

API_SUBJECT = struct(
    id=LONG,
    type=INT,
    name=TEXT,
    name_cn=TEXT,
    date=TEXT,
    locked=FLAG,
    error=TEXT,
    code=INT,
    tags=listed(struct(name=TEXT, count=LONG)),
    collection=_COUNTERS,
    rating=struct(rank=LONG, total=LONG, score=DOUBLE),
)

# One element of a page: its place in document order, the last element below it, its children, its
# position among siblings of the same tag, and the texts directly inside.
_NODE = struct(
    idx=INT,
    last=INT,
    kids=listed(INT),
    tag=TEXT,
    nth=INT,
    attrs=T.MapType(TEXT, TEXT),
    text=listed(TEXT),
)

# A page read once: its elements in document order, and where an id or a class value occurs.
PAGE = struct(
    nodes=listed(_NODE), ids=T.MapType(TEXT, listed(INT)), classes=T.MapType(TEXT, listed(INT))
)

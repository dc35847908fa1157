import datetime as dt
import json
import random

from tagmill.functions.html import _Matcher, _read, child, deep, values_of
from tagmill.operators.api import api_collections, api_subjects, api_users, collection_pages
from tagmill.operators.extract import (
    extract_pages,
    forward_fill,
    home_links,
    page_friends,
    page_home_users,
    page_indexes,
    page_links,
    page_records,
    page_subjects,
    page_users,
    rule,
)
from tagmill.schemas import API_DOCUMENTS, HTML_PAGES

SITE = "https://example.org"


def pages(spark, *rows):
    return spark.createDataFrame([(SITE + u, r and SITE + r, h) for u, r, h in rows], HTML_PAGES)


def test_tolerant_reading():
    page = _read("<ul><li>a<li>b<br>c<p>d<p>e</ul>f<!-- <b> --><script>if(a<b){'</p>'}</script><i x='1' y>g&amp;h")
    tags = [(n["tag"], n["nth"], n["text"]) for n in page["nodes"]]
    assert tags == [
        ("ul", 1, []),
        ("li", 1, ["a"]),
        ("li", 2, ["b", "c"]),
        ("br", 1, []),
        ("p", 1, ["d"]),
        ("p", 2, ["e"]),
        ("script", 1, ["if(a<b){'</p>'}"]),
        ("i", 1, ["g&h"]),
    ]
    assert page["nodes"][0]["kids"] == [1, 2] and page["nodes"][0]["last"] == 5
    assert page["nodes"][7]["attrs"] == [("x", "1"), ("y", "")]
    for broken in (None, "", "<", "<a", '<a href="x', "</b></b>", "<!--", "<script>x", "a < b > c"):
        assert isinstance(_read(broken)["nodes"], list)
    assert len(_read("<a '" * 20_000)["nodes"]) > 0  # linear, not quadratic


def test_rules(spark):
    html = '<html><body><div id="m"><p class="c">one</p><p>two<b>x</b></p></div><p class="c">three'
    rules = {
        "first": rule(deep(class_="c")),
        "nested": rule(child("html"), child("body"), child("div", 1), child("p", 2), child("b")),
        "all": rule(deep("p"), take="texts"),
        "count": rule(deep(id="m"), child("p"), take="count"),
        "missing": rule(deep("h1"), default="none"),
    }
    row = extract_pages(pages(spark, ("/x", None, html)), rules).first()
    assert [row[name] for name in rules] == ["one", "x", ["one", "two", "three"], 2, "none"]


def test_rules_per_element(spark):
    html = (
        '<ul id="l"><li id="a">one<b>x</b><ul><li id="c"><b>z</b></ul><li><i>no</i></ul><ul id="l"><li id="d"><b t="1">'
    )
    rules = {
        "items": rule(deep(id="l"), deep("li"), key=rule(take="@id"), bold=rule(deep("b")), own=rule(), n=rule(child("b"), take="count")),
        "inner": rule(deep("ul"), child("li"), each_b=rule(deep("b"), mark=rule(take="@t", default="-"))),
    }
    row = extract_pages(pages(spark, ("/x", None, html), ("/y", None, None)), rules).orderBy("url").collect()
    # Reached by way of both lists, an inner element is still taken once, in its place.
    assert [tuple(i) for i in row[0]["items"]] == [
        ("a", "x", "one", 1), ("c", "z", None, 1), (None, None, None, 0), ("d", None, None, 1),
    ]
    assert [[tuple(b) for b in i["each_b"]] for i in row[0]["inner"]] == [[("-",), ("-",)], [("-",)], [], [("1",)]]
    assert row[1]["items"] == [] and row[1]["inner"] == []


def _plainly(page, rules):
    """Rules without ``each`` looked up in the node table, step by step."""
    nodes = page["nodes"]

    def fits(step, node):
        attrs = dict(node["attrs"])
        return (
            step.tag in (None, node["tag"]) and step.nth in (None, node["nth"])
            and all(attrs.get(k) == v for k, v in step.attrs.items())
        )

    def reached(steps):
        first, *rest = steps
        found = {n["idx"] for n in (nodes if first.deep else nodes[:1]) if fits(first, n)}
        for step in rest:
            below = {
                k for at in found
                for k in (range(at + 1, nodes[at]["last"] + 1) if step.deep else nodes[at]["kids"])
            }
            found = {k for k in below if fits(step, nodes[k])}
        return [nodes[k] for k in sorted(found)]

    out = {}
    for name, r in rules.items():
        found = reached(r.steps)
        said = [t for n in found for t in n["text"]]
        marks = [dict(n["attrs"]).get("class") for n in found]
        out[name] = {
            "text": next(iter(said), None), "texts": said, "count": len(found), "any": bool(found),
            "@class": next(iter(marks), None), "@@class": [m for m in marks if m is not None],
        }[r.take]
    return out


def test_matching_equals_the_node_table():
    draw = random.Random(5)
    tags, marks = ["div", "p", "ul", "li", "b", "br"], ["", ' class="x"', " class=y id=q", ' class="x&amp;"']
    takes = ["text", "texts", "count", "any", "@class", "@@class"]
    for _ in range(400):
        html = "".join(
            draw.choice([f"<{draw.choice(tags)}{draw.choice(marks)}>", f"</{draw.choice(tags)}>", draw.choice("ab &lt;")])
            for _ in range(draw.randrange(40))
        )
        rules = {}
        for k in range(6):
            steps = [
                draw.choice([child, deep])(
                    draw.choice([None, *tags]), draw.choice([None, None, 1, 2]), **draw.choice([{}, {}, {"class_": "x"}])
                )
                for _ in range(draw.randrange(1, 4))
            ]
            rules[f"r{k}"] = rule(*steps, take=draw.choice(takes))
        assert values_of(_Matcher(rules).read(html).taken) == _plainly(_read(html), rules), (html, rules)


PROFILE = (
    "<html><body><div><div></div><div>{head}</div><div><div><div><h1><div></div><div><a>N\x01</a>"
    "<small>@7</small></div></h1></div></div></div><div><div><div><div><div><ul><li><span></span>"
    "<span>2009-4-5 joined</span></li></ul></div></div></div></div></div>{log}</div></body>"
)
HEAD, LOG = '<div id="headerProfile"></div>', '<ul class="timeline"><li>x</ul>'


def test_users(spark):
    found = page_users(
        pages(
            spark,
            ("/user/7", "/user/99", PROFILE.format(head=HEAD, log=LOG)),
            ("/user/8", None, PROFILE.format(head=HEAD, log=LOG)),
            ("/user/9", None, PROFILE.format(head="", log=LOG)),
            ("/user/10", None, PROFILE.format(head=HEAD, log="")),
            ("/user/11", None, None),
        )
    )
    day = dt.date(2009, 4, 5)
    assert sorted(tuple(r) for r in found.collect()) == [(7, "7", "N", day), (99, "7", "N", day)]


def test_home_pages(spark):
    home = (
        '<div id="headerProfile">{banner}<div id="user_home"><div class="user_box clearit"><ul>'
        "<li><span>a</span><span>2009-4-5 x</span></ul></div></div><div id=\"game\"></div></div>"
    )
    users = page_home_users(
        pages(
            spark,
            ("/user/7", None, home.format(banner="")),
            ("/user/8", None, home.format(banner='<div class="tipIntro"></div>')),
            ("/user/bad", "/user/5", home.format(banner="")),
        ),
        blocked=["bad"],
    )
    assert [tuple(r) for r in users.collect()] == [(7, "7", "", dt.date(2009, 4, 5), ["game"])]
    assert [tuple(r) for r in home_links(users).collect()] == [(7, "/game/list/7")]


def test_lists(spark):
    index = (
        '<div id="columnSubjectBrowserA"><div><a href="/user/u1">x</a><span><span>2010-1-2 y</span>'
        '{liked}</span></div><ul><li id="item_3"><li id="item_5"></ul></div>'
    )
    found = page_indexes(
        pages(
            spark,
            ("/index/1", None, index.format(liked="<span>4</span>")),
            ("/index/2", None, index.format(liked="")),
            ("/index/3", None, "<p>"),
        )
    )
    day = dt.date(2010, 1, 2)
    assert sorted(tuple(r) for r in found.collect()) == [
        (1, "u1", 4, day, [3, 5]),
        (2, "u1", 0, day, [3, 5]),
    ]


def test_records_and_links(spark):
    html = (
        '<ul class="navSubTabs"><li><a href="/a" class="focus"><span>seen (25)</span></a></ul>'
        '<ul id="browserItemList"><li id="item_3"><div><p class="collectInfo"><span class="tip_j">'
        '2010-1-2</span><span class="tip"> tags: a b </span><span class="starstop-s"><span class='
        '"starlight stars8"></span></span></p><div class="text">so\x02 good</div></div>'
        '<li id="item_4"><div><p class="collectInfo"><span class="tip_j">2010年</span>'
        '<span class="starstop-s"><span class="starlight stars0"></span></span></p></div></ul>'
    )
    landed = pages(
        spark,
        ("/anime/list/u1/collect", None, html),
        ("/anime/list/u1/collect?page=2", None, html),
    )
    rows = {r["iid"]: tuple(r) for r in page_records(landed.limit(1)).collect()}
    assert rows[3] == (
        "u1", 3, "anime", "collect", dt.date(2010, 1, 2), 8, ["a", "b"], "so good",
    )
    assert rows[4] == ("u1", 4, "anime", "collect", dt.date(2010, 1, 1), None, None, None)
    links = sorted((r["url"][-7:], r["kind"], r["link"]) for r in page_links(landed).collect())
    assert links == [
        ("?page=2", "state", "/a"),
        ("collect", "next", SITE + "/anime/list/u1/collect?page=2"),
        ("collect", "state", "/a"),
    ]


def test_friends(spark):
    html = '<a href="/user/no"></a><ul id="memberUserList"><li><a href="/user/b"></a><li><b><a href="/c"></a></b></ul>'
    found = page_friends(pages(spark, ("/user/a/friends", None, html)))
    assert sorted(tuple(r) for r in found.collect()) == [("a", "b"), ("a", "c")]


def test_subjects(spark):
    def related(*items):
        return "".join(
            (f'<li class="sep"><span>{label}</span>' if label else "<li>")
            + f'<a class="title" href="/subject/{number}">x</a></li>'
            for label, number in items
        )

    html = (
        '<div id="headerSubject"><h1><a title="">Shown</a></h1></div><div class="global_score"><div>'
        '<small>Site Anime Rank</small></div></div><div class="infobox"><ul><li><span>导演: </span>'
        '<a href="/person/1"></a><a href="/person/2"></a></li><li>no label</li><li><span>别名: </span>'
        "Other</li></ul></div>"
        '<ul class="browserCoverMedium clearit">{}</ul><ul class="browserCoverSmall clearit">'
        '<li><a href="/subject/21"></a></ul>'
    )
    items = [("前传", 11), (None, 12), ("续集", 13), ("前传", 14)]
    found = page_subjects(
        pages(
            spark,
            ("/subject/1", "/subject/9", html.format(related(*items))),
            ("/subject/2", None, html.format(related((None, 5), ("续集", 6), (None, 7)))),
            ("/subject/3", None, "<p>"),
        )
    )
    rows = {r["subjectid"]: r for r in found.collect()}
    assert set(rows) == {1, 2}
    one = rows[1]
    assert (one["subjecttype"], one["subjectname"], one["order"]) == ("anime", "Shown", 9)
    assert one["alias"] == ["Other"] and one["staff"] == {"导演": ["1", "2"]}
    assert one["relations"] == {"前传": ["14"], "续集": ["13"], "单行本": ["21"]}
    assert rows[2]["relations"] == {"续集": ["6", "7"], "单行本": ["21"]}


def test_forward_fill(spark):
    df = spark.createDataFrame(
        [(1, 1, None), (1, 2, "a"), (1, 3, None), (1, 4, "b"), (2, 1, None)], "p int, o int, x string"
    )
    rows = {(r["p"], r["o"]): r["filled"] for r in forward_fill(df, ["p"], "o", "x").collect()}
    assert rows == {(1, 1): None, (1, 2): "a", (1, 3): "a", (1, 4): "b", (2, 1): None}


def answers(spark, *rows):
    return spark.createDataFrame(
        [(s, SITE + u, r and SITE + r, json.dumps(b)) for s, u, r, b in rows], API_DOCUMENTS
    )


def test_api_answers(spark):
    user = {"id": 1, "username": "a", "usergroup": 10, "avatar": {}}
    users = api_users(
        answers(
            spark,
            (200, "/user/1", None, user),
            (200, "/user/2", None, {**user, "id": 2, "username": "b", "usergroup": 4}),
            (200, "/user/3", None, {"code": 404}),
            (404, "/user/4", None, {}),
        )
    )
    assert sorted(r["id"] for r in users.collect()) == [1, 2]
    page = {"total": 60, "data": [{"subject_id": 5, "rate": 7, "tags": ["x"], "subject": {}}]}
    listings = answers(
        spark,
        (200, "/v0/users/a/collections?limit=50&offset=0", None, page),
        (200, "/v0/users/a/collections?limit=50&offset=50", None, {**page, "total": 51}),
        (200, "/v0/users/b/collections?limit=50&offset=0", None, page),
    )
    rows = [tuple(r)[:3] for r in api_collections(listings, users).collect()]
    assert sorted(rows) == [("a", 5, 7), ("a", 5, 7)]
    more = {r["offset"]: (r["more"], r["next_offset"]) for r in collection_pages(listings).collect()}
    assert more == {0: (True, 50), 50: (False, None)}

    subject = {"id": 1, "name": "n", "locked": False, "images": {}, "summary": "s"}
    found = api_subjects(
        answers(
            spark,
            (200, "/v0/subjects/1", "/v0/subjects/77", subject),
            (200, "/v0/subjects/2", None, {**subject, "id": 2}),
            (200, "/v0/subjects/3", None, {**subject, "locked": True}),
            (200, "/v0/subjects/4", None, {"error": "x"}),
            (404, "/v0/subjects/5", None, {}),
        )
    )
    assert {(r["id"], r["order"]) for r in found.collect()} == {(1, 77), (2, 2)}
    assert not {"summary", "images", "locked"} & set(found.columns)


def test_home_pages_are_read_by_many_tasks(spark):
    """Customers lie in one small file; the pages made from them are dealt evenly before they are read."""
    from checks.page_checks import home_links_query

    assert home_links_query(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 4


def test_elements_that_no_rule_leads_to_are_not_kept(monkeypatch):
    """They share one; behind the last place where a rule can begin, a page is not walked at all."""
    from tagmill.functions import html as reader
    from tagmill.operators.extract import LIST_RULES

    made = []

    class Counted(reader._Element):
        def __init__(self, *given):
            made.append(1)
            super().__init__(*given)

    monkeypatch.setattr(reader, "_Element", Counted)
    tabs = '<ul class="navSubTabs"><li><a href="/x"><span>1</span></a></li><li><a class="focus" href="/y"><span>2</span></a></ul>'
    many = '<div><p class="a">b<li><i id="c">d</i></div>' * 500
    found = values_of(reader._Matcher(LIST_RULES).read(f"<body>{many}{tabs}{many}").taken)
    assert found == {"states": ["/x", "/y"], "focus": "2"} and len(made) < 100
    # A value may be written with escapes, and a stray end tag closes what stands around it.
    found = values_of(reader._Matcher(LIST_RULES).read('<ul><ul class="nav&#83;ubTabs"><li></ul></ul><li><a href="/z">').taken)
    assert found == {"states": [], "focus": None}

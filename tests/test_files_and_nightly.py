import dataclasses
import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tagmill.operators.snapshots import snapshot_diff
from tagmill.plans.nightly import Paths, newest, run_pipeline
from tagmill.schemas import INT, LONG, TEXT, listed, struct
from tagmill.session import counted, scratch_folder
from tagmill.sources.ledger import Ledger
from tagmill.sources.readers import (
    latest_by,
    latest_snapshot,
    line_key,
    list_files,
    read_csv,
    read_jsonlines,
    read_lines_with_key,
    read_tsv,
)
from tagmill.sources.writers import (
    flat_items,
    route,
    write_chunked,
    write_csv,
    write_item_tsv,
    write_jsonlines,
    write_numbered,
    write_routed,
    write_tsv,
)
from pyspark.sql import types as T

AS_OF = dt.date(2026, 12, 1)


def text_of(folder):
    return "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{folder}/**/part-*", recursive=True)))


def test_jsonlines(spark, tmp_path):
    df = spark.createDataFrame([(1, "你é"), (2, None)], "id long, name string").coalesce(1)
    path = write_jsonlines(df, str(tmp_path), AS_OF)
    assert path.endswith("as_of=2026_12_01")
    assert text_of(path) == '{"id":1,"name":"你é"}\n{"id":2,"name":null}\n'
    assert read_jsonlines(spark, path, df.schema).count() == 2


def test_delimited(spark, tmp_path):
    schema = struct(id=LONG, name=TEXT, rank=LONG)
    rows = [(1, 'a\t"b" ', 3), (2, "NA", None), (3, " x,y", 4)]
    df = spark.createDataFrame(rows, schema)
    write_tsv(df, str(tmp_path / "t"))
    assert sorted(tuple(r) for r in read_tsv(spark, str(tmp_path / "t"), schema).collect()) == rows
    write_csv(df, str(tmp_path / "c"), ["id", "name"])
    found = read_csv(spark, str(tmp_path / "c"), struct(id=LONG, name=TEXT)).collect()
    assert sorted(tuple(r) for r in found) == [r[:2] for r in rows]


def test_item_file(spark, tmp_path):
    schema = struct(
        uid=LONG, alias=listed(TEXT), items=listed(LONG), staff=T.MapType(TEXT, listed(LONG))
    )
    df = spark.createDataFrame([(1, ["a", "b"], [4, 5], {"x": [1, 2], "y": [3]})], schema).coalesce(1)
    fields = ["alias", "uid", "items", "staff"]
    assert tuple(flat_items(df, fields).first()) == ("a;b", 1, "4;5", "x:1,2;y:3")
    write_item_tsv(df, str(tmp_path / "i"), fields)
    assert text_of(tmp_path / "i") == "alias\tuid\titems\tstaff\na;b\t1\t4;5\tx:1,2;y:3\n"


def test_chunks(spark, tmp_path):
    write_chunked(spark.range(25).coalesce(1), str(tmp_path / "k"), 10)
    sizes = [len(open(f).readlines()) for f in sorted(glob.glob(f"{tmp_path}/k/part-*"))]
    assert sizes == [10, 10, 5]


def test_route(spark):
    df = spark.createDataFrame([(1, "d"), (2, None)], "uid long, joindate string")
    out = route(df, {"user": F.col("joindate").isNotNull(), "record": F.lit(True)})
    assert [r["uid"] for r in out["user"].collect()] == [1]
    assert [r["uid"] for r in out["record"].collect()] == [2]
    assert out["rest"].count() == 0
    some = route(df, {"user": F.col("joindate").isNotNull()}, rest="else")
    assert [r["uid"] for r in some["else"].collect()] == [2]


def test_dated_snapshots_are_found(spark, tmp_path):
    for day, rows in ((1, 2), (2, 3)):
        write_jsonlines(spark.range(rows), f"{tmp_path}/subject_archive", dt.date(2026, 12, day))
    files = list_files(spark, str(tmp_path))
    paths = [latest_snapshot(files, "subject", n).first()["path"] for n in (1, 2)]
    assert [p.rsplit("=", 1)[-1] for p in paths] == ["2026_12_02", "2026_12_01"]
    assert latest_snapshot(files, "subject", 3).count() == 0


def test_keys_with_nulls_stay_apart(spark):
    lines = spark.createDataFrame([('{"a": 1}',), ('{"b": 1}',), ("broken",), ('{"a": 1, "b": 2}',)], "line string")
    keys = [r.k for r in lines.select(line_key(F.col("line"), ["a", "b"]).alias("k")).collect()]
    assert keys == [None, None, None, "1_2"]


def test_keyed_lines_and_diff(spark, tmp_path):
    def landed(name, keys):
        (tmp_path / name).write_text(
            "".join(json.dumps({"subject_id": a, "user_order": b}) + "\n" for a, b in keys)
        )
        return read_lines_with_key(spark, str(tmp_path / name), ["subject_id", "user_order"])

    prev = landed("p", [(1, 1), (1, 2), (2, 1), (2, 1)])
    cur = landed("c", [(1, 1), (3, 1)])
    upserts, deletes = snapshot_diff(prev, cur, "key")
    assert sorted(r["key"] for r in deletes.collect()) == ["1_2", "2_1"]
    assert sorted(r["line"] for r in upserts.collect()) == [
        '{"subject_id": 1, "user_order": 1}',
        '{"subject_id": 3, "user_order": 1}',
    ]


def test_newest_file(spark, tmp_path):
    for i, name in enumerate(["subject_a", "subject_b", "other", "subject_c"]):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1_000_000 + i, 1_000_000 + i))
    os.utime(tmp_path / "subject_a", (3_000_000, 3_000_000))
    assert newest(spark, str(tmp_path), "subject").endswith("subject_a")
    assert newest(spark, str(tmp_path), "subject", 2).endswith("subject_c")
    assert newest(spark, str(tmp_path), "subject", 4) is None


def test_latest_by(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c")], "k int, ts int, v string")
    assert sorted(tuple(r) for r in latest_by(df, "ts", ["k"]).collect()) == [(1, 7, "b"), (2, 1, "c")]
    assert tuple(latest_by(df, "ts").first()) == (1, 7, "b")


def test_scratch_is_shared(spark):
    assert scratch_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_folder(spark) != scratch_folder(spark)


def test_row_counts(spark):
    observed, seen = counted(spark.range(7), "seven")
    observed.collect()
    assert seen.get == {"rows": 7}


def landed(folder):
    """A small catalogue: the writer of its files, and records, statistics and archive."""

    def lines(name, rows):
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows))
        return str(path)

    box = "{{Infobox animanga/TV\r\n|别名={\r\n[x]\r\n}\r\n|开始= 2009年\r\n}}"
    archive = [
        {"id": i, "type": 2, "name": f"n{i}", "name_cn": "", "infobox": box, "summary": "s"}
        for i in range(1, 6)
    ]
    stats = [
        {
            "id": i, "order": i, "rating": {"rank": i, "total": 60},
            "collection": {"wish": i, "collect": 1, "doing": 0, "on_hold": 0, "dropped": 0},
        }
        for i in range(1, 6)
    ]
    records = [
        {"subject_id": s, "user_id": f"u{u}", "user_order": u, "rate": (s * u) % 10 + 1, "tags": ["T!", "t"]}
        for s in range(1, 6)
        for u in range(1, 7)
    ]
    return lines, records, stats, archive


def test_whole_chain(spark, tmp_path):
    lines, records, stats, archive = landed(tmp_path)
    gone = {"subject_id": 9, "user_id": "u1", "user_order": 1, "rate": 1, "tags": []}
    paths = Paths(
        records=lines("records", records),
        stats=lines("stats", stats),
        archive=lines("archive", archive),
        output=str(tmp_path / "out"),
        previous_records=lines("before", [gone, records[0]]),
        previous_subjects=lines("old", [{"id": 1}, {"id": 77}]),
    )
    rows = run_pipeline(spark, paths, AS_OF, tol=1e-2)
    assert rows == {
        "subject_archive": 5,
        "subject_entity": 5,
        "tags": 10,
        "subject_comprehensive": 5,
        "subject_del": 1,
        "collections_del": 1,
    }
    stamp = "as_of=2026_12_01"
    found = [json.loads(x) for x in text_of(tmp_path / "out/subject_comprehensive" / stamp).splitlines()]
    first = min(found, key=lambda d: d["id"])
    assert first["infobox"] == {"date_onair": "2009-12-01"} and first["alias"] == ["x"]
    assert {t["tags"] for t in first["tags"]} == {"T!", "t"} and first["rank_custom"]
    assert [s["input"] for s in first["suggest"]] == ["n1", "x", "T!", "t"]
    assert json.loads(text_of(tmp_path / "out/collections_del" / stamp)) == {"id": "9_1"}
    assert json.loads(text_of(tmp_path / "out/subject_del" / stamp)) == {"id": 77}
    update = text_of(tmp_path / "out/collections_update" / stamp).splitlines()
    assert sorted(update) == sorted(json.dumps(r, ensure_ascii=False) for r in records)
    pairs = text_of(tmp_path / "out/pair_rate" / stamp).splitlines()
    assert len(pairs) == 10
    ranks = text_of(tmp_path / "out/customrank" / stamp).splitlines()
    assert ranks[0] == "name,rank_custom,rank_site,subjectname" and len(ranks) == 6

    # The next night finds this night's subjects by itself.
    night = dataclasses.replace(
        paths, previous_subjects=None, previous_records=None, archive=lines("archive2", archive[:-1])
    )
    rows = run_pipeline(spark, night, AS_OF + dt.timedelta(days=1), tol=1e-2)
    assert rows["subject_archive"] == 4 and rows["subject_del"] == 1


def test_a_broken_night_is_taken_up_again(spark, tmp_path, monkeypatch):
    """Nothing is named but the two folders: newest and previous inputs come from what has landed and from the ledger."""
    from tagmill.plans import nightly

    lines, records, stats, archive = landed(tmp_path / "landed")
    for name, rows in (("records", records), ("stats", stats), ("archive", archive)):
        lines(f"{name}/as_of=2026_12_01/part-0.json", rows)
    paths = Paths(output=str(tmp_path / "out"), landed=str(tmp_path / "landed"))
    first = run_pipeline(spark, paths, AS_OF, tol=1e-2)
    assert "subject_del" not in first and "collections_del" not in first

    night = AS_OF + dt.timedelta(days=1)
    lines("records/as_of=2026_12_02/part-0.json", records[2:])
    lines("archive/as_of=2026_12_02/part-0.json", archive[1:])
    made, broken = [], []

    def watched(name):
        make = getattr(nightly, name)

        def run(*args, **settings):
            made.append(name)
            if name == "tag_table" and not broken:
                broken.append(name)
                raise OSError("the night breaks")
            return make(*args, **settings)

        monkeypatch.setattr(nightly, name, run)

    for name in ("enrich_subjects", "subject_aliases", "tag_table", "build_documents"):
        watched(name)
    with pytest.raises(OSError, match="the night breaks"):
        run_pipeline(spark, paths, night, tol=1e-2)
    done = Ledger(spark, paths.output, night).done
    assert set(done) == {"night", "collections", "subject_archive", "subject_entity"}
    assert done["subject_archive"]["rows"] == 4 and done["subject_archive"]["inputs"]["archive"].endswith("as_of=2026_12_02")

    lines("archive/as_of=2026_12_03/part-0.json", [])  # landed since; the night goes on with what it has chosen
    rows = run_pipeline(spark, paths, night, tol=1e-2)
    assert made == ["enrich_subjects", "subject_aliases", "tag_table", "tag_table", "build_documents"]
    assert rows["subject_archive"] == 4 and rows["subject_del"] == 1 and rows["collections_del"] == 2
    assert json.loads(text_of(tmp_path / "out/subject_del/as_of=2026_12_02")) == {"id": 1}
    gone = {json.loads(x)["id"] for x in text_of(tmp_path / "out/collections_del/as_of=2026_12_02").splitlines()}
    assert gone == {"1_1", "1_2"}

    made.clear()
    assert run_pipeline(spark, paths, night, tol=1e-2) == rows and made == []
    run_pipeline(spark, paths, night, mapping={"n": "m"}, tol=1e-2)
    assert made == ["subject_aliases", "tag_table", "build_documents"]


def test_numbered_files_are_full(spark, tmp_path):
    write_numbered(spark.range(0, 1_050, numPartitions=7), str(tmp_path / "n"), 100)
    files = sorted(glob.glob(f"{tmp_path}/n/chunk=*/part-*"))
    sizes = {int(f.split("chunk=")[1].split("/")[0]): len(open(f).readlines()) for f in files}
    assert len(files) == 11 and sizes == {i: 100 if i < 10 else 50 for i in range(11)}
    first = [json.loads(x)["id"] for x in text_of(tmp_path / "n/chunk=3").splitlines()]
    assert first == list(range(300, 400))
    write_numbered(spark.range(0), str(tmp_path / "none"), 100)
    assert glob.glob(f"{tmp_path}/none/chunk=*") == []


def test_routes_are_stored_by_one_scan(spark, tmp_path):
    rows = [(1, "a", 5), (2, "b", None), (3, None, 7), (4, "a", None)]
    df = spark.createDataFrame(rows, "id int, kind string, n int")
    tests = {"a": F.col("kind") == "a", "big": F.col("n") > 4}
    found = write_routed(df, tests, str(tmp_path / "r"), columns={"a": ["id"], "rest": ["id", "kind"]})
    assert {k: sorted(map(tuple, v.collect())) for k, v in found.items()} == {
        "a": [(1,), (4,)], "big": [(3, None, 7)], "rest": [(2, "b")]
    }
    assert found["a"].columns == ["id"]
    only = write_routed(df.where("id = 2"), tests, str(tmp_path / "only"), rest=None)
    assert [v.count() for v in only.values()] == [0, 0]


def test_scratch_without_the_setting(spark, monkeypatch):
    import tagmill.session as session

    class Conf:
        def __init__(self, master):
            self.values = {"spark.master": master}

        def get(self, name, default=None):
            return self.values.get(name, default)

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    one, two = (session.scratch_folder(Session("local[2]")) for _ in range(2))
    assert os.path.dirname(one) == os.path.dirname(two) and one != two
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_folder(Session("yarn"))

"""Feed source, cleaning/inference and sinks."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from leadlens.operators import infer as I
from leadlens.plans.feeds import FEEDS, cleaned_feed, refresh, refresh_feeds
from leadlens.sinks import writers as W
from leadlens.sinks.committed import commit, current, publish, read_committed
from leadlens.sources.report import read_report, sanitize_columns


def write_doc(folder, name, columns, records, raw_suffix=""):
    os.makedirs(folder, exist_ok=True)
    doc = {"columns": [{"index": i, "label": c} for i, c in enumerate(columns)], "records": records}
    text = json.dumps(doc)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text + raw_suffix)
    return os.path.join(folder, name)


FEED_COLUMNS = ["Lease Name", "2nd Phone_#", "Rent", "Amount", "Created Time", "Link", "Note"]
FEED_RECORDS = [
    ["L1", "312", "1200.5", "$1,200.50", "", '<a name="maple" href="x">', "x;y\\z"],
    ["L2", "313", "900", "$900.00", "01/02/2014", '<a name="q">', "café\nok"],
    ["L3", "314", "", "$2,000.00", "01/02/2014 10:00", "plain", "n"],
    ["L4", "315", "1000", "$1,000.00", "13/45/2014", "plain", "n"],
    ["L5", "316", "800", "$800.00", "", "plain", "n"],
]


def test_sanitize_columns():
    assert sanitize_columns(["Lease Name", "2nd Phone_#", "a-b"]) == ["leasename", "_2ndphone", "ab"]
    with pytest.raises(ValueError):
        sanitize_columns(["A B", "a_b"])
    with pytest.raises(ValueError):
        sanitize_columns(["__"])


def test_read_and_clean_report(spark, tmp_dir):
    write_doc(tmp_dir, "a.json", FEED_COLUMNS, FEED_RECORDS)
    raw = read_report(spark, tmp_dir)
    assert raw.columns == ["leasename", "_2ndphone", "rent", "amount", "createdtime", "link", "note"]
    assert raw.count() == 5
    df, rejects = cleaned_feed(spark, tmp_dir)
    types = dict(df.dtypes)
    assert types["_2ndphone"] == "double"          # every cell parses
    assert types["rent"] == "string"               # one '' cell keeps it text
    assert types["amount"] == "double"             # '$' and ',' dropped
    assert types["createdtime"] == "date"
    rows = {r.leasename: r for r in df.collect()}
    assert rows["L1"].amount == 1200.5 and rows["L1"].createdtime == dt.date(1900, 1, 1)
    assert rows["L3"].createdtime == dt.date(2014, 1, 2)
    assert rows["L4"].createdtime is None
    assert rows["L1"].link == "ple" and rows["L2"].link == ""
    assert rows["L1"].note == "xyz" and rows["L2"].note == "cafok"
    assert [(r.column_name, r.value) for r in rejects.collect()] == [("createdtime", "13/45/2014")]


def test_report_escapes_and_object_records(spark, tmp_dir):
    p = os.path.join(tmp_dir, "esc.json")
    with open(p, "w") as f:
        f.write('{"columns":[{"index":0,"label":"A"},{"index":1,"label":"B"}],'
                '"records":[{"0":"it\\\'s","1":"a\\>b"}]}')
    r = read_report(spark, tmp_dir).first()
    assert (r.a, r.b) == ("it's", "a>b")


def test_every_document_is_read_by_its_own_header(spark, tmp_dir):
    write_doc(tmp_dir, "a.json", ["A", "B"], [["a1", "b1"]])
    with open(os.path.join(tmp_dir, "b.json"), "w") as f:          # other order, other numbers, as objects
        json.dump({"columns": [{"index": 7, "label": "B"}, {"index": 2, "label": "a_"}],
                   "records": [{"2": "a2", "7": "b2"}, {"7": "b3"}]}, f)
    write_doc(tmp_dir, "c.json", ["B", "C"], [["b4", None]])       # lacks A, has C
    with open(os.path.join(tmp_dir, "d.json"), "w") as f:
        f.write("no document")
    with open(os.path.join(tmp_dir, "e.json"), "w") as f:
        json.dump({"columns": [{"index": 0, "label": "A"}], "records": []}, f)
    df = read_report(spark, tmp_dir, newest_only=False).select("a", "b", "c")
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(
        [("a1", "b1", None), ("a2", "b2", None), (None, "b3", None), (None, "b4", None)], key=repr)


def test_the_newest_document_alone(spark, tmp_dir):
    write_doc(tmp_dir, "a.json", ["A", "B"], [["a1", "b1"]])
    newer = write_doc(tmp_dir, "b.json", ["B", "A"], [["b2", "a2"]])
    os.utime(newer, (4_000_000_000, 4_000_000_000))
    assert [(r.a, r.b) for r in read_report(spark, tmp_dir).collect()] == [("a2", "b2")]


def test_headers_that_clash_or_are_missing(spark, tmp_dir):
    write_doc(tmp_dir, "a.json", ["A B", "ab"], [["1", "2"]])
    with pytest.raises(ValueError):
        read_report(spark, tmp_dir)
    other = os.path.join(tmp_dir, "none")
    os.makedirs(other)
    with open(os.path.join(other, "x.json"), "w") as f:
        f.write('{"records": []}')
    with pytest.raises(ValueError):
        read_report(spark, other, newest_only=False)


@pytest.mark.parametrize("text, want", [
    (r'{"a":"it\'s"}', '{"a":"it\'s"}'), (r'{"a":"x\>y"}', '{"a":"x>y"}'), (r'{"a":"\\\>"}', r'{"a":"\\>"}'),
    (r'{"a":"\\>"}', r'{"a":"\\>"}'), (r'{"a":"\u0041\n\""}', r'{"a":"\u0041\n\""}'), ("", "")])
def test_escapes_are_repaired_in_pairs(spark, text, want):
    from leadlens.sources.report import repair_escapes
    assert spark.createDataFrame([(text,)], "t string").select(repair_escapes(F.col("t"))).first()[0] == want


def test_the_plan_parses_once(spark):
    from leadlens.sources.report import parse_documents, records
    raw = spark.createDataFrame([("x", None, '{"columns":[{"index":0,"label":"A"}],"records":[["1"]]}')],
                                "path string, modified timestamp, value string")
    df = records(parse_documents(raw), ["a"])
    assert df.first().a == "1"
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json(") + plan.count("parseJson(") == 1, plan


def test_refresh_commits_table_and_rejects(spark, tmp_dir):
    src, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    write_doc(src, "a.json", FEED_COLUMNS, FEED_RECORDS)
    refresh(spark, src, root)
    assert [r.value for r in read_committed(spark, root, "rejects").collect()] == ["13/45/2014"]
    back = read_committed(spark, root, "data")
    assert back.count() == 5 and dict(back.dtypes)["amount"] == "double"
    assert W.sql_types(back)["createdtime"] == "date"


def test_a_broken_feed_leaves_its_table_and_the_others_are_refreshed(spark, tmp_dir):
    landing = {n: os.path.join(tmp_dir, "in", n) for n in FEEDS}
    root = os.path.join(tmp_dir, "out")
    for n in FEEDS:
        write_doc(landing[n], "a.json", ["Name"], [["old"], ["x"]])
    assert set(refresh_feeds(spark, landing, root)) == set(FEEDS)
    for n in FEEDS:
        p = write_doc(landing[n], "b.json", ["Name", "Rent"] if n != "pw_lease" else ["Name", "na me"], [["new", "1"]])
        os.utime(p, (4_000_000_000, 4_000_000_000))
    with pytest.raises(RuntimeError, match="pw_lease"):
        refresh_feeds(spark, landing, root)
    names = {n: sorted(r.name for r in read_committed(spark, f"{root}/{n}", "data").collect()) for n in FEEDS}
    assert names == {"pw_building": ["new"], "pw_lease": ["old", "x"], "pw_unit": ["new"]}
    with pytest.raises(ValueError):
        refresh_feeds(spark, {"other": tmp_dir}, root)


def test_a_write_that_fails_midway_shows_nothing_new(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    with pytest.raises(ValueError):
        read_committed(spark, root, "a")
    one = commit(spark, root, {"a": spark.range(3), "b": spark.range(1)})
    fails = spark.range(100).withColumn("id", F.when(F.col("id") < 99, F.col("id")).otherwise(
        F.raise_error(F.lit("broken row")).cast("long")))
    with pytest.raises(Exception, match="broken row"):
        commit(spark, root, {"a": spark.range(7), "b": fails})
    assert current(spark, root) == one and read_committed(spark, root, "a").count() == 3
    assert sorted(os.listdir(root)) == sorted(["_log", os.path.basename(one.folder)])      # no remains
    before = read_committed(spark, root, "a")
    two = commit(spark, root, {"a": spark.range(7)})
    assert two.number == 2 and read_committed(spark, root, "a").count() == 7
    assert before.count() == 3                       # who began earlier can finish
    commit(spark, root, {"a": spark.range(8)})
    assert not os.path.exists(one.folder) and os.path.exists(two.folder)
    with pytest.raises(ValueError):
        read_committed(spark, root, "b")


def test_two_refreshes_at_once(spark, tmp_dir, monkeypatch):
    from leadlens.sinks import committed
    root = os.path.join(tmp_dir, "t")
    commit(spark, root, {"a": spark.range(1)})
    seen = committed._entries
    monkeypatch.setattr(committed, "_entries", lambda files, r: [])      # began before the first one ended
    with pytest.raises(RuntimeError, match="another refresh"):
        commit(spark, root, {"a": spark.range(2)})
    monkeypatch.setattr(committed, "_entries", seen)
    assert read_committed(spark, root, "a").count() == 1


def test_views_follow_the_current_version(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    for n in (2, 5):
        commit(spark, root, {"a": spark.range(n)})
        publish(spark, root, {"published_a": "a"})
        assert spark.table("published_a").count() == n
    spark.sql("DROP VIEW published_a")


@pytest.mark.parametrize("cells, money, date", [
    (["$1", "$2", "$2"], True, False),                       # all hold $
    (["a", "b", "b"], False, False),                         # none does
    (["$1", "x", "x"], False, False), (["$1", "$1", "x"], True, False),
    (["$1", "x"], True, False), (["%1", "$1"], True, False),           # a tie goes by value
    (["1/2/2013", "1/2/2013"], False, False),                # there is no second value
    (["1/2/2013", "3/4/2013"], False, True), (["", "", "1/2/2013"], False, True),
    (["x", "x", "1/2/2013", "3/4/2013"], False, True), (["1/2/2013", "1/2/2013", "x"], False, False),
    ([None, None], False, False)])
def test_frequent_values_decide(spark, cells, money, date):
    df = spark.createDataFrame([(c,) for c in cells], "v string")
    s = I.column_stats(df)["v"]
    assert (s.money, s.date) == (money, date)


@pytest.mark.parametrize("items, candidates", [(10_000, 64), (8, 2), (4, 1)])
def test_top_two_equals_ranking_everything(spark, monkeypatch, items, candidates):
    import random
    from collections import Counter
    monkeypatch.setattr(I, "SKETCH_ITEMS", items)
    monkeypatch.setattr(I, "CANDIDATES", candidates)
    r = random.Random(items)
    columns = {"often": ["a"] * 300 + ["b"] * 200 + [f"z{k}" for k in range(500)],
               "even": [f"v{k % 40}" for k in range(1000)], "unique": [f"u{k}" for k in range(1000)],
               "few": ["x", "y"] * 20 + [None] * 960}
    for c in columns.values():
        r.shuffle(c)
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} string" for c in columns))
    got = I.top_two(df, {c: sum(v is not None for v in cells) for c, cells in columns.items()})
    for c, cells in columns.items():
        ranked = sorted(Counter(v for v in cells if v is not None).items(), key=lambda x: (-x[1], x[0]))
        assert got[c] == [v for v, _ in ranked[:2]], c


def test_forced_decisions_rank_nothing(spark, monkeypatch):
    def ranks(*a, **k):
        raise AssertionError("ranked")
    monkeypatch.setattr(I, "top_values", ranks)
    df = spark.range(5000).select(F.concat(F.lit("$"), "id").alias("money"), F.concat(F.lit("t"), "id").alias("text"),
                                  F.when(F.col("id") % 3 == 0, "").otherwise(
                                      F.date_format(F.date_add(F.lit("2013-01-01").cast("date"), (F.col("id") % 700).cast("int")),
                                                    "M/d/yyyy")).alias("day"))
    got = I.clean_frame(df)[0]
    assert dict(got.dtypes) == {"money": "double", "text": "string", "day": "date"}


def test_infer_numbers_edge(spark):
    df = spark.createDataFrame([("1d", "1e3", None), ("2", " 4 ", "$5")], "a string, b string, c string")
    out = I.infer_numeric(df)
    assert dict(out.dtypes) == {"a": "string", "b": "double", "c": "double"}


def test_top_values_ties_and_nulls(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",), ("x",), (None,), (None,), (None,), ("z",)], "v string")
    got = [(r.value, r.cnt, r.rank) for r in I.top_values(df, 2).orderBy("rank").collect()]
    assert got == [("x", 2, 1), ("y", 2, 2)]


def test_fill_defaults(spark):
    df = spark.createDataFrame([(None, None, None)], "d date, x double, s string")
    r = I.fill_defaults(df).first()
    assert (r.d, r.x, r.s) == (dt.date(1900, 1, 1), 0.0, None)


def test_text_contract_and_delimited(spark, tmp_dir):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "NA"), (4, "N/A")], "ID long, v string")
    t = W.to_text_table(df).orderBy("id").collect()
    assert [(r.id, r.v) for r in t] == [("1", ""), ("2", ""), ("3", None), ("4", "N/A")]
    p = os.path.join(tmp_dir, "csv")
    W.write_delimited(df, p)
    lines = sorted(line for f in os.listdir(p) if f.endswith(".csv")
                   for line in open(os.path.join(p, f)).read().splitlines())
    assert lines == ["1;", "2;", "3;NA", "4;N/A"]


def test_delimited_read_back(spark, tmp_dir):
    schema = "id long, v string, day date, x double, w string"
    day = dt.date(2014, 1, 2)
    rows = [(1, "a;b", day, 1.5, ' "q" '), (2, None, None, None, None), (3, "NA", day, -0.25, ""), (4, "", day, 1e300, "N/A"),
            (None, '"', day, 0.0, ";"), (5, " x", day, 2.0, "\\")]
    p = os.path.join(tmp_dir, "csv")
    W.write_delimited(spark.createDataFrame(rows, schema), p)
    got = [tuple(r) for r in W.read_delimited(spark, p, schema).collect()]
    want = [(a, None if v == "NA" else v or "", d, x, w or "") for a, v, d, x, w in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    lines = spark.createDataFrame([(1, "a\nb"), (2, "c")], "id long, v string")
    W.write_delimited(lines, p + "2")
    assert sorted(map(tuple, W.read_delimited(spark, p + "2", lines.schema, multi_line=True).collect())) == [(1, "a\nb"), (2, "c")]


def test_a_report_is_ordered_and_numbered(spark, tmp_dir):
    import random
    names = [f"n{k % 50:02d}" for k in range(400)] + [None]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "name string, k long").repartition(5)
    root = os.path.join(tmp_dir, "rep")
    order = [F.col("name").asc_nulls_last(), F.col("k").desc()]
    for fmt in ("parquet", "csv"):
        v = W.write_report(spark, root, {"all": df, "none": df.where("false")}, {"all": order, "none": order}, fmt=fmt)
        got = [tuple(r) for r in read_committed(spark, root, "all").orderBy("position").collect()]
        want = sorted(((n, k) for k, n in enumerate(names)), key=lambda r: (r[0] is None, r[0] or "", -r[1]))
        assert got == [(i, *r) for i, r in enumerate(want, 1)]
        assert read_committed(spark, root, "none").count() == 0
    folder = os.path.join(v.folder, "all")
    files = sorted(f for f in os.listdir(folder) if f.endswith(".csv"))
    positions = [int(line.split(",")[0]) for f in files for line in open(os.path.join(folder, f)).read().splitlines()[1:]]
    assert positions == list(range(1, len(names) + 1))       # file after file


def test_a_leading_blank_is_an_empty_date(spark):
    cells = [(" 1/2/2013",), ("",), ("1/2/2013 10:30",), ("x",), (None,)]
    got = spark.createDataFrame(cells, "v string").select(I.parse_date_cell(F.col("v")).alias("d")).collect()
    assert [r.d for r in got] == [dt.date(1900, 1, 1), dt.date(1900, 1, 1), dt.date(2013, 1, 2), None, None]

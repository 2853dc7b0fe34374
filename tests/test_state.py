"""Operators of state, attachments, clauses, contracts, builders and sinks on planted rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from canonry.functions import dates, html
from canonry.functions import text as T
from canonry.operators import attachments, clauses, quality, resolve, state
from canonry.sources import builders, sinks


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first().x


D = dt.date


def test_clauses_name_older_texts(spark):
    docs = [
        ("n1", "甲某管理办法（修订）", "O", D(2020, 1, 1), "我会对《甲某管理办法》进行了修订，现予发布。此前发布的《丙某操作指引》，《丁某操作指引》同时废止。"),
        ("o1", "甲某管理办法", "O", D(2010, 1, 1), "x"), ("o2", "甲某管理办法（2015年修订）", "O", D(2015, 1, 1), None), ("o3", "甲某管理办法", "P", D(2018, 1, 1), ""),
        ("c1", "丙某操作指引", "Q", D(2011, 1, 1), None), ("d1", "丁某操作指引", "Q", D(2012, 1, 1), None),
        ("r1", "新某实施细则", "O", D(2021, 1, 1), "现将《旧某实施细则》修订为《新某实施细则》。自2021年1月1日起施行，《未知的长标题》（以下简称《简称办法》）。《简称办法》同时废止；《新某实施细则》同时废止"),
        ("r0", "旧某实施细则", "O", D(2001, 1, 1), None), ("u1", "未知的长标题", "O", D(2002, 1, 1), None), ("late", "后来的规定办法", "O", D(2030, 1, 1), None),
        ("z", "某某规定", "O", D(2005, 1, 1), "《后来的规定办法》同时废止。《重名的规定》一并废止。"), ("y1", "重名的规定", "O", None, None), ("y2", "重名的规定", "O", None, None), (None, "无号的规定", None, None, "《丙某操作指引》废止"),
        ("t1", "乙某规定（修订）", "O", D(2020, 1, 1), "对《乙某规定》予以修订。"), ("t2", "乙某规定", "O", D(2015, 1, 1), None), ("t3", "乙某规定", "O", D(2015, 1, 1), None),
    ]
    df = spark.createDataFrame(docs * 2, "id string, title string, org string, day date, body string").withColumn("key", F.lit(1)).withColumn("to_id", F.lit("?"))
    assert rows(clauses.successors(df)) == [
        ("n1", "c1", "explicit_repeal", "丙某操作指引"), ("n1", "d1", "explicit_repeal", "丁某操作指引"), ("n1", "o2", "exact_title_revision", "甲某管理办法"),
        ("r1", "r0", "explicit_rename", "旧某实施细则"), ("r1", "u1", "explicit_repeal", "未知的长标题"),
    ]
    assert clauses.successors(df.limit(0)).count() == 0


def test_attempts_runs_and_queues(spark):
    a = spark.createDataFrame([("r", 1, True, "x"), ("r", 2, False, "y"), ("s", 1, None, "z"), ("s", 3, False, "w"), (None, 9, True, "v")], "k string, t int, ok boolean, v string")
    assert rows(state.keep_last_good(a, "k", F.col("ok"), ["t"]).select("k", "v", "is_complete")) == [("r", "x", True), ("s", "w", False)]
    p = spark.createDataFrame([("a", True, True), ("a", True, None), ("b", True, True), ("c", False, False), ("d", True, None)], "run string, ok boolean, p boolean")
    got = {r.run: (r.complete_parts, r.is_complete, r.publish_status) for r in state.run_status(p, "run", [F.col("ok")], F.col("p")).collect()}
    assert got == {"a": (2, True, "published"), "b": (1, True, "published"), "c": (0, False, "quarantined"), "d": (1, True, "n/a")}
    runs = spark.createDataFrame([("r1", 1, True), ("r2", 2, True), ("r3", 3, False)], "run string, at int, ok boolean")
    assert rows(state.latest_complete(runs, "run", "at", F.col("ok"))) == [("r2", 2)] and rows(state.latest_complete(runs.where("not ok"), "run", "at", F.col("ok"))) == []
    queue = spark.createDataFrame([("a", 1, 2), ("b", 1, 1), ("gone", 0, 0)], "id string, first_queued_at int, last_queued_at int")
    found = spark.createDataFrame([("a", 5, "p1"), ("c", 5, "p2"), ("e", 5, "p3")], "id string, t int, page string")
    closed = spark.createDataFrame([("p3",)], "page string")
    ids = spark.createDataFrame([("b",)], "id string")
    assert rows(state.queued(queue, found, [(closed, "page"), (ids, "id")], "id", "t")) == [("a", 1, 5), ("c", 5, 5), ("gone", 0, 0)]
    e = spark.createDataFrame([("k", 2, "u", "e2"), ("k", 1, "v", "e1"), ("k", 3, None, "e1"), (None, 1, "v", "e1")], "k string, t int, p string, owner string")
    assert rows(state.accumulated(e, "k", ["t"], ["p"], "owner")) == [("k", "e1", ["u", "v"])]


def test_resume_and_cache(spark):
    todo = spark.createDataFrame([("a",), ("b",)], "k string")
    done = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(state.resumed(todo, done, ["k"], {"code": "1"}, {"code": "1"})) == [("b",)]
    with pytest.raises(ValueError, match="code"):
        state.resumed(todo, done, ["k"], {"code": "2"}, {"code": "1"})
    q = spark.createDataFrame([("q1",), ("q2",), ("q3",), ("q4",)], "f string")
    finished = spark.createDataFrame([("q1", "o1"), ("q1", "o2"), ("q2", "o1"), ("q3", None)], "f string, o string")
    assert rows(state.uncached(q, finished, spark.createDataFrame([("o1",)], "o string"), "f", "o")) == [("q1",), ("q4",)]


def test_carried_matched_preferred(spark):
    r = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string")
    p0, p1 = spark.createDataFrame([("a", "0", None)], "k string, x string, y string"), spark.createDataFrame([("a", "1", "1"), ("b", "1", None), ("d", "1", "1")], "k string, x string, y string")
    over = spark.createDataFrame([("d", None, "o")], "k string, x string, y string")
    assert rows(state.carried(r, "k", [p0, p1], ["x", "y"], over)) == [("a", "0", "1", 0), ("b", "1", None, 1), ("c", None, None, None), ("d", None, "o", -1)]
    left = spark.createDataFrame([("l", "t", "n"), ("m", None, "n"), ("n", None, None)], "l string, t string, n string")
    right = spark.createDataFrame([("r", "t", "n"), ("s", "t", None)], "r string, t string, n string")
    assert rows(state.matched_either(left, right, "l", "r", ["t", "n"])) == [("l", "r", "t,n"), ("l", "s", "t"), ("m", "r", "n")]
    t = spark.createDataFrame([("a", "z"), ("a", "y"), ("b", "")], "k string, v string")
    assert rows(state.preferred(r, "k", [("first", t, "v", F.col("v") != ""), ("second", p1, "x", F.lit(True))])) == [("a", "y", "first"), ("b", "1", "second"), ("c", None, None), ("d", "1", "second")]


def test_attachments(spark):
    day = D(2020, 1, 1)
    parents = spark.createDataFrame([("p1", "决定", day, ["c1"]), ("p2", "送达公告", day, ["c2"]), ("p3", "决定", day, ["c3", "c4"]), ("p4", None, day, ["c5"]), ("p5", "决定", None, ["c6"])], "pid string, title string, day date, assets array<string>")
    children = spark.createDataFrame([(f"c{i}", f"p{i if i < 4 else i - 1}", day, "决定") for i in range(1, 7)], "cid string, pid string, day date, title string")
    assert rows(attachments.carriers(children, parents, "cid", "pid", F.col("title") == F.coalesce("p_title", F.lit("决定")), "送达公告")) == [("c1", "p1"), ("c5", "p4")]
    m = spark.createDataFrame([("s", "1", "E1"), ("s", "2", "E2"), ("s", "3", "E1")], "sys string, rec string, eid string")
    e = spark.createDataFrame([("s", "1", "2"), ("s", "1", "2"), ("s", "1", "3"), ("s", "1", "9"), ("s", None, "2")], "s string, a string, b string")
    assert rows(attachments.mapped_edges(e, m, [(["s", "a"], "f"), (["s", "b"], "t")], ["sys", "rec"], "eid")) == [("E1", "E2")]
    text = "现公布《某某管理办法》《某某操作指引》。"
    d = spark.createDataFrame([("1", "某某管理办法", text, "h"), ("2", "某某操作指引（试行）", text, "h"), ("3", "某某管理办法", "《某某管理办法》", "g"), ("4", None, None, None)], "id string, title string, body string, key string")
    assert rows(attachments.shared_announcements(d, "id", "title", "body", "key", "现公布")) == [("1", "h", len(text)), ("2", "h", len(text))]
    g = attachments.case_groups(spark.createDataFrame([("a", "b"), ("b", "x")], "a string, b string"), spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "n string"), "n")
    assert rows(g) == [("a", "a", 2), ("b", "a", 2), ("c", "c", 1)]


def test_passes_with_sets(spark):
    d = spark.createDataFrame([("a", 3, ["x", "y"], None), ("b", 2, ["y", "z", "z"], None), ("c", 1, ["z"], "h"), ("e", 0, None, "h"), ("f", 9, [], None), ("g", 5, ["q"], "h2")], "id string, o int, s array<string>, h string")
    assert rows(resolve.dedupe_passes(d, "id", ["o"], [["s"], ["h"]])) == [("a", "e", 0), ("b", "e", 0), ("c", "e", 1)]
    assert rows(resolve.dedupe_passes(d.limit(0), "id", ["o"], [["s"], ["h"]])) == []


def test_overlaps_in_rounds_fill_blanks(spark):
    e = spark.createDataFrame([("E1", ["x"], None, None), ("E2", ["y"], "2", None), ("E3", ["y"], "3", None)], "eid string, keys array<string>, n string, d string")
    r = spark.createDataFrame([("r1", 1, ["x", "z"], "1", None), ("r2", 2, ["x"], "9", None), ("r3", 3, ["x"], "1", "d1"), ("r4", 4, ["y"], None, None), ("r5", 5, ["z"], None, "d1"), ("r6", 6, None, "1", "d")], "rid string, o int, keys array<string>, n string, d string")
    found = resolve.overlap_rounds(r, e, "rid", "eid", "keys", ["n", "d"], "o")
    assert rows(found) == [("r1", "E1", 0), ("r3", "E1", 1), ("r5", "E1", 1)]
    assert resolve.overlap_rounds(r.limit(0), e, "rid", "eid", "keys", ["n", "d"], "o").count() == 0


def test_contracts_and_enumerations(spark):
    d = spark.createDataFrame([("1", "a", 1), ("2", "?", 2), ("3", " ", 3)], "id string, st string, n int")
    got = rows(quality.contract(d, "id", {"id": "string", "n": "bigint", "gone": "string"}, ["st", "gone"], {"st": ["a", " "]}))
    assert got == [("column_missing", "gone", "string"), ("column_type", "n", "int"), ("enum_st", "2", "?"), ("required", "3", "st")]
    assert rows(quality.contradictions(d, "id", {"big": F.col("n") > 2, "never": F.lit(None).cast("boolean")})) == [("big", "3", None)]
    t = spark.createDataFrame([("1", "text", ["f1"]), ("2", " ", ["f2", None]), ("3", "a <p>b</p> x<y", None)], "id string, t string, a array<string>")
    assert rows(quality.normalized(t, "id", "t", "a", spark.createDataFrame([("f1",)], "f string"), "f")) == [("asset_missing", "2", "f2"), ("empty_text", "2", None), ("markup_left", "3", "<p>")]
    assert rows(quality.subset(spark.createDataFrame([("g", "a"), ("g", "c"), ("h", None)], "g string, v string"), "g", "v", ["a", "b"], "s")) == [("s", "g", "b"), ("s", "h", "a"), ("s", "h", "b")]
    pages = [("ok", 1, 3), ("ok", 1, 3), ("ok", 2, 3), ("gap", 1, 2), ("gap", 3, 2), ("total", 1, 5), ("uneven", 1, 3), ("uneven", 2, 3), ("uneven", 2, 3)]
    got = rows(quality.enumeration(spark.createDataFrame(pages, "g string, p int, n int"), "g", "p", "n", 2))
    assert {x[:2] for x in got} == {("page_gap", "gap"), ("total_differs", "total"), ("page_size", "gap"), ("page_size", "uneven")}


def test_builders(spark):
    f = spark.createDataFrame([("a",), ("b",), ("c",)], "p string")
    of = lambda names, **k: [r.p for r in builders.typed_files(f, spark.createDataFrame([(n,) for n in names], "p string"), "p", **k).collect()]
    assert of(["c", "b"]) == ["b", "c"] and of(["b", "gone"]) == ["a", "b", "c"] and of(["b", None]) == ["a", "b", "c"] and of(["d"], together=True) == ["a", "b", "c", "d"] and of([], limit=2) == ["a", "b"]
    item = lambda **kv: {"domainMetaList": [{"resultList": [{"key": k, "value": v} for k, v in kv.items()]}]}
    pages = [("1", json.dumps({"total": 3, "results": [item(wh="n1"), item(wjbh="n2", title="t")]})), ("2", json.dumps({"total": 3, "results": [item(title="u")]})), ("3", "broken")]
    got = rows(builders.paged_items(spark.createDataFrame(pages, "page string, payload string"), "page", "payload", {"number": ["wh", "wjbh"], "title": ["title"]}))
    assert got == [("1", 0, "n1", None, True), ("1", 1, "n2", "t", True), ("2", 0, None, "u", True)]
    spec = spark.createDataFrame([("k", "d1", "甲", "乙"), ("k", "d2", "乙", "丙"), ("k", "d3", "乙", "没有")], "k string, document string, start string, end string")
    assert rows(builders.split_documents(spark.createDataFrame([("k", "甲 一 乙 二 丙")], "k string, t string"), spec, "k", "t")) == [("k", "d1", "甲一"), ("k", "d2", "乙二"), ("k", "d3", None)]
    art, files = spark.createDataFrame([("f1", "acc", 7), ("f2", "acc", 8)], "path string, account string, reads int"), spark.createDataFrame([("f2", b"2"), ("f1", b"1")], "path string, content binary")
    b = builders.bundle(art, files, "account", "path", ["reads"])
    assert b.count() == 2 and "reads" not in b.columns and b.select("batch_id").distinct().count() == 1 and {r.lane for r in b.collect()} == {"clue"}
    with pytest.raises(ValueError):
        builders.bundle(art, files.limit(1), "account", "path", [])
    with pytest.raises(ValueError):
        builders.bundle(art.withColumn("account", F.col("path")), files, "account", "path", [])
    assert rows(builders.tree_hash(files, "path", "content")) == rows(builders.tree_hash(files.orderBy("path"), "path", "content")) != rows(builders.tree_hash(files.limit(1), "path", "content"))
    seeds, landed = spark.createDataFrame([("a",), ("b",)], "s string"), spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "s string, page int, v string")
    assert rows(builders.per_seed(seeds, landed, ["s"], "page", 2)) == [("a", 1, "x", True), ("a", 2, "y", True), ("b", None, None, False)]


def test_sinks_of_bundles_digests_and_runs(spark, tmp_path):
    root, a = f"file://{tmp_path}/pub", spark.range(2).toDF("id")
    sinks.publish_bundle({"x": a, "y": a.limit(1)}, root, "b")
    sinks.publish_bundle({"x": a.limit(0), "y": a}, root, "b")
    assert sinks.bundle_table(spark, root, "b", "x").count() == 0 and sinks.bundle_table(spark, root, "b", "y").count() == 2

    def refuse(tables):
        raise ValueError("no")

    with pytest.raises(ValueError):
        sinks.publish_bundle({"x": a}, root, "b", refuse)
    assert sinks.bundle_table(spark, root, "b", "y").count() == 2
    sinks.roll_back(spark, root, "b")
    assert sinks.bundle_table(spark, root, "b", "x").count() == 2
    with pytest.raises(ValueError):
        sinks.roll_back(spark, root, "nothing")
    c = spark.createDataFrame([("1", "new", "a|b <i>"), ("2", "removed", None)], "id string, change string, title string")
    d = sinks.digest(c, "run-1", "id", "change", "title")
    assert json.loads(d["json"])["counts"] == {"new": 1, "removed": 1} and "a\\|b" in d["markdown"] and "&lt;i&gt;" in d["html"]
    run = sinks.Run(spark, "r", str(tmp_path / "log"))
    run.observed(a, "rows", table="x").write.parquet(str(tmp_path / "t"))
    run.event("started", mode="full")
    run.close()
    log = {(r.kind, r.name): r.value for r in spark.read.json(str(tmp_path / "log")).collect()}
    assert log == {("counter", "rows{table=x}"): 2, ("event", "started"): None, ("run", "complete"): None}
    sinks.markdown_library(c, str(tmp_path / "lib"), ["change"], "id", "title")
    assert spark.read.parquet(str(tmp_path / "lib")).where("change = 'new'").count() == 1


def test_texts_numbers_dates(spark):
    low = lambda t, x: one(spark, T.low_signal(F.col("t"), F.col("x")), t=t, x=x)
    assert [low("标题", None), low("标题", "标题"), low("标题", "标题，详见附件。第一条"), low("标题", "标题" + "正文" * 5), low(None, "见附件" + "正文" * 20), low(None, "短")] == [True, True, True, False, False, False]
    link = lambda h, b="http://a.example/x/y.html?q": one(spark, T.resolved_link(F.col("h"), F.col("b")), h=h, b=b)
    assert [link("./f.pdf"), link("/f.pdf"), link("//b.example/f"), link("http://x/https://y.example/f"), link('g.doc" target'), link("javascript:x"), link("#a"), link(""), link(None)] == [
        "http://a.example/x/f.pdf", "http://a.example/f.pdf", "https://b.example/f", "https://y.example/f", "http://a.example/x/g.doc", None, None, None, None,
    ]
    numbers = spark.createDataFrame([(n,) for n in (0, 1, 10, 11, 20, 99, 100)], "n int").select(T.chinese_number(F.col("n")).alias("x"))
    assert [r.x for r in numbers.collect()] == [None, "一", "十", "十一", "二十", "九十九", None]
    assert one(spark, T.call_arguments(F.col("x")), x="go('a','b c')") == ["a", "b c"] and one(spark, T.script_safe(F.col("x")), x="</script>") == "<\\/script>"
    assert one(spark, T.unmangled(F.col("x")), x="证券".encode().decode("latin-1").encode().decode("latin-1")) == "证券" and one(spark, T.unmangled(F.col("x")), x="naïf é") == "naïf é"
    assert one(spark, T.relinked(F.col("x"), "a.b/", "$c/"), x="[x](a.b/f) (a.b/f) [y](aXb/f)") == "[x]($c/f) (a.b/f) [y](aXb/f)"
    when = lambda text, stated, version, pub: one(spark, dates.effective(F.col("t"), F.to_date("s"), F.col("v"), F.to_date("p")), t=text, s=stated, v=version, p=pub)
    assert when("自2020年2月31日起施行。自2020年3月1日起施行", "2020-03-02", None, None) == D(2020, 3, 1) and when("自2020年3月1日起施行", "2020-06-01", None, None) == D(2020, 6, 1)
    assert when("自公布之日起施行", None, "20190102", "2019-01-01") == D(2019, 1, 2) and when("自公布之日起施行", None, "x", "2019-01-01") == D(2019, 1, 1) and when("无", "2020-01-01", None, None) == D(2020, 1, 1)
    assert dates.as_of_date("2020-01-01") == "2020-01-01" and len(dates.as_of_date()) == 10


def test_titles_and_numbers_as_written(spark):
    x = lambda f, v: one(spark, f(F.col("v")), v=v)
    assert [x(T.unescaped, v) for v in ("a &amp; b&#35777;&#x5238;&mdash;&unknown; &#0;", "无", None)] == ["a & b证券—&unknown; &#0;", "无", None]
    assert x(T.normal_title, "附件1：&ldquo;甲&rdquo; 办法？（试行）.pdf") == "甲办法？试行"
    assert x(T.title_keys, "关于公开征求意见的通知《某某办法（草案）》") == ["某某办法"]
    assert [x(T.number_keys, v) for v in ("证监会令【第１２号】", "〔2020〕5号", " ", None)] == [["证监会令第12号", "第12号"], ["〔2020〕5号"], [], None]


def test_legal_basis(spark):
    df = spark.createDataFrame([("依据《甲某管理办法》第三条、第十二条第一款和《乙某规定》第五条，《丙某规则》作出决定",), (None,), ("无",)], "t string").select(T.legal_basis(F.col("t")).alias("x"))
    assert [[tuple(y) for y in r.x] if r.x is not None else None for r in df.collect()] == [[("甲某管理办法", "第三条"), ("甲某管理办法", "第十二条"), ("乙某规定", "第五条"), ("丙某规则", None)], None, []]


def test_fragments_listings_articles():
    f = html.fragment('<h2>标题</h2><p>甲 <b>乙</b><img src="i.png" alt="图"></p><ul><li>一</li><li><a href="x.pdf?1">附件</a></li></ul><table><tr><td>a|b</td><td>c</td></tr><tr><td>d</td></tr></table><p>尾 <x>')
    assert f["markdown"] == "## 标题\n\n甲 乙![图](i.png)\n\n- 一\n\n- 附件\n\n| a\\|b | c |\n| --- | --- |\n| d |  |\n\n尾 <x>"
    assert f["tables"] == [{"table_id": "table_0001", "rows": [["a|b", "c"], ["d"]]}] and [(a["kind"], a["ref"], a["label"]) for a in f["assets"]] == [("image", "i.png", "图"), ("file", "x.pdf?1", "附件")]
    assert html.fragment("") == {"markdown": "", "tables": [], "assets": []}
    page = '<ul><li><a href="1" title="全名">简…</a><span>2020-1-2</span></li><li>无链接</li><li><a href="2">乙</a></li><li><a href="3">a</a><a href="4">b</a></li></ul>'
    assert html.listing(page) == [{"href": "1", "title": "全名", "day": "2020-01-02"}, {"href": "2", "title": "乙", "day": None}]
    c = html._fed(html.Clean("END"), '<p onclick="x" class="k">a<script>b</script><a href="https://h/1">l</a><a href="javascript:y">m</a></p><!-- END --><p>c</p>')
    assert "".join(c.out) == '<p class="k">a<a href="https://h/1">l</a><a>m</a></p>' and list(c.links) == ["https://h/1"]

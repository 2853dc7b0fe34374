"""Core operators on small rows: special cases and brute force."""

import datetime as dt
import decimal
import os
import random

import pytest
from pyspark.sql import functions as F

from canonry import catalog
from canonry.functions import html, ids
from canonry.functions import text as T
from canonry.functions.dates import china_date, lenient_date
from canonry.operators import cascade, changes, graph, joins, quality, resolve, windows
from canonry.sources import readers, sinks


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names)).select(column.alias("x")).first().x


def test_dates(spark):
    day = dt.date(2014, 3, 1)
    for s in ("2014-03-01", "2014/3/1", "2014.03.01", "20140301", "2014年3月1日", "2014-03-01 12:30", " 2014年 3 月 1 日 "):
        assert one(spark, lenient_date(F.col("s")), s=s) == day, s
    for s in (None, "", "2014", "2014年3", "2014-02-30", "0000-00-00", "待定", "----", "99999999"):
        assert one(spark, lenient_date(F.col("s")), s=s) is None, s
    ms = spark.sql("select 1393603200000L as ms").select(china_date(F.col("ms")).alias("d")).first().d
    assert ms == day  # midnight at UTC+8 is the day before at UTC


def test_titles_and_numbers(spark):
    assert one(spark, T.normal_title(F.col("s")), s="附件1：《某某 办法》（试行）.PDF".lower()) == "某某办法试行"
    assert one(spark, T.title_keys(F.col("s")), s="关于《某某管理办法（草案）》的通知") == ["关于某某管理办法的通知", "某某管理办法"]
    assert {one(spark, T.fileno_key(F.col("s")), s=s) for s in ("甲发〔2014〕5号", "甲发[2014]第5号", "甲发（2014） 5 号", "甲发2014年第5号")} == {"甲发20145"}
    assert [one(spark, T.fileno_key(F.col("s")), s=s) for s in (None, "", "无", "N/A")] == [None] * 4
    assert one(spark, T.body_hash(F.col("s")), s="x" * 79) is None and one(spark, T.body_hash(F.col("s")), s="x " * 80) is not None
    assert one(spark, T.clean_lines(F.col("s")), s=" a  b \r\n\r\n　c\n") == "a b\nc"
    assert one(spark, T.digest(F.col("s")), s=" SHA256:" + "AB" * 32) == "ab" * 32 and one(spark, T.digest(F.col("s")), s="unknown") is None


def test_coverage_and_bytes(spark):
    f = lambda a, b: one(spark, T.shingle_coverage(F.col("a"), F.col("b"), 4), a=a, b=b)
    assert [f("", "abc"), f("ab", "xabx"), f("ab", "ba"), f("abcdefgh", "xxabcdzz"), f("abcdefgh", "abcdefgh"), f(None, "a")] == [None, 1.0, 0.0, 0.5, 1.0, None]
    for s in ("", "abc", "é" * 9, "中文abc字", "a中b"):
        for n in (0, 1, 3, 4, 7, 100):
            assert one(spark, T.truncate_utf8(F.col("s"), n), s=s) == s.encode()[:n].decode("utf-8", "ignore")


def test_urls(spark):
    f = lambda u, q=True: one(spark, T.canonical_url(F.col("u"), q), u=u)
    assert f("HTTP://Ex.Com//a//b?utm_source=1&b=2&spm=3&a=1#f") == "http://ex.com/a/b?b=2&a=1"
    assert [f("http://e.com"), f("http://e.com/a?x=1", False), f(None), f("no url")] == ["http://e.com/", "http://e.com/a", None, "no url"]


def test_ids(spark):
    import hashlib

    assert one(spark, ids.entity_id(F.col("a"), F.col("b")), a="s", b="r") == "law_" + hashlib.sha256(b"s:r").hexdigest()[:24]
    df = spark.createDataFrame([(["b", "a"],), (["a"],)], "m array<string>").select(ids.family_id(F.col("m")).alias("f"))
    assert {r.f for r in df.collect()} == {"family:" + hashlib.sha1(b"a|b").hexdigest()[:20], "id:a"}
    same = [one(spark, ids.text_fingerprint(F.col("t")), t=t) for t in ("a  b\n", "a b", None, "")]
    assert same[0] == same[1] != same[2] == same[3]


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(f"n{rng.randrange(90):02}", f"n{rng.randrange(90):02}") for _ in range(70)] + [(f"c{i:02}", f"c{i + 1:02}") for i in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[find(a)] = find(b)
    groups = {}
    for x in parent:
        groups.setdefault(find(x), []).append(x)
    want = sorted((x, min(g)) for g in groups.values() for x in g)
    assert rows(graph.components(spark.createDataFrame(edges, "a string, b string"))) == want
    assert rows(graph.components(spark.createDataFrame([], "a string, b string"))) == []


def test_priority_match(spark):
    d = dt.date(2020, 1, 10)
    primary = spark.createDataFrame([("p1", "t", "n1", d), ("p2", "t", "n2", d + dt.timedelta(3)), ("p3", "u", None, None), ("p4", None, "n9", d), ("p5", "v", "n", None), ("p6", "v", "n", None)], "pid string, key string, number string, day date")
    probes = spark.createDataFrame([("a", None, "n9", d), ("b", "t", "n2", None), ("c", "t", None, d + dt.timedelta(2)), ("e", "t", None, d + dt.timedelta(9)), ("f", "u", None, None), ("g", "v", "n", None), ("h", "zz", None, None)], "rid string, key string, number string, day date")
    got = {r.rid: (r.match_id, r.rule) for r in joins.priority_match(probes, primary, "key", "number", "day", "pid", "rid").collect()}
    assert got == {"a": (None, "new"), "b": ("p2", "same"), "c": ("p2", "near_date"), "e": (None, "ambiguous"), "f": ("p3", "only_candidate"), "g": (None, "ambiguous"), "h": (None, "new")}


def test_as_of_equals_brute_force(spark):
    rng = random.Random(3)
    left = [(i, rng.choice("ab"), rng.choice([*range(20), None])) for i in range(60)]
    right = [(100 + i, rng.choice("ab"), rng.choice([*range(20), None])) for i in range(25)]
    lf, rf = spark.createDataFrame(left, "id int, k string, t int"), spark.createDataFrame(right, "rid int, k string, rt int")
    for forward in (True, False):
        for unique in (True, False):
            want = []
            for i, k, t in left:
                c = [(rt, rid) for rid, rk, rt in right if rk == k and t is not None and rt is not None and (rt > t if forward else rt < t)]
                best = (min if forward else max)(c, key=lambda x: x[0])[0] if c else None
                hit = sorted(rid for rt, rid in c if rt == best)
                want.append((i, (hit[0] if len(hit) == 1 or not unique else None) if hit else None))
            got = [(r.id, r.as_of_id) for r in joins.as_of(lf, rf, ["k"], "t", "rt", "rid", forward, unique).collect()]
            assert sorted(got, key=str) == sorted(want, key=str)


def test_edges_first_wins_and_stubs(spark):
    e = spark.createDataFrame([("a", "b", 2, "late"), ("a", "b", 1, "early"), ("a", "c", 1, None)], "f string, t string, p int, w string")
    assert rows(joins.first_wins(e, ["f", "t"], [F.col("p")])) == [("a", "b", 1, "early"), ("a", "c", 1, None)]
    n = spark.createDataFrame([("b",), ("b",)], "id string")
    assert rows(joins.with_stubs(e, n, "t", "id")) == [("b", False), ("c", True)]


def test_anchor_is_not_transitive(spark):
    d = dt.date(2020, 1, 1)
    data = [("A", "k", d), ("B", "k", d + dt.timedelta(3)), ("C", "k", d + dt.timedelta(5)), ("D", "k", d), ("E", "k", None), ("F", None, d), ("G", "j", d + dt.timedelta(1))]
    got = rows(resolve.anchor_dedupe(spark.createDataFrame(data, "id string, key string, day date"), ["key"], "day", "id"))
    assert got == [("A", "A"), ("B", "A"), ("C", "C"), ("D", "A"), ("E", "E"), ("F", "F"), ("G", "G")]


def test_fold(spark):
    data = [("g", 1, None, "short", ["x"]), ("g", 2, "unknown", "much longer", None), ("g", 3, "name", "", ["y", "x"]), ("h", 1, " ", None, None)]
    got = resolve.fold(spark.createDataFrame(data, "g string, o int, name string, body string, ids array<string>"), "g", "o", ["name"], ["body"], ["ids"])
    assert rows(got) == [("g", 3, "name", "much longer", ["x", "y"]), ("h", 1, None, None, [])]


def test_windows(spark):
    df = spark.createDataFrame([("d", i, v) for i, v in enumerate([1, 2, 3, 7, 8, 5])], "d string, line int, v int")
    assert rows(windows.islands(df, ["d"], "line", "v")) == [("d", 1, 3, 3, 0), ("d", 5, 5, 1, 5), ("d", 7, 8, 2, 3)]
    v = spark.createDataFrame([("f", "a", 3), ("f", "b", 2), ("f", "c", 2), ("f", "e", 0), ("f", "g", None)], "fam string, id string, v int")
    assert rows(windows.version_edges(v, "fam", F.col("v"), "id")) == [("a", "b", "f")]
    n = [r.file_name for r in windows.suffixed(spark.createDataFrame([(1, "s"), (2, "s"), (3, "t")], "id int, stem string"), "stem", "id").orderBy("id").collect()]
    assert n[0] == "s" and n[1].startswith("s - ") and n[2] == "t"
    assert rows(windows.latest(spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 1, None)], "k string, o int, v string"), ["k"], ["o"])) == [("j", 1, None), ("k", 2, "b")]


def test_changes(spark):
    b = spark.createDataFrame([("a", "1", "m"), ("b", "1", "m"), ("c", "1", "m"), ("d", None, "m")], "k string, c string, m string")
    a = spark.createDataFrame([("a", "1", "m"), ("b", "2", "n"), ("c", "1", "n"), ("e", "1", "m"), ("d", None, "m")], "k string, c string, m string")
    assert rows(changes.snapshot_diff(b, a, "k", "c", "m")) == [("b", "content_changed"), ("c", "metadata_changed"), ("e", "new")]


SEEN = {"x": [1, 2, 3, 4, 5, 6], "y": [1, 4, 5], "z": [2, 3], "w": [1, 3, 6], "v": [1]}


def test_removal_batch_equals_stream(spark, tmp_path):
    from canonry.streaming.removal import removal_stream

    runs = spark.createDataFrame([(r,) for r in range(1, 7)], "run int")
    seen = spark.createDataFrame([(k, r) for k, rs in SEEN.items() for r in rs], "key string, run int")
    batch = rows(changes.removal_events(seen, runs, "key", "run").select("key", "run", "event"))
    assert ("y", 3, "removed") in batch and ("y", 4, "restored") in batch and ("z", 5, "removed") in batch and not any(k == "x" for k, _, _ in batch)
    landed = tmp_path / "landed"
    for r in range(1, 7):
        spark.createDataFrame([(k, r, r in rs) for k, rs in SEEN.items()], "key string, run int, present boolean").coalesce(1).write.mode("append").parquet(str(landed))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema("key string, run int, present boolean").option("maxFilesPerTrigger", 1).parquet(str(landed))
        q = removal_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(180)
        assert rows(spark.read.parquet(str(tmp_path / "out"))) == batch
    finally:
        if before:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_quality_and_cascade(spark):
    df = spark.createDataFrame([("a", "ok", ""), ("a", "bad", "x"), (None, None, None)], "id string, st string, v string")
    assert rows(quality.unique(df, "id", "u")) == [("u", "a", "2")]
    assert rows(quality.foreign(df, "st", spark.createDataFrame([("ok",)], "s string"), "s", "f")) == [("f", "bad", "1")]
    assert rows(quality.required(df, "id", ["st", "v"], "r")) == [("r", "a", "v"), ("r", None, "st,v")]
    assert rows(quality.allowed(df, "id", "st", ["ok"], "w")) == [("w", "a", "bad")]
    R = cascade.Rule
    out = df.select(cascade.decide([R("one", F.col("st") == "ok", "A", 1.0), R("two", F.col("st").isNotNull(), "B", 0.5)], R("else", F.lit(True), None, 0.1)).alias("d")).select("d.*")
    assert rows(out) == [("A", "one", 1.0), ("B", "two", 0.5), (None, "else", 0.1)]


def test_html(spark):
    page = "<html><head><title>T &amp; t</title><script>x()</script></head><body><p>a <b>b</b> &lt;5</p><table><tr><td>文号：</td><td>甲1</td></tr><tr><td>文号</td><td>乙2</td></tr></table><a href='/u'>link</a><p>1 <foo> 2"
    got = spark.createDataFrame([(page,), (None,), ("",)], "h string").select(html.html_page(F.col("h")).alias("x")).select("x.*").collect()
    assert got[0].title == "T & t" and got[0].labels == {"文号": "甲1"} and got[0].links[0].href == "/u" and "a b <5" in got[0].text and "1 <foo> 2" in got[0].text and "x()" not in got[0].text
    assert got[1].text is None and got[2].text == ""


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.json").write_text('{\n"id": 1,\n"x": {"y": "z"}}')
    assert [(r.id, r.x.y) for r in readers.json_documents(spark, str(tmp_path / "j"), "id int, x struct<y: string>").collect()] == [(1, "z")]
    (tmp_path / "l.jsonl").write_text('{"k": "a", "o": 1}\nbroken\n{"k": "a", "o": 2}\n')
    assert [(r.k, r.o) for r in readers.json_lines(spark, str(tmp_path / "l.jsonl"), "k string, o int", "k", "o").collect() if r.k] == [("a", 2)]
    (tmp_path / "b").mkdir()
    (tmp_path / "b/t.txt").write_bytes("中文".encode("gb18030"))
    (tmp_path / "b/p.pdf").write_bytes(b"%PDF-1.4 rest")
    (tmp_path / "b/bad.xlsx").write_bytes(b"PK\x03\x04 broken")
    assert {(r.kind, r.text) for r in readers.asset_texts(spark, str(tmp_path / "b")).collect()} == {("txt", "中文"), ("pdf", None), ("zip", None)}
    assert {r.kind: bool(r.failure) for r in readers.asset_texts(spark, str(tmp_path / "b")).collect()} == {"txt": False, "pdf": True, "zip": True}
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "file string")
    pick = lambda names: [r.file for r in readers.manifest_files(spark.createDataFrame([(n,) for n in names], "file string"), files).orderBy("file").collect()]
    assert pick(["a", "b"]) == ["a", "b"] and pick(["a", "gone"]) == ["a", "b", "c"] and pick([]) == ["a", "b", "c"]
    reg = readers.registry(spark.createDataFrame([("e1", "http://X.com/a", "p1", "full"), ("e2", "http://x.com/a#f", "p2", "part")], "endpoint_id string, url string, profile string, scope_mode string"))
    assert [(r.url, r.profiles, r.conflict) for r in reg.collect()] == [("http://x.com/a", ["p1", "p2"], True)]
    df = spark.createDataFrame([(1, ["a", "b"], 'x "q" | y')], "id int, l array<string>, s string")
    sinks.csv_report(df, str(tmp_path / "csv"))
    assert [(r.id, r.l) for r in readers.csv_table(spark, str(tmp_path / "csv"), "id int, l string, s string").collect()] == [(1, "a;b")]
    root = f"file://{tmp_path}/pub"
    sinks.publish(df, root, "t")
    sinks.publish(df.withColumn("id", F.lit(2)), root, "t")
    assert sinks.published(spark, root, "t").first().id == 2
    with pytest.raises(ValueError):
        sinks.publish(df, root, "t", issues=df)
    sinks.append_events(df, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 1
    assert "\\|" in sinks.markdown(df, "s", ["id"], "s").first().markdown


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_queries_equal_oracle(spark, name):
    d = "/root/testdata/sf0.001"
    if not os.path.exists(d):
        pytest.skip("no test data here")
    df = catalog.queries()[name](spark, d)
    got = df.collect()
    if name not in catalog.oracle_sql():
        return
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(d):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{d}/{f}'")
    want = con.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(df.columns)
    shown = lambda x: "null" if x is None or x != x else f"{float(x):.6g}" if isinstance(x, float | decimal.Decimal) else str(x)
    values = lambda columns, data: sorted(tuple(shown(r[i]) for i in sorted(range(len(columns)), key=columns.__getitem__)) for r in data)
    assert values(df.columns, got) == values(names, want.fetchall())


def test_rest_stands_without_the_subpackage():
    import ast
    import pathlib

    root = pathlib.Path(catalog.__file__).parent
    for p in root.rglob("*.py"):
        if "llm" in p.relative_to(root).parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names] if isinstance(node, ast.Import) else []
            assert not any("llm" in n for n in names), p


def test_passes_overlaps_chains_clauses(spark):
    d = spark.createDataFrame([("a", 3, "n", None), ("b", 1, "n", "h"), ("c", 2, None, "h"), ("e", 0, None, "h"), ("f", 1, None, None)], "id string, o int, n string, h string")
    assert rows(resolve.dedupe_passes(d, "id", ["o"], [["n"], ["h"]])) == [("a", "e", 0), ("b", "e", 1), ("c", "e", 1)]
    e = spark.createDataFrame([("E1", ["x", "y"], "1"), ("E2", ["y"], None), ("E3", ["z"], "3")], "eid string, keys array<string>, n string")
    r = spark.createDataFrame([("r1", ["y"], "1"), ("r2", ["y"], None), ("r3", ["z", "z"], "4"), ("r4", ["z"], None), ("r5", None, None)], "rid string, keys array<string>, n string")
    assert rows(resolve.unique_overlap(r, e, "rid", "eid", "keys", ["n"])) == [("r1", "E1"), ("r4", "E3")]
    chain = spark.createDataFrame([("c", 1, "A"), ("c", 2, "B"), ("c", 3, "?"), ("c", 4, "C")], "c string, p int, t string")
    known = spark.createDataFrame([("a", "A"), ("b1", "B"), ("b2", "B"), ("c", "C")], "id string, t string")
    assert rows(joins.chain_edges(chain, "c", "p", ["t"], known, "id")) == [("c", "b2", "a"), ("c", None, "b2")]
    refs = spark.createDataFrame([("d1", "s", "1"), ("d1", "s", "2"), ("d2", "s", "3"), ("d3", "s", "9")], "doc string, sys string, rec string")
    m = spark.createDataFrame([("s", "1", "E1"), ("s", "2", "E1"), ("s", "3", "E1"), ("s", "3", "E2")], "sys string, rec string, eid string")
    assert rows(joins.resolve_documents(refs, m, "doc", ["sys", "rec"], "eid")) == [("d1", "E1", False), ("d2", None, True), ("d3", None, False)]
    laws = spark.createDataFrame([("L1", "甲某管理办法"), ("L2", "乙某管理办法"), ("L3", "重名规定"), ("L4", "重名规定")], "id string, k string")
    t = spark.createDataFrame([("L1", "本办法施行。《乙某管理办法》《重名规定》同时废止；《甲某管理办法》废止。另见《乙某管理办法》"), ("L2", None)], "id string, body string")
    assert rows(joins.clause_targets(t, "id", "body", "废止", laws.withColumnRenamed("id", "lid"), "k", "lid", T.normal_title)) == [("L1", "L2", "乙某管理办法")]


def test_slices_and_markdown(spark):
    f = lambda t, a, b: one(spark, T.slice_between(F.col("t"), F.col("a"), F.col("b")), t=t, a=a, b=b)
    assert [f("x 开 始 正文 结束 y", "开始", "结束"), f("开始 开始 结束", "开始", "结束"), f("结束 开始", "开始", "结束"), f(None, "a", "b")] == ["开始正文", None, None, None]
    md = one(spark, T.markdown_body(F.col("t")), t="第一章 总则\n第一条 某某应当在\n十日内报送。\n- 3 -\nThe word\nwraps here.\n")
    assert md == "## 第一章 总则\n\n**第一条** 某某应当在十日内报送。\n\nThe word wraps here."
    df = spark.createDataFrame([([["a", "b|c"], ["d"]],), ([],), (None,)], "m array<array<string>>").select(T.markdown_table(F.col("m")).alias("x"))
    assert [r.x for r in df.collect()] == ["| a | b\\|c |\n| --- | --- |\n| d |  |", None, None]


def test_field_checks(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", "z")], "id int, p string, q string")
    b = spark.createDataFrame([(1, "x", "n"), (3, "y", "z")], "id int, p string, q string")
    assert rows(quality.mismatches(a, b, "id", ["p", "q"], "m")) == [("m", "1", "q"), ("m", "2", "missing"), ("m", "3", "extra")]
    assert rows(quality.exactly_one(a, "id", spark.createDataFrame([(1,), (1,), (2,)], "id int"), "o")) == [("o", "1", "2")]


def test_ranks_commons_and_mirrors(spark):
    rng = random.Random(5)
    data = [(rng.choice(["a", "b", None]), i) for i in rng.sample(range(1000), 200)]
    df = spark.createDataFrame(data, "k string, v int").repartition(7)
    assert rows(windows.ranked(df, ["v"])) == sorted(((k, v, 1 + sum(w < v for _, w in data)) for k, v in data), key=str)
    assert rows(windows.ranked(df, ["v"], ["k"])) == sorted(((k, v, 1 + sum(w < v and j == k for j, w in data)) for k, v in data), key=str)
    assert windows.ranked(df.limit(0), ["v"]).count() == 0
    g = spark.createDataFrame([("g", 1, "x"), ("g", 1, "y"), ("g", 2, "x"), ("g", 2, "x"), ("h", 1, "x"), ("h", 2, None)], "g string, m int, v string")
    assert rows(resolve.common_to_all(g, ["g"], "m", "v")) == [("g", 2, "x")]
    e = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "c"), ("a", "c"), (None, "c")], "f string, t string")
    back = e.where("f is not null").select(F.col("t").alias("f"), F.col("f").alias("t"))
    assert rows(quality.unmirrored(e, back, ["f", "t"])) == [("a", "c", "missing"), ("c", "a", "extra"), (None, "c", "missing")]


def test_unique_later_equals_pairs(spark):
    rng = random.Random(6)
    left = spark.createDataFrame([(f"l{i}", rng.choice("ab"), rng.choice([None, 1, 2, 3, 4])) for i in range(30)], "l string, k string, t int")
    right = spark.createDataFrame([(f"r{i}", rng.choice("abc"), rng.choice([None, 1, 2, 3, 4, 5])) for i in range(9)], "r string, k string, u int")
    pairs = joins.unique_match(left, right.withColumnRenamed("k", "j"), (F.col("k") == F.col("j")) & (F.col("u") >= F.col("t")), "l", "r")
    assert rows(joins.unique_later(left, right, ["k"], "t", "u", "l", "r")) == rows(pairs)


def test_components_with_salted_hub(spark, monkeypatch):
    monkeypatch.setattr(graph, "LINKS_PER_SALT", 5)
    edges = spark.createDataFrame([("hub", f"s{i:02}") for i in range(30)] + [("s01", "z"), ("p", "q"), ("q", "p"), ("x", "x")], "a string, b string")
    got = dict(rows(graph.components(edges)))
    assert {got[k] for k in ("hub", "z", *(f"s{i:02}" for i in range(30)))} == {"hub"} and got["q"] == got["p"] == "p" and "x" not in got


def test_pages_without_end_tags():
    page = html.parse("<html><head><title>x</title><body><p>hello <foo>there</foo>")
    assert page["title"] == "x" and page["text"] == "hello <foo>there</foo>"

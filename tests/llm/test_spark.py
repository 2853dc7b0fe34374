"""Special cases of the operators: nulls, blanks, very long texts, ties, repeats, empty tables, clashing columns."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from canonry.llm import p1_pages, p2_near, p3_match, p4_survivor, p5_groups, p6_scans, p7_encoding, p8_tokens, p9_leaks, p10_quality, registry


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def brute_groups(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    groups = {}
    for x in parent:
        groups.setdefault(find(x), []).append(x)
    return sorted((x, min(g)) for g in groups.values() for x in g)


REL = "from_id string, to_id string, relation string, entity string, salt int, low string"


def test_groups_chain_star_and_dirt(spark):
    rng = random.Random(1)
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
    star = [("hub", f"s{i:03}") for i in range(80)]
    other = [(f"r{rng.randrange(60)}", f"r{rng.randrange(60)}") for _ in range(50)]
    data = [(a, b, "same_instrument_copy", "x", 1, "y") for a, b in chain + star + other]
    data += [(b.upper() + " ", a, " Same_Instrument_Copy", None, None, None) for a, b in chain[:5]] + data[:9]
    data += [(None, "c001", "same_instrument_copy", "", 0, ""), ("c001", None, "same_instrument_copy", "", 0, ""), ("z", "z", "same_instrument_copy", "", 0, ""), ("q", "c000", "related_to", "", 0, ""), ("", "c000", "same_instrument_copy", "", 0, ""), ("k", "m", None, "", 0, "")]
    found = p5_groups.components(p5_groups.links(spark.createDataFrame(data, REL)))
    assert rows(found) == brute_groups([(a, b) for a, b in chain + star + other if a != b])


def test_groups_salted_hub(spark, monkeypatch):
    monkeypatch.setattr(p5_groups, "LINKS_PER_SALT", 7)
    star = [("hub", f"s{i:03}", "same_instrument_copy") for i in range(40)]
    assert rows(p5_groups.components(p5_groups.links(spark.createDataFrame(star, "from_id string, to_id string, relation string")))) == brute_groups([s[:2] for s in star])


def test_groups_of_nothing(spark):
    assert rows(p5_groups.components(p5_groups.links(spark.createDataFrame([], REL)))) == []


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("甲乙丙丁戊己庚辛壬癸子丑寅卯") for _ in range(300)) for _ in range(6)]
    texts = []
    for b in base:
        for cut_ in (0, 3, 40, 90, 140):
            t = list(b)
            for _ in range(cut_ // 3):
                t[rng.randrange(len(t))] = "X"
            texts.append("".join(t))
    texts += [base[0] + " \n　", base[0].upper(), "abc", "", " ", None, "ab" * 30000, "ab" * 30000 + "c"]
    data = [("law", f"d{i:03}", t, "clash") for i, t in enumerate(texts)] * 2 + [("writ", "w1", base[0], "clash"), ("law", None, base[0], "clash")]
    df = spark.createDataFrame(data, "kind string, id string, text string, key string").select("kind", "id", "text")
    known = p2_near.sketches(df)
    pairs = p2_near.near_pairs(df, known)
    ids = {}
    for r in known.where("n > 0").collect():
        ids.setdefault((r.kind, r.key), set()).add(r.id)
    got = {tuple(sorted((x, y))) for r in pairs.collect() for x in ids[r.kind, r.a] for y in ids[r.kind, r.b]}
    got |= {tuple(sorted((x, y))) for (k, _), v in ids.items() if k == "law" for x in v for y in v if x < y}
    g = {i: p2_near.grams("".join(t.split()).lower()) for i, t in ((f"d{i:03}", t) for i, t in enumerate(texts)) if t}
    want = set()
    for x in g:
        for y in g:
            if x < y and len(g[x]) and len(g[y]):
                common = len(set(g[x].tolist()) & set(g[y].tolist()))
                if common >= 0.6 * (len(g[x]) + len(g[y]) - common):
                    want.add((x, y))
    assert got == want
    assert not p2_near.near_pairs(df.limit(0), p2_near.sketches(df.limit(0))).collect()


LAW = "lawlist struct<law struct<secFutrsLawId string, secFutrsLawName string, fileno string, pubDate bigint, source_record_id string>>, law_id string"
REC = "source_record_id string, metadata struct<name string, fileno string, pub_date string, law_id string>, core string"


def test_matching_rules(spark):
    day = 1393632000000 - 8 * 3600 * 1000  # 2014-03-01
    law = [
        ((("L1", "甲乙市某某资料管理办法", "甲证发〔2014〕5号", day, "x"),), "y"), ((("L2", "丙丁省托管账户实施细则", None, day, "x"),), "y"), ((("L3", None, None, None, None),), None),
        ((("L4", "戊己区评级公告操作指南", "戊债协〔2010〕7号", None, None),), None), ((("L5", "相同名称的某项规定", None, None, None),), None), ((("L6", "相同名称的某项规定", None, None, None),), None),
    ]
    rec = [
        ("S1", ("关于印发《甲乙市某某资料管理办法》的通知", "甲证发（2014）第5号", "2014年3月2日", "z"), "c"), ("S2", ("丙丁省托管帐户实施细则", None, "20140303", None), "c"), ("S3", ("丙丁省托管账户实施细则（征求意见稿）", None, "2014-03-01", None), "c"),
        ("S4", ("甲乙市某某资料管理办法", "乙证发〔2015〕9号", "2015-01-01", None), "c"), ("S5", ("戊己区评级公告操作…", "戊债协〔２０１０〕７号", None, None), "c"), ("S6", (None, None, None, None), None), ("S7", ("相同名称的某项规定", None, None, None), None),
        ("S8", ("甲乙市某某资料管理办法的解读", "甲证发〔2014〕5号", "2014-03-01", None), None), (None, ("甲乙市某某资料管理办法", None, None, None), None), ("S9", None, None),
    ]
    a, b = map(p3_match.cut, p3_match.sides(spark.createDataFrame(law * 2, LAW), spark.createDataFrame(rec * 2, REC)))
    out = p3_match.matches(a, b)
    assert {(r.law_id, r.source_record_id) for r in out.collect()} == {("L1", "S1"), ("L2", "S2"), ("L4", "S5")}
    assert all(0 < r.confidence < 1 for r in out.collect())
    assert p3_match.matches(a.limit(0), b.limit(0)).count() == 0


def test_survivors(spark):
    t = dt.datetime(2025, 1, 1)
    schema = "capture_id string, source_record_id string, source_system string, ingest_status string, metadata struct<fileno string, pub_date string>, content struct<plain_text string>, assets array<struct<asset_id string, sha256 string>>, fetched_at timestamp, entity_id string, rank int"
    sha = "a" * 64
    data = [
        ("c1", "r1", "Sys-A", "complete", ("甲发〔2014〕5号", "2014-02-30"), ("正文一二三",), [("a", None)], t, "x", 1),
        ("c2", "r1", "sys_a", " COMPLETE", ("N/A", "2014年3月1日"), ("404 Not Found",), [("a", "SHA256:" + sha.upper())], t + dt.timedelta(1), "x", 1),
        ("c3", "r2", "sys_b", "incomplete", ("甲发〔2014〕6号", "2014"), ("别的正文",), None, None, None, None),
        ("c4", "r9", "sys_b", None, None, None, None, t, None, None), ("c5", "r3", "sys_a", "complete", ("甲发〔2014〕5号", "2014-03-01"), ("正文",), None, t, None, None), (None, "r1", "sys_a", None, None, None, None, None, None, None),
    ]
    m = spark.createDataFrame([("sys_a", "r1", "E"), ("sys_b", "r2", "E"), ("sys_a", "r3", "F"), ("sys_a", "r1", "E"), (None, "r1", "G")], "source_system string, record_id string, entity_id string")
    k = spark.createDataFrame([("sys_a", 2), ("sys_b", 1)], "source_system string, trust_rank int")
    c = p4_survivor.captures(spark.createDataFrame(data * 2, schema), m, k)
    assert rows(p4_survivor.survivors(c)) == [("E", "assets", "c2"), ("E", "content", "c1"), ("E", "fileno", "c1"), ("E", "pub_date", "c2")]
    assert p4_survivor.survivors(c.limit(0)).count() == 0
    tied = {(r.field_name, r.capture_id) for r in p4_survivor.survivors(c, [("fileno", "pub_date")]).collect()}
    assert {("content", "c1"), ("assets", "c2")} <= tied


def test_pages(spark):
    nav, foot = ["首页 | 新闻 | 公告", "当前位置：首页 > 新闻"], ["上一篇：某某办法", "版权所有 © 2020 某某协会", "您是第77位访问者"]
    body = ["证券公司应当在十日内报送第{}号资料，不得拖延。", "新闻", "基金管理人应当核对账户{}。"]
    data = []
    for i in range(12):
        for host in ("a.example", "b.example"):
            own = [x.format(i) for x in body]
            lines = [*nav, *own, *foot] if host == "a.example" else own
            data.append(("source", f"{host}{i:02}", host, "\r\n".join(lines), i))
    data += [("source", "none", "a.example", None, 1), ("source", "blank", "a.example", " \n　", 1), ("source", "gone", "a.example", "404 Not Found", 1), ("source", "nohost", "", "一句完整的话，在这里。", 1), ("source", "long", "a.example", "长句子，" * 20000, 1), (None, None, None, None, None)]
    df = spark.createDataFrame(data * 2, "kind string, id string, host string, text string, line int")
    got = {}
    for r in p1_pages.site_lines(df.select("kind", "id", "host", "text")).collect():
        got.setdefault(r.id, set()).add(r.line_no)
    assert got == {f"a.example{i:02}": {0, 1, 5, 6, 7} for i in range(12)}
    assert p1_pages.site_lines(df.select("kind", "id", "host", "text").limit(0)).count() == 0
    text = {r.id: r.body for r in p1_pages.bodies(df.select("kind", "id", "host", "text")).collect()}
    assert text["a.example03"] == "\n".join(x.format(3) for x in body) and text["nohost"] == "一句完整的话，在这里。" and not {"gone", "blank", "none"} & text.keys()


def test_leaks(spark):
    rng = random.Random(8)
    item = "".join(rng.choice("甲乙丙丁戊己庚辛壬癸") for _ in range(100))
    docs = [(1, "序言，" + "。".join((item[:30], item[30:75])) + "结尾", "x"), (2, item[:30] + "断" + item[40:60], "x"), (3, None, "x"), (4, "", None), (5, item * 40, "x"), (6, "无关文字" * 5000, None)]
    items = [(7, "zh", item, 1), (8, None, "An unrelated English item that is long enough to have some prints. " * 3, 1), (9, "zh", None, 1), (10, "zh", "", 1)]
    d = spark.createDataFrame(docs + docs[:2], "doc_id bigint, text string, body string")
    e = spark.createDataFrame(items * 2, "item_id bigint, lang string, text string, place int")
    assert rows(p9_leaks.leaks(d, e)) == [(1, 7), (5, 7)]
    assert p9_leaks.leaks(d.limit(0), e).count() == 0 and p9_leaks.leaks(d, e.limit(0)).count() == 0


def test_leaks_without_filter(spark, monkeypatch):
    monkeypatch.setattr(p9_leaks, "FILTER_HASHES", 0)
    item = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余成岁律吕调阳"
    d = spark.createDataFrame([(1, item), (2, "别的")], "doc_id bigint, text string")
    assert rows(p9_leaks.leaks(d, spark.createDataFrame([(3, "zh", item)], "item_id bigint, lang string, text string"))) == [(1, 3)]


def test_tokens_quality_and_encoding_of_odd_rows(spark):
    d = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "Hello 世界", None), (4, "x" * 20000, None)], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.ids for r in p8_tokens.encode(d).collect()}
    assert got[1] == got[2] == [] and got[3][0] == 15496 and len(got[4]) > 0
    assert p8_tokens.encode(d.limit(0)).count() == 0
    s = p10_quality.statistics(d)
    assert {r.doc_id: r.n_lines for r in s.collect()} == {1: 0, 2: 0, 3: 1, 4: 1}
    assert [r.doc_id for r in p10_quality.kinds(s).collect()] in ([4], [3, 4], [4, 3])
    assert p10_quality.statistics(d.limit(0)).count() == 0
    clean = "证券公司应当在十日内报送资料，不得拖延。基金管理人应当核对托管账户，并保存记录。"
    v = [(f"k{i:03}", "full_text", clean + str(i)) for i in range(400)] + [("bad", "full_text", p7_encoding.garble(clean, ("gb18030", "latin-1"))), ("part", "full_text", clean + p7_encoding.garble(clean[:20], ("utf-8", "latin-1"))), ("ru", "full_text", clean + "Приложение № 2")]
    df = spark.createDataFrame(v * 2, "law_id string, field_name string, text string")
    out = {r.law_id: r.restored for r in p7_encoding.garbled(df, True).collect()}
    assert out == {"bad": clean, "part": clean + clean[:20]}
    assert p7_encoding.garbled(df.limit(0), False).count() == 0


def test_scans(spark):
    page = ["证券公司应当及时核对账户并保存", "相关资料，不得拖延。"]
    clean = "\n".join(page * 3)
    scan = "\n".join(["某某协会规则", page[0], "相关资料，个得拖延。", "基金管理人应当报送", "— 8 —", "某某协会规则", *page, "评级机构应当核对", "— 9 —"])
    data = [("law", f"k{i:02}", clean) for i in range(50)] + [("law", "scan", scan), ("law", "long", clean * 300)]
    df = spark.createDataFrame(data, "kind string, id string, text string")
    forms = p6_scans.learn(df)
    assert p6_scans.noise(scan, forms) == [(0, "furniture"), (2, "misread"), (4, "furniture"), (5, "furniture"), (9, "furniture")]
    assert p6_scans.noise(clean, forms) == [] == p6_scans.noise("", forms)
    assert [x[1] for x in p6_scans.repaired(scan, forms)][1] == "相关资料，不得拖延。"
    assert p6_scans.learn(df.limit(0)).wrong == {}


def test_scans_with_more_facts_than_fit(spark, monkeypatch):
    body = "The council keeps modern short-dated records of the council\nand the modern council keeps short-dated records"
    scan = "Tlie coun-\ncil keeps short-\ndated modem records"
    data = [("law", f"k{i:02}", body) for i in range(60)] + [("law", "scan", scan), ("law", "scan", scan + " too"), ("law", None, scan)]
    df = spark.createDataFrame(data, "kind string, id string, text string").where("id is not null")
    run = lambda: sorted(map(tuple, p6_scans.applied(df, p6_scans.noise, ["line_no", "noise"], "line_no int, noise string").select("id", "version", "line_no", "noise").collect()))
    broadcast = run()
    assert {x[2:] for x in broadcast} == {(0, "hyphen"), (0, "misread"), (2, "misread")} and {x[0] for x in broadcast} == {"scan"} and len({x[1] for x in broadcast}) == 2
    monkeypatch.setattr(p6_scans, "FORMS_BYTES", 0)
    assert run() == broadcast


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_queries_on_small_tables(spark, name):
    import os

    d = "/root/testdata/sf0.001"
    if not os.path.exists(d):
        pytest.skip("no test data here")
    df = registry.queries()[name](spark, d)
    assert df.agg(F.count(F.lit(1))).first()[0] > 0


def test_common_garbling_is_no_usual_text(spark):
    import random

    rng = random.Random(5)
    parts = ["证券公司", "应当", "在十日内", "向协会", "报送", "资料", "基金", "管理人", "不得", "托管", "账户", "及时", "核对", "保存", "，", "。"]
    text = ["".join(rng.choice(parts) for _ in range(30)) for _ in range(300)]
    bad = {i: p7_encoding.garble(t, ("utf-8", "latin-1")) for i, t in enumerate(text) if i % 3 == 0}
    df = spark.createDataFrame([(str(i), "full_text", bad.get(i, t)) for i, t in enumerate(text)], "law_id string, field_name string, text string")
    got = {r.law_id: r.restored for r in p7_encoding.garbled(df, True).collect()}
    assert got == {str(i): text[i] for i in bad}


def test_survivors_with_full_width_numbers(spark):
    schema = "capture_id string, source_record_id string, source_system string, ingest_status string, metadata struct<fileno string, pub_date string>, content struct<plain_text string>, assets array<struct<asset_id string, sha256 string>>, fetched_at timestamp"
    data = [(c, c, "a", "complete", (n, None), None, None, dt.datetime(2025, 1, d)) for c, n, d in (("c1", "砚证监公告〔2009〕474号", 1), ("c2", "砚证监公告〔２００９〕４７４号", 2), ("c3", "ＡＢＣ", 3))]
    m = spark.createDataFrame([("a", c, "E") for c in ("c1", "c2", "c3")], "source_system string, record_id string, entity_id string")
    c = p4_survivor.captures(spark.createDataFrame(data, schema), m, spark.createDataFrame([("a", 1)], "source_system string, trust_rank int"))
    assert rows(p4_survivor.survivors(c, fields=["fileno"])) == [("E", "fileno", "c2")]
    assert len({r.fileno_value for r in c.where("capture_id <> 'c3'").collect()}) == 1


def test_branch_and_bound_equals_brute_force(spark):
    import itertools

    rng = random.Random(9)
    data = []
    for e in range(60):
        for k in range(rng.randrange(2, 7)):
            n, d = rng.choice([None, "1", "2", "3"]), rng.choice([None, "a", "b", "c"])
            data.append((f"E{e}", f"c{e:02}{k}", n is not None, n, d is not None, d, (rng.random() < 0.3, rng.randrange(1, 5), rng.randrange(9), f"c{e:02}{k}")))
    schema = "entity_id string, capture_id string, fileno boolean, fileno_value string, pub_date boolean, date_value string, order struct<incomplete: boolean, rank: int, age: bigint, capture_id: string>"
    found = {}
    for r in p4_survivor.survivors(spark.createDataFrame(data, schema), [("fileno", "pub_date")], ("fileno", "pub_date")).collect():
        found.setdefault(r.entity_id, {})[r.field_name] = r.capture_id
    trust = lambda o: (1.0 if o[0] else 2.0) - o[1] / 2000
    for e in {x[0] for x in data}:
        own = [x for x in data if x[0] == e]
        seen = {(x[3], x[5]) for x in own if x[3] and x[5]}
        held = {a for a, _ in seen}
        best = 0.0
        for n, d in itertools.product([None, *(x for x in own if x[3])], [None, *(x for x in own if x[5])]):
            if not n or not d or n[3] not in held or (n[3], d[5]) in seen:
                best = max(best, sum(trust(x[6]) for x in (n, d) if x))
        by_id = {x[1]: x for x in own}
        got = {f: by_id[c] for f, c in found.get(e, {}).items()}
        assert abs(sum(trust(x[6]) for x in got.values()) - best) < 1e-9
        if len(got) == 2 and got["fileno"][3] in held:
            assert (got["fileno"][3], got["pub_date"][5]) in seen


def test_forest_finds_planted_pairs(spark):
    """Recall at the depth that the pilot trees tell, on planted pairs of several similarities."""
    rng = random.Random(12)
    make = lambda n: "".join(rng.choice("甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳") for _ in range(n))
    data, planted = [], set()
    for i in range(400):
        a = make(400)
        b = list(a)
        for _ in range(rng.choice([2, 5, 9, 14])):
            b[rng.randrange(400)] = rng.choice("甲乙丙丁")
        data += [("law", f"a{i:03}", a), ("law", f"b{i:03}", "".join(b))]
        x, y = p2_near.grams(a), p2_near.grams("".join(b))
        common = len(set(x.tolist()) & set(y.tolist()))
        if common >= 0.6 * (len(x) + len(y) - common):
            planted.add((f"a{i:03}", f"b{i:03}"))
    df = spark.createDataFrame(data, "kind string, id string, text string")
    known = p2_near.sketches(df)
    ids = {r.key: r.id for r in known.collect()}
    found = {tuple(sorted((ids[r.a], ids[r.b]))) for r in p2_near.near_pairs(df, known).collect()}
    assert found <= planted and len(found) >= 0.99 * len(planted) and len(planted) > 300


def test_encodings_are_learnt_from_every_value(spark):
    text = [f"证券公司应当在十日内报送第{i}号资料" for i in range(2500)]
    df = spark.createDataFrame([(str(i), "full_text", t) for i, t in enumerate(text)], "law_id string, field_name string, text string").repartition(3)
    model = p7_encoding.fit(df)
    assert model.text.single.sum() == sum(map(len, text)) and model.text.single[ord("证")] == 2500
    assert (model.odds == p7_encoding.fitted(text).odds).all()

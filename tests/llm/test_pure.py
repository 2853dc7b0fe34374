"""Operators of the subpackage that need no session."""

import base64
import os
import random
import unicodedata

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from canonry.llm import p1_pages, p2_near, p6_scans, p7_encoding, p8_tokens, p9_leaks, p10_quality


@pytest.fixture(scope="module")
def ranks():
    if not os.path.exists(p8_tokens.VOCABULARY):
        pytest.skip("no vocabulary here")
    with open(p8_tokens.VOCABULARY, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def test_encoder_equals_public_library(ranks):
    tiktoken = pytest.importorskip("tiktoken")
    public = tiktoken.Encoding("own", pat_str=p8_tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = p8_tokens.Encoder(ranks)
    rng = random.Random(1)
    texts = ["", "a", " ", "\n\n x", "<|endoftext|> hi", "é" * 100, "日本語テキスト" * 50, "aaaa" * 2000, "퟿\u0000x", "  lots   of  space \t\n"]
    texts += ["".join(rng.choice("abc de\n，。中文éß1234!?'") for _ in range(rng.randrange(200))) for _ in range(300)]
    assert own(texts) == [public.encode_ordinary(t) for t in texts]
    assert own(texts) == [public.encode_ordinary(t) for t in texts]  # now from what is remembered


def test_cut_pieces_equal_plain_merging(monkeypatch):
    rng = random.Random(4)
    ranks = {bytes([b]): b for b in range(256)}
    alphabet = [bytes([b]) for b in sorted(set("ab 中丰é".encode()))]
    while len(ranks) < 300:
        made = rng.choice(alphabet) + rng.choice(alphabet)
        if made not in ranks and len(made) < 12:
            ranks[made] = len(ranks)
            alphabet.append(made)

    def plain(piece):
        parts = [bytes([b]) for b in piece.encode()]
        while (best := min((ranks.get(x + y, 1 << 30), i) for i, (x, y) in enumerate(zip(parts, [*parts[1:], b"\0\0\0"], strict=True))))[0] < 1 << 30:
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return [ranks[p] for p in parts]

    own = p8_tokens.Encoder(ranks)
    texts = ["", *("".join(rng.choice("ab 中丰é界\n") for _ in range(rng.randrange(60))) for _ in range(300)), "ab" * 300]
    want = [[i for piece in own.find(t) for i in plain(piece)] for t in texts]
    assert own(texts) == want and own(texts) == want and own([]) == []
    for bound in (1, 50):  # forgotten in between
        monkeypatch.setattr(p8_tokens, "REMEMBERED", bound)
        assert [ids for t in texts for ids in own([t])] == want


def test_equal_parts_of_pieces_are_merged_once(ranks, monkeypatch):
    rng = random.Random(8)
    merged, merge = [], p8_tokens.merge_rows
    monkeypatch.setattr(p8_tokens, "merge_rows", lambda pieces, pair_rank: merged.extend(pieces) or merge(pieces, pair_rank))
    own = p8_tokens.Encoder(ranks)
    texts = ["".join(rng.choice("证券公司应当在十日内向协会报送资料") for _ in range(40)) for _ in range(500)]
    assert sum(map(len, own(texts))) > 500 * 40
    assert len(merged) == len(set(merged)) < 100


@given(st.text(max_size=120), st.text(max_size=120))
@settings(max_examples=60, deadline=None)
def test_grams_jaccard_equals_sets(a, b):
    sets = [{t[i : i + 5] for i in range(len(t) - 4)} for t in (a, b)]
    x, y = p2_near.grams(a), p2_near.grams(b)
    assert [len(x), len(y)] == [len(s) for s in sets]
    assert len(np.intersect1d(x, y)) == len(sets[0] & sets[1])


def test_forest_depth_keeps_recall():
    last = p2_near.DEPTHS[-1]
    assert p2_near.chance(p2_near.THRESHOLD, last) >= p2_near.RECALL > p2_near.chance(p2_near.THRESHOLD, last + 1)
    assert p2_near.TREES * p2_near.DEPTHS[0] <= p2_near.BINS and list(p2_near.DEPTHS) == sorted(p2_near.DEPTHS, reverse=True)


def test_signature_agreement_estimates_similarity():
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh") for _ in range(3000))
    other = base[:2400] + "".join(rng.choice("abcdefgh") for _ in range(600))
    x, y = p2_near.grams(base), p2_near.grams(other)
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert abs((p2_near.signature(x) == p2_near.signature(y)).mean() - true) < 0.1
    assert (p2_near.signature(p2_near.grams("abcde")) == p2_near.signature(p2_near.grams("abcde"))).all()


def test_winnowing_finds_every_long_run():
    rng = random.Random(5)
    for rule, (run, k, w) in p9_leaks.RULES.items():
        for _ in range(30):
            shared = "".join(rng.choice("abcdefghij") for _ in range(run))
            a = "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(150))) + shared + "xyz"
            b = "q" * rng.randrange(9) + shared + "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(150)))
            ha, hb = (set(p9_leaks.winnow(p9_leaks._codes(t), k, w)[1].tolist()) for t in (a, b))
            assert ha & hb, rule


def test_covered_equals_brute_force():
    rng = random.Random(6)
    for _ in range(50):
        item = "".join(rng.choice("ab") for _ in range(60))
        doc = "".join(rng.choice("ab") for _ in range(20)) + item[10:40] + "c" + item[45:58]
        seen = set()
        for i in range(len(item) - 9):
            if item[i : i + 10] in doc:
                seen |= set(range(i, i + 10))
        assert p9_leaks.covered(item, doc, list(range(-60, 90)), 10) == len(seen)


def test_reduced_form():
    assert p9_leaks.reduced("Ａb-１ 中。　ﬁ") == "ab1中fi"
    assert p9_leaks.reduced(None) == "" == p9_leaks.reduced("…")
    assert unicodedata.is_normalized("NFKC", p9_leaks.reduced("Å ½ ﷺ"))


def test_alignment_of_pages():
    weight = np.array([0.3, 0.3, 3.5, 0.3, 3.5, 0.3, 0.3])
    fixed = np.array([True, True, False, False, False, True, True])
    assert p1_pages.body(weight, fixed) == (2, 5)
    assert p1_pages.body(weight, np.ones(7, bool)) == (0, 0)
    assert p1_pages.body(weight, np.zeros(7, bool)) == (0, 7)


def test_wrappers_have_optional_and_repeated_groups_and_slots():
    w = p1_pages.Wrapper()
    for page in ([1, 2, 50, 9], [1, 3, 51, 9], [1, 2, 3, 52, 53, 9], [1, 2, 54, 7, 7, 7, 9]):
        w.fold(page, [t + 100 if t == 1 else t * len(page) for t in page])
    got = {g[0]: g for g in w.groups}
    assert [g[0] for g in w.groups if g[0] < 10] == [1, 2, 3, 7, 9]  # in order
    assert got[1] == (1, 101, 4, 0)  # fixed, with one text
    assert got[9] == (9, 0, 4, 0)  # fixed, a text slot
    assert got[2][2] == 3 and got[3][2] == 2  # optional
    assert got[7][2:] == (1, 1)  # repeated
    other = p1_pages.Wrapper()
    for _ in range(96):
        other.fold([1, 9], [101, 9])
    other.merge(w.pages, w.groups)
    other.settle()
    assert [g[0] for g in other.groups] == [1, 2, 3, 9] and other.pages == 100
    assert p1_pages.squared([1, 2, 1, 2, 1, 2, 3])[0] == [0, 1, 6]
    assert p1_pages.squared([]) == ([], []) and p1_pages.longest([], {}) == []
    assert p1_pages.longest([5, 1, 2, 3], {1: [0], 2: [1], 3: [2], 5: [3]}) == [(1, 0), (2, 1), (3, 2)]


def test_page_tokens_have_slots():
    assert p1_pages.tokens("上一篇：甲规定")[1] == p1_pages.tokens("上一篇：乙办法")[1]
    assert p1_pages.tokens("第3页")[0] == p1_pages.tokens("第17页")[0]
    assert p1_pages.tokens("首页 | 新闻")[0] != p1_pages.tokens("首页 | 公告")[0]


@pytest.mark.parametrize("chain", p7_encoding.CHAINS)
def test_chains_invert_where_nothing_is_lost(chain):
    text = "Any holder’s “register” – naïve" if chain[0] == "utf-8" else "证券公司应当报送资料"
    bad = p7_encoding.garble(text, chain)
    if "�" not in bad and "?" not in bad:
        assert p7_encoding.invert(bad, chain) in (text, None)


def test_classifier_on_held_out_text():
    rng = random.Random(2)
    parts = ["证券公司", "应当", "在十日内", "向协会", "报送", "资料", "基金", "管理人", "不得", "托管", "的", "账户", "及时", "核对", "并", "保存", "，", "。"]
    make = lambda n: "".join(rng.choice(parts) for _ in range(n))
    clean = [make(40) for _ in range(300)]
    model = p7_encoding.fitted(clean)
    right = total = 0
    for chain in (("utf-8", "latin-1"), ("utf-8", "cp1252"), ("gb18030", "latin-1"), ("utf-8", "gb18030"), ("gb18030", "koi8-r")):
        for _ in range(10):
            text = make(12)
            if "�" in p7_encoding.garble(text, chain):
                continue
            found = model.stretch(p7_encoding.garble(text, chain))
            total += 1
            right += found is not None and found[3] == text
    assert right >= 0.9 * total
    assert model.stretch(make(30)) is None
    # Correct foreign scripts, marks, odd characters and misreads of scanners are none.
    for right_as_is in (
        "Приложение № 2", make(5) + "\n付表：カタカナ表記", "Guidelines – COMISSÃO", "naïf coöperatie", make(9) + "\n囧 龘 靐 犇 燚", "      第3页\n" + make(9), "參見總則", make(9).replace("的", "旳"), "Société Brévane’s rule",
    ):
        assert model.stretch(right_as_is) is None, right_as_is
    assert model.stretch("") is None


@pytest.mark.parametrize("together", [1, 40, 1 << 15])
def test_texts_are_scanned_together(monkeypatch, together):
    rng = random.Random(7)
    parts = ["证券公司", "应当", "在十日内", "向协会", "报送", "资料", "基金", "管理人", "不得", "托管", "的", "及时", "并", "，", "。"]
    make = lambda n: "".join(rng.choice(parts) for _ in range(n))
    model = p7_encoding.fitted([make(40) for _ in range(200)])
    texts = ["", "a", "é", "的", "ascii only", "Société Brévane’s rule", make(9) + "囧", "\n", "ï¿½", "锟斤拷锟斤拷", "\ufffd" * 5, "\U00020000", "\ud800é"]
    for chain in p7_encoding.CHAINS:
        texts += [make(20), make(3) + p7_encoding.garble(make(8), chain) + "\n" + make(60), p7_encoding.garble(make(2), chain), "Rule " * 30 + p7_encoding.garble("“naïve”", chain)]
    one_by_one = {best: [model.stretch(t, best) for t in texts] for best in (False, True)}
    assert sum(x is not None for x in one_by_one[False]) > 40
    gains, calls = p7_encoding._gains, []
    monkeypatch.setattr(p7_encoding, "_gains", lambda odds: calls.append(1) or gains(odds))
    monkeypatch.setattr(p7_encoding, "TOGETHER", together)
    for best, want in one_by_one.items():
        assert model.stretches(texts, best) == want
    calls.clear()
    assert model.stretches([make(12) for _ in range(500)], False) == [None] * 500
    assert together < 100 or len(calls) < 100  # not for each text


def test_gain_of_some_pairs_equals_all():
    text = p7_encoding.fitted(["基金管理人应当及时核对账户。" * 3, "the rule of any fund"]).text
    for a, b in (("the rule", "thé rúle"), ("基金管理", "基佥管里"), ("a", "é"), ("same", "same")):
        assert text.gain(a, b) == pytest.approx(text._log_p(a).sum() - text._log_p(b).sum())
        assert (text.log_p(a) == text._log_p(a)).all() and (text.log_p(a) == text._log_p(a)).all()  # new, and remembered


def test_counts_of_garbled_text_equal_brute_force(monkeypatch):
    monkeypatch.setattr(p7_encoding, "AT_ONCE", 20)
    texts = ["证券公司应当报送", "Any holder’s “register” – naïve", "é", "\U00020000好\n好", "ÿ\x81", "あ한", "不計入"]
    weights = dict.fromkeys(texts, 1) | {"不計入": 0, "é": 0}
    count = lambda weight: p7_encoding._counts(*pd.concat(p7_encoding._tally(texts, weight)).to_numpy(np.int64).T)
    got = p7_encoding.chain_counts(count(lambda t: 1) + count(lambda t: weights[t] - 1))
    for row, chain in zip(got, ((), *p7_encoding.CHAINS), strict=True):
        want = np.zeros(p7_encoding.BUCKETS, np.int64)
        for t in texts:
            data = np.frombuffer(f"\n{p7_encoding.garble(t, chain)}\n".encode(), np.uint8)
            want += weights[t] * np.bincount(p7_encoding._bigrams(data), minlength=p7_encoding.BUCKETS)
        assert (row == want).all(), chain


def test_scan_furniture():
    body = ["证券公司应当及时核对账户并保存", "相关资料，不得拖延。", "基金管理人应当在十日内报送报", "告。"]
    lines = ["某某协会规则", *body, "- 3 -", "某某协会规则", *body, "- 4 -", "某某协会规贝", *body, "- 5 -"]
    assert p6_scans.furniture(lines) == {0, 5, 6, 11, 12, 17}
    assert p6_scans.furniture([]) == set() == p6_scans.furniture(["", " "])
    assert p6_scans.furniture(["档次", "3/9", "4/9", "正文。"]) == set()


def test_scan_facts():
    beside = lambda *x: p6_scans.Beside(*(np.array(v) for v in zip(*((ord(c), ord(o), n) for c, o, n in x), strict=True)))
    none = np.empty(0, np.int64)
    forms = p6_scans.Forms({"tlie": "the", "modem": "modern", "co": "oo"}, {"co-op"}, {("short", "dated")}, beside(("应", "，", 500)), beside(("应", "当", 900)))
    assert forms.word_right("Tlie") == "the" and forms.word_right("the") is None
    assert forms.misread("tlie-based") and not forms.misread("co-op") and forms.misread("co-owner")
    assert forms.own_hyphen("Short", "dated-x") and not forms.own_hyphen("coun", "cil")
    code = lambda t: np.frombuffer(t.encode("utf-32-le"), np.uint32)
    assert forms.glyphs_right(code("，庒当x庒y")) == {1: "应"} and forms.glyphs_right(code("")) == {}
    assert p6_scans.Forms({}, set(), set(), p6_scans.Beside(none, none, none), p6_scans.Beside(none, none, none)).glyphs_right(code("庒")) == {}


def test_headers_alike():
    lines = ["某某证券业协会自律规则汇编", "某某证券业协会自律规贝汇编", "第一条其他内容完全不同的句子", "某某证券业"]
    assert p6_scans._recurring(lines) == {lines[0], lines[1], lines[3]}
    assert p6_scans._recurring([]) == set() and p6_scans._recurring(["ab", "ab"]) == set()


def test_headers_of_pages_without_number():
    body = ["证券公司应当及时核对账户并保存全部资料，不得拖延或者", "隐瞒，并在十日内报送相关资料给协会，由协会会同评级机", "构另行商定具体的办法和期限，逾期不报的按照规定处理。"]
    lines = ["某某协会规则", *body, "- 3 -", "某某协会规则", *body[:1], "某某协会规贝", *body[1:], "- 4 -", "某某协会规则", *body, "- 5 -", body[0], body[1], body[2], "某某协会规则"]
    assert p6_scans.furniture(lines) == {0, 4, 5, 7, 10, 11, 15}


def test_quality_lines():
    prose = "证券公司应当在十日内报送资料，不得拖延。基金管理人应当核对账户。\n" * 3
    listed = "\n".join(f"{i}. 某某资料" for i in range(20))
    tabled = "\n".join("项目,3,2020-01-01,4.5%" for _ in range(9))
    junk = "%□□{@●\\@~$]^^_++★◆○<¤★■" * 10
    texts = [prose, listed, tabled, junk, "", None, " \n\t", "x" * 3000]
    import pandas as pd

    out = next(p10_quality._count(iter([pd.DataFrame({"doc_id": range(8), "text": texts})])))
    got = out.set_index("doc_id")
    share = lambda kind: sum(got[r] for r, k in p10_quality.REASONS.items() if k == kind)
    assert got.prose_share[0] == 1 and share("list")[1] > 0.9 and share("table")[2] > 0.9 and share("junk")[3] == 1
    assert list(got.n_lines[4:7]) == [0, 0, 0] and share("junk")[7] == 1

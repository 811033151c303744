import random

import pytest

from noticeflow.llm import lookalike as L
from noticeflow.llm import queries

SAME = [
    ("Ｗｅｂサイト", "Webサイト"), ("ﾃﾞｰﾀｾﾝﾀｰ", "データセンター"), ("データ", "データ"), ("消⁠防​署", "消防署"), ("業\U000e0101務", "業務"), ("⼯事", "工事"), ("エ事", "工事"), ("サーバ—", "サーバー"), ("サ─バ一", "サーバー"),
    ("АЕD", "AED"), ("LΑΝ", "LAN"), ("a b", "a b"), ("a　b", "a  b "), ("デー夕", "データ"), ("アスべスト", "アスベスト"), ("図︀書", "図書"), ("カ", "力"), ("é", "é"), ("ﾌﾟ‍ｰﾙ", "プール"), ("soft­hyphen", "softhyphen"),
]
OTHER = [("その1", "その2"), ("北棟", "南棟"), ("a b", "ab"), ("é", "e"), ("ハ", "バ"), ("管理", "監理"), ("A地区", "B地区"), ("ッ", "ツ")]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same(a, b):
    assert L.fold(a) == L.fold(b)


@pytest.mark.parametrize(("a", "b"), OTHER)
def test_other(a, b):
    assert L.fold(a) != L.fold(b)


def test_fold_edges():
    assert L.fold(None) is None and L.fold("") == L.fold(" ​　") == ""
    for a, _ in SAME:
        assert L.fold(L.fold(a)) == L.fold(a)


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_automaton_is_the_edit_distance():
    rng = random.Random(3)
    words = {"".join(rng.choice("abcd") for _ in range(rng.randrange(1, 7))) for _ in range(60)}
    for budget in (0, 1, 2):
        trie = L.Trie(budget)
        for w in words:
            trie.add(w)
        for _ in range(150):
            q = "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 8)))
            best = min(((edit(q, w), w) for w in words), default=None)
            assert trie.find(q) == (best[1] if best[0] <= budget else None)


def test_automaton_zero_costs():
    trie = L.Trie()
    trie.add("デ夕センA")
    assert trie.find("デタセン​А") == "デ夕センA" and trie.find("デタセ") is None


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "natural_key string, organization_id string, title_normalized string, form string, text string, id int")


def test_pairs_are_all_pairs(spark):
    rng = random.Random(5)
    stems = ["工場データ センター一", "給食ポール AED", "x y"]
    swap = {"工": "エ⼯工", "デ": "ﾃﾞデ", "ー": "ー—─", "A": "AΑА", " ": " 　 ", "x": "xх"}

    def variant(s):
        out = "".join(rng.choice(swap[c]) if c in swap and len(swap[c]) > 1 and c != "デ" else c for c in s)
        return out + rng.choice(["", "", "​", "︀"])

    rows = [(f"k{i:03d}", rng.choice(["o", "p", None]), rng.choice([None, "", " ", *[variant(s) for s in stems * 3]])) for i in range(160)] + [(None, "o", "x y")]
    got = {(r["a"], r["b"]) for r in L.same_looking_pairs(frame(spark, rows), "natural_key", "organization_id", "title_normalized").collect()}
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] and b[0] and a[0] < b[0] and a[1] and a[1] == b[1] and a[2] is not None and b[2] is not None and a[2] != b[2] and L.fold(a[2]) == L.fold(b[2])}
    assert got == want and len(want) > 100
    assert L.same_looking_pairs(frame(spark, []), "natural_key", "organization_id", "title_normalized").count() == 0


def test_one_form_per_class(spark):
    rows = [(f"k{i}", "o", t) for i, t in enumerate(["工事 A", "エ事 A", "工事　А", None, "", "別"] * 3)]
    got = {}
    for r in L.canonical_texts(frame(spark, rows), "natural_key", "title_normalized").collect():
        got.setdefault(r["text"], set()).add(r["form"])
    assert got["工事 A"] == got["エ事 A"] == got["工事　А"] and len(got["工事 A"]) == 1
    assert got[None] == {None} and got[""] == {""} and got["別"] == {"別"}


def test_form_is_the_most_frequent_spelling(spark):
    texts = ["水道メーター 更新", "水道メーター 修繕", "水道メ一ター 購入", "水道ﾒｰﾀｰ 撤去", "水道メー​ター 移設", "デー夕 一式", "データ 一部", "データ 一覧", "サーバー"]
    got = {r["text"]: r["form"] for r in L.canonical_texts(frame(spark, [(f"k{i}", "o", t) for i, t in enumerate(texts)]), "natural_key", "title_normalized").collect()}
    assert [got[t] for t in texts] == ["水道メーター 更新", "水道メーター 修繕", "水道メーター 購入", "水道メーター 撤去", "水道メーター 移設", "データ 一式", "データ 一部", "データ 一覧", "サーバー"]


def test_forms_are_equal_where_the_table_is(spark):
    texts = ["a b", "a \u2066 b", "a\u309bb", "a \u3099b", "\u2066", "ab", "aa\u00b4Α", "aa \u0301A", "A", "Α", "Α x"]
    got = {r["text"]: r["form"] for r in L.canonical_texts(frame(spark, [(f"k{i}", "o", t) for i, t in enumerate(texts)]), "natural_key", "title_normalized").collect()}
    assert all((got[a] == got[b]) == (L.fold(a) == L.fold(b)) for a in texts for b in texts) and got["\u2066"] == ""


def test_the_automaton_gives_what_the_table_does_not(spark):
    texts = ["第1期 更新", "第1期 修繕", "第l期 更新", "第I期 購入", "第I期 撤去", "O号棟", "0号棟 改修", "0号棟", "三二 ミニ", "OO O0"]
    rows = [(f"k{i}", "o", t) for i, t in enumerate(texts)]
    got = {r["text"]: r["form"] for r in L.canonical_texts(frame(spark, rows), "natural_key", "title_normalized").collect()}
    assert got["第l期 更新"] == "第1期 更新" and L.fold("第l期") != L.fold("第1期")
    assert got["第I期 購入"] == "第I期 購入"  # one and capital I are not taken for each other
    assert got["O号棟"] == got["0号棟"] == "0号棟" and got["OO O0"].split()[0] == got["OO O0"].split()[1]
    pairs = {(r["a"], r["b"]) for r in L.same_looking_pairs(frame(spark, rows), "natural_key", "organization_id", "title_normalized").collect()}
    assert pairs == {("k0", "k2"), ("k5", "k7")}


def test_budget(monkeypatch):
    trie = L.Trie(L.BUDGET)
    trie.add("10号")
    assert trie.find("1O号") == trie.find("l0号") == "10号" and trie.find("lO号") is None and trie.find("11号") is None


@pytest.mark.parametrize(("a", "b"), [("第①期", "第1期"), ("5²", "52"), ("㈱研究所", "(株)研究所"), ("½", "1/2"), ("㌢", "センチ"), ("三", "ミ"), ("千", "チ")])
def test_what_has_a_look_of_its_own(a, b):
    assert L.fold(a) != L.fold(b) and L.shape(L.shape(a)) == L.shape(a)


def test_a_hot_form(spark):
    rows = spark.range(100_000).selectExpr("cast(id as string) id", "'o' as g", "if(id = 7, '工事', if(id = 8, '⼯事', 'エ事')) as t")
    got = L.same_looking_pairs(rows, "id", "g", "t")
    assert got.count() == 2 * 99_998 + 1


def test_titles_come_in_one_form_with_normalized_titles(spark, tmp_path):
    rows = [("a", "工事 データ", "工事 データ"), ("b", "エ事 データ", "工事 データ"), ("c", "⼯事　ﾃﾞｰﾀ", "エ事 データ"), ("d", None, "サーバー"), ("e", "サーバ—", None), ("e", "\u2066", ""), (None, "別", "サーバー 別")]
    spark.createDataFrame(rows, "natural_key string, title string, title_normalized string").write.parquet(str(tmp_path / "tender.parquet"))
    got = queries.p5_forms(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and {(r["natural_key"], r["title"], r["title_normalized"]) for r in got} == set(rows)
    forms = {(r["title"], r["title_normalized"]): (r["title_own_form"], r["title_form"]) for r in got}
    assert [forms[r[1:]] for r in rows] == [("工事 データ", "工事 データ")] * 3 + [(None, "サーバー"), ("サーバー", None), ("", ""), ("別", "サーバー 別")]

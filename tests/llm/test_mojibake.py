import random

import numpy as np
import pytest

from noticeflow.llm import mojibake as M

LINES = ["支払いは検査に合格した後、適正な請求書を受理した日から行う。", "星原桐研究所の敷地内にあり、作業は午前9時から正午までの間に行うものとします。", "一般競争入札 榎野鶴コミュニティセンター旧館外壁タイル撤去工事について", "データセンター北棟ネットワーク機器の保守点検業務委託", "The contractor shall submit a work plan by 11 December 2026.", "令和８年度　笹柏野スポーツ公園中央監視室Webサイト点検業務委託第2回"]


@pytest.fixture(scope="module")
def restorer():
    rng = random.Random(1)
    singles, pairs = {}, np.zeros(M.BUCKETS, np.int64)
    M.count_pairs([rng.choice(LINES) for _ in range(3000)], singles, pairs)
    return M.Restorer(M.Statistics(singles, pairs))


TITLE = LINES[2]
CODECS = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "mac_roman"), ("utf-8", "cp1251"), ("utf-8", "koi8_r"), ("utf-8", "cp932"), ("utf-8", "gbk"), ("utf-8", "euc_jp"), ("cp932", "cp1252"), ("cp932", "latin-1"), ("cp932", "utf-8"), ("cp932", "cp1251"), ("euc_jp", "latin-1"), ("euc_jp", "cp932"), ("euc_jp", "utf-8"), ("euc_jp", "gbk")]


def garble(text, right, wrong):
    raw = text.encode(right)
    if wrong in ("cp1252", "cp1251"):
        return "".join(bytes([b]).decode(wrong, "replace").replace("�", chr(b)) for b in raw)
    return raw.decode(wrong, "replace")


@pytest.mark.parametrize(("right", "wrong"), CODECS)
@pytest.mark.parametrize("part", [False, True])
def test_found(restorer, right, wrong, part):
    cut = (6, 30) if part else (0, len(TITLE))
    bad = TITLE[: cut[0]] + garble(TITLE[cut[0] : cut[1]], right, wrong) + TITLE[cut[1] :]
    assert restorer.restore(bad)[0]


@pytest.mark.parametrize(("right", "wrong"), [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "mac_roman"), ("cp932", "latin-1"), ("euc_jp", "latin-1")])
def test_restored(restorer, right, wrong):
    assert restorer.restore(garble(TITLE, right, wrong)) == (True, TITLE, True)


def test_twice_and_shifted(restorer):
    once = garble(TITLE, "utf-8", "cp1252")
    assert restorer.restore(garble(once, "utf-8", "cp1252"))[:2] == (True, TITLE)
    shifted = TITLE.replace("　", "").encode("iso2022_jp").decode("ascii").replace("\x1b", "")
    assert restorer.restore(shifted) == (True, TITLE, True)
    assert restorer.restore("A $B and (B)") == (False, "A $B and (B)", True)


CLEAN = [*LINES, "", " ", "São Miro Ltda. e Irmãos, Ångmark Värme AB", "Société Générix-Lumière à Évrel", "Đồng Phú Trạch, Müßner & Söhne", "Çınar Ölçüm, Ærø Færgeri, Łódkowo Żwir", "25 °C ± 2, £40, §5, ½", "À définir – Â préciser", "縺れた配線を整理する。", "(cid:123)(cid:45)(cid:6)", "ﾃﾞｰﾀｾﾝﾀｰの保守点検業務委託", "エレベ​ータ⁠ー", "業󠄀務委託", "髙﨑𠮷", "㈱研究所", "a" * 3000]


@pytest.mark.parametrize("text", CLEAN)
def test_clean(restorer, text):
    assert restorer.restore(text) == (False, text, True)


def test_segments_are_maximal():
    def brute(x):
        # maximal segments by their recursive definition: the best one, then left and right of it
        if not len(x) or max(x) <= 0:
            return []
        best = max(((sum(x[i:j]), -(j - i), -i, i, j) for i in range(len(x)) for j in range(i + 1, len(x) + 1)), key=lambda t: (round(t[0], 9), t[1], t[2]))
        i, j = best[3], best[4]
        return [*brute(x[:i]), (i, j), *[(a + j, b + j) for a, b in brute(x[j:])]]

    rng = random.Random(4)
    for _ in range(200):
        x = [rng.choice([-3, -2, -1, 1, 2, 3]) + rng.random() / 7 for _ in range(rng.randrange(0, 12))]
        assert [(a, b) for a, b, _ in M.maximal_segments(np.array(x, float))] == brute(x)


def test_a_garbled_line_does_not_vouch_for_itself():
    singles, pairs = {}, np.zeros(M.BUCKETS, np.int64)
    M.count_pairs([garble(TITLE, "utf-8", "cp1252"), None, "", "良い\n$B0lHL(B\n文"], singles, pairs)
    assert {chr(c) for c in singles} == set("良い文") and pairs.sum() == 1


def test_spark(spark):
    bad = garble(TITLE, "utf-8", "cp1252")
    corpus = spark.createDataFrame([(LINES[i % 6],) for i in range(2000)] + [(None,), ("",)], "text string")
    df = spark.createDataFrame([("t", "1", bad, 0), ("t", "2", TITLE, 0), ("t", "3", None, 0), ("t", "3", "", 0), ("t", "1", bad, 0)], "table_name string, record_key string, text string, garbled int")
    got = sorted((r["record_key"], r["garbled"], r["restored"] or "") for r in M.examine(df, M.gather(corpus)).collect())
    assert got == [("1", True, TITLE), ("1", True, TITLE), ("2", False, TITLE), ("3", False, ""), ("3", False, "")]
    assert M.examine(df.limit(0), M.gather(corpus.limit(0))).count() == 0
    assert M.examine(df, M.gather(corpus.limit(0))).count() == 5  # no corpus: nothing is known, nothing crashes


LATIN = ["don’t", "Müller", "naïve façade in Zürich", "5€", "Café", "“quoted” – and so on…", "Señor Núñez", "20 °C ± 1"]


@pytest.mark.parametrize("text", LATIN)
@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "mac_roman", "cp850"])
def test_latin_script(restorer, text, wrong):
    assert restorer.restore(garble(text, "utf-8", wrong)) == (True, text, True)
    assert restorer.restore("工事 " + garble(text, "utf-8", wrong) + " の件")[:2] == (True, "工事 " + text + " の件")
    assert restorer.restore(text) == (False, text, True)


@pytest.mark.parametrize("text", ["«CAFÉ»", "ÉTÉ – À L’ÉCOLE", "Â, Ã et Ä", "«DÉJÀ»", "naïveté"])
def test_latin_left_alone(restorer, text):
    assert restorer.restore(text) == (False, text, True)


def test_counts_beyond_32_bits():
    a, b, c = (ord(x) for x in "入札日")
    pairs = np.zeros(M.BUCKETS, np.int64)
    at = lambda x, y: M._INDEX[x] * M.LETTERS + M._INDEX[y]
    pairs[at(a, b)], pairs[at(b, c)] = 2**40, 3
    s = M.Statistics({a: 2**41, b: 2**41, c: 2**30}, pairs)
    got = s.information(np.array([a, b, c, a, 0x2603], np.uint32))
    total = 2**42 + 2**30
    want = [np.log2(2**40 * total / 2**82), np.log2(3 * total / 2**71), -np.log2(2**71 / total + 1)]
    assert np.allclose(got[:3], want, rtol=2e-3, atol=2e-3) and np.isnan(got[3])


def test_a_pair_is_unseen_however_large_the_corpus():
    rng = np.random.default_rng(1)
    pairs = np.zeros(M.BUCKETS, np.int64)
    pairs[rng.choice(M.BUCKETS, 2_000_000, replace=False)] = 1000  # more pairs than a million buckets could tell apart
    s = M.Statistics({int(c): 10**9 for c in M.ALPHABET}, pairs)
    assert np.isfinite(s.mutual[:-1, :-1]).all() and (s.mutual[:-1, :-1].ravel() == s.mutual[:-1, :-1].min()).sum() == M.BUCKETS - 2_000_000

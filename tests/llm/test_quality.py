import os

import duckdb
import pytest

from noticeflow.llm import quality as Q

PROSE = "支払いは検査に合格した後、適正な請求書を受理した日から31日以内に行う。ただし、疑義が生じた場合は、この限りでない。"
ENGLISH = "The contractor shall submit a work plan by 11 December 2026 and keep a copy for 4 years. Past experience with the repair of fire alarms counts for 26 of 100 points."
LIST = "提出書類は次のとおりとする。\n・内訳明細書\n・プリンター 280台\n・霧楓鷺福祉センターネットワーク機器調査業務委託\n・質問書\n・霜鶴雪庁舎駐車場ゲート設置工事\n・試験成績書"
TABLE = "| 番号 | 件名 | 数量 |\n| 1 | 業務計画書 | 486 |\n| 2 | 歩道橋修繕 | 578 |\n| 3 | 誓約書 | 99 |"
COMMON = {"ja": frozenset("の に は を が".split()), "en": frozenset("the of and to".split())}
FOUND = [LIST, TABLE, TABLE.replace("|", "\t"), "<table><tr><td>1</td><td>見積書</td></tr></table>", "■" * 40, "(cid:12)(cid:345)" * 20, "204207 575137 3228982 " * 20, "PDFを開く" * 30, "詳細はこちら\n" * 20, "read more >> " * 20, ".nav50{margin:33px;color:#0d3a7c}var a62=1;\n" * 9, "2026-02-12T19:44 WARN worker-23 retry=2 code=0x647c\n" * 9, "務と上ビ。格とやになも件き以へ託にい希るとで績。日書者4を加委合に履6和、望2午問行ルす向分後た書は1同はも6合者", "診療所 カラー複写機 データセンター 屋上防水 サーバー 市民会館 参加申請書 設計業務委託", "ot 2 o .ayier ee bk6e rifrhhe tesh t en iti efe t rrll dsv aoiebs rehellb", "vRAc0BsctDKkDzgHkxPdNi69tEqE5OxxDLPGFVMocQcvvUFX8j2lLy0o5ZpKD95A", "a signed pledge\n55 fire alarms\na work plan\nleasing of document scanners\nan inspection record", "x"]
NATURAL = [PROSE, ENGLISH, "\n".join(PROSE[i : i + 17] for i in range(0, len(PROSE), 17)), "\n".join(ENGLISH[i : i + 40] for i in range(0, len(ENGLISH), 40)), "件名　道路清掃業務委託\n" + PROSE, "第1条　" + PROSE + "\n第2条　" + PROSE, "問1: " + PROSE + "\r\n答1: " + PROSE, PROSE * 4 + "\n・見積書\n・誓約書\n" + PROSE, PROSE * 5 + "\n" + TABLE, PROSE.replace("、", "，").replace("。", "．"), PROSE[:20] + "<|endoftext|>" + PROSE[20:], PROSE * 3000]


@pytest.mark.parametrize("text", FOUND)
def test_not_prose(text):
    assert Q.statistics(text, COMMON)[-1] in ("list", "table", "junk")


@pytest.mark.parametrize("text", NATURAL)
def test_prose(text):
    assert Q.statistics(text, COMMON)[-1] == "prose"


@pytest.mark.parametrize("text", [(PROSE + "\n") * 300, (PROSE + "\n\n") * 300, (PROSE[:30] + "\n" + PROSE[30:] + "\n\n") * 3, (ENGLISH + "\n") * 5, "ただし、期限を過ぎた場合は、この限りでない。" * 6])
def test_filler_of_sentences(text):
    assert Q.prose_share(text, len("".join(text.split()))) >= 0.5 and Q.statistics(text, COMMON)[-1] == "junk"


@pytest.mark.parametrize("text", [(PROSE + "\n") * 2, "ただし、期限を過ぎた場合は、この限りでない。" * 2, "\n".join([PROSE, ENGLISH, "以上", PROSE])])
def test_prose_said_twice(text):
    assert Q.statistics(text, COMMON)[-1] == "prose"


OTHER_TONGUES = [
    "Die Arbeiten sind bis zum 11. Dezember abzuschließen. Der Auftragnehmer muss die Unterlagen mit dem Angebot einreichen. Wenn die Frist nicht eingehalten wird, kann der Auftraggeber von dem Vertrag zurücktreten.",
    "Le titulaire doit remettre les documents avec son offre avant la date limite. Les travaux sont exécutés dans un délai de trois mois. Si le délai n'est pas respecté, le contrat est résilié par la ville.",
    "El contratista debe presentar los documentos con la oferta antes de la fecha límite. Los trabajos se realizan en un plazo de tres meses y no se pueden prorrogar.",
    "Il fornitore deve presentare i documenti con la propria offerta entro la data indicata. I lavori sono eseguiti in un periodo di tre mesi e non si possono prorogare.",
    "De aannemer moet de documenten met de offerte indienen voor de gestelde datum. Het werk wordt in een periode van drie maanden uitgevoerd en kan niet worden verlengd.",
]


@pytest.mark.parametrize("text", OTHER_TONGUES)
def test_prose_of_other_languages(text):
    assert Q.statistics(text, COMMON)[-1] == "prose"


@pytest.mark.parametrize("text", ["Müller GmbH\nSchröder & Söhne AG\nBäckerei König\nFrançois Générale S.A.", "Feuermelder, Drucker, Schränke, Stühle, Tische, Lampen, Türen.", "straße haus baum tisch stuhl lampe fenster dach wand boden keller garten zaun tor weg."])
def test_names_and_items_of_other_languages(text):
    assert Q.statistics(text, COMMON)[-1] in ("list", "junk")


@pytest.mark.parametrize("text", [None, "", " \n　\t", "​"])
def test_empty(text):
    assert Q.statistics(text, COMMON)[-1] == "empty"


def test_figures():
    got = dict(zip([f.split()[0] for f in Q.FIELDS.split(", ")], Q.statistics("The cat.\nThe cat.\n\nof 12!", COMMON), strict=True))
    assert (got["words"], got["lines"], got["mean_word_length"], got["lines_ended"], got["common_share"]) == (6, 3, pytest.approx(16 / 6), 1.0, 0.5)
    assert got["symbol_ratio"] == pytest.approx(3 / 19) and got["duplicate_lines"] == pytest.approx(8 / 22)
    assert Q.duplicate_share(["ab", "c", "ab"]) == 0.4 and Q.duplicate_share([]) == 0.0


@pytest.mark.parametrize("text", ["abcd" * 50, "x" * 9, "abcdefgh", "", "a", "あいうえ、" * 30 + "終わり"])
def test_dominant_run_by_counting(text):
    n, want = len(text), 0.0
    for k in (4, 8, 16):
        if n < 2 * k:
            continue
        runs = [text[i : i + k] for i in range(n - k + 1)]
        top = max(runs.count(r) for r in set(runs))
        if top > 1:
            want = max(want, max(text.count(r) for r in set(runs) if runs.count(r) == top) * k / n)
    assert Q.dominant_run(text) == pytest.approx(min(1.0, want), abs=4 / max(n, 1) + 1e-9)


def test_spark(spark):
    df = spark.createDataFrame([(1, PROSE, "x"), (2, LIST, "x"), (3, None, "x"), (2, LIST, "x"), (None, TABLE, "x")], "doc_id bigint, text string, label string")
    common = spark.createDataFrame([("ja", "の", 1), (None, "x", 1), ("en", None, 1)], "lang string, word string, word_rank int")
    got = sorted((r["id"] or 0, r["label"]) for r in Q.describe(df, "doc_id", "text", common).collect())
    assert got == [(0, "table"), (1, "prose"), (2, "list"), (2, "list"), (3, "empty")]
    assert Q.describe(df.limit(0), "doc_id", "text", common.limit(0)).count() == 0
    with pytest.raises(ValueError, match="10 000"):
        Q.describe(df, "doc_id", "text", spark.range(10_001).selectExpr("'ja' lang", "cast(id as string) word"))


def test_labelled_documents():
    d = "/root/testdata/sf0.01"
    if not os.path.isdir(d):
        pytest.skip("no test data")
    rows = duckdb.sql(f"select text, label from '{d}/documents.parquet' join '{d}/doc_label.parquet' using (doc_id)").fetchall()
    right = sum((Q.statistics(t, COMMON)[-1] == "prose") == (label == "prose") for t, label in rows)
    assert right >= 0.97 * len(rows)

"""Listings, attachments, fetching, registry."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from noticeflow.sources import attachments, html_listing, registry
from noticeflow.sources.html_listing import Layout
from noticeflow.sources.http import Client, ContactNotConfigured, FetchError, Response, ResponseTooLarge, RobotsDenied, UnsafeUrl, robots_policy, user_agent
from noticeflow.sources.registry import Source

PAGE = """<html><head><meta charset="{charset}"></head><body><div><ul class="menu"><li><a href="/m">menu</a></li></ul>
<ul class="x news_list"><li><span><a href="/b/1.html">【一般競争】 道路<br>清掃業務</a></span></li><li><a href="/b/2.html">【入札結果】橋梁</a></li><li><a href="">空</a></li><li><a href="/b/3.html"> </a></li></ul>
<ul class="news_list"><li><a href="../b/1.html">again</a></li><li><a href="/b/4.html">給食&amp;食器</a></li></ul></div></body></html>"""


def parse(spark, *contents):
    rows = [(f"p{i}", "https://city.example.jp/business/", None if c is None else bytearray(c)) for i, c in enumerate(contents)]
    return html_listing.parse_pages(spark.createDataFrame(rows, "page_id string, base_url string, content binary"))


@pytest.mark.parametrize("charset", ["utf-8", "shift_jis", "euc-jp"])
def test_listing(spark, charset):
    parsed = parse(spark, PAGE.format(charset=charset).encode({"shift_jis": "cp932"}.get(charset, charset))).cache()
    links = parsed.where("url is not null").orderBy("ordinal").collect()
    assert [(r["url"], r["title"]) for r in links] == [("https://city.example.jp/b/1.html", "【一般競争】 道路清掃業務"), ("https://city.example.jp/b/2.html", "【入札結果】橋梁"), ("https://city.example.jp/b/4.html", "給食&食器")]
    raw = html_listing.raw_tenders(parsed, "city", F.lit(dt.datetime(2026, 9, 7)).cast("timestamp_ntz")).orderBy("source_url").collect()
    assert [(r["method_text"], r["raw_payload"]["is_result_announcement"]) for r in raw] == [("一般競争", "false"), (None, "true"), (None, "false")]


def test_missing_container_is_not_empty(spark):
    good = PAGE.format(charset="utf-8")
    parsed = parse(spark, good.encode(), good.replace("news_list", "renewed").encode(), b'<ul class="news_list"></ul>', None, b"", "﻿<ul class=news_list><li><a href=a>道".encode())
    assert [(r["page_id"], r["rows"], r["status"]) for r in html_listing.listing_status(parsed).orderBy("page_id").collect()] == [("p0", 3, "ok"), ("p1", 0, "failed"), ("p2", 0, "ok_empty"), ("p3", 0, "failed"), ("p4", 0, "failed"), ("p5", 0, "ok_empty")]


def test_stored_pages(spark, tmp_path):
    (tmp_path / "a.html").write_bytes(PAGE.format(charset="utf-8").encode())
    (tmp_path / "big.html").write_bytes(b"x" * 5000)
    assert html_listing.read_pages(spark, str(tmp_path), "https://x.jp/", 4000).count() == 1


def office(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in members.items():
            z.writestr(name.replace("__", "/").replace("_xml", ".xml"), body)
    return out.getvalue()


W = "xmlns:w='urn:w'"
DOCX = office(word__document_xml=f"<w:document {W}><w:body><w:p><w:r><w:t>一行</w:t></w:r><w:r><w:t>目</w:t></w:r></w:p><w:p><w:r><w:t>二行目</w:t></w:r></w:p></w:body></w:document>")
XLSX = office(xl__sharedStrings_xml="<sst><si><t>件名</t></si><si><r><t>道</t></r><r><t>路</t></r></si></sst>", xl__worksheets__sheet1_xml="<worksheet><sheetData><row><c t='s'><v>0</v></c><c><v>12</v></c></row><row><c/></row><row><c t='s'><v>1</v></c><c t='inlineStr'><is><t>直</t></is></c></row></sheetData></worksheet>")


def test_attachments(spark):
    files = [("https://x.jp/a.txt", " 本文\n".encode()), ("https://x.jp/a.html", b"<p>x</p>"), ("https://x.jp/a.docx", DOCX), ("https://x.jp/a.xlsx", XLSX), ("https://x.jp/a.jtd", b"x"), ("https://x.jp/a.zip", b"PK"), ("https://x.jp/b.docx", b"broken"), ("https://x.jp/a.pdf", b"text"), ("https://x.jp/s.pdf", b"scan"), ("https://x.jp/c.pdf", b"cid"), ("https://x.jp/none", None), ("https://x.jp/bomb.docx", office(word__document_xml="<a><!-- --></a>" + " " * 10))]
    df = spark.createDataFrame([(u, None if c is None else bytearray(c)) for u, c in files], "file_url string, content binary")
    pdf = lambda b: {b"text": "x" * 60, b"scan": "", b"cid": "(cid:1)" * 30 + "ab"}[b]
    got = {r["file_url"].rpartition("/")[2]: (r["status"], r["text"], r["needs_human"]) for r in attachments.extract_files(df, pdf).collect()}
    assert got["a.txt"] == ("ok", "本文", False) and got["a.html"][1] == "<p>x</p>" and got["a.docx"][1] == "一行目\n二行目" and got["a.xlsx"][1] == "件名\t12\n道路\t直"
    assert got["a.jtd"] == got["a.zip"] == ("unsupported_format", None, True) and got["b.docx"][0] == "fetch_failed" and got["a.pdf"][0] == "ok"
    assert got["s.pdf"][0] == got["c.pdf"][0] == "unsupported_scanned" and got["none"][0] == "fetch_failed"
    assert attachments.extract(b"x", ".pdf", None)[0] == "skipped"


def test_archives_are_bounded(monkeypatch):
    monkeypatch.setattr(attachments, "UNPACKED", 1000)
    assert attachments.extract(office(word__document_xml="<a>" + " " * 5000 + "</a>"), ".docx", None)[0] == "fetch_failed"
    assert attachments.extract(office(word__document_xml="<!DOCTYPE a [<!ENTITY b 'c'>]><a/>"), ".docx", None)[0] == "fetch_failed"


class Net:
    def __init__(self, answers):
        self.answers, self.asked, self.slept, self.now = answers, [], [], 0.0

    def __call__(self, url, headers, timeout, limit):
        self.asked.append(url)
        got = self.answers.get(url, Response(404, {}, b"", url))
        got = got.pop(0) if isinstance(got, list) else got
        if isinstance(got, Exception):
            raise got
        return got

    def client(self, **more):
        def sleep(s):
            self.slept.append(s)
            self.now += s

        return Client("ua", self, clock=lambda: self.now, sleep=sleep, **more)


def ok(url, body=b"x", **headers):
    return Response(200, headers, body, url)


def test_fetching():
    u = "https://x.jp/a"
    net = Net({u: [Response(503, {}, b"", u), OSError("down"), ok(u)]})
    assert net.client().get(u).body == b"x" and net.asked.count(u) == 3 and net.slept
    with pytest.raises(FetchError, match="404"):
        Net({}).client().get(u)
    net = Net({u: [OSError("a")] * 3})
    with pytest.raises(FetchError, match="a"):
        net.client().get(u)
    with pytest.raises(UnsafeUrl):
        Net({}).client().get("http://127.0.0.1/")
    with pytest.raises(UnsafeUrl):
        Net({u: ok("http://10.0.0.1/")}).client().get(u)
    for r in (ok(u, b"x" * 11), ok(u, b"x", **{"content-length": "99"})):
        with pytest.raises(ResponseTooLarge):
            Net({u: r}).client(limit=10).get(u)
    robots = "https://x.jp/robots.txt"
    with pytest.raises(RobotsDenied):
        Net({robots: ok(robots, b"User-agent: *\nDisallow: /a"), u: ok(u)}).client().get(u)
    assert Net({robots: ok(robots, b"<html>"), u: ok(u)}).client().get(u).status == 200
    assert [robots_policy(x)[0] for x in (None, Response(404, {}, b"", ""), ok("", b"x", **{"content-type": "text/HTML"}), ok("", b"User-agent: *"))] == ["error", "missing", "not_robots", "parsed"]
    assert "me@x" in user_agent("p", "me@x")
    with pytest.raises(ContactNotConfigured):
        user_agent("p", " ")


def test_registry(spark):
    listed = [Source(i, kind, "o", "n", f"https://x.jp/{i}", Layout(css_class="rows")) for i, kind in (("b", "http"), ("a", "browser"))]
    table = registry.source_table(spark, listed)
    assert [(r["id"], r["layout"]["css_class"]) for r in table.collect()] == [("a", "rows"), ("b", "rows")]
    assert [r["id"] for r in table.where("kind = 'http'").collect()] == ["b"]
    assert [(r["id"], r["crawler_id"], r["entry_url"]) for r in registry.organizations(table).collect()] == [("o", "a", "https://x.jp/a")]
    with pytest.raises(ValueError, match="already"):
        registry.source_table(spark, [*listed, Source("a", "http", "o", "n", "u")])
    with pytest.raises(ValueError, match="kind ftp"):
        registry.source_table(spark, [Source("z", "ftp", "o", "n", "u")])
    assert registry.source_table(spark, []).count() == 0

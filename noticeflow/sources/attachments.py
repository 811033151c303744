"""Text of attached files.

Formats are settled by name first, so unsupported files are never read. PDF
needs a reader that may be absent; without it files come as ``skipped``, which
is not a failure. Office files are read from their XML with a limit on what an
archive may unpack to.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeflow.functions import urls
from noticeflow.functions.text import CID

LEAST_CHARS, MOST_CID = 50, 0.2
#: Bytes that a file of an archive may unpack to.
UNPACKED = 200 * 1024 * 1024

_CID = re.compile(CID)
_SCHEMA = "file_url string, status string, text string, chars int, file_ext string, note string"
PdfReader = Callable[[bytes], str]


def default_pdf_reader() -> PdfReader | None:
    try:
        from pypdf import PdfReader as Reader
    except ImportError:
        return None
    return lambda content: "\n".join(p.extract_text() or "" for p in Reader(io.BytesIO(content)).pages)


def _member(archive: zipfile.ZipFile, name: str) -> ElementTree.Element:
    with archive.open(name) as f:
        body = f.read(UNPACKED + 1)
    if len(body) > UNPACKED:
        raise ValueError(f"{name} unpacks to more than {UNPACKED} bytes")
    if b"<!DOCTYPE" in body[:2048] or b"<!ENTITY" in body[:2048]:
        raise ValueError("document type in an office file")
    return ElementTree.fromstring(body)


def _local(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2]


def docx_text(content: bytes) -> str:
    """Paragraphs, one a line."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = _member(z, "word/document.xml")
    return "\n".join("".join(t.text or "" for t in p.iter() if _local(t) == "t") for p in root.iter() if _local(p) == "p")


def xlsx_text(content: bytes) -> str:
    """Rows of all sheets, cells set apart by tabs; rows without content are dropped."""
    lines = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter() if _local(t) == "t") for si in _member(z, "xl/sharedStrings.xml") if _local(si) == "si"]
        sheets = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
        for sheet in sheets:
            for row in (r for r in _member(z, sheet).iter() if _local(r) == "row"):
                cells = []
                for c in (c for c in row if _local(c) == "c"):
                    value = next((v.text or "" for v in c if _local(v) == "v"), None)
                    if c.get("t") == "s" and value is not None:
                        value = shared[int(value)]
                    elif c.get("t") == "inlineStr":
                        value = "".join(t.text or "" for t in c.iter() if _local(t) == "t")
                    cells.append(value or "")
                if any(cells):
                    lines.append("\t".join(cells))
    return "\n".join(lines)


def cid_share(text: str) -> float:
    n = len(_CID.findall(text))
    return n / (n + len(_CID.sub("", text))) if n else 0.0


def extract(content: bytes | None, ext: str, pdf: PdfReader | None) -> tuple[str, str | None, int, str]:
    """(status, text, chars, note) of one file."""
    try:
        if content is None:
            return "fetch_failed", None, 0, "no content"
        if ext == ".pdf":
            if pdf is None:
                return "skipped", None, 0, "no PDF reader"
            text = pdf(content).strip()
            if len(text) < LEAST_CHARS:
                return "unsupported_scanned", None, len(text), "hardly any text"
            if cid_share(text) > MOST_CID:
                return "unsupported_scanned", None, len(text), "glyph numbers instead of text"
        elif ext in (".txt", ".csv", ".html", ".htm"):
            text = content.decode("utf-8", "replace").strip()
        elif ext == ".docx":
            text = docx_text(content).strip()
        elif ext == ".xlsx":
            text = xlsx_text(content).strip()
        else:
            return "unsupported_format", None, 0, ext
    except Exception as e:  # noqa: BLE001  a broken file is a result, not a failed job
        return "fetch_failed", None, 0, type(e).__name__
    return "ok", text, len(text), ""


def extract_files(files: DataFrame, pdf: PdfReader | None = None) -> DataFrame:
    """files (file_url, content) -> (file_url, status, text, chars, file_ext, note, needs_human).

    Files ruled out by name are split off in the plan; their content is neither
    read (a binaryFile scan prunes it) nor sent to Python.
    """
    named = files.withColumn("file_ext", urls.extension(F.col("file_url"))).withColumn("early", urls.classify_before_fetch(F.col("file_ext")))
    refused = named.where("early is not null").select("file_url", F.col("early").alias("status"), F.lit(None).cast("string").alias("text"), F.lit(0).alias("chars"), "file_ext", F.col("file_ext").alias("note"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = pdf or default_pdf_reader()
        for pdf_ in batches:
            got = [extract(None if c is None else bytes(c), e or "", reader) for c, e in zip(pdf_["content"], pdf_["file_ext"], strict=True)]
            yield pd.DataFrame({"file_url": pdf_["file_url"], "status": [g[0] for g in got], "text": [g[1] for g in got], "chars": [g[2] for g in got], "file_ext": pdf_["file_ext"], "note": [g[3] for g in got]}).astype({"chars": "int32"})

    read = named.where("early is null").select("file_url", "file_ext", "content").mapInPandas(run, _SCHEMA)
    return read.unionByName(refused).withColumn("needs_human", urls.needs_human(F.col("status")))

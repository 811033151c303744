"""Addresses: what may be fetched, what a file is."""

from __future__ import annotations

import ipaddress
from urllib.parse import unquote, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
SUPPORTED = (".pdf", ".docx", ".xlsx", ".html", ".htm", ".txt", ".csv")
UNSUPPORTED = (".jtd", ".jtdc", ".jsw", ".jtt", ".xls", ".doc", ".zip", ".lzh", ".7z", ".jpg", ".jpeg", ".png", ".tif", ".tiff")
LARGEST_BYTES = 25 * 1024 * 1024
NEEDS_HUMAN = ("unsupported_scanned", "unsupported_format", "fetch_failed")
LOCAL_NAMES = ("localhost", ".localhost", ".internal", ".local")


def safe(url: str | None) -> bool:
    """http(s) to a public host; user parts and bracketed addresses are read as a browser would."""
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").rstrip(".").lower()
        parts.port  # noqa: B018  raises on nonsense
    except ValueError:
        return False
    if parts.scheme not in ("http", "https") or not host:
        return False
    if any(host == n.lstrip(".") or host.endswith(n if n[0] == "." else "." + n) for n in LOCAL_NAMES):
        return False
    try:
        ip = ipaddress.ip_address(host.partition("%")[0])
    except ValueError:
        return True
    mapped = getattr(ip, "ipv4_mapped", None)
    return all(x.is_global and not x.is_multicast for x in (ip, *([mapped] if mapped else [])))


@F.pandas_udf(T.BooleanType())
def is_safe_url(url: pd.Series) -> pd.Series:
    return url.map(safe)


@F.pandas_udf(T.StringType())
def extension(url: pd.Series) -> pd.Series:
    """.ext in lower case of a URL's path, empty without one; + stays +."""

    def one(u: str) -> str:
        try:
            name = unquote(urlsplit(u).path)
        except ValueError:
            return ""
        _, dot, ext = name.rpartition(".")
        return "" if not dot or "/" in ext else "." + ext.lower()

    return url.map(one, na_action="ignore")


def classify_before_fetch(ext: Column) -> Column:
    """unsupported_format, or null where the content has to decide."""
    return F.when((ext == "") | ext.isNull() | ext.isin(*SUPPORTED), None).otherwise(F.lit("unsupported_format"))


def too_large(declared: Column, actual: Column, limit: int = LARGEST_BYTES) -> Column:
    """By the declared length where it is a number, or by the bytes read."""
    told = F.when(declared.rlike(r"^\d{1,18}$"), declared.cast("bigint") > limit).when(declared.rlike(r"^\d+$"), F.lit(True))
    return F.coalesce(told, F.lit(False)) | F.coalesce(actual > limit, F.lit(False))


def needs_human(status: Column) -> Column:
    return F.coalesce(status.isin(*NEEDS_HUMAN), F.lit(False))


def robots_source(status: Column, content_type: Column, body: Column) -> Column:
    """parsed, missing, not_robots or error of a robots.txt answer; only a parsed one restricts."""
    head = F.lower(F.ltrim(F.substring(F.coalesce(body, F.lit("")), 1, 512)))
    html = F.coalesce(F.lower(content_type), F.lit("")).contains("html") | head.startswith("<!doctype html") | head.startswith("<html")
    return F.when(status.isNull(), "error").when(status != 200, "missing").when(html, "not_robots").otherwise("parsed")

"""Text scalars: normalization, titles, tags, keyword hits."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
BRACKETS = "【】（）()「」『』［］[]〔〕｛｝{}〈〉《》"
PREFIXES = ("条件付一般競争入札公告", "一般競争入札公告", "指名競争入札公告", "条件付一般競争入札", "公募型プロポーザル", "一般競争入札", "指名競争入札", "企画競争公告", "入札公告", "入札情報", "公告")
SUFFIXES = ("の実施について", "の入札について", "の公告について", "に係る公告", "について", "の件")
FISCAL_YEAR = r"(?:令和|平成|昭和|大正|[RHST])(?:元|\d{1,2})年度|\d{4}年度"
REPEATED = r"([・\-−ー~〜_])\1+"
EDGE = r"[・\-−ー~〜_,、。:：;；]+"
METHODS = (("公募型プロポーザル", "proposal"), ("プロポーザル", "proposal"), ("企画競争", "proposal"), ("指名競争", "selective"), ("随意契約", "negotiated"), ("随契", "negotiated"), ("一般競争", "open"), ("条件付一般競争", "open"))
RESULT_TAGS = ("契約結果公表", "入札結果", "結果公表", "中止")
MOJIBAKE = "[ÃÂãåäæÐ][\u0080-¿†-™]"
CID = r"\(cid:\d+\)"

#: Blanks as Python and the sources know them; Java's \s is ASCII without (?U).
BLANKS = r"(?U)[\s\x1c-\x1f]+"


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility composition; the one normalization that the JVM side has no function for."""
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def strip_blanks(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, rf"^{BLANKS}", ""), rf"{BLANKS}\z", "")


def normalize_text(c: Column) -> Column:
    """NFKC, runs of blanks to one space, ends stripped."""
    return F.trim(F.regexp_replace(nfkc(c), BLANKS, " "))


def match_form(c: Column) -> Column:
    """NFKC in lower case, for keyword tests."""
    return F.lower(nfkc(c))


def _strip_affixes(c: Column, phrases: Sequence[str], head: bool) -> Column:
    either = "|".join(phrases)  # longest first
    pattern = rf"(?s)^(?:{either})+(?=.)" if head else rf"(?s)(?<=.)(?:{either})+\z"
    return F.regexp_replace(c, pattern, "")


def title_from_nfkc(n: Column) -> Column:
    """Title without brackets, blanks, fiscal year and boilerplate, of an NFKC text; never empty unless the text is."""
    base = F.regexp_replace(F.translate(n, BRACKETS, ""), BLANKS, "")
    s = F.regexp_replace(base, rf"(?U){FISCAL_YEAR}", "")
    s = _strip_affixes(_strip_affixes(s, PREFIXES, True), SUFFIXES, False)
    s = F.regexp_replace(s, REPEATED, "$1")
    s = F.regexp_replace(F.regexp_replace(s, f"^{EDGE}", ""), rf"{EDGE}\z", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.nullif(base, F.lit("")), strip_blanks(n))


def normalize_title(c: Column) -> Column:
    return title_from_nfkc(nfkc(c))


def classify_method(c: Column) -> Column:
    """First matching method of the ordered list; null, empty and unmatched are unknown."""
    n = F.coalesce(normalize_text(c), F.lit(""))
    case = F.when(n == "", "unknown")
    for needle, method in METHODS:
        case = case.when(F.contains(n, F.lit(needle)), method)
    return case.otherwise("unknown")


def leading_tag(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "^【([^】]+)】", 1), F.lit(""))


def is_result_announcement(c: Column) -> Column:
    return F.coalesce(leading_tag(c).rlike("|".join(RESULT_TAGS)), F.lit(False))


def method_text(c: Column) -> Column:
    """The leading tag unless it marks a result."""
    return F.when(~is_result_announcement(c), leading_tag(c))


def mojibake_hits(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(MOJIBAKE)), F.lit(0))


def looks_mojibake(c: Column, threshold: int = 2) -> Column:
    return mojibake_hits(c) >= threshold


def cid_ratio(c: Column) -> Column:
    """Share of undecoded glyph tokens among tokens and other characters; 0 without any."""
    n = F.regexp_count(c, F.lit(CID))
    rest = F.length(F.regexp_replace(c, CID, ""))
    return F.coalesce(F.when(n > 0, n / (n + rest)), F.lit(0.0))


def keyword_hits(title: Column, keywords: Column) -> Column:
    """The keywords (already in match form) that the title (in match form) contains, in their order."""
    return F.filter(keywords, lambda k: F.contains(title, k))


@F.pandas_udf(T.StringType())
def url_join(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([None if b is None or h is None else urljoin(b, h) for b, h in zip(base, href, strict=True)])

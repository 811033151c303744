"""Content-derived keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeflow.functions.text import BLANKS, nfkc

KEY_VERSION = "1"
SPEC_CHARS = 12_000
_NUL = "\u0000"


def anchor_kind(announced: Column, deadline: Column) -> Column:
    return F.when(announced.isNotNull(), "announced").when(deadline.isNotNull(), "bid_deadline").otherwise("none")


def anchor_date(announced: Column, deadline: Column) -> Column:
    return F.coalesce(announced, deadline)


def is_weak(announced: Column, deadline: Column) -> Column:
    """A key without a date may join different notices."""
    return anchor_kind(announced, deadline) == "none"


def natural_key(organization: Column, title: Column, announced: Column, deadline: Column) -> Column:
    """sha256 over version, organization, normalized title and anchor date; null for an empty title."""
    day = F.coalesce(F.date_format(anchor_date(announced, deadline), "yyyy-MM-dd"), F.lit(""))
    parts = F.concat_ws(_NUL, F.lit(KEY_VERSION), organization, title, day)
    return F.when(F.coalesce(title, F.lit("")) != "", F.sha2(parts, 256))


def _flat(c: Column) -> Column:
    return F.trim(F.regexp_replace(nfkc(F.coalesce(c, F.lit(""))), BLANKS, " "))


def cache_key(title: Column, spec: Column, profile: Column) -> Column:
    """sha256 over title, the spec's first characters and profile text, blanks and width aside."""
    return F.sha2(F.concat_ws(_NUL, _flat(title), _flat(F.substring(spec, 1, SPEC_CHARS)), _flat(profile)), 256)

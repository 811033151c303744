"""Price texts: amount, undisclosed, tax basis."""

from __future__ import annotations

import re
import unicodedata
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
UNDISCLOSED = ("非公表", "非公開", "公表しない", "公表せず", "未定", "不明", "事後公表", "予定価格を公表しない", "入札後に公表", "開札後に公表", "落札後に公表")
EMPTY = ("", "-", "−", "―", "ー", "‐", "－", "─", "/", "−−", "--", "なし", "該当なし")
TAX_EXCLUDED = "税抜|税別|消費税.{0,4}(?:抜|除|含まない|含まず)"
TAX_INCLUDED = "税込|消費税.{0,4}含"
LONGEST = 200
DIGITS = 16
# What may stand behind a number, largest first; the currency itself comes last.
UNITS = {"億": 10**8, "百万": 10**6, "万": 10**4, "千": 10**3, "円": 1}

_NUMBER = re.compile(rf"(\d+)\s*({'|'.join(UNITS)})?")
_SAYS = {"included": re.compile(TAX_INCLUDED), "excluded": re.compile(TAX_EXCLUDED)}


def amount_in(text: str) -> int | None:
    """Yen that an NFKC text states.

    The text is read once into numbers with their units. Each unit in turn,
    largest first, takes its first number behind the one taken before; a number
    without any unit counts only where none was taken. Runs of more digits than
    ``DIGITS`` are no numbers, so nothing is cut silently.
    """
    numbers = [(int(n), unit) for n, unit in _NUMBER.findall(text.replace(",", "")) if len(n) <= DIGITS]
    total, behind = 0, 0
    for unit, factor in UNITS.items():
        at = next((i for i in range(behind, len(numbers)) if numbers[i][1] == unit), None)
        if at is not None:
            total, behind = total + numbers[at][0] * factor, at + 1
    if behind:
        return total
    return numbers[0][0] if numbers else None


def basis_in(text: str) -> str:
    """Both or neither way of saying it is unknown."""
    said = [basis for basis, pattern in _SAYS.items() if pattern.search(text)]
    return said[0] if len(said) == 1 else "unknown"


def price_in(raw: str | None) -> tuple[Decimal | None, bool, str, str]:
    """(amount, undisclosed, tax_basis, raw) of a price text; the basis is read whether or not there is an amount."""
    shown = (raw or "").strip()
    text = unicodedata.normalize("NFKC", shown) if len(shown) <= LONGEST else ""
    hidden = any(x in text for x in UNDISCLOSED)
    amount = None if hidden or text in EMPTY else amount_in(text)
    return None if amount is None else Decimal(amount), hidden, basis_in(text), shown[:LONGEST]


PRICE = T.StructType([T.StructField("amount", T.DecimalType(38, 0)), T.StructField("undisclosed", T.BooleanType()), T.StructField("tax_basis", T.StringType()), T.StructField("raw", T.StringType())])


@F.pandas_udf(PRICE)
def parse_price(raw: pd.Series) -> pd.DataFrame:
    """struct(amount, undisclosed, tax_basis, raw); undisclosed and unreadable prices have no amount.

    One crossing into Python for the whole reading: as JVM expressions the
    units' steps nest, and predicates pushed through them would multiply them.
    """
    return pd.DataFrame([price_in(x) for x in raw], columns=PRICE.names)


def as_bigint(amount: Column) -> Column:
    """The amount where it fits the table's column, else null."""
    return F.when(F.abs(amount) <= F.lit(2**63 - 1).cast("decimal(38,0)"), amount.cast("bigint"))


def in_range(amount: Column, low: Column, high: Column) -> Column:
    """Bounds are inclusive; a missing amount or bound never excludes."""
    return amount.isNull() | (F.coalesce(amount >= low, F.lit(True)) & F.coalesce(amount <= high, F.lit(True)))


def display_price(amount: Column, undisclosed: Column) -> Column:
    return F.when(undisclosed, "非公表").when(amount.isNull(), "記載なし").otherwise(F.concat(F.format_number(amount, 0), F.lit("円")))

"""Amounts stated in differing units and notations, brought to yen.

A stated amount is number x unit. The unit is explicit in the text (a counter
such as thousand or hundred million, a currency sign), or else the one that the
source declares for its whole listing, or else the base unit. The stored amount
and the stated one are bound by identities:

    stored = number x unit,     total = net + tax share,     tax share = rate x total / (1 + rate)

``fit_units`` evaluates every combination of candidate unit and tax step against
the identities and takes the one with the smallest log residual; two that fit
equally well (within ``TIE``) make the solution non-unique and are flagged. ``source_units``
sums the residuals over all unit-less rows of a source, which tells a source
whose declared unit is missing or wrong. ``read_price`` settles what the text
itself states: its unit is a combination like the others. A stored amount is right
where that combination, without a tax step, is the one that fits, and leaves nothing.

Defined cases: null, empty and dash texts, undisclosed prices and ranges state
no amount; several different amounts in one text state none; amounts in another
currency are no amounts; a null or unreadable source note declares nothing;
numbers of 10^22 or more, beyond any column, state nothing.
A number of more than six decimals takes
its stated unit in, then is rounded. Whole texts are read, however long: stretches of blanks count as one, and no
pattern starts again inside a number.
"""

from __future__ import annotations

import re
import unicodedata
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Counters and numerals of Japanese amounts, the plain and the legal forms.
DIGITS = {"〇": 0, "零": 0, "一": 1, "壱": 1, "壹": 1, "二": 2, "弐": 2, "貳": 2, "三": 3, "参": 3, "參": 3, "四": 4, "肆": 4, "五": 5, "伍": 5, "六": 6, "陸": 6, "七": 7, "漆": 7, "質": 7, "八": 8, "捌": 8, "九": 9, "玖": 9}
TENS = {"十": 10, "拾": 10, "百": 100, "佰": 100, "陌": 100, "千": 1000, "仟": 1000, "阡": 1000}
MYRIADS = {"万": 10**4, "萬": 10**4, "億": 10**8, "兆": 10**12}
UNDISCLOSED = ("非公表", "非公開", "公表しない", "公表せず", "公開しない", "未定", "後に公表", "事後公表", "後公表", "undisclosed", "not disclosed", "to be announced", "tba")
INCLUDED = ("税込", "内税", "税を含", "税額を含", "税等を含", "税含", "込み", "tax included", "incl. tax", "including tax", "tax incl", "included", "inclusive")
EXCLUDED = ("税抜", "外税", "税別", "税を除", "税額を除", "税等を除", "税は含まない", "税を含まない", "税含まず", "税を含まず", "抜き", "別途", "excl", "without tax", "before tax", "plus tax")

# Other currencies, as they stand before and behind amounts.
FOREIGN_BEFORE = "us$ a$ c$ nz$ hk$ s$ nt$ $ € £ ₩ usd eur gbp cny rmb krw chf aud cad nzd hkd twd sgd"
FOREIGN_BEHIND = "ドル 米ドル 豪ドル ユーロ ポンド ウォン 人民元 スイスフラン dollars dollar euros euro pounds usd eur gbp cny rmb krw chf aud cad nzd hkd twd sgd $ € £ ₩"

_NUM = r"\d+(?:,\d{3})*(?:\.\d+)?"
_KANJI = "".join([*DIGITS, *TENS, *MYRIADS])
#: A tax share stated beside the total: the total includes it.
_SHARE = re.compile(rf"[(\[（]?\s*(?:うち|内|内訳)\s*(?:、)?\s*(?:取引に係る)?(?:消費税|税)(?:及び地方消費税)?(?:相当)?(?:等)?(?:額)?(?:の額)?\s*[:は]?\s*(?:金)?[¥\\]?\s*{_NUM}\s*円?\s*[)\]）]?")
_SHARE_EN = re.compile(rf"[(\[]?\s*(?:of which|incl(?:uding|\.)?)\s+(?:consumption\s+)?tax\s*(?:of)?\s*[:]?\s*(?:jpy|yen|¥)?\s*{_NUM}\s*(?:yen)?\s*[)\]]?")
_RANGE = re.compile(r"[~〜～]|以上|未満|以下|以内|範囲|\bto\b|\bbetween\b|\bor (?:more|less)\b|\d\s*円?\s*[-–—]\s*[¥\\]?\d")
#: (unit phrase standing apart from the number, factor)
_APART = (
    (re.compile(r"[(\[]?\s*(?:単位\s*[:=は/]?\s*)?(?:百万円)\s*(?:単位)?\s*[)\]]?"), 10**6),
    (re.compile(r"[(\[]?\s*(?:単位\s*[:=は/]?\s*)?(?:[千仟]円)\s*(?:単位)?\s*[)\]]?"), 10**3),
    (re.compile(r"[(\[]?\s*(?:単位\s*[:=は/]?\s*)?(?:[万萬]円)\s*(?:単位)?\s*[)\]]?"), 10**4),
    (re.compile(r"[(\[]?\s*(?:単位\s*[:=は/]?\s*)?(?:億円)\s*(?:単位)?\s*[)\]]?"), 10**8),
)
_COUNTERS = r"(?:百万|十億|[千仟百]?[億万萬兆]|千|仟|百|十)"
_MIXED = re.compile(rf"({_NUM})\s*({_COUNTERS})?")
_WESTERN = re.compile(rf"(?<!\d)({_NUM})\s*(thousand|million|billion|mn|bn|k|m|b)\b")
_WESTERN_FACTOR = {"thousand": 10**3, "k": 10**3, "million": 10**6, "mn": 10**6, "m": 10**6, "billion": 10**9, "bn": 10**9, "b": 10**9}

def _either(signs: str) -> str:
    return "|".join(re.escape(x) for x in sorted(signs.split(), key=len, reverse=True))


#: An amount of another currency with its counters.
_FOREIGN = re.compile(
    rf"(?<![a-z])(?:{_either(FOREIGN_BEFORE)})\s*{_NUM}\s*(?:(?:{_COUNTERS})+|(?:thousand|million|billion|mn|bn|k|m|b)\b)?"
    rf"|(?<![\d.,]){_NUM}\s*(?:(?:{_COUNTERS})(?:{_NUM})?)*\s*(?:thousand|million|billion|mn|bn)?\s*(?:{_either(FOREIGN_BEHIND)})(?![a-z])"
)
_CURRENCY = re.compile(r"円|[¥\\]|\bjpy\b|\byen\b")


def _squeeze(s: str) -> str:
    """Stretches of blanks as one, a line end if they hold one."""
    return re.sub(r"\s{2,}", lambda m: "\n" if "\n" in m[0] else " ", s)


def _spans(s: str) -> bool:
    """Whether a line says from and, behind it, up to."""
    return any("まで" in line.partition("から")[2] for line in s.split("\n"))


def _kanji_number(s: str) -> int | None:
    """The value of a numeral written in words, e.g. two thousand and a hundred myriads; None if it is none."""
    total = section = 0
    digit: int | None = None
    for ch in s:
        if ch in DIGITS:
            digit = DIGITS[ch] if digit is None else digit * 10 + DIGITS[ch]
        elif ch in TENS:
            section += (1 if digit is None else digit) * TENS[ch]
            digit = None
        elif ch in MYRIADS:
            section += digit or 0
            total += (section or 1) * MYRIADS[ch]
            section, digit = 0, None
        else:
            return None
    return total + section + (digit or 0)


def _counter(s: str | None) -> int:
    factor = 1
    for ch in s or "":
        factor *= TENS.get(ch) or MYRIADS[ch]
    return factor


def basis_of(s: str) -> str:
    """included, excluded or unknown, of a folded text."""
    if _SHARE.search(s) or _SHARE_EN.search(s):
        return "included"
    without = any(x in s for x in EXCLUDED)
    if without:
        return "excluded"
    return "included" if any(x in s for x in INCLUDED) else "unknown"


def read_price(raw: str | None) -> tuple[Decimal | None, int | None, str, bool]:
    """(number, explicit unit or None, tax basis, undisclosed) that a text states.

    The number is None unless the text states one definite amount. Amounts of
    several counters (3 hundred millions and 10 ten-thousands) come as their sum
    with unit 1. The tax basis is read independently of the amount.
    """
    if raw is None:
        return None, None, "unknown", False
    s = _squeeze(unicodedata.normalize("NFKC", raw).strip().lower().replace("¥", "¥"))
    basis = basis_of(s)
    if any(x in s for x in UNDISCLOSED):
        return None, None, basis, True
    s = _SHARE_EN.sub(" ", _SHARE.sub(" ", s))
    s = re.sub(r"(?<=\d)[,、](?=\d{3}(?!\d))", ",", s)
    if _RANGE.search(s) or _spans(s):
        return None, None, basis, False
    s = _squeeze(re.sub(r"(?:税率|消費税率?)?\s*(?<!\d)\d+(?:\.\d+)?\s*%", " ", s))
    s, others = _FOREIGN.subn(" ", s)
    if others and not re.search(rf"\d|[{_KANJI}]+円", s):
        return None, None, basis, False
    money = bool(_CURRENCY.search(s))
    if m := _WESTERN.search(s):
        rest = s[: m.start()] + s[m.end() :]
        return (None if re.search(r"\d", rest) else Decimal(m[1].replace(",", ""))), _WESTERN_FACTOR[m[2]], basis, False
    if not re.search(r"\d", s):
        runs = [x for x in re.findall(rf"[{_KANJI}]+", s) if any(c in DIGITS or c in TENS for c in x)]
        flat = s.replace(" ", "")
        runs = [x for x in runs if rf"{x}円" in flat or "金" in s] or runs
        if len(runs) != 1 or _kanji_number(runs[0]) is None:
            return None, None, basis, False
        return Decimal(_kanji_number(runs[0])), (1 if money or any(c in MYRIADS or c in TENS for c in runs[0]) else None), basis, False
    apart = None
    for pattern, factor in _APART:
        # the phrase must not follow a number directly, else it is the number's own counter
        for m in pattern.finditer(s):
            if not re.search(rf"[\d{_KANJI}]\s*$", s[max(0, m.start() - 2) : m.start()]) or m[0].lstrip()[:1] in "([":
                apart, s = factor, s[: m.start()] + " " + s[m.end() :]
                break
        if apart:
            break
    total, counted, plain, last_end = Decimal(0), 0, [], None
    for m in _MIXED.finditer(s):
        value = Decimal(m[1].replace(",", ""))
        if m[2]:
            joined = last_end is None or not s[last_end : m.start()].strip()
            if not joined:
                return None, None, basis, False
            total, counted, last_end = total + value * _counter(m[2]), counted + 1, m.end()
        elif counted and last_end is not None and not s[last_end : m.start()].strip():
            total, last_end = total + value, m.end()
        else:
            plain.append(value)
    if counted:
        return (None if plain else total), 1, basis, False
    if len(set(plain)) != 1:
        return None, None, basis, False
    return plain[0], apart or (1 if money else None), basis, False


def declared_unit(note: str | None) -> int | None:
    """The unit in which a source says it prints its amounts."""
    if not note:
        return None
    s = unicodedata.normalize("NFKC", note).lower()
    for pattern, factor in ((r"百万円|million", 10**6), (r"[千仟]円|thousand", 10**3), (r"億円|billion", 10**8), (r"[万萬]円", 10**4)):
        if re.search(pattern, s):
            return factor
    return None


_STATED = T.StructType(
    [
        T.StructField("number", T.DecimalType(28, 6)),
        T.StructField("unit", T.LongType()),
        T.StructField("basis", T.StringType()),
        T.StructField("undisclosed", T.BooleanType()),
    ]
)


def _fitting(number: Decimal | None, unit: int | None, limit: Decimal) -> tuple[Decimal | None, int | None]:
    """number and unit within the column's six decimals: a finer number takes its unit in, then is rounded half up."""
    if number is None or number.as_tuple().exponent >= -6:
        return number, unit
    if unit:
        number, unit = number * unit, 1
    return (number.quantize(Decimal("0.000001"), ROUND_HALF_UP) if number < limit else None), unit


@F.pandas_udf(_STATED)
def stated(raw: pd.Series) -> pd.DataFrame:
    """read_price of a column; equal texts of a batch are read once."""
    codes, texts = pd.factorize(raw, use_na_sentinel=True)
    read = [read_price(x) for x in texts] + [read_price(None)]
    limit = Decimal(10) ** 22
    rows = [(*_fitting(n if n is None or n < limit else None, u, limit), b, h) for n, u, b, h in (read[c] for c in codes)]
    out = pd.DataFrame(rows, columns=["number", "unit", "basis", "undisclosed"])
    out["unit"] = out["unit"].astype("Int64")
    return out


@F.pandas_udf(T.LongType())
def note_unit(note: pd.Series) -> pd.Series:
    return pd.Series([declared_unit(x) for x in note], dtype="Int64")


#: Units that amounts may have been written or stored in.
CANDIDATES = (1, 10**3, 10**4, 10**6, 10**8)
#: Log residuals closer than this are equal: half a per cent, well below any unit step.
TIE = 0.005
#: Rate of the consumption tax, and the steps by which a stored amount may differ for it.
TAX_RATE = 0.10
TAX_STEPS = (("none", 1.0), ("added", 1 + TAX_RATE), ("taken", 1 / (1 + TAX_RATE)))


def to_base_units(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows (key, source, raw, stored, stored_basis) with what their texts state in the base unit.

    Adds number, unit (explicit, else declared, else 1), unit_from (text, source,
    default), amount (yen, rounded half up), basis, undisclosed. ``sources`` is
    (source, note), one row per source; the join is left to the optimizer, so a
    large source table is shuffled rather than broadcast. Rows keep their number:
    sources are made unique first.
    """
    units = sources.where(F.col("source").isNotNull()).groupBy("source").agg(F.max(note_unit(F.col("note"))).alias("declared"))
    read = rows.withColumn("_s", stated("raw")).select("key", "source", "raw", "stored", "stored_basis", "_s.number", F.col("_s.unit").alias("explicit"), "_s.basis", "_s.undisclosed")
    joined = read.join(units, "source", "left")
    unit = F.coalesce("explicit", "declared", F.lit(1).cast("bigint"))
    where = F.when(F.col("explicit").isNotNull(), "text").when(F.col("declared").isNotNull(), "source").otherwise("default")
    amount = F.round(F.col("number") * unit.cast("decimal(10,0)"), 0)
    return joined.select("key", "source", "raw", "stored", "stored_basis", "number", "explicit", "declared", unit.alias("unit"), where.alias("unit_from"), amount.cast("decimal(38,0)").alias("amount"), "basis", "undisclosed")


def fit_units(converted: DataFrame) -> DataFrame:
    """Adds fitted_unit, fitted_tax, residual, unique.

    Of all combinations of a unit (``CANDIDATES`` and the one that the text or its
    source states) and a tax step (none, added, taken) the one under which stored =
    number x unit x step, in whole yen, holds best; of equal ones the stated unit
    without a step, then the others without a step. Null where number or stored is missing or not positive. unique
    is false where a combination that gives another amount fits as well.
    """
    number, stored = F.col("number").cast("double"), F.col("stored").cast("double")
    usable = (number > 0) & (stored > 0)

    def way(unit: Column, factor: Column, order: int, tax: str) -> Column:
        return F.struct(F.abs(F.log(stored / F.greatest(factor, F.lit(1.0)))).alias("residual"), F.lit(order).alias("order"), factor.alias("amount"), unit.alias("unit"), F.lit(tax).alias("tax"))

    ways = [way(F.col("unit"), F.col("amount").cast("double"), 0, "none")]
    for tax, step in TAX_STEPS:
        for unit in (F.col("unit"), *[F.lit(u).cast("bigint") for u in CANDIDATES]):
            ways.append(way(unit, F.round(number * unit.cast("double") * step, 0), len(ways), tax))
    fitted = converted.withColumn("_f", F.when(usable, F.array_sort(F.array(*ways))))
    best = F.col("_f")[0]
    as_well = F.exists("_f", lambda w: (w["amount"] != best["amount"]) & (w["residual"] - best["residual"] <= TIE))
    return fitted.withColumns({"fitted_unit": best["unit"], "fitted_tax": best["tax"], "residual": best["residual"], "unique": ~as_well}).drop("_f")


def source_units(converted: DataFrame) -> DataFrame:
    """(source, declared, fitted_unit, rows, residual, unique): the unit of a source's unit-less amounts.

    The combination of one unit per source that minimises the mean log residual
    of stored = number x unit over all its unit-less rows; sums are combined
    before the shuffle.
    """
    number, stored = F.col("number").cast("double"), F.col("stored").cast("double")
    rows = converted.where(F.col("explicit").isNull() & (number > 0) & (stored > 0))
    # residuals are capped at one decade, so that single wrong stored amounts don't outvote the rest
    sums = [F.avg(F.least(F.abs(F.log(stored / (number * F.lit(float(u))))), F.lit(2.302585))).alias(f"r_{u}") for u in CANDIDATES]
    by = rows.groupBy("source").agg(F.max("declared").alias("declared"), F.count(F.lit(1)).alias("rows"), *sums)
    best = F.array_sort(F.array(*[F.struct(F.round(f"r_{u}", 9).alias("residual"), F.lit(u).cast("bigint").alias("unit")) for u in CANDIDATES]))
    got = by.withColumn("_b", best)
    return got.select(
        "source", "declared", "rows",
        F.col("_b")[0]["unit"].alias("fitted_unit"),
        F.col("_b")[0]["residual"].alias("residual"),
        ((F.col("_b")[1]["residual"] - F.col("_b")[0]["residual"]) > TIE).alias("unique"),
    )


def wrong_stored() -> Column:
    """True, of a frame from fit_units, where the text states one definite amount and the stored amount or basis is another.

    The amount is right where the fit ends at the stated unit without a tax step
    and leaves no residual. Doubles do not tell apart amounts of more than 15
    digits, so what the fit calls right is compared once more, exactly.
    """
    fits = (F.col("fitted_unit") == F.col("unit")) & (F.col("fitted_tax") == "none") & (F.col("residual") == 0)
    nothing = (F.col("amount") == 0) & (F.col("stored") == 0)  # no logarithm
    same = F.col("stored").cast("decimal(38,0)") == F.col("amount")
    right = F.coalesce((fits | nothing) & same, F.lit(False))
    return F.col("amount").isNotNull() & (~right | ~F.col("stored_basis").eqNullSafe(F.col("basis")))

"""New batches against everything accepted, through a segment index for edit distance.

Two strings within ``EDITS`` edits share at least one of ``EDITS + 1`` segments
unchanged, at a position that the edits can have shifted only so far. The index
therefore holds, per accepted wording, its segments with string length and
segment number; a new wording probes it with the few substrings of its own that
could equal such a segment (the multi-match-aware selection), for each length it
could match. Candidates are verified by bounded edit distance, then by what the
edits are: one character too many, too few, or two swapped is the same wording,
one in place of another is not. Then the segments of the batch are appended.

A wording is a title in its look-alike form without boilerplate, blanks and year;
a title whose halves can have been set in the other order, at a middle dot or
where words that end a procurement stand within it, has both orders as wordings.
Wordings, not rows, are indexed and compared: a title that a
third of all rows carry is one entry. Rows meet their wordings' entries again by
date: entries are (wording, date, first arrival), and a row looks up the entries
of the 15-day bins around its own date.

Defined cases: a null or empty wording matches nothing (its key may); a null
organization matches nothing; a null key matches nothing; a null date is within
reach of every date; wordings of fewer than ``SHORT`` characters must be equal.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticeflow.llm.lookalike import fold
from noticeflow.storage import materialize, remove

EDITS = 2
SHORT = 6
#: Wordings of a group that may share a segment and still be compared with each other by it.
HOT = 500
_PRIME, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51
#: Days between two announcements of the same procurement.
REACH = 14

# What notices carry around the name of the procurement.
BEFORE = "入札公告 公募型プロポーザル 条件付一般競争入札 一般競争入札 指名競争入札 電子入札対象 物品役務"
AFTER = "の入札について の実施について に係る公告 について の件"
AMID = "一式の調達 の調達 一式 再度公告 再公告 公告 訂正 ほか における に係る に伴う"
# Variants of one character, the usual form last.
VARIANTS = "亊事 髙高 﨑崎 嵜崎 邊辺 邉辺 齋斎 齊斉 廣広 學学 國国 會会 體体 圖図 舘館 櫻桜 瀧滝 澤沢 濱浜 德徳 點点 縣県 淸清 冝宜"

# Words that end the name of a procurement; what follows them was set behind it.
ENDINGS = "工事 業務委託 委託業務 業務 委託 事業 購入 買入 買入れ 調達 賃貸借 借上 借上げ 借入 借入れ リース 修繕 点検整備 製造 印刷 売却 売払 売払い"

_VARIANTS = str.maketrans({a: b for a, b in VARIANTS.split()})


def _any(phrases: str) -> str:
    return "|".join(sorted((regex.escape(fold(x)) for x in phrases.split()), key=len, reverse=True))


_OUT = regex.compile(rf"[\s【】「」『』()\[\]〔〕<>〈〉《》]|(?:令和|平成|R|H)(?:\d{{1,2}}|元)年度|\d{{4}}年度|{_any(BEFORE)}|{_any(AMID)}|(?:{_any(AFTER)})$")
_SETS = regex.compile("設備機器")
_AND = regex.compile("及び|および|並びに|ならびに")
_LOT = regex.compile(r"(?:その\d+|第\d+(?:回|期|[工エ]区)|\d+号機|[A-Z]地区)+$")


def _slips(word: str) -> set[str]:
    """A word as it is and with one slip, as far as the slip leaves more than one character of it."""
    inner = range(1, len(word))
    shorter = {word[:i] + word[i + 1 :] for i in range(len(word))} if len(word) > 2 else set()
    return {word, *shorter, *(word[: i - 1] + word[i] + word[i - 1] + word[i + 1 :] for i in inner), *(word[:i] + "の" + word[i:] for i in inner)}


_ENDS = regex.compile(rf"(?:((?:{'|'.join(sorted({regex.escape(x) for e in ENDINGS.split() for x in _slips(fold(e))}, key=lambda x: (-len(x), x)))})[等他]?))+")


def _work(stem: str) -> str:
    """Commissioned work written in full, in whichever of its short or turned forms it ends."""
    if stem.endswith("委託業務"):
        return stem[:-4] + "業務委託"
    if stem.endswith("業務"):
        return stem + "委託"
    if stem.endswith("委託") and not {"業", "務"} <= set(stem[-6:-2]):
        return stem[:-2] + "業務委託"
    return stem


def _orders(stem: str) -> list[str]:
    """A title without its middle dots, as it stands and turned at each seam that it has."""
    cuts = {i for i, ch in enumerate(stem) if ch == "・"}
    for run in _ENDS.finditer(stem):
        if run.end() < len(stem):
            cuts.update(run.ends(1))
    turned = [stem[i:] + stem[:i] for i in sorted(cuts)]
    return list(dict.fromkeys(x.replace("・", "") for x in [stem, *turned]))


def wordings(title: str | None) -> list[str]:
    """The forms under which a title is compared, the plain one first."""
    s = (fold(title) or "").translate(_VARIANTS)
    for _ in range(3):  # what one removal uncovers goes too
        s, before = _OUT.sub("", s), s
        if s == before:
            break
    s = _AND.sub("と", _SETS.sub("設備", s))
    lot = _LOT.search(s)
    stem, tail = (s[: lot.start()], lot[0]) if lot else (s, "")
    found: dict[str, None] = {}
    for order in _orders(stem):
        if whole := _work(order) + tail:
            found[whole] = None
        if order.endswith("業務") and len(order) > SHORT:  # works, purchases and the like are at times called a service on top
            found[order[:-2] + tail] = None
    return list(found)


def same_wording(a: str, b: str) -> bool:
    """Whether two wordings differ by one slip of the pen at most."""
    if a == b:
        return True
    if min(len(a), len(b)) < SHORT:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    q = 0
    while q < min(len(a), len(b)) - p and a[-1 - q] == b[-1 - q]:
        q += 1
    x, y = a[p : len(a) - q], b[p : len(b) - q]
    if len(x) + len(y) == 1:
        ch = x or y
        return not (ch.isascii() and ch.isalnum()) and a[p - 1 : p] != "第"
    return len(x) == len(y) == 2 and x == y[::-1] and not (x.isascii() and x.isalnum())


def segments(n: int) -> list[tuple[int, int]]:
    """(start, length) of each segment of a string of n characters; the last ones are longer."""
    parts = EDITS + 1
    short, longer = divmod(n, parts)
    out, at = [], 0
    for i in range(parts):
        size = short + (i >= parts - longer)
        out.append((at, size))
        at += size
    return out


def index_segments(s: str) -> list[tuple[int, int, str]]:
    """(length, segment number, segment) of an indexed wording."""
    return [(len(s), i, s[a : a + k]) for i, (a, k) in enumerate(segments(len(s)))] if len(s) >= SHORT else []


def probe_segments(s: str) -> list[tuple[int, int, str]]:
    """(length, segment number, substring) that an index entry within reach must have one of."""
    m, out = len(s), set()
    if m < SHORT:
        return []
    for n in range(max(SHORT, m - EDITS), m + EDITS + 1):
        shift = m - n
        for i, (a, k) in enumerate(segments(n)):
            lo = max(0, a - i, a + shift - (EDITS - i))
            hi = min(m - k, a + i, a + shift + (EDITS - i))
            out |= {(n, i, s[p : p + k]) for p in range(lo, hi + 1)}
    return sorted(out)


_KEYS = T.ArrayType(T.StructType([T.StructField("n", T.IntegerType()), T.StructField("i", T.IntegerType()), T.StructField("s", T.StringType())]))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _wordings(title: pd.Series) -> pd.Series:
    codes, values = pd.factorize(title)
    got = [wordings(v) for v in values] + [[]]
    return pd.Series([got[c] for c in codes])


@F.pandas_udf(_KEYS)
def _index_segments(s: pd.Series) -> pd.Series:
    return pd.Series([index_segments(x) for x in s])


@F.pandas_udf(_KEYS)
def _probe_segments(s: pd.Series) -> pd.Series:
    return pd.Series([probe_segments(x) for x in s])


@F.pandas_udf(T.BooleanType())
def _same_wording(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([same_wording(x, y) for x, y in zip(a, b, strict=True)])


def _keyed(distinct: DataFrame, of) -> DataFrame:
    """(group, wording, key): one row per segment; the key is a hash of group, length, number and segment."""
    x = distinct.select("group", "wording", F.explode(of(F.col("wording"))).alias("x"))
    return x.select("group", "wording", F.xxhash64("group", "x.n", "x.i", "x.s").alias("key"))


def segment_index(entries: DataFrame) -> DataFrame:
    """The index of the distinct wordings of (group, wording, ...)."""
    return _keyed(entries.select("group", "wording").distinct(), _index_segments)


def without_one(s: str) -> list[int]:
    """Hashes of a string and of it with each one of its characters left out, in time linear in its length."""
    n, ahead, power = len(s), [0], [1]
    for ch in s:
        ahead.append((ahead[-1] * _BASE + ord(ch)) % _PRIME)
        power.append(power[-1] * _BASE % _PRIME)
    out, behind = {(ahead[n] * 31 + n) % _PRIME}, 0  # behind: the hash of what follows position p
    for p in range(n - 1, -1, -1):
        out.add(((ahead[p] * power[n - 1 - p] + behind) * 31 + n - 1) % _PRIME)
        behind = (behind + ord(s[p]) * power[n - 1 - p]) % _PRIME
    return sorted(out)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _without_one(s: pd.Series) -> pd.Series:
    return pd.Series([without_one(x) for x in s])


def similar(probes: DataFrame, index: DataFrame) -> DataFrame:
    """(group, wording, other): wordings of ``probes`` (group, wording) and indexed ones that name the same.

    A wording is always similar to itself. A segment that more than ``HOT``
    wordings of a group have would pair them all, so its wordings meet by what is
    left of them without one character instead: two that differ by one character
    more or less, or by two swapped, leave the same. That finds all that
    ``same_wording`` would let through, in rows proportional to the wordings.
    """
    mine = probes.select("group", "wording").distinct()
    keys = _keyed(mine, _probe_segments)
    them = index.select("group", F.col("wording").alias("other"), "key")
    hot = index.groupBy("group", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("group", "key")
    by_segment = keys.join(hot, ["group", "key"], "left_anti").join(them, ["group", "key"]).select("group", "wording", "other")
    left = keys.join(hot, ["group", "key"], "left_semi").select("group", "wording").distinct()
    right = them.join(hot, ["group", "key"], "left_semi").select("group", "other").distinct()
    left = left.withColumn("rest", F.explode(_without_one("wording")))
    right = right.withColumn("rest", F.explode(_without_one("other")))
    met = by_segment.unionByName(left.join(right, ["group", "rest"]).select("group", "wording", "other")).where(F.col("wording") != F.col("other"))
    near = met.where(F.levenshtein("wording", "other", EDITS) >= 0).distinct()
    return near.where(_same_wording("wording", "other")).unionByName(mine.withColumn("other", F.col("wording")))


def rows_of(df: DataFrame, key: str, group: str, title: Column, day: str, order: Column, id: Column) -> DataFrame:
    """(id, order, key, group, day, wordings) of a table, the form in which rows are compared."""
    return df.select(id.alias("id"), order.alias("order"), F.col(key).alias("key"), F.col(group).alias("group"), F.col(day).cast("date").alias("day"), _wordings(title).alias("wordings"))


_BIN, _ALL, _NONE = REACH + 1, -(10**6), -(10**6) - 1


def _bin(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / F.lit(_BIN)).cast("int")


def entries_of(rows: DataFrame) -> DataFrame:
    """(group, wording, day, first): the earliest arrival of each wording and date."""
    worded = rows.where("group is not null").select("group", "day", "order", F.explode("wordings").alias("wording"))
    return worded.groupBy("group", "wording", "day").agg(F.min("order").alias("first"))


def dated(entries: DataFrame) -> DataFrame:
    """(group, wording, bin, day, first): entries in the bin of their date, and each wording once in the bin of rows without a date."""
    each = entries.select("group", "wording", F.coalesce(_bin(F.col("day")), F.lit(_NONE)).alias("bin"), "day", "first")
    whole = entries.groupBy("group", "wording").agg(F.min("first").alias("first"))
    return each.unionByName(whole.select("group", "wording", F.lit(_ALL).alias("bin"), F.lit(None).cast("date").alias("day"), "first"))


def repeats(batch: DataFrame, entries: DataFrame, keys: DataFrame, index: DataFrame) -> DataFrame:
    """Ids of batch rows (rows_of) that repeat an earlier one.

    ``entries`` (entries_of) and ``keys`` (key, first) cover history and batch;
    ``index`` their wordings.
    """
    return _repeats(batch, dated(entries), keys, index)


def _repeats(batch: DataFrame, entries: DataFrame, keys: DataFrame, index: DataFrame) -> DataFrame:
    by_key = batch.where("key is not null").join(keys, "key").where("first < order").select("id")

    # read by the index probe and by the look-up of entries, so titles are read once
    probes = materialize(batch.where("group is not null").select("id", "order", "group", "day", F.explode("wordings").alias("wording")))
    them = entries.select("group", F.col("wording").alias("other"), "bin", F.col("day").alias("other_day"), "first")
    here = _bin(F.col("day"))
    bins = F.when(F.col("day").isNull(), F.array(F.lit(_ALL))).otherwise(F.array(here - 1, here, here + 1, F.lit(_NONE)))
    named = probes.join(similar(probes, index), ["group", "wording"]).withColumn("bin", F.explode(bins))
    near = F.col("other_day").isNull() | F.col("day").isNull() | (F.abs(F.datediff("day", "other_day")) <= REACH)
    by_name = named.join(them, ["group", "other", "bin"]).where((F.col("first") < F.col("order")) & near).select("id")
    return by_key.unionByName(by_name).distinct()


def first_keys(rows: DataFrame) -> DataFrame:
    """(key, first): the earliest arrival of each key."""
    return rows.where("key is not null").groupBy("key").agg(F.min("order").alias("first"))


class AcceptedIndex:
    """Everything accepted so far: segments, entries and keys in bucketed Parquet below ``folder``.

    Each of the three lies in buckets of the columns it is looked up by, so a
    batch is brought to the buckets and the history is read where it lies: never
    its rows again, and without moving the index. ``judge`` appends the batch's
    part, a folder of its own in each of the three, so that a batch that failed
    half way can be judged again. The number of buckets belongs to the folder.
    """

    _ORDER = "struct<batch:int,row:bigint>"
    #: What is stored -> columns, and those that its buckets go by.
    _TABLES = {
        "segments": ("group string, wording string, key bigint", ["group", "key"]),
        "entries": (f"group string, wording string, bin int, day date, first {_ORDER}", ["group", "wording", "bin"]),
        "keys": (f"key string, first {_ORDER}", ["key"]),
    }

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.folder, self.buckets = spark, folder, buckets

    def _name(self, what: str) -> str:
        return f"noticeflow_accepted_{hashlib.sha256(self.folder.encode()).hexdigest()[:16]}_{what}"

    def _write(self, what: str, rows: DataFrame, part: str) -> None:
        _, by = self._TABLES[what]
        name, at = self._name(f"{what}_part"), f"{self.folder}/{what}/part={part}"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, at)
        rows.repartition(self.buckets, *by).write.bucketBy(self.buckets, *by).sortBy(*by).option("path", at).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # of the catalogue; the files stay

    def read(self, what: str) -> DataFrame:
        """All parts of segments, entries or keys, in their buckets."""
        columns, by = self._TABLES[what]
        name, listed = self._name(what), ", ".join(f"`{c}`" for c in by)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        quoted = ", ".join("`{}` {}".format(*c.split(" ", 1)) for c in columns.split(", "))
        self.spark.sql(f"CREATE TABLE {name} ({quoted}, part string) USING parquet PARTITIONED BY (part) CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{what}'")
        self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return self.spark.table(name).drop("part")

    def append(self, rows: DataFrame, part: str) -> None:
        """Add accepted rows (rows_of) as the part of that name, replacing it."""
        entries = materialize(entries_of(rows))
        self._write("segments", segment_index(entries), part)
        self._write("entries", dated(entries), part)
        self._write("keys", first_keys(rows), part)

    def judge(self, batch: DataFrame, part: str) -> DataFrame:
        """Ids of the batch's rows that repeat an accepted one or an earlier one of the batch; then the batch is appended."""
        self.append(batch, part)
        # parts may repeat a wording or key of others: that repeats a finding, which is made distinct
        return _repeats(batch, self.read("entries"), self.read("keys"), self.read("segments"))

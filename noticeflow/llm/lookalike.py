"""One form for text that looks the same.

``fold`` is the table: width and composition by NFKC, ignorable characters out,
every blank a space, every dash and look-alike letter the first of its class.
``canonical_tokens`` chooses spellings: the distinct tokens of a column, the most
frequent first, go through a trie of the vocabulary met so far under a weighted
edit automaton in which look-alikes replace each other and ignorables come and
go at no cost, and a character that is taken for another only at a glance (zero
and O, one and l) replaces it at half an edit. A token within ``BUDGET`` takes the
nearest spelling found; one that the automaton does not match joins the vocabulary
as it is written, so that a class has the spelling that most texts carry, but for
width and composition. Likeness at a glance is not transitive (1 and l, l and I), so
no table can hold it: which spelling a token takes depends on those in use.

Width and composition leave alone what has a look of its own although NFKC would
undo it: circled, raised and squared characters and parenthesized ideographs.

Scale: only distinct tokens are compared. They meet in buckets by the hash of
their skeleton, the table form with glance-alikes made one, so no trie holds more
than its bucket's classes, and a step of the automaton looks up the few characters
that may stand for its own instead of walking a node's children. A class with very
many spellings is spread by a salt first and then joined from one spelling per
salt, so it never passes through one task as a whole.

Defined cases: null stays null, blank and wholly ignorable texts become the
empty string, and such tokens leave no blank in a text; equal tokens are compared
once; ties of frequency go to the spelling that the table changes least, then to
the smaller string; of spellings equally near the smallest is taken.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticeflow.storage import materialize

# Classes of characters that look alike, the form to keep first.
LOOKALIKES = """
-‐‑‒–—―−─━⁃﹘ー一
二ニ 八ハ 力カ 口ロ囗 工エ 夕タ 卜ト
ヘへ ベべ ペぺ リり
AΑАᎪ BΒВᏴ CСϹⅭ EΕЕᎬ HΗНᎻ IΙІӀ JЈᎫ KΚКᏦ MΜМϺ NΝ OΟО PΡРᏢ SЅᏚ TΤТᎢ XΧХ YΥҮ ZΖᏃ
aаɑ cсϲ eе iі jј oоο pрρ sѕ uυ vν xх yу
・·•‧∙⋅ ~〜∼ 〇○◯
"""
# Pairs that pass for each other at a glance only.
GLANCE = "0O 1l lI 三ミ 千チ 才オ 丿ノ"
#: What replacing one by the other costs, and what a token may differ by from its spelling.
GLANCE_COST, BUDGET = 0.5, 0.5
#: Characters without a look of their own, beside the format characters (Cf) and controls.
IGNORABLE_RANGES = ((0x034F, 0x034F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xE0100, 0xE01EF))

_FIRST = {ord(ch): group[0] for group in LOOKALIKES.split() for ch in group[1:]}


class _Table(dict):
    """Code point -> the form to keep, empty for ignorables, space for blanks."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        if any(a <= code <= b for a, b in IGNORABLE_RANGES):
            got = ""
        elif ch.isspace() or unicodedata.category(ch) == "Zs":
            got = " "
        elif unicodedata.category(ch) in ("Cf", "Cc"):
            got = ""
        else:
            got = _FIRST.get(code, ch)
        self[code] = got
        return got


_TABLE = _Table()
#: Class -> characters of it, beside its first; class -> classes that pass for it at a glance.
_MEMBERS = {group[0]: group[1:] for group in LOOKALIKES.split()}
_GLANCE: dict[str, str] = {}
for _a, _b in GLANCE.split():
    _GLANCE[_a], _GLANCE[_b] = _GLANCE.get(_a, "") + _b, _GLANCE.get(_b, "") + _a


def _skeletons() -> dict[int, str]:
    """Character -> the first character that it can be reached from by glances."""
    out: dict[str, str] = {}
    for ch in sorted(_GLANCE):
        todo = [ch]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = ch
                todo += _GLANCE[x]
    return {ord(k): v for k, v in out.items()}


_SKELETON = _skeletons()
_HIDDEN = str.maketrans({c: "" for a, b in IGNORABLE_RANGES for c in range(a, b + 1)} | {0xAD: "", 0x200B: "", 0x200C: "", 0x200D: "", 0x200E: "", 0x200F: "", 0x2060: "", 0xFEFF: "", 0x061C: ""})


def compose(text: str) -> str:
    """Width and composition only; ignorables go first, since they keep marks from their letters."""
    return unicodedata.normalize("NFKC", text.translate(_HIDDEN))


def _has_own_look(code: int) -> bool:
    """Whether NFKC would turn a character into something that does not look like it."""
    tag, *parts = unicodedata.decomposition(chr(code)).split() or [""]
    return tag in ("<circle>", "<super>", "<sub>", "<square>", "<fraction>") or tag == "<compat>" and len(parts) > 1 and parts[0] == "0028"


_OWN_LOOK = re.compile("([" + "".join(map(re.escape, (chr(c) for c in (*range(0x80, 0xD800), *range(0xF900, 0x10000), *range(0x1F100, 0x1F300)) if _has_own_look(c)))) + "]+)")


def shape(text: str) -> str:
    """Width and composition, as far as the look stays the same."""
    if text.isascii():
        return text
    if not _OWN_LOOK.search(text):
        return compose(text)
    return "".join(part if i % 2 else compose(part) for i, part in enumerate(_OWN_LOOK.split(text)))


def fold(text: str | None) -> str | None:
    """The table form of a text."""
    return None if text is None else " ".join(shape(text).translate(_TABLE).split())


def kind(ch: str) -> str:
    """The look-alike class of a character; empty for ignorables."""
    return _TABLE[ord(ch)]


class Trie:
    """Vocabulary under the weighted edit automaton.

    A node maps characters to nodes, "" to the spelling that ends there and None
    to its children that are ignorables.
    """

    def __init__(self, budget: float = 0):
        self.root: dict = {}
        self.budget = budget

    def add(self, token: str) -> None:
        node = self.root
        for ch in token:
            if ch not in node:
                node[ch] = {}
                if kind(ch) == "":
                    node.setdefault(None, []).append(ch)
            node = node[ch]
        node[""] = token

    def find(self, token: str) -> str | None:
        """The vocabulary's spelling at the least cost within the budget; of equal ones the smallest.

        Look-alikes and ignorables cost nothing, glance-alikes half, any other edit 1.
        """
        best: tuple[float, str] | None = None
        seen: dict[tuple[int, int], float] = {}
        todo = [(0.0, 0, self.root)]
        n, budget = len(token), self.budget
        kinds = [*map(kind, token), None]
        while todo:
            cost, at, node = todo.pop()
            if seen.get((at, id(node)), budget + 1) <= cost:
                continue
            seen[at, id(node)] = cost
            if at == n and "" in node and (best is None or (cost, node[""]) < best):
                best = (cost, node[""])
            here = kinds[at]
            if cost + 1 <= budget:
                if here:
                    todo.append((cost + 1, at + 1, node))  # a character too many
                for ch, child in node.items():
                    if ch:
                        todo.append((cost + 1, at, child))  # one too few
                        if here is not None:
                            todo.append((cost + 1, at + 1, child))
            if here in _GLANCE and cost + GLANCE_COST <= budget:
                todo += [(cost + GLANCE_COST, at + 1, node[ch]) for other in _GLANCE[here] for ch in other + _MEMBERS.get(other, "") if ch in node]
            if None in node:
                todo += [(cost, at, node[ch]) for ch in node[None]]  # ignorables of the vocabulary
            if here == "":
                todo.append((cost, at + 1, node))
            elif here is not None:
                if here in node:
                    todo.append((cost, at + 1, node[here]))
                if here in _MEMBERS:
                    todo += [(cost, at + 1, node[ch]) for ch in _MEMBERS[here] if ch in node]
        return best[1] if best else None


def _distance(token: str, folded: str) -> int:
    return sum(a != b for a, b in zip(token, folded, strict=False)) + abs(len(token) - len(folded))


@F.pandas_udf(T.StructType([T.StructField("skeleton", T.StringType()), T.StructField("off", T.IntegerType())]))
def _placed(token: pd.Series) -> pd.DataFrame:
    codes, values = pd.factorize(token)
    folded = [fold(x) for x in values]
    skeleton = [f.translate(_SKELETON) for f in folded] + [None]
    off = [_distance(x, f) for x, f in zip(values, folded, strict=True)] + [0]
    return pd.DataFrame({"skeleton": [skeleton[c] for c in codes], "off": [off[c] for c in codes]})


def _through_tries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by bucket, then best first: (bucket, token, n) -> (token, n, spelling)."""
    bucket, trie = None, Trie(BUDGET)
    for pdf in batches:
        out = []
        for b, token in zip(pdf["bucket"], pdf["token"], strict=True):
            if b != bucket:
                bucket, trie = b, Trie(BUDGET)
            written = shape(token)
            got = trie.find(written) if any(map(kind, written)) else ""
            if got is None:
                got = written
                trie.add(got)
            out.append(got)
        yield pd.DataFrame({"token": pdf["token"], "n": pdf["n"], "spelling": out})


def canonical_tokens(tokens: DataFrame, buckets: int = 4096, salts: int = 8) -> DataFrame:
    """(token, spelling) for every distinct non-null ``token``."""

    def level(counted: DataFrame, salts: int) -> DataFrame:
        x = counted.withColumn("f", _placed("token"))
        part, salt = F.pmod(F.xxhash64("f.skeleton"), F.lit(buckets)), F.pmod(F.xxhash64("token"), F.lit(salts))
        keyed = x.select("token", "n", F.col("f.off").alias("off"), F.concat_ws("-", part.cast("string"), salt.cast("string")).alias("bucket"))
        ordered = keyed.repartition("bucket").sortWithinPartitions("bucket", F.desc("n"), "off", "token")
        return ordered.select("bucket", "token", "n").mapInPandas(_through_tries, "token string, n bigint, spelling string")

    # both what follows and the last join read it, so the tries run once
    first = materialize(level(tokens.where("token is not null").groupBy("token").agg(F.count(F.lit(1)).alias("n")), salts))
    # what the salts found for one class is now at most one spelling per salt, each as frequent as the first that took it
    local = first.groupBy(F.col("spelling").alias("token")).agg(F.max("n").alias("n"))
    second = level(local, 1).select(F.col("token").alias("local"), F.col("spelling").alias("final"))
    return first.join(second, first["spelling"] == second["local"]).select("token", F.col("final").alias("spelling"))


def _forms(texts: DataFrame) -> DataFrame:
    """(text, form) of every distinct ``text`` with a visible token: token by token in its canonical spelling, blanks as single spaces."""
    distinct = texts.where("text is not null").distinct()
    split = distinct.select("text", F.posexplode(_blank_split("text")).alias("at", "token"))
    spelled = split.join(canonical_tokens(split.select("token")), "token")
    form = F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("at", "spelling"))), lambda x: x["spelling"]))
    return spelled.groupBy("text").agg(form.alias("form"))


def canonical_texts(df: DataFrame, id: str, text: str) -> DataFrame:
    """(id, text, form): the text token by token in its canonical spelling, blanks as single spaces.

    Texts are made distinct first, so repeated texts are split and joined once.
    """
    forms = _forms(df.select(F.col(text).alias("text")))
    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.join(forms, "text", "left").select("id", "text", F.when(F.col("text").isNotNull(), F.coalesce("form", F.lit(""))).alias("form"))


def canonical_columns(df: DataFrame, id: str, columns: dict[str, str]) -> DataFrame:
    """The id, and each text column beside its form, named by ``columns``; all columns share one choice of spellings, so their forms compare."""
    rows = df.select(id, *columns)
    # each column is joined with the forms
    forms = materialize(_forms(rows.select(F.explode(F.array(*columns)).alias("text"))))
    for text, form in columns.items():
        rows = rows.join(forms.select(F.col("text").alias("_text"), F.col("form").alias("_form")), F.col(text) == F.col("_text"), "left")
        rows = rows.withColumn(form, F.when(F.col(text).isNotNull(), F.coalesce("_form", F.lit("")))).drop("_text", "_form")
    return rows.select(id, *[c for pair in columns.items() for c in pair])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _blank_split(text: pd.Series) -> pd.Series:
    """The tokens of texts; composed first, since composition can bring blanks."""
    blank = {}
    out = []
    for t in map(shape, text):
        for ch in set(t):
            if ch not in blank:
                blank[ch] = ch if kind(ch) != " " else " "
        out.append("".join(blank[ch] for ch in t).split(" "))
    return pd.Series([[x for x in parts if any(map(kind, x))] for parts in out])


def same_looking_pairs(df: DataFrame, id: str, group: str, text: str, keep=None) -> DataFrame:
    """(a, b), a < b: rows of one group with the same form but different strings.

    Rows of a form that has one string only never enter the join. ``keep``: a
    boolean column; rows without it are out. Equal strings are no pair, nor is an
    id with itself.
    """
    rows = df.where(F.col(id).isNotNull() & F.col(group).isNotNull() & F.col(text).isNotNull())
    rows = rows.where(keep) if keep is not None else rows
    forms = canonical_texts(rows.select(F.struct(F.col(id).alias("id"), F.col(group).alias("group")).alias("row"), F.col(text).alias("text")), "row", "text")
    # read by the count of strings and by both sides of the join
    flat = materialize(forms.select(F.col("id.id").alias("id"), F.col("id.group").alias("group"), "text", "form"))
    strings = flat.groupBy("group", "form", "text").agg(F.count(F.lit(1)).alias("rows"))
    several = strings.groupBy("group", "form").agg(F.count(F.lit(1)).alias("strings")).where("strings > 1").select("group", "form")
    found = strings.join(several, ["group", "form"], "left_semi").select("group", "form", "text")
    # strings are paired before rows are: a string that a million rows carry is one here
    pairs = found.withColumnRenamed("text", "text_a").join(found.withColumnRenamed("text", "text_b"), ["group", "form"]).where("text_a < text_b")
    rows = flat.select("group", "text", "id")
    one = rows.select("group", F.col("text").alias("text_a"), F.col("id").alias("one"))
    other = rows.select("group", F.col("text").alias("text_b"), F.col("id").alias("other"))
    met = pairs.select("group", "text_a", "text_b").join(one, ["group", "text_a"]).join(other, ["group", "text_b"]).where("one <> other")
    return met.select(F.least("one", "other").alias("a"), F.greatest("one", "other").alias("b"))

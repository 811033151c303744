"""Text that was decoded with the wrong character encoding.

1. Corpus statistics: characters and adjacent pairs of all lines that hold only
   ASCII, kana, first-level kanji and ordinary Japanese punctuation. A garbled
   stretch nearly always holds something else, so it does not vouch for itself.
   Such lines are written in an alphabet of some 3 700 characters, so pairs are
   counted exactly, in a table whose size does not depend on the corpus (27 MB
   where it is broadcast).
2. Every adjacent pair of a text is scored by mutual information: pairs seen
   more often than chance speak against garbling, pairs with a character that
   the corpus lacks, or seen far less often than chance, for it.
3. The maximal scoring segments (Ruzzo and Tompa) are the improbable runs.
4. Inside a run, and nowhere else, the inverse mappings are tried: the run's
   characters back to bytes in each encoding that may have been used wrongly,
   the bytes to text in each that may have been right; twice for text garbled
   twice. The mapping whose result consists of corpus characters and probable
   pairs wins; a few bytes may be lost. A run that becomes no Japanese is tried
   as text in Latin script, stretch by stretch: every byte of a stretch must take
   part in a strict decoding to accented letters, quotation marks, dashes or signs.
5. A run that no mapping restores is garbled only if it bears the marks of
   decoding: replacement characters, C1 controls, private-use characters, or a
   dense run of high Latin letters and signs that no word has.

Scoring sees characters in their look-alike form (narrow kana as wide kana,
ignorables dropped), so those are no marks of garbling. Seven-bit ISO-2022-JP
without its escape bytes is ASCII to the statistics and is found by its shift
sequences instead.

Defined cases: null and empty texts are clean; a lost character is restored as
the replacement character; a text without any run is returned as it is.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.lookalike import _TABLE, compose
from noticeflow.storage import spread

#: A character counts as known to the corpus from this share of its characters, and this often, on.
KNOWN_SHARE, KNOWN_TIMES = 2e-7, 2
#: The least score of an improbable run.
RUN_SCORE = 2.5
#: The same where strict decoding to Latin script is asked for: two pairs in a row suffice.
LATIN_SCORE = 1.5

# Encodings used wrongly, encodings that were right.
WRONG = ("cp1252", "latin-1", "cp932", "gbk", "mac_roman", "cp1251", "euc_jp", "koi8_r", "cp437", "cp850", "cp1250", "cp949", "big5", "cp1253", "cp1254", "iso8859_15")
RIGHT = ("utf-8", "cp932", "euc_jp")

_ISO2022_RUN = regex.compile(r"\x1b?\$[@B](?:(?!\x1b?\([BJ])[!-~]{2})+(?:\x1b?\([BJ])?")
_MARKS = regex.compile(r"[�\u0080-\u009f\p{Co}\p{Cn}]")
_HIGH = regex.compile(r"[¡-ÿŒœŠšŸŽžƒˆ˜‐-•…‰‹›€™†‡Ѐ-ӿ∂∏∑√∞∫≈≠≤≥◊Ωπıﬁﬂ˘˙˚˝˛ˇ⁄░-▟─-╬]")

_DENSE = regex.compile(f"{_HIGH.pattern}{{2,}}")
_NARROW = regex.compile(r"[｡-ﾟ]")
_BESIDE = regex.compile(f"{_HIGH.pattern}(?={_HIGH.pattern})")

def _known_line_char(code: int) -> bool:
    """ASCII, kana, first-level kanji, Japanese punctuation and rules."""
    if 0x20 <= code < 0x7F or code == 9:
        return True
    ch = chr(code)
    if "ぁ" <= ch <= "ヾ":
        return True
    try:
        b = ch.encode("euc_jp")
    except UnicodeEncodeError:
        return False
    return len(b) == 2 and (b[0] in (0xA1, 0xA2, 0xA3, 0xA8) or 0xB0 <= b[0] <= 0xCF)


def units(text: str) -> list[tuple[str, int, int]]:
    """(character in its look-alike form, start, end) of a text; ignorables belong to the one before."""
    out: list[tuple[str, int, int]] = []
    for i, ch in enumerate(text):
        if ch in "ﾞﾟ" and out and out[-1][0] != " ":
            base = compose(out[-1][0] + ch)
            out[-1] = (base if len(base) == 1 else out[-1][0], out[-1][1], i + 1)
            continue
        folded = _form(ch)
        if not folded:
            if out:
                out[-1] = (out[-1][0], out[-1][1], i + 1)
            continue
        out.append((folded, i, i + 1))
    return out


class _Forms(dict):
    """Code point -> its look-alike form, for str.translate."""

    def __missing__(self, code: int) -> str:
        self[code] = got = _form(chr(code))
        return got


_FORMS: dict[str, str] = {}
_FORM_TABLE = _Forms()


def _form(ch: str) -> str:
    got = _FORMS.get(ch)
    if got is None:
        if ch in "\u0080\u0081\u008d\u008f\u0090\u009d" or 0x7F <= ord(ch) < 0xA0 and ch != "\u0085":
            got = ch  # a control that decoding left, not an ignorable
        else:
            wide = compose(ch)
            got = _TABLE[ord(wide)] if len(wide) == 1 else ch if wide else ""
        _FORMS[ch] = got
    return got


#: The characters of countable lines, in order; a pair has the index of its first times their number plus that of its second.
ALPHABET = np.array([c for c in range(0x10000) if not 0xD800 <= c < 0xE000 and _known_line_char(c)], np.uint32)
LETTERS = len(ALPHABET)
#: Pairs there can be.
BUCKETS = LETTERS * LETTERS
_INDEX = np.full(0x110000, LETTERS, np.int32)
_INDEX[ALPHABET] = np.arange(LETTERS, dtype=np.int32)


def count_pairs(texts: Iterator[str | None], singles: dict[int, int], pairs: np.ndarray) -> None:
    """Add the countable lines of the texts to both counts."""
    joined = "\n".join(t.replace("\r", "\n") for t in texts if t)
    if not joined:
        return
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    every, at = np.unique(codes, return_inverse=True)
    forms = [_form(chr(c)) if c != 10 else "\n" for c in every]
    form = np.array([ord(f) if f else 0 for f in forms], np.uint32)
    good = np.array([c == 10 or not f or _known_line_char(ord(f)) for c, f in zip(every, forms, strict=True)])
    line = np.cumsum(codes == 10)
    bad = np.bincount(line, weights=~good[at], minlength=line[-1] + 1) > 0
    for m in _ISO2022_RUN.finditer(joined):
        bad[line[m.start()]] = True
    x = form[at]
    keep = (x != 0) & (x != 10) & ~bad[line]
    x, line = x[keep], line[keep]
    if not len(x):
        return
    for c, n in zip(*np.unique(x, return_counts=True), strict=True):
        singles[int(c)] = singles.get(int(c), 0) + int(n)
    same = line[1:] == line[:-1]
    np.add.at(pairs, _INDEX[x[:-1][same]].astype(np.int64) * LETTERS + _INDEX[x[1:][same]], 1)


class Statistics:
    """Counts of the corpus and the scores that follow from them."""

    def __init__(self, singles: dict[int, int], pairs: np.ndarray):
        self.total = max(1, sum(singles.values()))
        least = max(KNOWN_TIMES, self.total * KNOWN_SHARE)
        self.singles = {c: n for c, n in singles.items() if n >= least}
        self.mutual = self._mutual(pairs)

    def _mutual(self, pairs: np.ndarray) -> np.ndarray:
        """Mutual information of every pair of the alphabet; nan for what the corpus lacks, and in the last row and column."""
        n = self.table[ALPHABET].astype(float)
        out = np.full((LETTERS + 1, LETTERS + 1), np.nan, np.float16)
        known = np.flatnonzero(n)
        for i in known.tolist():
            expected = n[i] * n[known] / self.total
            seen = pairs[i * LETTERS + known].astype(float)
            with np.errstate(divide="ignore"):
                out[i, known] = np.where(seen > 0, np.log2(seen / expected), np.where(expected > 2, -np.log2(expected + 1), 0.0))
        return out

    @cached_property
    def table(self) -> np.ndarray:
        """Counts by code point; made where it is used, not broadcast."""
        got = np.zeros(0x110000, np.float32)
        for c, n in self.singles.items():
            got[c] = n
        return got

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "table"}

    def known(self, ch: str) -> bool:
        return ord(ch) in self.singles

    def information(self, codes: np.ndarray) -> np.ndarray:
        """Of each adjacent pair: log2 of how much more often than chance it occurs.

        nan where a character is unknown; 0 where chance would not expect to see the pair once.
        """
        at = _INDEX[codes]
        return self.mutual[at[:-1], at[1:]].astype(float)

    def suspicion(self, s: str) -> np.ndarray:
        """Of each adjacent pair: positive speaks for garbling."""
        codes = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)
        mi = self.information(codes)
        score = np.where(np.isnan(mi), 1.0, np.where(mi > 0, -np.minimum(1.5, 0.4 + mi / 4), np.where(mi < 0, np.minimum(0.25, -mi / 16), -0.25)))
        plain = codes < 0x80
        # a pair of ASCII characters is never evidence: names, codes and numbers have all of them
        return np.where(plain[:-1] & plain[1:], np.minimum(score, -0.15), score)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, score) of all maximal scoring segments, after Ruzzo and Tompa."""
    found: list[list[float]] = []  # start, end, sum before, sum after
    total = 0.0
    for i, x in enumerate(scores.tolist()):
        if x <= 0:
            total += x
            continue
        k = [i, i + 1, total, total + x]
        total += x
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= k[2]:
                j -= 1
            if j < 0 or found[j][3] >= k[3]:
                break
            k = [found[j][0], k[1], found[j][2], k[3]]
            del found[j:]
        found.append(k)
    return [(int(a), int(b), after - before) for a, b, before, after in found]


MAPPINGS = [(w, r) for w in WRONG for r in RIGHT if w != r]
#: Encodings whose single high bytes stand for nothing.
_MULTIBYTE = ("cp932", "euc_jp", "gbk", "cp949", "big5")


def _odd_bytes(ch: str, wrong: str) -> bytes | None:
    """The byte that a decoder let through although its encoding has no character for it."""
    code = ord(ch)
    if code < 0x100 and (wrong == "cp932" and code >= 0x80 or wrong not in _MULTIBYTE):
        return bytes([code])  # as a control
    if wrong == "cp932" and 0xE000 <= code < 0xE758:  # user-defined rows
        row, cell = divmod(code - 0xE000, 188)
        return bytes([0xF0 + row, cell + 0x40 + (cell >= 63)])
    if wrong == "cp932" and 0xF8F0 <= code <= 0xF8F3:
        return (b"\xa0", b"\xfd", b"\xfe", b"\xff")[code - 0xF8F0]
    return None


def _handler(wrong: str):
    def handle(error: UnicodeEncodeError) -> tuple[bytes, int]:
        return b"".join(_odd_bytes(ch, wrong) or b"\xff" for ch in error.object[error.start : error.end]), error.end

    return handle


for _wrong in WRONG:
    codecs.register_error(f"noticeflow-{_wrong}", _handler(_wrong))


# Encodings that text in Latin script is wrongly read in, and the UTF-8 of what it then was: letters of
# Latin-1 and its signs, dashes and quotation marks, ellipsis, per mille, euro, trade mark.
LATIN_WRONG = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1254", "iso8859_15")
_LATIN_BYTES = re.compile(rb"(?:\xc3[\x80-\xbf]|\xc2[\xa0-\xbf]|\xe2\x80[\x90-\xa6\xb0\xb2\xb3\xb9\xba]|\xe2\x82\xac|\xe2\x84\xa2)+")
_BEYOND_ASCII = regex.compile(r"[^\x00-\x7f]{2,}")


def _strict(ch: str, wrong: str) -> bytes | None:
    """The one byte of a character, in that encoding or let through as a control."""
    try:
        return ch.encode(wrong)
    except UnicodeEncodeError:
        return bytes([ord(ch)]) if 0x80 <= ord(ch) < 0xA0 else None


def _raw(run: str, wrong: str) -> bytes | None:
    """The bytes that a run was before its wrong decoding, 0xFF for a lost one; None if hardly any character was one of that encoding."""
    raw = run.encode(wrong, f"noticeflow-{wrong}")
    return None if raw.count(b"\xff") * 2 > len(run) + 2 else raw


class Restorer:
    """Finds the garbled runs of a text and their originals."""

    def __init__(self, statistics: Statistics):
        self.s = statistics

    def counts(self, text: str) -> tuple[int, int, np.ndarray]:
        """(corpus characters beyond ASCII, others beyond ASCII, the code points of the text's form)."""
        form = text.translate(_FORM_TABLE)
        codes = np.frombuffer(form.encode("utf-32-le", "surrogatepass"), np.uint32)
        high = codes[codes >= 0x80]
        # wrong mappings yield narrow kana from any high byte, so these don't count for a mapping
        narrow = len(_NARROW.findall(text))
        good = int(np.count_nonzero(self.s.table[high])) - narrow
        return good, len(high) - good - narrow // 2, codes

    def decode(self, run: str, mappings: Iterable[tuple[str, str]] = ()) -> tuple[tuple[float, str] | None, list[tuple[str, str]]]:
        """((worth, original) of the best mapping of a run or None, the mappings that gave corpus characters at all)."""
        best: tuple[float, str] | None = None
        hopeful: list[tuple[int, tuple[str, str]]] = []
        raw: dict[str, bytes | None] = {}
        for wrong, right in mappings or MAPPINGS:
            if wrong not in raw:
                raw[wrong] = _raw(run, wrong)
            if raw[wrong] is None:
                continue
            first = raw[wrong].decode(right, "replace")
            options = [first]
            if right == "utf-8" and wrong in ("cp1252", "latin-1") and _HIGH.search(first):  # garbled twice
                again = _raw(first, "cp1252")
                options += [again.decode("utf-8", "replace")] if again else []
            for t in options:
                gaps = t.count("�")
                if t == run or gaps * 2 > len(t) + 2:
                    continue
                good, bad, codes = self.counts(t)
                bad -= gaps
                if good >= 2:
                    hopeful.append((good - bad, (wrong, right)))
                if good < 2 or good < 1.5 * bad or good == 2 and (bad or gaps):
                    continue
                worth = good - 2 * bad - 0.5 * gaps
                if best is not None and worth + 8 <= best[0]:
                    continue
                mi = self.s.information(codes)
                both = (codes[:-1] >= 0x80) & (codes[1:] >= 0x80) & ~np.isnan(mi)
                mean = float(mi[both].mean()) if both.any() else 0.0
                worth += 2 * min(mean, 4) * (good > 2)
                if mean > (0 if good == 2 else -0.5) and (best is None or worth > best[0]):
                    best = (worth, t)
        return best, [m for _, m in sorted(hopeful, reverse=True)[:3]]

    def marked(self, run: str) -> bool:
        """Whether a run bears marks of decoding, restorable or not."""
        if _MARKS.search(run):
            return True
        found = _HIGH.findall(run)
        high = len(found)
        dense = max((len(m[0]) for m in _DENSE.finditer(run)), default=0)
        beside = len(_BESIDE.findall(run))
        letters = sum(c.isascii() and c.isalpha() for c in run)
        signs = sum(not c.isalpha() for c in found)
        thick = dense >= 4 and high > 2 * letters or beside >= 3 and high >= 6 and high * 3 >= len(run)
        return thick and signs * 8 >= high  # words have letters, decoding also gives signs

    def latin(self, run: str) -> tuple[str, bool]:
        """(the run with those stretches restored that are text in Latin script, decoded wrongly; whether that is all there was, among letters of words)."""
        left, restored = False, 0

        def undo(m: regex.Match) -> str:
            nonlocal left, restored
            for wrong in LATIN_WRONG:
                raw = b"".join(_strict(ch, wrong) or b"\xff" for ch in m[0])
                if _LATIN_BYTES.fullmatch(raw):
                    restored += len(raw.decode("utf-8"))
                    return raw.decode("utf-8")
            left = left or not all(map(self.s.known, filter(None, map(_form, m[0]))))
            return m[0]

        original = _BEYOND_ASCII.sub(undo, run)
        letters = sum(c.isascii() and c.isalpha() for c in original)
        return original, not left and 0 < 2 * restored <= letters

    def restore(self, text: str) -> tuple[bool, str, bool]:
        """(garbled, text restored as far as possible, restored wholly)."""
        if text.isascii():
            return self._shifted(text)
        got = units(text)
        form = "".join(u[0] for u in got)
        scores = self.s.suspicion(form)
        runs = []
        if len(scores) and scores[scores > 0].sum() >= LATIN_SCORE:
            runs = [run for run in maximal_segments(scores) if run[2] >= LATIN_SCORE]
        out, at, garbled, whole = [], 0, False, True
        for a, b, score in runs:  # pairs a .. b - 1 are characters a .. b
            start, end = got[a][1], got[b][2]
            if start < at:
                continue
            ends = []
            latin, words = self.latin(text[start:end])
            hopeful = self.decode(text[start:end])[1] if score >= RUN_SCORE and not words else []
            # the run's ends may each reach over one sound character, or leave out an ASCII byte of a garbled one
            for s in {start, got[a + 1][1], got[max(a - 1, 0)][1]}:
                for e in {end, got[b - 1][2], got[min(b + 1, len(got) - 1)][2]}:
                    if at <= s < e and hopeful:
                        d, _ = self.decode(text[s:e], hopeful)
                        if d:
                            ends.append((d[0] + self._outside(got, s, e), s, e, d[1]))
            if ends:
                _, s, e, original = max(ends)
                out += [text[at:s], original]
                at, garbled = e, True
                whole = whole and "�" not in original
            elif latin != text[start:end]:
                out += [text[at:start], latin]
                at, garbled = end, True
            elif score >= RUN_SCORE and self.marked(text[start:end]):
                garbled, whole = True, False
        out.append(text[at:])
        shifted, rest, all_ = self._shifted("".join(out))
        return garbled or shifted, rest, whole and all_

    def _outside(self, got: list[tuple[str, int, int]], start: int, end: int) -> float:
        """A run that swallows sound characters is worth less."""
        ends = [u[0] for u in got if u[1] == start or u[2] == end]
        return -0.5 * sum(self.s.known(c) and ord(c) >= 0x80 for c in ends)

    def _shifted(self, text: str) -> tuple[bool, str, bool]:
        """Seven-bit shift sequences undone."""
        if "$B" not in text and "$@" not in text:
            return False, text, True
        hit, whole = False, True

        def undo(m: regex.Match) -> str:
            nonlocal hit, whole
            body = regex.sub(r"^\x1b?\$[@B]|\x1b?\([BJ]$", "", m[0])
            original = (b"\x1b$B" + body.encode("ascii") + b"\x1b(B").decode("iso2022_jp", "replace")
            good, bad, _ = self.counts(original)
            if good < 1 or bad > good:
                return m[0]
            hit = True
            whole = whole and "�" not in original
            return original

        return (lambda t: (hit, t, whole))(_ISO2022_RUN.sub(undo, text))


def gather(texts: DataFrame) -> Statistics:
    """Statistics over every row of ``texts`` (one string column).

    Each partition sums its own counts, whole ones of 64 bits; what reaches the
    driver is one row per pair that occurs and per counted character. The alphabet
    bounds both: 14 million pairs there can be, of which a language uses a tenth.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        singles: dict[int, int] = {}
        pairs = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            count_pairs((x.as_py() for x in batch.column(0)), singles, pairs)
        at = np.flatnonzero(pairs)
        keys = np.concatenate([at, -1 - np.array(sorted(singles), np.int64)]).astype(np.int64)
        values = np.concatenate([pairs[at], np.array([singles[c] for c in sorted(singles)], np.int64)]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values)], ["k", "n"])

    counted = texts.mapInArrow(run, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    k, n = counted.column("k").to_numpy(), counted.column("n").to_numpy()
    pairs = np.zeros(BUCKETS, np.int64)
    pairs[k[k >= 0]] = n[k >= 0]
    return Statistics({int(-1 - c): int(v) for c, v in zip(k[k < 0], n[k < 0], strict=True)}, pairs)


def examine(df: DataFrame, statistics: Statistics) -> DataFrame:
    """(table_name, record_key, text) -> the same with garbled, restored, whole; one row per row."""
    shared = df.sparkSession.sparkContext.broadcast(statistics)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for batch in batches:
            got = [restorer.restore(t) if t else (False, t, True) for t in (x.as_py() for x in batch.column(2))]
            columns = [pa.array([g[0] for g in got], pa.bool_()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["table_name", "record_key", "text", "garbled", "restored", "whole"])

    return spread(df.select("table_name", "record_key", "text")).mapInArrow(run, "table_name string, record_key string, text string, garbled boolean, restored string, whole boolean")

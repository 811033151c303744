"""Text statistics of a document, and what share of it is natural prose.

A text is cut into lines; lines that only a hard line end separates are joined
again, and what remains is cut into sentences. Each stretch is prose if it is
built like a sentence of Japanese, English or one of six other languages in Latin
script: function words and endings in an order that language
has, enough words, not a repetition of itself, not cells. Everything else is a
list item, a table row or junk. The verdict goes by the share of visible
characters in prose, so a heading, a short list or a short table does not make
prose a list, and a lead-in sentence does not make a list prose. A text more than
half of which repeats itself, in lines, in paragraphs or in one run, is a filler
and no prose, however well its sentences are built.

Statistics per document: words, mean word length, symbol ratio, share of lines
that end in punctuation, share of common words (``common_word``), and repetition:
shares of characters in duplicate lines and duplicate paragraphs, and the
largest share of characters that one repeated run of 4 to 16 characters covers.

Defined cases: null, empty and blank texts have zero counts, null ratios and
label ``empty``; other columns are not read. Whole texts are read, however long,
in time linear in their length.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeflow.storage import spread

# Japanese endings and connectives that only running sentences have.
ENDINGS_JA = "する した して します される された され ます ません ました です でした である であり ない なかった なら なけれ ければ られ れる いる おり いた ある あり あった こと とする とし による により について において ため から まで ください でき という となる として よう ものの など だけ この その ただし また なお とき もって ものと ついて かじめ やかに ほか とおり までと に必要 なって ており ています ていた している としま とします となって による よると には では とは への との までに 余りの して、 は、 と、 に、 め、 が、 り、 も、 場合は、"
# English words that sentences have and names of things lack.
VERBAL_EN = "is are was were be been being will would shall should must may might can could has have had do does did not if that which who when where because since unless until it this these those they we you he she there than also but after before within by at from as"
# English words that both sentences and names of things have.
LINKING_EN = "the a an of and or to in on for with no all any each every other such"

# Function words of other languages in Latin script, a line each: German, French, Spanish, Italian, Portuguese, Dutch.
FUNCTION_WORDS = """
der die das den dem des ein eine einen einem einer und oder aber nicht ist sind war wird werden wurde hat haben kann muss mit von zu zum zur im in am an auf aus bei für durch nach vor über unter wenn dass als wie auch nur sich es er sie wir
le la les un une des du de et ou mais ne pas est sont était sera être a ont avec pour par dans sur sous entre au aux ce cette ces qui que dont il elle nous vous ils si plus comme son sa ses leur en
el la los las un una unos del de y o pero no es son era será fue ha han con para por en sobre entre al este esta estos que quien se su sus lo como si más también cuando
il lo la i gli le un una del della dei delle di e o ma non è sono era sarà ha hanno con per da dal nel nella su tra fra al alla questo questa che chi si suo sua come se più anche quando
o a os as um uma do da dos das de e ou mas não é são era será foi tem com para por em no na nos nas sobre entre ao à este esta que quem se seu sua como mais também quando
de het een en of maar niet is zijn was wordt worden werd heeft hebben kan moet met van te voor door in op aan bij uit na over onder als dat die dit deze ook niet zich er wij zij hun
"""

#: Han characters and their iteration mark, as a character class.
_HAN = r"⺀-⿟々〇〡-〩〸-〻㐀-䶿一-鿿豈-﫿\U00020000-\U000323af"
_ENDINGS = re.compile("|".join(sorted(ENDINGS_JA.split(), key=len, reverse=True)))
_VERBAL = frozenset(VERBAL_EN.split())
_LINKING = frozenset(LINKING_EN.split())
_TONGUES = [frozenset(line.split()) for line in FUNCTION_WORDS.strip().splitlines()]
_KANA_KANJI = re.compile(rf"[ぁ-ゖァ-ヺー{_HAN}]")
_WORD = re.compile(rf"[A-Za-zÀ-ɏ]+(?:['’][a-z]+)?|\d+|[ァ-ヺー]+|[{_HAN}]+|[ぁ-ゖ]+")
_EN_WORD = re.compile(rf"(?<![A-Za-z])[A-Za-z]+(?:['’][a-z]+)?(?![A-Za-z])")
_LATIN_WORD = re.compile(r"[^\W\d_]+")
_LINE = re.compile(r"\r\n|[\n\r\v\f\x1c-\x1e\x85  ]")
_ODD_LINE = re.compile(r"[\r\v\f\x1c-\x1e\x85\u2028\u2029]")
_SENTENCE = re.compile(r"[^。．！？!?.]*(?:[。．！？!?]+|\.(?=\s|$)|\.(?!\s)|$)[」』）)\"']*")
_STOPS = frozenset("。．！？!?.:：")
#: What begins an item or a clause; such a line is not the rest of the one before.
_MARK = re.compile(r"^(?:[・●○◆◇■□▪▫◦*•\-–—+>※☐✓]|\(?[\d①-⓿]{1,3}[).:、．]|（[\d①-⓿]{1,3}）|[①-⓿]|第\d+[条章節項]|[アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワ][\s　)）.、]|[a-zA-Z][).]|[QA問答]\d*[:：.]|[\d①-⓿]{1,3}[\s　])")
_CELLS = re.compile(r"\t|[|│｜┃]|</?t[dhr][ >]|[─━├┼┤┌┬┐└┴┘═]|(?<=\S)(?: {2,}|　{2,})(?=\S)")
_CELL = re.compile(r"[\t|│｜┃<─━├┼┤┌┬┐└┴┘═]|  |　　")
_MARKUP = re.compile(r"[{}<>]|\b\w+=\S|\(cid:\d+\)|[;]\s*\w+:")
_PARAGRAPH = re.compile(r"(?:\r\n|\n|\r)\s*(?:\r\n|\n|\r)")
_BETWEEN = re.compile(r"[、，,;；/／・]")


class _Classes(dict):
    """Code point -> h hiragana, c other kana and kanji, l letter, n digit, s symbol, blank if not visible."""

    def __missing__(self, code: int) -> str:
        ch, kind = chr(code), unicodedata.category(chr(code))
        if kind[0] in "CZ" or ch.isspace():
            got = " "
        elif "ぁ" <= ch <= "ゖ":
            got = "h"
        elif _KANA_KANJI.match(ch):
            got = "c"
        else:
            got = {"L": "l", "M": "l", "N": "n"}.get(kind[0], "s")
        self[code] = got
        return got


_CLASSES = _Classes()


def _lines(text: str) -> list[str]:
    return _LINE.split(text) if _ODD_LINE.search(text) else text.split("\n")


def _ended(line: str) -> bool:
    return line.rstrip("'\"」』）)")[-1:] in _STOPS and line != ""


def _has_cells(line: str) -> bool:
    return _CELL.search(line) is not None and len(_CELLS.findall(line)) >= 2


def visible(s: str) -> int:
    """Characters that are neither blank nor control nor format characters."""
    classes = s.translate(_CLASSES)
    return len(classes) - classes.count(" ")


def is_sentence(s: str) -> bool:
    """Whether a stretch is built like a sentence of Japanese or English."""
    return sentence_length(s) > 0


def sentence_length(s: str) -> int:
    """Visible characters of a stretch that is built like a sentence, else 0."""
    classes = s.translate(_CLASSES)
    seen = len(classes) - classes.count(" ")
    if seen < 8:
        return 0
    hiragana = classes.count("h")
    kana_kanji = hiragana + classes.count("c")
    if kana_kanji * 3 >= seen:
        if hiragana < 4 or hiragana * 7 < kana_kanji or classes.count("s") * 4 >= seen:
            return 0
        covered = sum(map(len, _ENDINGS.findall(s)))
        if covered < hiragana * COVER:
            return 0
        varied = len(set(s)) * 3 >= len(s)
    else:
        words = [w.lower() for w in _EN_WORD.findall(s)]
        if not _english(s, words, seen):
            words = [w.lower() for w in _LATIN_WORD.findall(s)]
            if not _other_tongue(s, words, seen):
                return 0
        varied = len(set(words)) * 2 >= len(words)
    if any(c in s for c in "={}<>;") or "(cid:" in s:
        if len(_MARKUP.findall(s)) * 20 > seen:
            return 0
    # what repeats itself has few different pieces
    return seen if varied or len({s[i : i + 4] for i in range(len(s) - 3)}) * 2 >= len(s) - 3 else 0


def _worded(s: str, words: list[str], seen: int) -> bool:
    """Whether a stretch consists of words rather than of numbers, single letters or items."""
    if len(words) < 5 or sum(map(len, words)) * 10 < seen * 6:
        return False
    return sum(len(w) > 1 for w in words) * 10 >= len(words) * 8 and len(_BETWEEN.findall(s)) * 4 <= len(words)


def _english(s: str, words: list[str], seen: int) -> bool:
    if not _worded(s, words, seen):
        return False
    verbal = sum(w in _VERBAL for w in words)
    if (verbal + sum(w in _LINKING for w in words)) * 5 < len(words):
        return False
    return bool(verbal) or len(words) >= 9 and _ended(s.rstrip())


def _other_tongue(s: str, words: list[str], seen: int) -> bool:
    """Whether a stretch is a sentence of another language in Latin script: ended, and held together by function words of one."""
    if not _ended(s.rstrip()) or not _worded(s, words, seen):
        return False
    return any(sum(w in tongue for w in words) * 4 >= len(words) and len(tongue.intersection(words)) >= 3 for tongue in _TONGUES)


#: Share of a sentence's hiragana that endings and connectives must cover.
COVER = 0.2


def blocks(lines: Iterable[str]) -> Iterator[tuple[str, bool]]:
    """(text, whether cells) with hard line ends undone."""
    held = ""
    for line in lines:
        bare = line.strip()
        if not bare:
            if held:
                yield held, False
            held = ""
            continue
        if _has_cells(bare) and not is_sentence(_CELLS.sub(" ", bare)):
            if held:
                yield held, False
            held = ""
            yield bare, True
            continue
        if held and (_MARK.match(bare) or _ended(held)):
            yield held, False
            held = bare
        elif held:
            cjk = _KANA_KANJI.match(bare) or not held[-1].isascii()
            held += bare if cjk else " " + bare
        else:
            held = bare
    if held:
        yield held, False


def prose_share(text: str, total: int) -> float:
    """Share of the ``total`` visible characters that lie in sentences."""
    prose = 0
    for block, cells in blocks(_lines(text)):
        if cells:
            continue
        for m in _SENTENCE.finditer(block):
            if m[0]:
                prose += sentence_length(m[0])
    return prose / total


def dominant_run(text: str) -> float:
    """The largest share of the text that one repeated run of characters covers.

    Runs of 4, 8 and 16 characters are counted at every position by their
    rolling hash; the most frequent one is then counted without overlap.
    """
    n, best = len(text), 0.0
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    hashed, k = codes, 1
    while k < 16 and n > 2 * k:
        # the hash of 2k characters from those of its halves; wraps at 64 bits
        hashed = hashed[: len(hashed) - k] * np.uint64(0x9E3779B97F4A7C15) + (hashed[k:] ^ (hashed[k:] >> np.uint64(29)))
        k *= 2
        if k < 4:
            continue
        order = np.sort(hashed)
        starts = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1], [True])))
        times = np.diff(starts)
        top = times.argmax()
        if times[top] > 1 and times[top] * k > best * n:
            at = int(np.flatnonzero(hashed == order[starts[top]])[0])
            best = max(best, min(1.0, text.count(text[at : at + k]) * k / n))
    return best


def duplicate_share(parts: list[str]) -> float:
    """Share of characters in parts that occurred before."""
    total = sum(map(len, parts))
    seen: set[str] = set()
    again = 0
    for p in parts:
        if p in seen:
            again += len(p)
        seen.add(p)
    return again / total if total else 0.0


def statistics(text: str | None, common: dict[str, frozenset[str]]) -> tuple:
    """The values of ``FIELDS`` for one text."""
    classes = (text or "").translate(_CLASSES)
    seen = len(classes) - classes.count(" ")
    if not seen:
        return (0, 0, None, None, None, None, None, None, None, None, "empty")
    lines = [x.strip() for x in _lines(text)]
    lines = [x for x in lines if x]
    paragraphs = [p for p in (x.strip() for x in _PARAGRAPH.split(text)) if p] if len(lines) > 1 else lines
    words = _WORD.findall(text)
    shared = sum(n for w, n in Counter(words).items() if (_ja_common(w, common["ja"]) if "ぁ" <= w[0] <= "ゖ" else w.lower() in common["en"]))
    share = prose_share(text, seen)
    duplicate, again, dominant = duplicate_share(lines), duplicate_share(paragraphs), dominant_run(text)
    repeated = max(duplicate, again, dominant - 16 / len(text)) > 0.5  # a run's first time is no repetition; it has 16 characters at most
    cells = sum(len(x) for x in lines if _has_cells(x))
    symbols = classes.count("s") / seen
    if share >= 0.5 and not repeated:
        label = "prose"
    elif cells * 2 > sum(map(len, lines)):
        label = "table"
    elif repeated or dominant > 0.5 or symbols > 0.35 or _junk(text, lines, words, seen):
        label = "junk"
    else:
        label = "list"
    return (
        len(words), len(lines),
        sum(map(len, words)) / len(words) if words else 0.0,
        symbols,
        sum(map(_ended, lines)) / len(lines),
        shared / len(words) if words else 0.0,
        duplicate, again, dominant, share, label,
    )


@lru_cache(1 << 16)
def _ja_common(word: str, common: frozenset[str]) -> bool:
    """Whether a stretch of hiragana is or ends in a common word."""
    return any(word[-k:] in common for k in range(1, min(len(word), 6) + 1))


def _junk(text: str, lines: list[str], words: list[str], seen: int) -> bool:
    """Numbers, code, or words and letters in no order rather than items."""
    letters = sum(len(w) for w in words if not w.isdigit())
    if letters * 3 < seen or len(_MARKUP.findall(text)) * 15 > seen:
        return True
    marked = sum(bool(_MARK.match(x)) for x in lines)
    parts = len(_BETWEEN.findall(text)) + len(lines)
    # a list sets its items apart by marks, lines or commas; stretches of dozens of words without any are not items
    return marked * 2 < len(lines) and seen > 40 * parts


FIELDS = "words bigint, lines bigint, mean_word_length double, symbol_ratio double, lines_ended double, common_share double, duplicate_lines double, duplicate_paragraphs double, dominant_run double, prose_share double, label string"


def describe(df: DataFrame, id: str, text: str, common: DataFrame) -> DataFrame:
    """(id, statistics..., label), one row per row of df.

    ``common`` is (lang, word): a fixed list of words that is read whole on the
    driver; a list of more than 10 000 words is refused rather than broadcast.
    """
    rows = common.select("lang", "word").where("word is not null").limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("common_word is a list of at most 10 000 words")
    words = {lang: frozenset(r["word"] for r in rows if r["lang"] == lang) for lang in ("ja", "en")}
    names = [f.split()[0] for f in FIELDS.split(", ")]
    kinds = [{"bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}[f.split()[1]] for f in FIELDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [statistics(x.as_py(), words) for x in batch.column(1)]
            columns = [pa.array([g[i] for g in got], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *names])

    kind = dict(df.dtypes)[id]
    return spread(df.select(F.col(id).alias("id"), F.col(text).alias("text"))).mapInArrow(run, f"id {kind}, {FIELDS}")

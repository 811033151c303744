"""Byte-pair encoding with a public vocabulary.

A text is cut by the vocabulary's pattern. The bytes of a piece form a doubly
linked list of symbols (``end`` gives a symbol's successor, ``left`` its
predecessor, both by start byte). A heap holds the merge rank of adjacent pairs;
the lowest rank is merged first, and entries whose pair no longer exists are
skipped when they come up (a rank names its bytes, so an entry is stale unless
the pair at its start still has that length). A piece of n bytes takes
O(n log n), however long it is. Decoding joins the vocabulary's byte strings.

Strings of special tokens are ordinary text. Defined cases: null and empty
texts have no ids.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.storage import spread

#: Pieces up to this many characters are remembered, up to so many of them per worker.
_KEPT_CHARS, _KEPT = 48, 200_000


def vocabulary(name: str, path: str | None = None) -> tuple[str, dict[bytes, int]]:
    """(pattern, byte string -> id) of a tokenizer; path: its file of base64 strings and ids."""
    import public_tokenizers

    at = path or public_tokenizers.path(f"{name}.tiktoken")
    with open(at, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return public_tokenizers.PATTERN, ranks


def merge(piece: bytes, ranks: dict[bytes, int], length: dict[int, int]) -> list[int]:
    """Ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n, get = len(piece), ranks.get
    end = list(range(1, n + 1))  # 0 once the symbol is merged into its predecessor
    left = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        r = get(piece[i : i + 2])
        if r is not None:
            heap.append(r << 32 | i)
    heapify(heap)
    while heap:
        entry = heappop(heap)
        i = entry & 0xFFFFFFFF
        j = end[i]
        if not j or j == n or end[j] - i != length[entry >> 32]:
            continue
        e = end[j]
        end[i], end[j] = e, 0
        if e < n:
            left[e] = i
            r = get(piece[i : end[e]])
            if r is not None:
                heappush(heap, r << 32 | i)
        p = left[i]
        if p >= 0:
            r = get(piece[p:e])
            if r is not None:
                heappush(heap, r << 32 | p)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


def encoder(pattern: str, ranks: dict[bytes, int]) -> Callable[[str | None], list[int]]:
    """text -> ids; repeated short pieces are merged once."""
    find = regex.compile(pattern).findall
    length = {r: len(b) for b, r in ranks.items()}
    kept: dict[str, list[int]] = {}

    def encode(text: str | None) -> list[int]:
        ids: list[int] = []
        for piece in find(text) if text else ():
            got = kept.get(piece)
            if got is None:
                got = merge(piece.encode("utf-8", "surrogatepass"), ranks, length)
                if len(piece) <= _KEPT_CHARS:
                    if len(kept) >= _KEPT:
                        kept.clear()
                    kept[piece] = got
            ids += got
        return ids

    return encode


def decode(ids: list[int], ranks: dict[bytes, int]) -> str:
    strings = {r: b for b, r in ranks.items()}
    return b"".join(strings[i] for i in ids).decode("utf-8", "replace")


def encode_column(df: DataFrame, id: str, text: str, name: str, path: str | None = None, counts_only: bool = False) -> DataFrame:
    """(id, ids) or (id, tokens), one row per row of df.

    The vocabulary is broadcast: its file bounds it (some 50 000 entries).
    """
    spark: SparkSession = df.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary(name, path))
    kind = dict(df.dtypes)[id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*shared.value)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            offsets, flat = [0], []
            for x in texts:
                flat += encode(x.as_py())
                offsets.append(len(flat))
                if len(flat) > 8_000_000:  # one batch of very long texts must not need one very long array
                    yield _part(keys, offsets, flat, counts_only)
                    keys, offsets, flat = keys.slice(len(offsets) - 1), [0], []
            yield _part(keys, offsets, flat, counts_only)

    out = f"id {kind}, tokens bigint" if counts_only else f"id {kind}, ids array<int>"
    return spread(df.select(F.col(id).alias("id"), F.col(text).alias("text"))).mapInArrow(run, out)


def _part(keys: pa.Array, offsets: list[int], flat: list[int], counts_only: bool) -> pa.RecordBatch:
    keys = keys.slice(0, len(offsets) - 1)
    at = pa.array(offsets, pa.int32())
    if counts_only:
        import pyarrow.compute as pc

        return pa.RecordBatch.from_arrays([keys, pc.subtract(at[1:], at[:-1]).cast(pa.int64())], ["id", "tokens"])
    return pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(at, pa.array(flat, pa.int32()))], ["id", "ids"])

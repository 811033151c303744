"""Tokenizer and packing."""

import random
from collections import Counter

import pytest
import tiktoken
from pyspark.sql import functions as F

from noticeflow.llm import bpe, packing

P = pytest.importorskip("public_tokenizers")
TEXTS = ["", " ", "a", "Hello world", "支払いは検査に合格した後、適正な請求書を受理した日から31日以内に行う。", "<|endoftext|> is text", "𠮷野家​㈱ﾃﾞｰﾀ\r\n\t", "�\x00\x1f", "x" * 5000, "あ" * 3000, "don't I'll  we've   \n\n  end ", "1234567890" * 40, "🙂👩‍👩‍👧‍👦", "a\n" * 2000]


@pytest.mark.parametrize("name", ["byte_bpe_50k", "byte_bpe_multi_50k"])
def test_ids_are_the_library_s(name):
    pattern, ranks = bpe.vocabulary(name)
    encode = bpe.encoder(pattern, ranks)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    random_texts = ["".join(rng.choice("ab cé日本語かなカナ12!\n　") for _ in range(rng.randrange(200))) for _ in range(300)]
    for t in TEXTS + random_texts:
        ids = encode(t)
        assert ids == library.encode_ordinary(t)
        assert bpe.decode(ids, ranks) == t
    assert encode(None) == []


def test_merge_is_near_linear():
    import time

    _, ranks = bpe.vocabulary("byte_bpe_50k")
    length = {r: len(b) for b, r in ranks.items()}
    began = time.time()
    bpe.merge(b"ab" * 200_000, ranks, length)
    assert time.time() - began < 20


def test_encode_column(spark):
    rows = [(1, "a b", "x"), (2, None, "x"), (3, "", "x"), (1, "a b", "x"), (None, "契約", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = bpe.encode_column(df, "doc_id", "text", "byte_bpe_50k").collect()
    encode = bpe.encoder(*bpe.vocabulary("byte_bpe_50k"))
    assert sorted((r["id"] or 0, r["ids"]) for r in got) == sorted((i or 0, encode(t)) for i, t, _ in rows)
    counts = bpe.encode_column(df, "doc_id", "text", "byte_bpe_50k", counts_only=True).collect()
    assert sorted(r["tokens"] for r in counts) == sorted(len(encode(t)) for _, t, _ in rows)
    assert bpe.encode_column(df.limit(0), "doc_id", "text", "byte_bpe_50k").count() == 0


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, spaces):
        if len(spaces) >= best[0]:
            return
        if i == len(items):
            best[0] = len(spaces)
            return
        for b in {s: k for k, s in enumerate(spaces) if s >= items[i]}.values():
            spaces[b] -= items[i]
            go(i + 1, spaces)
            spaces[b] += items[i]
        spaces.append(capacity - items[i])
        go(i + 1, spaces)
        spaces.pop()

    go(0, [])
    return best[0]


def test_plans_are_whole_and_reduction_keeps_the_optimum():
    rng = random.Random(6)
    above = 0
    for _ in range(250):
        capacity = rng.choice([7, 10, 20, 31])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 10))]
        made = packing.plan(Counter(items), capacity)
        held = Counter()
        for n, contents in made:
            assert n > 0 and sum(s * k for s, k in contents) <= capacity
            for s, k in contents:
                held[s] += n * k
        assert held == Counter(items)
        h = packing._Histogram(Counter(items))
        fixed = sum(n for n, _ in packing.reduce_dominated(h, capacity))
        rest = [s for s, k in h.count.items() for _ in range(k)]
        assert fixed + fewest(rest, capacity) == fewest(items, capacity)
        above += sum(n for n, _ in made) > fewest(items, capacity)
    assert above <= 2


def test_many_copies_are_planned_at_once():
    rng = random.Random(7)
    counts = {s: rng.randrange(1, 10**7) for s in range(1, 2049)}
    made = packing.plan(counts, 2048)
    total = sum(s * n for s, n in counts.items())
    assert sum(n for n, _ in made) <= 1.01 * -(-total // 2048) and len(made) < 20_000


def test_pack(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice([None, 0, 5, 5, 5, 5, 100, 130, 700, 64, rng.randrange(1, 300)])) for i in range(2000)] + [(7, 5), (7, 700), (7, 700), (None, 64)]
    df = spark.createDataFrame(rows, "id bigint, size bigint").cache()
    got = packing.pack(df, {1: 64, 2: 256}).collect()
    for kind, capacity in ((1, 64), (2, 256)):
        mine = [r for r in got if r["container_id"] == kind]
        fill = Counter()
        for r in mine:
            if r["container"]:
                fill[r["container"]] += r["tokens"]
        assert max(fill.values()) <= capacity
        assert Counter(r["id"] for r in mine if r["container"] is None) == Counter(i for i, s in rows if not s)
        tokens = Counter()
        for r in mine:
            tokens[r["id"]] += r["tokens"]
        want = Counter()
        for i, s in rows:
            want[i] += s or 0
        assert +tokens == +want
        pieces = Counter(r["id"] for r in mine if r["container"])
        assert all(pieces[i] == 1 for i, s in rows if s and s <= capacity and sum(j == i for j, _ in rows) == 1)
        assert len(fill) <= 1.02 * -(-sum(want.values()) // capacity) + 1
    assert packing.pack(df.limit(0), {1: 64}).count() == 0 and packing.pack(df, {}).count() == 0
    assert packing.pack(df.where("size is null"), {1: 64}).where(F.col("container").isNull()).count() == sum(s is None for _, s in rows)

"""A paid judge behind a cache and a monthly budget.

The budget is sequential by nature: a pair is free if its content was judged
before, else it uses one call while the company has calls left. Two ways:

* ``plan_calls`` settles it in set operations where the cache is shared and
  every pair is new: the first pair of each content is the one that calls, it
  calls if its rank among its company's calls fits the budget, and later pairs
  of that content are hits once a call has been made.
* ``replay`` walks the pairs one after another as a loop would, for tests.

Real calls are made once: ``judge`` writes the planned pairs, calls in
``mapInPandas`` over them, and materializes the answers before anything joins
them, so that a retried task of a later stage never pays again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeflow.functions import identity, temporal
from noticeflow.storage import materialize

# Yen per million tokens in and out; calls a month.
IN_RATE, OUT_RATE, MONTHLY_CAP = 450.0, 2250.0, 50
STUB_RATE, STUB_OUT = 0.9, 200


def cost(input_tokens: Column, output_tokens: Column, cache_hit: Column) -> Column:
    return F.when(cache_hit, 0.0).otherwise((input_tokens * IN_RATE + output_tokens * OUT_RATE) / 1e6)


def billed_this_month(ledger: DataFrame, now: Column) -> DataFrame:
    """(company_id, used): judged and paid rows of the month of ``now``."""
    first, after = temporal.month_bounds(now)
    inside = (F.col("evaluated_at") >= first) & (F.col("evaluated_at") < after)
    return ledger.where((F.col("stage") == 3) & ~F.coalesce("cache_hit", F.lit(False)) & inside).groupBy("company_id").agg(F.count(F.lit(1)).alias("used"))


def stub(title: Column, spec: Column, profile: Column, score: int = 80) -> Column:
    """A deterministic verdict: struct(score, reason, summary, input_tokens, output_tokens)."""
    chars = F.length(title) + F.length(spec) + F.length(profile)
    return F.struct(F.lit(score).alias("score"), F.concat(F.lit("模擬の判定: "), F.substring(title, 1, 20)).alias("reason"), F.lit("模擬の要約").alias("summary"), F.floor(chars * STUB_RATE).cast("bigint").alias("input_tokens"), F.lit(STUB_OUT).cast("bigint").alias("output_tokens"))


def with_keys(pairs: DataFrame) -> DataFrame:
    """Adds the cut spec and the content key to (natural_key, company_id, seq, title, spec_text, profile_text)."""
    return pairs.withColumn("spec_text", F.substring("spec_text", 1, identity.SPEC_CHARS)).withColumn("cache_key", identity.cache_key(F.col("title"), F.col("spec_text"), F.col("profile_text")))


def plan_calls(pairs: DataFrame, cache: DataFrame, used: DataFrame, caps: DataFrame) -> DataFrame:
    """Adds action: hit (answered before), call (first of its content, within budget) or over (no budget).

    ``pairs`` has cache_key, company_id and a total order ``seq``; ``cache`` has
    cache_key; ``used`` (company_id, used); ``caps`` (company_id, cap). Exact
    where a content belongs to one company, as it does when the profile is part
    of it: an unaffordable first pair leaves every later one of its content
    unaffordable too, since a month's count never falls.
    """
    known = cache.select("cache_key").distinct().withColumn("known", F.lit(True))
    seen = pairs.join(known, "cache_key", "left")
    order = Window.partitionBy("cache_key").orderBy("seq")
    seen = seen.withColumn("first", F.col("known").isNull() & (F.row_number().over(order) == 1))
    firsts = seen.where("first").select("cache_key", "company_id", "seq")
    # only firsts are ranked: pairs of the same content were collapsed before the window by company
    ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("company_id").orderBy("seq")))
    budget = ranked.join(used, "company_id", "left").join(caps, "company_id", "left")
    paid = budget.select("cache_key", (F.col("rank") + F.coalesce("used", F.lit(0)) <= F.coalesce("cap", F.lit(MONTHLY_CAP))).alias("paid"))
    joined = seen.join(paid, "cache_key", "left")
    action = F.when(F.col("known"), "hit").when(~F.col("paid"), "over").when(F.col("first"), "call").otherwise("hit")
    return joined.withColumn("action", action).drop("known", "first", "paid")


def replay(rows: Iterable[tuple[str, str]], cached: set[str], used: dict[str, int], caps: dict[str, int]) -> list[str]:
    """The same, one (cache_key, company_id) after another."""
    cached, used, out = set(cached), dict(used), []
    for key, company in rows:
        if key in cached:
            out.append("hit")
        elif used.get(company, 0) >= caps.get(company, MONTHLY_CAP):
            out.append("over")
        else:
            used[company] = used.get(company, 0) + 1
            cached.add(key)
            out.append("call")
    return out


#: (title, spec, profile) -> {score, reason, summary, input_tokens, output_tokens}
Client = Callable[[str, str, str], dict]
_ANSWER = "cache_key string, response_json string, input_tokens bigint, output_tokens bigint"


def slice_json(text: str) -> dict:
    """The object between the first and the last brace of an answer."""
    a, b = text.find("{"), text.rfind("}")
    if a < 0 or b < a:
        raise ValueError("no JSON object in the answer")
    return json.loads(text[a : b + 1])


#: What a remote judge is asked; the answer's form is fixed, the wording is ours.
PROMPT = """公共調達の案件が、次の事業者に関係するかを判定してください。

事業者:
{profile}

案件名:
{title}

仕様書の抜粋:
{spec}

仕様書にない条件は補わず「記載なし」としてください。次の形のJSONだけを返してください。
{{"score": 0から100の整数, "reason": "一、二文の理由", "summary": "三行から五行の要約"}}
"""


def remote(ask: Callable[[str], tuple[str, int, int]]) -> Client:
    """A client from a function prompt -> (answer, input tokens, output tokens), whatever service is behind it."""

    def client(title: str, spec: str, profile: str) -> dict:
        answer, read, written = ask(PROMPT.format(profile=profile, title=title, spec=spec))
        body = slice_json(answer)
        return {"score": int(body["score"]), "reason": str(body["reason"]), "summary": str(body["summary"]), "input_tokens": read, "output_tokens": written}

    return client


def call(planned: DataFrame, client: Client) -> DataFrame:
    """Answers of the planned calls, each made once and kept before use."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [client(t, s, p) for t, s, p in zip(pdf["title"], pdf["spec_text"], pdf["profile_text"], strict=True)]
            body = [json.dumps({k: g[k] for k in ("score", "reason", "summary")}, ensure_ascii=False) for g in got]
            yield pd.DataFrame({"cache_key": pdf["cache_key"], "response_json": body, "input_tokens": [g["input_tokens"] for g in got], "output_tokens": [g["output_tokens"] for g in got]})

    asked = materialize(planned.where("action = 'call'").select("cache_key", "title", "spec_text", "profile_text"))
    return materialize(asked.mapInPandas(run, _ANSWER))


def judge(pairs: DataFrame, cache: DataFrame, used: DataFrame, caps: DataFrame, client: Client) -> tuple[DataFrame, DataFrame]:
    """(verdicts of the pairs that have one, the cache with new answers and hit counts)."""
    planned = materialize(plan_calls(with_keys(pairs), cache, used, caps))
    answers = call(planned, client)
    every = cache.select("cache_key", "response_json", "input_tokens", "output_tokens").unionByName(answers)
    said = F.from_json("response_json", "score int, reason string, summary string")
    hit = F.col("action") == "hit"
    verdicts = planned.where("action <> 'over'").join(every, "cache_key").select(
        "natural_key", "company_id", said["score"].alias("verdict_score"), said["reason"].alias("reason"), said["summary"].alias("summary"),
        "input_tokens", "output_tokens", hit.alias("cache_hit"), cost(F.col("input_tokens"), F.col("output_tokens"), hit).alias("cost_jpy"),
    )
    hits = planned.where(hit).groupBy("cache_key").agg(F.count(F.lit(1)).alias("hits"))
    after = cache.select("cache_key", "response_json", "input_tokens", "output_tokens", "hit_count").unionByName(answers.withColumn("hit_count", F.lit(0).cast("bigint")))
    return verdicts, after.join(hits, "cache_key", "left").withColumn("hit_count", F.col("hit_count") + F.coalesce("hits", F.lit(0))).drop("hits")



"""Tenders against company profiles: rules, title similarity, cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeflow.functions.money import in_range
from noticeflow.functions.text import keyword_hits, match_form, nfkc

STRICT, RELAXED = 0.25, 0.08
NOTIFY_SCORE, KEYWORD_SCORE = 60, 50
SEPARATORS = r"(?U)[\s　,、。・/／\-−ー()（）\[\]【】]+"

#: Broadcasting profiles is a decision of the optimizer by their measured size; there is no hint here.
PROFILE = "company_id string, categories array<string>, prefectures array<string>, qualifications array<string>, keywords array<string>, ng_keywords array<string>, price_min bigint, price_max bigint"


def profiles_with_forms(profiles: DataFrame) -> DataFrame:
    """Adds the match forms of both keyword lists and the comparison corpus (categories, then keywords)."""
    empty = F.expr("cast(array() as array<string>)")
    lists = {c: F.coalesce(F.col(c), empty) for c in ("categories", "prefectures", "keywords", "ng_keywords")}
    listed = profiles.withColumns(lists)
    joined = "\u0001"
    # each list crosses into Python once, joined by a character that NFKC leaves alone
    forms = {f"{c}_form": F.when(F.size(c) > 0, F.split(match_form(F.array_join(c, joined)), joined)).otherwise(empty) for c in ("keywords", "ng_keywords")}
    return listed.withColumns(forms).withColumn("corpus", F.concat("categories", "keywords"))


def stage_one(pairs: DataFrame) -> DataFrame:
    """Adds hard_excluded, keyword_hit, matched_keywords, promote to (title_form, amount, prefecture_code, profile columns).

    A keyword that excludes decides alone; area and price exclude only where both
    sides are known; a keyword hit is never needed to go on.
    """
    ng = F.size(keyword_hits(F.col("title_form"), F.col("ng_keywords_form"))) > 0
    hit = F.filter("keywords", lambda k, i: F.contains(F.col("title_form"), F.get(F.col("keywords_form"), i)))
    area = (F.size("prefectures") == 0) | F.col("prefecture_code").isNull() | F.array_contains("prefectures", F.col("prefecture_code"))
    out = pairs.withColumns({"hard_excluded": ng, "matched_keywords": F.when(~ng, hit).otherwise(F.expr("cast(array() as array<string>)"))})
    out = out.withColumn("keyword_hit", F.size("matched_keywords") > 0)
    return out.withColumn("promote", ~F.col("hard_excluded") & area & in_range(F.col("amount"), F.col("price_min"), F.col("price_max")))


def bigrams(form: Column) -> Column:
    """Array of the two-character pieces of a text in match form without separators; a single character is its own piece."""
    s = F.regexp_replace(F.coalesce(form, F.lit("")), SEPARATORS, "")
    n = F.length(s)
    many = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(s, i, F.lit(2)))
    return F.when(n >= 2, many).when(n == 1, F.array(s)).otherwise(F.expr("cast(array() as array<string>)"))


def grams(texts: DataFrame, id: str, form: str, copies: Column | None = None) -> DataFrame:
    """(id, gram, n, norm2): counts of each text's pieces and its squared norm; rows of one id are one text.

    The norm comes from the counts gathered per id, not from a join of the pieces
    with themselves, whose sides a planner takes for as small as the titles' files.
    """
    times = F.lit(1).cast("bigint") if copies is None else copies
    pieces = texts.select(F.col(id).alias("id"), times.alias("times"), F.explode(bigrams(F.col(form))).alias("gram"))
    counted = pieces.groupBy("id", "gram").agg(F.sum("times").alias("n"))
    whole = counted.groupBy("id").agg(F.collect_list(F.struct("gram", "n")).alias("g"), F.sum(F.col("n") * F.col("n")).alias("norm2"))
    return whole.select("id", F.explode("g").alias("g"), "norm2").select("id", "g.gram", "g.n", "norm2")


def similarity(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left, right, score) of all pairs that share a piece; the dot product is whole, so the score is bit-stable.

    An equi-join on the pieces: pairs without one in common (score 0) never exist as
    rows. It is a merge join, so neither side passes through the driver.
    """
    a = left.select(F.col("id").alias("left"), "gram", F.col("n").alias("na"), F.col("norm2").alias("ia"))
    b = right.select(F.col("id").alias("right"), "gram", F.col("n").alias("nb"), F.col("norm2").alias("ib"))
    met = a.hint("merge").join(b, "gram").repartition("left")  # what follows groups by the left side
    dot = met.groupBy("left", "right").agg(F.sum(F.col("na") * F.col("nb")).alias("dot"), F.first("ia").alias("ia"), F.first("ib").alias("ib"))
    return dot.select("left", "right", (F.col("dot") / (F.sqrt(F.col("ia").cast("double")) * F.sqrt(F.col("ib").cast("double")))).alias("score"))


def _most_similar(titles: DataFrame, profiles: DataFrame) -> DataFrame:
    """(natural_key, _two): each title's most similar corpus entry per company as an array of (company_id, score, best_match).

    Titles that read the same are compared once: a key stands for its forms with
    their counts, under 128 bits of their hash, so a long title is not repeated
    beside each of its pieces.
    """
    counted = titles.where("natural_key is not null").groupBy("natural_key", "title_form").agg(F.count(F.lit(1)).alias("copies"))
    keyed = counted.groupBy("natural_key").agg(F.array_sort(F.collect_list(F.struct("title_form", "copies"))).alias("forms"))
    keyed = keyed.withColumn("wording", F.unhex(F.substring(F.sha2(F.to_json("forms"), 256), 1, 32)))
    wordings = keyed.groupBy("wording").agg(F.first("forms").alias("forms")).select("wording", F.explode("forms").alias("f")).select("wording", "f.*")
    entries = profiles.select("company_id", F.posexplode("corpus").alias("at", "entry"))
    forms = entries.withColumn("form", match_form(F.col("entry"))).withColumn("e", F.struct("company_id", "at", "entry"))
    scored = similarity(grams(wordings, "wording", "title_form", F.col("copies")), grams(forms, "e", "form"))
    best = F.max(F.struct(F.col("score"), (-F.col("right.at")).alias("first"), F.col("right.entry").alias("entry"))).alias("b")
    each = scored.groupBy(F.col("left").alias("wording"), F.col("right.company_id").alias("company_id")).agg(best)
    found = each.groupBy("wording").agg(F.collect_list(F.struct("company_id", F.col("b.score").alias("score"), F.col("b.entry").alias("best_match"))).alias("_two"))
    return keyed.select("natural_key", "wording").hint("merge").join(found, "wording").select("natural_key", "_two")


def stage_two(titles: DataFrame, profiles: DataFrame) -> DataFrame:
    """(natural_key, company_id, score, best_match): the most similar corpus entry, the first of equal ones.

    Profiles without corpus, and pairs without any common piece, are absent:
    ``cascade`` reads them as score 0. Rows of one key are one text; null keys are out.
    """
    return _most_similar(titles, profiles).select("natural_key", F.explode("_two").alias("t")).select("natural_key", "t.*")


def rule_score(keyword_hit: Column, score: Column) -> Column:
    return F.greatest(F.when(keyword_hit, KEYWORD_SCORE).otherwise(0), F.floor(score * 100).cast("int"))


def pair_up(tenders: DataFrame, profiles: DataFrame) -> DataFrame:
    """Every tender beside every profile: profiles are exploded into each tender row from one bounded list.

    A tender row carries all profiles through one array, whose size is checked:
    beyond ``LARGEST_LIST`` profiles the plan would be a cross join, so it is refused;
    split the profiles and run once per part.
    """
    listed = profiles.limit(LARGEST_LIST + 1).collect()
    if len(listed) > LARGEST_LIST:
        raise ValueError(f"more than {LARGEST_LIST} profiles in one pass")
    names = profiles.schema.names
    if not listed:
        return tenders.limit(0).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in profiles.schema])
    array = F.array(*[F.struct(*[F.lit(v).cast(profiles.schema[n].dataType).alias(n) if not isinstance(v, list) else F.array(*[F.lit(x) for x in v]).cast(profiles.schema[n].dataType).alias(n) for n, v in zip(names, row, strict=True)]) for row in listed])
    return tenders.withColumn("_p", F.explode(array)).select(*tenders.columns, *[F.col(f"_p.{n}").alias(n) for n in names])


LARGEST_LIST = 200


def cascade(tenders: DataFrame, profiles: DataFrame, with_judge: bool) -> DataFrame:
    """Decisions of stages one and two for every tender and profile.

    ``tenders``: natural_key, title, amount, prefecture_code, spec_text. Rows
    that a judge should read have ``to_judge``; they are a filter of this frame,
    so nothing else reaches the judge's Python workers.
    """
    formed = profiles_with_forms(profiles)
    titled = tenders.withColumn("title_form", F.lower(nfkc(F.col("title"))))
    # tenders meet stage two before they are multiplied by the profiles, and neither passes through the driver
    beside = titled.hint("merge").join(_most_similar(titled, formed), "natural_key", "left")
    one = stage_one(pair_up(beside, formed))
    two = F.get(F.filter("_two", lambda t: t["company_id"] == F.col("company_id")), F.lit(0))
    joined = one.withColumns({"score": two["score"], "best_match": two["best_match"]})
    score = F.coalesce(F.col("score"), F.lit(0.0))
    has_spec = F.col("spec_text").isNotNull() & F.lit(with_judge)
    passed = (F.size("corpus") == 0) | (score >= F.when(has_spec, RELAXED).otherwise(STRICT))
    hit, promoted = F.col("keyword_hit"), F.col("promote")
    staged = joined.withColumns({"similarity": score, "promote_2": promoted & passed}).withColumn("to_judge", F.col("promote_2") & has_spec)
    stage = F.when(~promoted, 1).otherwise(2)
    points = F.when(F.col("hard_excluded"), 0).when(~promoted, F.when(hit, KEYWORD_SCORE).otherwise(0)).otherwise(rule_score(hit, F.col("similarity")))
    by = F.when(F.col("hard_excluded"), "none").when(hit, "rule").when(promoted, "vector").otherwise("none")
    return staged.withColumn("reason", _reason(stage)).select(
        "natural_key", "company_id", "title", "reason", "spec_text", stage.alias("stage"), points.cast("int").alias("score"), by.alias("matched_by"),
        (~F.col("hard_excluded") & (hit | F.col("promote_2"))).alias("should_notify"), "keyword_hit", "matched_keywords", F.col("similarity"), "best_match", "to_judge",
    )


def _reason(stage: Column) -> Column:
    """Why a pair stands where it stands, in words."""
    excluding = F.filter("ng_keywords", lambda k, i: F.contains(F.col("title_form"), F.get(F.col("ng_keywords_form"), i)))
    outside = ~((F.size("prefectures") == 0) | F.col("prefecture_code").isNull() | F.array_contains("prefectures", F.col("prefecture_code")))
    parts = F.concat_ws(
        "; ",
        F.when(F.col("keyword_hit"), F.concat(F.lit("キーワード一致: "), F.array_join("matched_keywords", "/"))),
        F.when(outside, F.concat(F.lit("対応エリア外: "), F.col("prefecture_code"))),
        F.when(~in_range(F.col("amount"), F.col("price_min"), F.col("price_max")), F.concat(F.lit("金額レンジ外: "), F.col("amount").cast("string"))),
    )
    rules = F.when(F.col("hard_excluded"), F.concat(F.lit("NGキーワード: "), F.array_join(excluding, "/"))).otherwise(F.coalesce(F.nullif(parts, F.lit("")), F.lit("条件に該当せず")))
    similar = F.concat(F.format_string("; 案件名類似度 %.2f", "similarity"), F.coalesce(F.concat(F.lit("（"), F.col("best_match"), F.lit("）")), F.lit("")), F.when(F.col("promote_2"), "").otherwise(" < 閾値"), F.when(F.col("spec_text").isNull(), " / 仕様書テキストなし").otherwise(""))
    return F.when(stage == 1, rules).otherwise(F.concat(rules, similar))


def apply_verdicts(decided: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Decisions with the judge's verdicts (natural_key, company_id, verdict_score, input_tokens, output_tokens, cache_hit, cost_jpy).

    A keyword hit is never lost to a verdict; a pair without one (no budget) keeps its decision.
    """
    joined = decided.join(verdicts, ["natural_key", "company_id"], "left")
    v, hit = F.col("verdict_score"), F.col("keyword_hit")
    judged = v.isNotNull()
    return joined.withColumns(
        {
            "stage": F.when(judged, 3).otherwise(F.col("stage")),
            "score": F.when(judged, F.greatest(v, F.when(hit, KEYWORD_SCORE).otherwise(0))).otherwise(F.col("score")).cast("int"),
            "matched_by": F.when(judged, "llm").otherwise(F.col("matched_by")),
            "should_notify": F.when(judged, (v >= NOTIFY_SCORE) | hit).otherwise(F.col("should_notify")),
            "llm_overridden": judged & hit & (v < NOTIFY_SCORE),
            "cost_jpy": F.coalesce(F.col("cost_jpy"), F.lit(0.0)),
        }
    )


def record(results: DataFrame, new: DataFrame, order: str) -> DataFrame:
    """Latest row per tender and company wins; feedback of the replaced row is kept."""
    both = results.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in results.columns if c not in ("natural_key", "company_id", "feedback")]
    by = both.groupBy("natural_key", "company_id").agg(F.max_by(F.struct(*rest), F.struct("_new", order)).alias("r"), F.max_by("feedback", F.when(F.col("feedback").isNotNull(), F.struct("_new", order))).alias("feedback"))
    return by.select("natural_key", "company_id", "r.*", "feedback").select(*results.columns)


def funnel(results: DataFrame) -> DataFrame:
    """One row per company: how far its tenders went and what that cost."""
    at = F.col("stage")
    got = results.groupBy("company_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(at >= 2).alias("stage_2"), F.count_if(at >= 3).alias("stage_3"),
        F.count_if((at == 3) & ~F.coalesce("cache_hit", F.lit(False))).alias("billed"), F.count_if((at == 3) & F.coalesce("cache_hit", F.lit(False))).alias("cache_hits"),
        F.coalesce(F.sum("cost_jpy"), F.lit(0.0)).alias("cost_jpy"), F.count_if("should_notify").alias("notified"),
    )
    return got.withColumn("stage_3_ratio", F.coalesce(F.try_divide(F.col("stage_3"), F.col("total")), F.lit(0.0)))


def profile_text() -> Column:
    """The profile as the judge reads it."""
    lines = [F.concat(F.lit(f"{label}: "), F.when(F.coalesce(F.size(c), F.lit(0)) > 0, F.array_join(c, "、")).otherwise("指定なし")) for label, c in (("業種・営業品目", "categories"), ("対応エリア", "prefectures"), ("保有資格", "qualifications"), ("注目キーワード", "keywords"))]
    bound = F.when(F.col("price_min").isNotNull() | F.col("price_max").isNotNull(), F.concat(F.lit("対応可能金額: "), F.coalesce(F.col("price_min").cast("string"), F.lit("None")), F.lit("〜"), F.coalesce(F.col("price_max").cast("string"), F.lit("None"))))
    return F.concat_ws("\n", *lines, bound)


def load_profiles(companies: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profiles of known companies with their monthly cap; list columns may come as JSON text."""
    lists = {c: F.from_json(c, "array<string>") for c in ("categories", "prefectures", "qualifications", "keywords", "ng_keywords") if dict(profiles.dtypes)[c] == "string"}
    return profiles.withColumns(lists).join(companies.select(F.col("id").alias("company_id"), "llm_monthly_cap"), "company_id")

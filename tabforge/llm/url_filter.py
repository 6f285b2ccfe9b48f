"""URL filter: ratio of two character language models.

URLs that an allow or a block rule fits train one smoothed variable-order
Markov model each (orders 0 to ``ORDER``, every order interpolated with the
next shorter context, Witten-Bell weights). A URL is judged by the difference
of both models' log-likelihoods per character; the cut is calibrated on the
training scores. Only DataFrame functions: n-grams are exploded from distinct
URLs, counted by partial aggregation and joined with sharded model tables.

Rules have a host and a path prefix; a rule fits its host and all subdomains.
The longest fitting rule (host and path together) wins.

Defined cases: a null URL, or one without ``://``, has empty host and path,
fits no rule and is judged by the model (null as an empty string);
repeated rows are judged alike; without accepted or rejected URLs every score
is 0 and the verdict allow; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import handed_off

#: (verdict, host, path prefix)
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
ORDER = 4
#: characters of the uniform model below order 0
ALPHABET = 256
#: accuracy of the approximate quantiles used for the calibration
ACCURACY = 10_000
#: share of accepted training URLs that the cut may reject
REJECT_ACCEPTED = 0.01


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """One row per distinct (url, context + character of one order) and its count.

    The URL gets one start mark for every context character, so each of its
    characters, and the end mark, has a full context."""
    padded = F.concat(F.lit("\u0002" * order), F.col("url"), F.lit("\u0003"))
    return urls.select("*", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("url") + 1),
        lambda i: F.substring(padded, i, F.lit(order + 1)))).alias("gram"))


def _model(urls: DataFrame, order: int) -> DataFrame:
    """(gram, p_allow, p_block): probability of a gram's last character after
    the others. ``urls`` are all URLs: those without a verdict add no count,
    only the grams that will be asked for, so each has a probability at every
    order and an unseen context falls to the shorter one."""
    def n(verdict: str) -> Column:
        return F.sum(F.when(F.col("verdict") == verdict, F.col("n")).otherwise(0)).alias(verdict)

    counts = handed_off(_grams(urls, order).groupBy("gram").agg(n("allow"), n("block")), "url-counts")
    probs = None
    for k in range(order + 1):
        at = counts.groupBy(F.substring("gram", order + 1 - k, k + 1).alias("g")) \
            .agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).withColumn("ctx", F.expr(f"left(g, {k})"))
        ctx = at.groupBy("ctx").agg(*[x for c in ("allow", "block") for x in (
            F.sum(c).alias(f"t_{c}"), F.sum((F.col(c) > 0).cast("long")).alias(f"d_{c}"))])
        at = at.join(ctx, "ctx")
        if probs is None:
            at = at.withColumns({f"low_{c}": F.lit(1.0 / ALPHABET) for c in ("allow", "block")})
        else:
            lower = probs.select(F.col("g").alias("shorter"), F.col("p_allow").alias("low_allow"),
                                 F.col("p_block").alias("low_block"))
            at = at.withColumn("shorter", F.substring("g", 2, k)).join(lower, "shorter")
        probs = at.select("g", *[
            F.when(F.col(f"t_{c}") > 0, (F.col(c) + F.col(f"d_{c}") * F.col(f"low_{c}"))
                   / (F.col(f"t_{c}") + F.col(f"d_{c}"))).otherwise(F.col(f"low_{c}")).alias(f"p_{c}")
            for c in ("allow", "block")])
    return probs.withColumnRenamed("g", "gram")


def scores(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """(url, verdict, n, score): log-likelihood difference a character, the
    accepted model less the rejected one, of distinct URLs (url, verdict, n)."""
    model = handed_off(_model(urls, order), "url-model")
    return _grams(urls, order).join(model, "gram").groupBy("url", "verdict", "n").agg(
        (F.sum(F.log("p_allow") - F.log("p_block")) / F.count(F.lit(1))).alias("score"))


def cut_of(scored: DataFrame) -> float | None:
    """The calibrated cut, None without accepted or rejected training URLs.

    Between the classes where they are apart; else it rejects at most
    ``REJECT_ACCEPTED`` of the accepted training URLs."""
    row = scored.agg(
        F.percentile_approx(F.when(F.col("verdict") == "allow", F.col("score")), REJECT_ACCEPTED, ACCURACY).alias("a"),
        F.percentile_approx(F.when(F.col("verdict") == "block", F.col("score")), 1 - REJECT_ACCEPTED, ACCURACY)
        .alias("b")).first()
    if row.a is None or row.b is None:
        return None
    return (row.a + row.b) / 2 if row.a > row.b else row.a


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, order: int = ORDER) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's score of every page."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    seen = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    seen = seen.select("*", rule.alias("rule"), verdict.alias("given"))
    urls = handed_off(seen.groupBy("url").agg(F.first("given").alias("verdict"), F.count(F.lit(1)).alias("n")), "urls")
    scored = handed_off(scores(urls, order).select("url", "score", "verdict"), "url-scores")
    cut = cut_of(scored)
    said = F.lit("allow") if cut is None else F.when(F.col("score") < cut, "block").otherwise("allow")
    return seen.join(scored.select("url", "score"), "url").select(
        "page_id", "host", "path", "rule", F.coalesce("given", said).alias("verdict"),
        (F.lit(0.0) if cut is None else F.col("score")).alias("score"))

import math
import re
from collections import Counter

import pytest

from llm_helpers import SF, by_id
from tabforge.llm import url_filter as U


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")


def rule(host, path):
    fit = [(len(h + p), h + p, k) for k, h, p in U.RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def brute_scores(rows, order):
    """{url: score} by counting contexts directly."""
    urls = Counter(u or "" for u in rows)
    verdict = {u: rule(*parts(u))[1] for u in urls}
    models = {}
    for kind in ("allow", "block"):
        count = Counter()
        for u, n in urls.items():
            if verdict[u] == kind:
                s = "\x02" * order + u + "\x03"
                for i in range(order, len(s)):
                    for k in range(order + 1):
                        count[s[i - k:i + 1]] += n
        total, kinds = Counter(), Counter()
        for g, n in count.items():
            total[len(g), g[:-1]] += n
            kinds[len(g), g[:-1]] += 1
        models[kind] = (count, total, kinds)

    def p(model, g):
        count, total, kinds = model
        low = 1 / U.ALPHABET if len(g) == 1 else p(model, g[1:])
        t, d = total[len(g), g[:-1]], kinds[len(g), g[:-1]]
        return (count[g] + d * low) / (t + d) if t else low

    out = {}
    for u in urls:
        s = "\x02" * order + u + "\x03"
        grams = [s[i - order:i + 1] for i in range(order, len(s))]
        out[u] = sum(math.log(p(models["allow"], g) / p(models["block"], g)) for g in grams) / len(grams)
    return out


AWKWARD = [None, "", "no scheme", "HTTP://WWW.Example.COM/en/1", "http://example.com", "http://example.com/en/x?y#z",
           "https://a.example.com/en/#q", "http://www.example.com/en/2", "http://deep.www.example.com/en/3",
           "http://x.net/es/1", "http://x.net/fr/", "http://x.net/en/1", "http://net/es/", "http://xnet/es/",
           "x://a.com?u=http://b.net/es/", "http://été.org/\U0001f600", "http://x.org/" + "ab/" * 3000,
           "http://notexample.com/en/1", "http://m.com#/x", "://", "http:///en/"]


@pytest.mark.parametrize("order", [2, 4])
def test_against_brute_force(spark, order):
    urls = AWKWARD + ["http://hot.net/es/5"] * 40 + [f"http://s{i}.example.com/en/{i}" for i in range(20)] + [
        f"http://www.example.com/en/{i}" for i in range(20)]
    rows = [(i if i else None, u, "score", i) for i, u in enumerate(urls)] + [(3, urls[3], "score", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string, n long").repartition(3)
    want = brute_scores([r[1] for r in rows], order)
    got = U.judge(pages, order=order).collect()
    assert by_id([(r.page_id, r.host, r.path, r.rule) for r in got]) == by_id(
        [(i, *parts(u), rule(*parts(u))[0]) for i, u, *_ in rows])
    url = {r[0]: r[1] or "" for r in rows}
    given = {i: rule(*parts(u))[1] for i, u in url.items()}
    for r in got:
        assert math.isclose(r.score, want[url[r.page_id]], rel_tol=1e-9, abs_tol=1e-12)
        assert r.verdict == given[r.page_id] if given[r.page_id] else r.verdict in ("allow", "block")
    free = [(r.score, r.verdict) for r in got if given[r.page_id] is None]
    assert max([s for s, v in free if v == "block"], default=-1e9) < min(s for s, v in free if v == "allow")


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = U.judge(pages)
    assert got.count() == pages.count() and got.filter("verdict is null").count() == 0


def test_without_training_urls_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    assert {(r.verdict, r.score) for r in U.judge(pages).collect()} == {("allow", 0.0)}
    assert U.judge(pages.limit(0)).count() == 0


def test_model_tells_classes_apart(spark):
    rows = [(i, f"http://s{i}.example.com/en/{i}") for i in range(300)] + [
        (1000 + i, f"http://b{i}.com/de/{i}") for i in range(300)] + [
        (2000 + i, f"http://s{i}.example.org/en/{i}") for i in range(50)] + [
        (3000 + i, f"http://b{i}.org/de/{i}") for i in range(50)]
    out = {r.page_id: r.verdict for r in U.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert sum(out[2000 + i] == "block" for i in range(50)) > 45
    assert sum(out[3000 + i] == "allow" for i in range(50)) > 45

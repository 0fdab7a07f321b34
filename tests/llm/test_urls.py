"""URL verdicts against the same model in plain Python."""

import math
import random
from collections import Counter

from cohortloom.llm import urls

RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"))


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = "".join(c.lower() if c < "\x80" else c for c in rest[:end]), rest[end:]
    return host, tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, default=(0, None, None))[1:]


def corpus():
    rng = random.Random(6)
    hosts = ["www.example.com", "a.example.com", "spam.net", "news.org", "Shop.COM", "x.y.net"]
    pages = [(i, f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr'])}/{rng.randrange(60)}{rng.choice(['', '?q=1', '#t'])}") for i in range(400)]
    odd = [None, "", "no scheme", "http://", "http://com", "http://com/", "x://A.Com?b/", "http://net/es/é#?", "a://b://c/d", "ftp://notexample.com/en/"]
    return pages + [(1000 + k, u) for k, u in enumerate(odd)] + [(3, pages[3][1]), (None, pages[0][1])]


def test_hosts_rules_and_model(spark):
    pages = corpus()
    df = spark.createDataFrame(pages, "page_id bigint, url string")
    rows = urls.judge(df, RULES).collect()
    found = {r.page_id: r for r in rows}
    assert len(rows) == len(pages)
    held = {(r.host, r.path) for r in df.select(*(c.alias(n) for c, n in zip(urls.host_and_path("url"), ("host", "path"), strict=True))).selectExpr("*", "pmod(xxhash64(host, path), 5) = 0 AS held").filter("held").collect()}
    counts = {"allow": Counter(), "block": Counter()}
    grams = {}
    for _, url in pages:
        host, path = parts(url)
        text = "\x02" * urls.CONTEXT + host + path + "\x03"
        grams[(host, path)] = [text[i : i + urls.CONTEXT + 1] for i in range(len(text) - urls.CONTEXT)]
        verdict = rule_of(host, path)[1]
        if verdict and (host, path) not in held:
            for gram in grams[(host, path)]:
                for k in range(urls.CONTEXT + 1):
                    counts[verdict][gram[urls.CONTEXT - k :]] += 1
                    counts[verdict]["context", k, gram[urls.CONTEXT - k : -1]] += 1

    def log_p(verdict, gram):
        p = 1 / urls.ALPHABET
        for k in range(urls.CONTEXT + 1):
            run = gram[urls.CONTEXT - k :]
            p = (counts[verdict][run] + urls.WEIGHT * p) / (counts[verdict]["context", k, run[:-1]] + urls.WEIGHT)
        return math.log(p)

    scores = {}
    for url, runs in grams.items():
        scores[url] = sum(log_p("allow", g) - log_p("block", g) for g in runs) / len(runs)
    decided = {True: [], False: []}
    for page, url in pages:
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        r = found[page]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if rule:
            assert r.verdict == verdict and r.score is None
        else:
            assert abs(r.score - scores[(host, path)]) < 1e-9
            decided[r.verdict == "allow"].append(r.score)
    assert min(decided[True]) > max(decided[False])


def test_empty_and_without_training(spark):
    schema = "page_id bigint, url string"
    assert urls.judge(spark.createDataFrame([], schema), RULES).count() == 0
    (row,) = urls.judge(spark.createDataFrame([(1, None)], schema), RULES).collect()
    assert (row.host, row.path, row.rule, row.verdict, row.score) == ("", "", None, "allow", 0.0)

import re
from collections import Counter
from itertools import combinations

from firmlens.llm import url_rules as U

URLS = [
    None, "", "no scheme", "http://", "https://A.Example.ORG/es/1?x=1", "http://example.org/en/12", "http://example.org/en/2#f",
    "http://org/", "http://org", "http://xorg/", "http://a.b.com/fr/x", "http://com/de/", "http://evilcom/de/", "http://x.net/a://b.org/",
    "ftp://h?q/p", "http://h#f/p?q", "http://É.com/de/ü", "http://a.org\n/x", "://example.org/es/",
]


def plain_judge(url, rules=U.LISTED):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    m = re.match(r"(?s)([^/?#]*)([^?#]*)", rest)
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1])
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and m[2].startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, m[2], best and best[1] + best[2], best and best[0]


def plain_tokens(url):
    host, path, _, _ = plain_judge(url)
    m = re.match(r"(?s)[^?#]*\?([^#]*)", url or "")
    keys = [x.split("=")[0] for x in (m[1] if m else "").split("&")]
    return {"h:" + x for x in host.split(".") if x} | {"p:" + x for x in path.split("/") if x} | {"q:" + x for x in keys if x}


def test_hosts_paths_and_listed_rules(spark):
    pages = spark.createDataFrame([(k, u, "own", "own", "own") for k, u in enumerate(URLS)], "page_id long, url string, host string, rule string, needs string")
    got = U.judge_urls(pages, min_support=1.0).select("doc.page_id", "host", "path", "rule", "verdict").collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path, rule, verdict = plain_judge(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or "allow")


def test_tokens(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(u,) for u in URLS if u is not None], "url string").select("url", U.url_tokens(F.col("url")).alias("t"))
    assert all(set(r.t) == plain_tokens(r.url) and len(set(r.t)) == len(r.t) for r in df.collect())


def test_mined_rules_and_verdicts_by_hand(spark):
    urls = [f"http://{h}.{t}/{p}/{k}" for k in range(3) for h in ("a", "b") for t in ("com", "org", "net") for p in ("de", "fr", "es")]
    rules = (("block", "com", "/de/"), ("allow", "com", "/fr/"), ("block", "org", "/es/"), ("block", "org", "/de/"))
    least, sure = 0.15, 0.9
    labelled = [(plain_tokens(u), plain_judge(u, rules)[3]) for u in urls if plain_judge(u, rules)[3]]
    mined = {}
    for n in range(1, 6):
        for needs in {c for t, _ in labelled for c in combinations(sorted(t), n)}:
            seen = Counter(v for t, v in labelled if set(needs) <= t)
            for v, k in seen.items():
                if k >= least * len(labelled) and k / seen.total() >= sure:
                    mined[needs, v] = (k / seen.total(), k / len(labelled), n, v)
    pages = spark.createDataFrame([(u,) for u in urls], "url string").repartition(3)
    got = U.judge_urls(pages, rules=rules, min_support=least, min_confidence=sure).select("doc.url", "verdict").collect()
    assert len(got) == len(urls)
    for r in got:
        best = max((m for (needs, _), m in mined.items() if set(needs) <= plain_tokens(r.url)), default=None)
        assert r.verdict == (plain_judge(r.url, rules)[3] or (best and best[3]) or "allow")
    assert any(plain_judge(r.url, rules)[3] is None and r.verdict == "block" for r in got)


def test_empty_and_repeated(spark):
    pages = spark.createDataFrame([(1, "http://com/de/x")] * 3 + [(None, None)] * 2, "page_id long, url string")
    assert U.judge_urls(pages).count() == 5
    assert U.judge_urls(pages.limit(0)).count() == 0

import random

from airloom.llm import url_filters


def judge(url, rules, default="allow"):
    """Brute force over all rules."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    best = None
    for h, p, v in rules:
        if host and h and (host == h or host.endswith("." + h)) and path.startswith(p or ""):
            key = (len(h) + len(p or ""), len(h), v == "block")
            if best is None or key > best[0]:
                best = (key, h + (p or ""), v)
    return host, path, best and best[1], best[2] if best else default


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "mine", "theirs", "p") for i, u in enumerate(urls)], "page_id long, url string, rule string, host string, part string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.match_urls(pages.repartition(3), spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert got == {i: judge(u, rules) for i, u in enumerate(urls)}


def test_random_urls_and_nested_rules(spark):
    r = random.Random(3)
    label = lambda: r.choice(["a", "b", "com", "net", "a-b", "x0"])
    host = lambda: ".".join(label() for _ in range(r.randint(1, 4)))
    path = lambda: "".join("/" + r.choice(["", "en", "e", "en.", "de"]) for _ in range(r.randint(0, 3)))
    rules = [(host(), path(), r.choice(["allow", "block"])) for _ in range(60)]
    urls = [r.choice(["http://", "HTTPS://", ""]) + host().upper() + path() + r.choice(["", "?q=://x/en", "#f"]) for _ in range(400)]
    check(spark, urls, rules)


def test_odd_urls(spark):
    rules = [("net", "/", "block"), ("net", "/", "allow"), ("example.net", "/en/", "allow"), ("", "/x", "block"), (None, "/", "block"), ("com", None, "block")]
    urls = [None, "", "no scheme", "http://", "://", "http://net", "http://net/", "x://a.example.net/en/1", "x://a.example.net./en/1", "http:///en/", "http://" + "a." * 500 + "net/" + "p" * 5000, "http://COM", "http://com?x", "http://dup.net/same", "http://dup.net/same", "a://b://c.net/"]
    check(spark, urls, rules)


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_filters.match_urls(pages, rules).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    row = url_filters.match_urls(one, rules, default="block").first()
    assert (row.host, row.rule, row.verdict) == ("a.net", None, "block")

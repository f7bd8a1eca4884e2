"""URL rules against brute force over all pairs of url and rule."""
import random
import re

from eventide.llm import op9_url_filter as op9

SCHEMA = "page_id long, url string, host string, rule string, verdict string, key string, path string"


def frame(spark, urls):
    return spark.createDataFrame([(k, u, "h", "r", "v", "k", "p") for k, u in urls], SCHEMA)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(urls, rules, default="allow"):
    out = []
    for k, url in urls:
        host, path = parts(url)
        fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=None)
        out.append((k, host, path, best and best[2], best[3] if best else default))
    return sorted(out, key=repr)


def test_contract_rules_and_edges(spark):
    urls = ["http://EXAMPLE.com/en/1?x", "https://www.example.com/en/", "http://a.www.example.com/en/x#y", "http://notexample.com/en/",
            "http://example.com", "http://example.com?/en/", "http://com/", "http://x.net/es", "http://x.net/es/", "ftp://net/fr/1", "net/es/",
            None, "", "://net/es/a", "http://É.net/es/", "http://x.net:80/es/", "http://x.net./es/", "a://b://net/es/", "http://user@x.net/fr/?",
            "http://example.com/en/\nline", "http://.com/a", "http://example.com/en", "http://com"]
    rows = [(k, u) for k, u in enumerate(urls)] + [(3, urls[3]), (None, urls[0])]
    got = op9.judge_urls(frame(spark, rows), op9.rules_table(spark)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, op9.DEFAULT_RULES)


def test_nested_rules_over_many_parts(spark):
    r = random.Random(3)
    seg = lambda: r.choice(["a", "b", "ab", "c"])
    host = lambda: ".".join(seg() for _ in range(r.randint(1, 3)))
    rules = {(host(), "/" + "".join(seg() + r.choice(["", "/"]) for _ in range(r.randint(0, 4)))): r.choice(["allow", "block"]) for _ in range(120)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [(k, f"http://{host()}/" + "".join(seg() + r.choice(["", "/"]) for _ in range(r.randint(0, 6)))) for k in range(400)]
    urls += [(1000 + k, "http://a.b/ab/c") for k in range(300)]  # one url far more often than others
    got = op9.judge_urls(frame(spark, urls).repartition(5), op9.rules_table(spark, rules)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(urls, rules)


def test_no_rules_no_pages(spark):
    urls = [(1, "http://a.com/x"), (2, None)]
    got = op9.judge_urls(frame(spark, urls), op9.rules_table(spark, []), default="block").collect()
    assert sorted(map(tuple, got), key=repr) == brute(urls, [], "block")
    assert op9.judge_urls(frame(spark, []), op9.rules_table(spark)).collect() == []


def test_of_equal_rules_block_counts(spark):
    rules = [("a.com", "/", "allow"), ("A.com", "/", "block"), (None, "/", "block")]
    assert op9.judge_urls(frame(spark, [(1, "http://a.com/")]), op9.rules_table(spark, rules)).first().verdict == "block"


def test_no_python_in_the_plan(spark):
    plan = op9.judge_urls(frame(spark, [(1, "http://a.com/")]), op9.rules_table(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

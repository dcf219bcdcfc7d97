import random

from loanlens.llm.url_filters import filter_urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/en/x", "block"), ("com", "", "block"),
         ("a.com", "/q", "allow"), ("example.com", "/de/", "allow"), ("b.example.com", "/de/de", "block"), ("a.com", "/q", "block")]


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    cut = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return host, path[:cut]


def brute(url):
    host, path = host_path(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else None
    return host, path, best[2] if best else None, best[3] if best else "allow"


def urls():
    r = random.Random(5)
    out = [None, "", "nothing", "http://", "http://com", "HTTP://A.B.Example.NET/en/x/1", "x://net?y", "http://net/", "http://.net/",
           "http://a..com/q", "http://exämple.net/ü#f://g", "http://" + "l." * 3000 + "com/" + "p" * 5000]
    for _ in range(400):
        host = ".".join(r.choice(["a", "b", "www", "example", "net", "com", "org", "xnet"]) for _ in range(r.randrange(1, 5)))
        out.append(f"http://{host}{r.choice(['', '/', '/en/', '/en/x', '/de/de', '/q', '/qq/1', '/EN/'])}{r.choice(['', '?a=b', '#x'])}")
    return out + out[:50]


def test_matches_brute_force(spark):
    rows = [(i if i % 7 else None, u, "kept") for i, u in enumerate(urls())]
    df = spark.createDataFrame(rows, "page_id bigint, url string, rule string").repartition(4)
    rules = spark.createDataFrame([*RULES, (None, "/", "block"), ("net", None, "block")], "host string, path string, verdict string")
    for per_sweep in (4, 4096):
        got = filter_urls(df, rules, rows_per_sweep=per_sweep).collect()
        assert sorted((r["url"] or "~", r["host"], r["path"], r["rule"] or "", r["verdict"]) for r in got) == sorted(
            (u or "~", *[x or "" for x in brute(u)]) for _, u, _ in rows)


def test_empty_tables(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    none = spark.createDataFrame([], "page_id bigint, url string")
    assert filter_urls(none, rules).count() == 0
    some = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    got = filter_urls(some, rules.limit(0)).first()
    assert (got["rule"], got["verdict"]) == (None, "allow")


def test_no_python_in_plan(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    plan = filter_urls(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_one_path_on_many_hosts(spark):
    """Hosts under one suffix that all have the same path go to several sweeps."""
    rows = [(i, f"https://h{i}.net/") for i in range(400)] + [(900, "https://h1.net/"), (901, "https://example.net/en/x")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow")], "host string, path string, verdict string")
    got = {r["page_id"]: r["verdict"] for r in filter_urls(df, rules, rows_per_sweep=10).collect()}
    assert got.pop(901) == "allow" and set(got.values()) == {"block"} and len(got) == 401

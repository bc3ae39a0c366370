import hashlib
import random

from pyspark.sql import functions as F

from affinis.llm import url_filters as U

RULES = U.RULES


def brute_hosts(urls):
    """The hosts of the pages whose md5 begins with 0 to 3, and the fixed ones."""
    hosts = {brute(u, ())[0] for u in urls} - {""}
    return {h for h in hosts if hashlib.md5(f"42:{h}".encode()).hexdigest()[0] in "0123"} | set(U.BLOCKED_HOSTS)


def brute(url, listed):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail[:min([tail.index(c) for c in "?#" if c in tail] + [len(tail)])]
    fits = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    if fits:
        rule = max(fits, key=len)
        return host, path, rule, RULES[rule]
    bad = any(host == h or host.endswith("." + h) for h in listed)
    return host, path, None, "block" if bad else "allow"


def test_rules_hosts_and_odd_urls(spark):
    rng = random.Random(1)
    urls = [None, "", "no scheme", "http://", "://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/x?y#z", "a://b://c/d",
            "http://notexample.com/en/1", "http://example.com/en", "http://example.com?x=/en/", "http://x.net/es/\nq", "http://net/fr/",
            "http://.net/es/", "http://SPAM-farm.example.org", "http://a.spam-farm.example.org/en/", "http://É.com/"]
    urls += [f"https://{rng.choice(['', 'www.', 'm.'])}{rng.choice(['example', 'foo', 'spam-farm.example'])}.{rng.choice(['com', 'net', 'org'])}"
             f"/{rng.choice(['en', 'fr', 'es', ''])}/{i}" for i in range(200)]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(None, urls[6], "x")], "page_id long, url string, host string")
    got = U.judge_pages(df).collect()
    assert len(got) == len(urls) + 1
    listed = brute_hosts(urls)
    assert sum(r.rule is None and r.verdict == "block" for r in got) > 5 and len(listed) > 3
    for r in got:
        u = urls[r.page_id] if r.page_id is not None else urls[6]
        assert (r.host, r.path, r.rule, r.verdict) == brute(u, listed), u
    assert U.judge_pages(df.limit(0)).collect() == []


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where(F.xxhash64("key") % 10 == 0).unionByName(spark.createDataFrame([("not in the corpus",), (None,)], "key string"))
    c = U.Cascade(listed.unionByName(listed), universe)
    assert len(c.levels) > 1                                       # level 1 alone errs here
    want = F.xxhash64("key") % 10 == 0
    assert universe.where(c.member(F.col("key")) != want).count() == 0
    assert universe.where(c.levels[0].holds(F.col("key")) & ~want).count() > 0


def test_no_join_judges_the_pages(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    plan = U.judge_pages(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Python" not in plan


def test_lists_beyond_one_cascade_are_split(spark, monkeypatch):
    """A list of 2000 keys where a level may hold 300, and a universe whose errors alone are above the limit."""
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    want = F.xxhash64("key") % 10 == 0
    c = U.Cascades(universe.where(want), universe, max_keys=300)
    assert len(c.shares) >= 6 and all(b.size <= 64 * (1 + 400 * U.BITS_PER_KEY // 64) for s in c.shares for b in s.levels)
    assert universe.where(c.member(F.col("key")) != want).count() == 0
    few = U.Cascades(universe.where("key = 'k7'"), universe, max_keys=50)
    assert len(few.shares) > 1 and [r.key for r in universe.where(few.member(F.col("key"))).collect()] == ["k7"]

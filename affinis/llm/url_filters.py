"""Operator 4, URL filters: Bloom filter cascade.

A list of keys is encoded as a cascade of Bloom filters.  Level 1 holds the
listed keys.  Level 2 holds those keys of the corpus that pass level 1
without being listed, level 3 those listed keys that pass level 2, and so on
until no key errs.  The corpus's complete key universe decides each level,
so for every key of the corpus the cascade answers exactly, and a page is
judged by expressions alone, without a join.

Keys of a URL are its host's suffixes with the beginnings of its path, in
the shapes (labels of the host, length of the path) that the list has.  A
key of a rule is host + path, the key of a listed host is the host alone.

The bits come to the driver once per level and go out as a literal:
``BITS_PER_KEY`` per key of the level.  A list or a universe whose levels
would hold more than ``MAX_KEYS`` keys is split by a hash of the key into
several cascades, each exact for its share of the keys; a key is tested
against the cascade of its share alone.

The query's host list is derived from the pages by a stated rule: a host is
listed when md5("42:" + host) begins with one of ``LISTED_DIGITS``, about a
quarter of all hosts, and ``BLOCKED_HOSTS`` are listed too.

Cases: a null URL or one without ``://`` has an empty host and path and fits
no rule; an empty table or list gives empty levels; repeated pages get equal
verdicts; two rules of equal length on one URL: the greater string wins;
other columns are not read.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.session import stage

# The rules of the contract, and the production host list.
RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
BLOCKED_HOSTS = ("spam-farm.example.org",)
LISTED_DIGITS = "0123"

BITS_PER_KEY = 10
HASHES = 7
MAX_KEYS = 4_000_000        # keys of one level: 5 MB of bits
ERRORS = 0.01               # share of keys, not listed, that pass a level, from above

Shape = tuple[int, int]     # labels of the host, characters of the path


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL by the contract's rule."""
    pattern = r"(?s)^.*?://([^/?#]*+)([^?#]*+)"
    u = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(u, pattern, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.regexp_extract(u, pattern, 2)


def shape_of(key: Column) -> tuple[Column, Column]:
    """(labels of the host, characters of the path) of a listed key."""
    host = F.substring_index(key, "/", 1)
    return F.size(F.split(host, r"\.")), F.length(key) - F.length(host)


def keys_of(host: Column, path: Column, shapes: list[Shape]) -> Column:
    """The URL's keys in the given shapes."""
    labels = F.size(F.split(host, r"\."))
    return F.array_compact(F.array(*[
        F.when((labels >= n) & (F.length(path) >= size),
               F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, size)))
        for n, size in shapes]).cast("array<string>"))


class Bloom:
    """One level: bits as bytes, and the test of a key."""

    def __init__(self, keys: DataFrame, level: int):
        n = keys.count()
        self.level, self.size = level, 64 * max(1, math.ceil(n * BITS_PER_KEY / 64))
        places = keys.select(F.explode(F.array(*self._places(F.col("key")))).alias("bit")).select(
            F.floor(F.col("bit") / 8).alias("byte"), F.call_function("shiftleft", F.lit(1), (F.col("bit") % 8).cast("int")).alias("mask"))
        bits = bytearray(self.size // 8)
        for r in places.groupBy("byte").agg(F.bit_or("mask").alias("mask")).toLocalIterator():
            bits[r["byte"]] = r["mask"]
        self.bits = bits

    def _places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(self.level), F.lit(j), key), F.lit(self.size)) for j in range(HASHES)]

    def holds(self, key: Column) -> Column:
        test = F.lit(True)
        for p in self._places(key):
            byte = F.conv(F.hex(F.substr(F.lit(self.bits), (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            test = test & (F.call_function("shiftright", byte, (p % 8).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return test


class Cascade:
    """Exact membership in ``listed`` (column key) for every key of ``universe`` (column key)."""

    def __init__(self, listed: DataFrame, universe: DataFrame):
        listed = stage(listed.select("key").where("key IS NOT NULL").distinct(), "listed_keys")
        self.levels = [Bloom(listed, 1)]
        # level 1's false positives: universe keys that pass and are not listed; one aggregate, no join
        passed = universe.where(self.levels[0].holds(F.col("key"))).select("key", F.lit(0).alias("own"))
        wrong = stage(passed.unionByName(listed.select("key", F.lit(1).alias("own"))).groupBy("key")
                      .agg(F.max("own").alias("own")).where("own = 0").select("key"), "cascade_level")
        right = listed
        while not wrong.isEmpty():
            self.levels.append(Bloom(wrong, len(self.levels) + 1))
            held = stage(right.where(self.levels[-1].holds(F.col("key"))), "cascade_level")
            right, wrong = wrong, held

    def member(self, key: Column) -> Column:
        test = None
        for bloom in reversed(self.levels):
            inside = bloom.holds(key)
            if bloom.level % 2:
                test = inside if test is None else inside & test
            else:
                test = ~inside if test is None else ~inside | test
        return test


class Cascades:
    """As ``Cascade``, with no level above ``max_keys`` keys, whatever the sizes of list and universe."""

    def __init__(self, listed: DataFrame, universe: DataFrame, max_keys: int = MAX_KEYS):
        errors = universe.agg(F.approx_count_distinct("key")).first()[0] * ERRORS       # sizes the split alone
        n = max(1, math.ceil(max(listed.distinct().count(), errors) / max_keys))
        self.shares = [Cascade(*(t.where(self._share(F.col("key"), n) == i) if n > 1 else t for t in (listed, universe)))
                       for i in range(n)]

    @staticmethod
    def _share(key: Column, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(n))

    def member(self, key: Column) -> Column:
        if len(self.shares) == 1:
            return self.shares[0].member(key)
        test = F.lit(False)
        for i, cascade in enumerate(self.shares):
            test = F.when(self._share(key, len(self.shares)) == i, cascade.member(key)).otherwise(test)
        return test


def _table(spark: SparkSession, keys) -> DataFrame:
    return spark.createDataFrame([(k,) for k in keys], "key string")


def _shapes(listed: DataFrame) -> list[Shape]:
    n, size = shape_of(F.col("key"))
    return sorted((r["n"], r["size"]) for r in listed.select(n.alias("n"), size.alias("size")).distinct().collect())


def judge(pages: DataFrame, allowed: DataFrame, blocked: DataFrame, hosts: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict): the longest fitting rule, else the host list (block) or allow.

    ``allowed``, ``blocked`` (keys host + path) and ``hosts`` (keys host) have one column, key.
    """
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    shapes = _shapes(allowed.unionByName(blocked))
    rule_keys, host_keys = keys_of(F.col("host"), F.col("path"), shapes), keys_of(F.col("host"), F.lit(""), _shapes(hosts))
    universe = urls.select(F.explode(rule_keys).alias("key"))
    allow, block = Cascades(allowed, universe), Cascades(blocked, universe)
    listed = Cascades(hosts, urls.select(F.explode(host_keys).alias("key")))
    fits = F.filter("rule_keys", lambda k: allow.member(k) | block.member(k))
    longest = F.array_max(F.transform(fits, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))["key"]
    urls = urls.withColumns({"rule_keys": rule_keys, "host_keys": host_keys}).withColumn("rule", longest)
    bad = F.exists("host_keys", listed.member)
    verdict = F.when(F.col("rule").isNull(), F.when(bad, "block").otherwise("allow")).otherwise(
        F.when(block.member(F.col("rule")), "block").otherwise("allow"))
    return urls.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def listed_hosts(pages: DataFrame, digits: str = LISTED_DIGITS) -> DataFrame:
    """(key): the pages' hosts whose seeded hash begins with one of ``digits``, and the fixed ones."""
    host = url_parts(F.col("url"))[0]
    drawn = F.md5(F.concat(F.lit("42:"), F.col("key"))).substr(1, 1).isin(*digits)
    hosts = pages.select(host.alias("key")).where("key <> ''").where(drawn)
    return hosts.unionByName(_table(pages.sparkSession, BLOCKED_HOSTS)).distinct()


def judge_pages(pages: DataFrame) -> DataFrame:
    """The contract's rules and the derived host list on every page."""
    spark = pages.sparkSession
    of = lambda action: _table(spark, [k for k, a in RULES.items() if a == action])
    return judge(pages, of("allow"), of("block"), stage(listed_hosts(pages), "listed_hosts"))

"""URL filters: rules by host and path, then a Bloom filter cascade over the hosts of the corpus. DataFrame functions only.

The cascade's first filter encodes the listed hosts; the next encodes those other hosts of the corpus that the first lets
through by mistake; the next the listed hosts that pass the second by mistake, and so on until a level makes no mistake. A
host is looked up level by level: the first filter without it decides, by the level's parity. As the levels were built
against every host of the corpus the answer is exact for each of them, and no page takes part in a join.

Filters are arrays of 64-bit words, used as scalar subqueries. A first filter takes about 1.44 log2(hosts / listed) bits a
listed host and the others far less; a filter above MAX_FILTER_BITS is refused before it is made.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits no rule; a null or empty list lists
nothing; repeated rows are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.session import stage

#: (verdict, host, path): fixed rules of the query.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Listed domains, subdomains included: a parameter of the query.
BLOCKED_DOMAINS = tuple(f"{name}.example.{end}" for name in ("ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm") for end in ("com", "net", "org"))
MAX_FILTER_BITS = 1 << 28
MAX_LEVELS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    rest = F.coalesce(F.regexp_extract(rest, r"(?s)\A([^?#]*)", 1), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"(?s)\A([^/]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"(?s)\A[^/]*(.*)\z", 1)


def under(host: Column, domain: str) -> Column:
    return (host == domain) | F.endswith(host, F.lit("." + domain))


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The rule string and the verdict of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, domain, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = under(host, domain) & F.startswith(path, F.lit(start))
        name, verdict = F.when(fits, domain + start).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    first, step = F.pmod(F.xxhash64(key, F.lit(2 * level)), F.lit(bits)), F.pmod(F.xxhash64(key, F.lit(2 * level + 1)), F.lit(bits - 1)) + 1
    return [F.pmod(first + step * j, F.lit(bits)) for j in range(hashes)]


class Level:
    """One Bloom filter: its words as a one-row table, and the test for a key."""

    def __init__(self, keys: DataFrame, n: int, level: int, rate: float):
        self.hashes = max(1, round(-math.log2(rate)))
        self.bits = 64 * max(1, math.ceil(-n * math.log(rate) / math.log(2) ** 2 / 64))
        self.level = level
        if self.bits > MAX_FILTER_BITS:
            raise ValueError(f"level {level} needs {self.bits} bits for {n} keys, over the bound of {MAX_FILTER_BITS}")
        set_bits = keys.select(F.explode(F.array(*_positions(F.col("key"), level, self.bits, self.hashes))).alias("p"))
        words = set_bits.groupBy(F.expr("p div 64").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("word"))
        blank = keys.sparkSession.range(self.bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("word"))
        words = words.unionByName(blank).groupBy("w").agg(F.bit_or("word").alias("word"))  # every word, so that the array is dense
        self.words = stage(words.agg(F.array_sort(F.collect_list(F.struct("w", "word"))).getField("word").alias("words")))

    def holds(self, key: Column) -> Column:
        words = self.words.scalar()
        test = F.lit(True)
        for p in _positions(key, self.level, self.bits, self.hashes):
            test = test & (F.getbit(F.element_at(words, (F.floor(p / 64) + 1).cast("int")), (p % 64).cast("int")) == 1)
        return test


def cascade(keys: DataFrame) -> list[Level]:
    """keys (key, listed), distinct and with every key that will be looked up -> the levels."""
    inside, outside = keys.where("listed").select("key"), keys.where("not listed").select("key")
    n, others = inside.count(), outside.count()
    levels: list[Level] = []
    while n:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError(f"the cascade did not end in {MAX_LEVELS} levels")
        rate = 0.5 if levels or not others else min(0.5, max(1e-6, n * math.sqrt(0.5) / others))
        levels.append(Level(inside, n, len(levels), rate))
        wrong = stage(outside.where(levels[-1].holds(F.col("key"))))
        inside, outside, n = wrong, inside, wrong.count()
    return levels


def listed(levels: list[Level], key: Column) -> Column:
    """Exact membership for the keys the cascade was built over."""
    answer = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        answer = F.when(levels[i].holds(key), answer).otherwise(F.lit(i % 2 == 1))
    return answer


def host_keys(hosts: DataFrame, domains: DataFrame) -> DataFrame:
    """hosts (host), domains (domain) -> (key, listed): each distinct host, listed if it is a domain of the list or below one."""
    labels = F.split("host", r"\.")
    distinct = hosts.distinct()
    ends = distinct.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("domain"))
    named = ends.join(domains.distinct(), "domain", "left_semi").select("host", F.lit(True).alias("listed"))
    return stage(distinct.select("host", F.lit(False).alias("listed")).unionByName(named).groupBy(F.col("host").alias("key")).agg(F.max("listed").alias("listed")))


def filter_urls(pages: DataFrame, domains: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row for each page: the longest rule's verdict, else block if listed."""
    host, path = host_and_path(F.col(url))
    parts = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    levels = cascade(host_keys(parts.select("host"), domains))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    own = F.when(listed(levels, F.col("host")), "block").otherwise("allow")
    return parts.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))

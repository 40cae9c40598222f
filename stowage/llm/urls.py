"""URL filtering by longest rule and, where none fits, by a Bloom filter cascade.

The cascade encodes which keys are listed, exactly, for the whole key universe of the corpus: the first Bloom filter holds
the listed keys, the second those unlisted keys that pass the first, the third those listed keys that pass the second,
and so on until none passes wrongly. A key's answer is the parity of the filters it passes, without a join. Keys are
hosts and their parent domains, so a listed domain covers its subdomains.

Scale: the universe comes from one distinct over hosts; each filter's bits are made by an aggregation over words and
only finished words reach the driver, of a size known before (`bits` for each key that it holds). If the cascade of all keys would
be larger than `max_bytes`, keys are split into as many shards as needed, each with its own cascade, and the pages are
read once for each shard; pages are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Bits for each key in the first filter and in the others, with so many hashes each.
FIRST_BITS, FIRST_HASHES = 10, 7
LATER_BITS, LATER_HASHES = 2, 1
MAX_BYTES = 64 << 20

#: Fixed values: (verdict, host, path) of the rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: The listed domains of the query on `pages`; judge() takes any table of them.
LISTED = tuple(f"{name}.example.{top}" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org"))

_AFTER = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: str) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty if there is no :// or no url."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _AFTER, 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _AFTER, 2)


def longest_rule(rules: tuple, host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """The rule that fits, as host and path in one string, and its verdict; null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((F.col(host) == h) | F.col(host).endswith("." + h)) & F.col(path).startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def domain_keys(host: str = "host") -> Column:
    """The host and its parent domains; an empty array for an empty host."""
    parts = f"split({host}, '[.]')"
    return F.expr(f"if({host} = '', array(), transform(sequence(1, size({parts})), i -> array_join(slice({parts}, i, size({parts})), '.')))")


def _hashes(key: str) -> tuple[Column, Column]:
    """Two independent 64-bit hashes."""
    return F.xxhash64(key).alias("h"), F.xxhash64(F.lit("second"), key).alias("g")


class Filter:
    """One Bloom filter as 64-bit words."""

    def __init__(self, words: np.ndarray, hashes: int, level: int):
        self.words, self.hashes, self.level = words, hashes, level

    def passes(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        ok = np.ones(len(h), dtype=bool)
        for k in range(self.hashes):
            p = position(h, g, self.level, k, 64 * len(self.words))
            ok &= (self.words[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1
        return ok


def position(h: np.ndarray, g: np.ndarray, level: int, k: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = h.astype(np.uint64) + g.astype(np.uint64) * np.uint64(2 * (16 * level + k) + 1)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(16)) % np.uint64(bits)).astype(np.int64)


class Cascade:
    def __init__(self, filters: list[Filter]):
        self.filters = filters

    def listed(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        """For keys of the universe: whether they are listed."""
        passed, going = np.zeros(len(h), dtype=np.int64), np.arange(len(h))
        for f in self.filters:
            going = going[f.passes(h[going], g[going])]
            passed[going] += 1
        return passed % 2 == 1


def _bits(keys: DataFrame, bits: int, hashes: int, level: int) -> np.ndarray:
    """The words of a filter of keys(h, g): tasks give (word, bits) and words meet in an aggregation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = np.concatenate([position(b["h"].to_numpy(), b["g"].to_numpy(), level, k, bits) for k in range(hashes)])
            yield pd.DataFrame({"word": p >> 6, "bits": (np.uint64(1) << (p & 63).astype(np.uint64)).view(np.int64)})

    got = keys.select("h", "g").mapInPandas(run, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[got["word"].to_numpy(dtype=np.int64)] = got["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return words


def _passing(keys: DataFrame, f: Filter) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(f)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[shared.value.passes(b["h"].to_numpy(), b["g"].to_numpy())]

    return keys.mapInPandas(run, keys.schema)


def build(universe: DataFrame) -> Cascade:
    """The cascade of universe(h, g, listed), which has each key once."""
    sides = [materialise(universe.where("listed").select("h", "g")), materialise(universe.where("not listed").select("h", "g"))]
    filters: list[Filter] = []
    n = sides[0].count()
    while n:
        level = len(filters)
        if level == 64:
            raise ValueError("two keys, one of them listed, have the same two hashes")
        per, hashes = (FIRST_BITS, FIRST_HASHES) if level == 0 else (LATER_BITS, LATER_HASHES)
        bits = max(64, -(-n * per // 64) * 64)
        filters.append(Filter(_bits(sides[0], bits, hashes, level), hashes, level))
        sides = [materialise(_passing(sides[1], filters[-1])), sides[0]]
        n = sides[0].count()
    return Cascade(filters)


def _member(shared, shard: int, shards: int):
    """A function of two columns, arrays of the hashes of a page's keys: whether one of this shard is listed."""

    def any_listed(h: pd.Series, g: pd.Series) -> pd.Series:
        counts, none = np.array([len(x) for x in h], dtype=np.int64), np.zeros(0, dtype=np.int64)
        hs, gs = np.concatenate([none, *h]).astype(np.int64), np.concatenate([none, *g]).astype(np.int64)
        yes = shared.value.listed(hs, gs) & (np.mod(hs, shards) == shard)
        return pd.Series(np.bincount(np.repeat(np.arange(len(h)), counts)[yes], minlength=len(h)) > 0)

    return F.pandas_udf(any_listed, "boolean")


def blocked_pages(pages: DataFrame, listed: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """`pages`, which has a column host, with a boolean `blocked`: the host or a parent domain is among listed(key)."""
    hosts = pages.select("host").distinct()
    keys = hosts.select(F.explode(domain_keys()).alias("key")).distinct()
    # Listed keys are tagged by a union and one grouping; those that no page has drop out.
    tagged = keys.select("key", F.lit(True).alias("here"), F.lit(False).alias("listed")).union(listed.select("key", F.lit(False), F.lit(True)))
    tagged = tagged.groupBy("key").agg(F.bool_or("here").alias("here"), F.bool_or("listed").alias("listed")).where("here")
    universe = tagged.select(*_hashes("key"), "listed")
    universe = materialise(universe)
    some = universe.agg(F.count("*").alias("n"), F.count_if("listed").alias("listed")).first()
    # The first filter takes its bits; about 1 % of the others pass it, and later filters shrink by half or more.
    size = (FIRST_BITS * some.listed + 4 * LATER_BITS * (some.n // 64 + some.listed // 2)) // 8
    shards = max(1, -(-size // max_bytes))
    out = pages.withColumn("blocked", F.lit(False))
    names = domain_keys()
    for shard in range(shards):
        mine = universe.where(F.pmod("h", F.lit(shards)) == shard)
        any_listed = _member(pages.sparkSession.sparkContext.broadcast(build(mine)), shard, shards)
        hs, gs = F.transform(names, lambda k: F.xxhash64(k)), F.transform(names, lambda k: F.xxhash64(F.lit("second"), k))
        out = out.withColumn("blocked", F.col("blocked") | any_listed(hs, gs))
        if shards > 1:
            out = materialise(out)
    return out


def judge(pages: DataFrame, listed: DataFrame, rules: tuple = RULES, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of pages(page_id, url; other columns are ignored).

    verdict is "allow" or "block": that of the longest rule that fits, else whether the host or a parent domain is
    listed. A url that is null or without :// has an empty host and path, fits no rule and is allowed. Null and repeated
    keys of listed(key) change nothing. Repeated rows stay.
    """
    rows = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    rule, verdict = longest_rule(rules)
    method = F.when(F.col("blocked"), "block").otherwise("allow")
    return blocked_pages(rows, listed, max_bytes).select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))

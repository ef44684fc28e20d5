"""URL rules and exact membership in a list by a cascade of Bloom filters.

The first filter encodes the listed keys. Those keys of the universe that it
passes though they are not listed are encoded by the second, listed keys that
the second passes by the third, and so on until a level passes nothing it should
not. For every key of the universe the first level that refuses it tells exactly
whether it is listed, so pages are judged without a join.

Filters are bit arrays built by bitwise aggregation and probed as scalar
subqueries. What is shipped grows with the list, not with the pages; a list whose
first level would exceed ``max_filter_bits`` is joined by key instead.

A null url, or one without ``://``, has an empty host and path, fits no rule and
is listed only if the empty key is. Null ids are carried; repeated rows are each
judged; of rules that fit, the longest wins and, of equally long ones, the first
in the alphabet. Empty tables and an empty list are allowed; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import LOWER, UPPER, bit_array, bit_is_set, checkpointed

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class CascadeParams:
    bits_per_key: int = 10
    hashes: int = 5
    max_filter_bits: int = 1 << 28


@dataclass(frozen=True)
class Level:
    bits: DataFrame  # one row, one array of longs
    n_bits: int
    number: int

    def passes(self, key: Column, hashes: int) -> Column:
        bits = self.bits.scalar()
        return reduce(Column.__and__, [bit_is_set(bits, p) for p in positions(key, self.number, self.n_bits, hashes)])


def positions(key: Column, level: int, n_bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(level * hashes + j), key), F.lit(n_bits).cast("bigint")) for j in range(hashes)]


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]
    params: CascadeParams

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed; exact, and false for a null."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            refused = F.lit(level.number % 2 == 1)
            verdict = F.when(level.passes(key, self.params.hashes), verdict).otherwise(refused)
        return F.coalesce(verdict & key.isNotNull(), F.lit(False))


def _level(keys: DataFrame, count: int, number: int, params: CascadeParams) -> Level:
    words = -(-count * params.bits_per_key // 64)
    n_bits = 64 * words
    at = keys.select(F.explode(F.array(*positions(F.col("key"), number, n_bits, params.hashes))).alias("p"))
    return Level(checkpointed(bit_array(at, words)), n_bits, number)


def build_cascade(listed: DataFrame, universe: DataFrame, params: CascadeParams = CascadeParams()) -> Cascade | None:
    """Levels for the keys ``key`` of two frames; None if the list is too long for filters."""
    both = listed.select("key", F.lit(True).alias("listed")).unionByName(
        universe.select("key", F.lit(False).alias("listed"))
    )
    keys = checkpointed(both.where("key IS NOT NULL").groupBy("key").agg(F.bool_or("listed").alias("listed")))
    encoded, others, levels = keys.where("listed").select("key"), keys.where("NOT listed").select("key"), []
    count = encoded.count()
    if count * params.bits_per_key > params.max_filter_bits:
        return None
    while count:
        level = _level(encoded, count, len(levels), params)
        levels.append(level)
        wrong = checkpointed(others.where(level.passes(F.col("key"), params.hashes)))
        encoded, others, count = wrong, encoded, wrong.count()
    return Cascade(tuple(levels), params)


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null. A rule is a host, a slash and the start of a path."""
    cases = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r), r), reverse=True):
        name, _, start = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + start))
        cases = F.when(fits, F.lit(rule)).otherwise(cases)
    return cases


def judge_urls(
    pages: DataFrame,
    rules: dict[str, str],
    listed: DataFrame,
    params: CascadeParams = CascadeParams(),
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """The id, ``host``, ``path``, ``rule``, ``listed`` and ``verdict`` of every page.

    Without a rule, a page is blocked if its host is among the keys of ``listed``.
    """
    url = F.col(url_column).cast("string")
    parsed = pages.select(id_column, url_host(url).alias("host"), url_path(url).alias("path"))
    cascade = build_cascade(listed, parsed.select(F.col("host").alias("key")), params)
    if cascade is None:
        keys = listed.select(F.col("key").alias("listed_key")).distinct()
        parsed = parsed.join(keys, F.col("host") == F.col("listed_key"), "left")
        is_listed = F.col("listed_key").isNotNull()
    else:
        is_listed = cascade.contains(F.col("host"))
    ruled = parsed.select(
        id_column, "host", "path", longest_rule(F.col("host"), F.col("path"), rules).alias("rule"), is_listed.alias("listed")
    )
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    return ruled.withColumn("verdict", F.coalesce(by_rule, F.when(F.col("listed"), BLOCK).otherwise(ALLOW)))

"""URL filtering by rules and an exact cascade of Bloom filters.

Listed keys are stored as a cascade. The first filter encodes the listed keys;
it is tried on all other keys of the corpus, and those it wrongly accepts go
into a second filter; that one is tried on the listed keys, and so on until a
filter accepts nothing wrongly. A key is listed if the first filter of the
cascade that rejects it stands at an even place (counted from 1): for every key
of the universe the cascade was built over, this is exact, and no table is
joined. Built-in expressions only.

The filters are one value of checked size that Spark sends along with the plan.
A cascade that would be larger than ``most_bytes`` is not sent: the keys are then
looked up by an equi-join with the list, which gives the same verdicts.

A null url, or one without ``://``, has an empty host and path. Empty hosts are
keys like any other. Repeated rows are judged alike; an empty table gives none;
an empty list blocks nothing. Only the url is read, whole, whatever its length;
other columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintext.llm.common import Scratch

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FIRST_RATE, _LATER_RATE = 0.02, 0.5  # wrongly accepted share, by level
MOST_BYTES = 8 << 20


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    rest = _after_scheme(url)
    return F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


@dataclass(frozen=True)
class Rule:
    """``host/path`` with its verdict; it fits the host and its subdomains."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as ``(pattern, verdict)``; null if none does."""
    chosen = F.lit(None).cast("struct<pattern:string,verdict:string>")
    # Of rules of equal length that fit the same url, the first in order counts.
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        on_host = (host == rule.host) | host.endswith("." + rule.host)
        value = F.struct(F.lit(rule.pattern).alias("pattern"), F.lit(rule.verdict).alias("verdict"))
        fits = on_host & path.startswith(rule.path)
        chosen = F.when(fits, value).otherwise(chosen)
    return chosen


@dataclass(frozen=True)
class Level:
    """A Bloom filter: ``bits`` places, ``hashes`` of which belong to a key, from word ``start`` on."""

    number: int
    bits: int
    hashes: int
    start: int

    def places(self, key: Column) -> list[Column]:
        return [
            F.pmod(F.xxhash64(F.lit(self.number * 64 + k), key), F.lit(self.bits)) for k in range(self.hashes)
        ]


def _level(number: int, keys: int, start: int) -> Level:
    rate = _FIRST_RATE if number == 1 else _LATER_RATE
    bits = max(64, math.ceil(keys * math.log2(1 / rate) / math.log(2)))
    words = -(-bits // 64)
    return Level(number, words * 64, max(1, round(math.log2(1 / rate))), start)


def _set_words(keys: DataFrame, level: Level) -> DataFrame:
    """``(word, bits)`` of the filter over ``keys``, without empty words."""
    place = keys.select(F.explode(F.array(*level.places(F.col("key")))).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
    return place.groupBy(F.call_function("div", F.col("place"), F.lit(64)).alias("word")).agg(
        F.bit_or(bit).alias("bits")
    )


@dataclass
class Cascade:
    """The levels, and all their words as an array column of one row."""

    levels: list[Level] = field(default_factory=list)
    words: DataFrame | None = None

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        if not self.levels:
            return F.lit(False)
        words = self.words.scalar()
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(_accepted(level, key, words), answer).otherwise(F.lit(level.number % 2 == 0))
        return answer


def _accepted(level: Level, key: Column, words: Column) -> Column:
    found = F.lit(True)
    for place in level.places(key):
        word = F.get(words, (F.call_function("div", place, F.lit(64)) + level.start).cast("int"))
        bit = F.call_function("shiftright", word, (place % 64).cast("int")).bitwiseAND(F.lit(1))
        found = found & (bit == 1)
    return found


def _as_array(words: DataFrame, n: int) -> DataFrame:
    """``n`` words in order in one row; ``n`` has been checked against the bound."""
    every = words.sparkSession.range(n).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    filled = every.union(words).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    entries = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return filled.agg(F.transform(entries, lambda e: e["bits"]).alias("words"))


def build_cascade(universe: DataFrame, most_bytes: int = MOST_BYTES) -> Cascade | None:
    """The cascade over distinct keys ``(key, listed)``; None if it is larger than ``most_bytes``."""
    scratch = Scratch(universe.sparkSession, "url-filter")
    stored = scratch.write(universe, "keys")
    inside, outside = stored.where("listed").select("key"), stored.where("NOT listed").select("key")
    cascade = Cascade()
    parts: list[DataFrame] = []
    total = 0
    while n := inside.count():
        level = _level(len(cascade.levels) + 1, n, total)
        total += level.bits // 64
        if 8 * total > most_bytes:
            return None
        words = scratch.write(_set_words(inside, level), "words")
        own = Level(level.number, level.bits, level.hashes, 0)
        filter_ = _as_array(words, level.bits // 64).scalar()
        wrong = scratch.write(outside.where(_accepted(own, F.col("key"), filter_)), "wrong")
        cascade.levels.append(level)
        parts.append(words.select((F.col("word") + level.start).alias("word"), "bits"))
        inside, outside = wrong, inside
    if parts:
        joined = parts[0]
        for part in parts[1:]:
            joined = joined.union(part)
        cascade.words = scratch.write(_as_array(joined, total), "cascade")
    return cascade


def judged(
    pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, url: str = "url", most_bytes: int = MOST_BYTES
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)``: the rule's verdict, else block if the host is listed.

    ``listed`` holds hosts in a column ``key``; those that no page has count for nothing.
    """
    rows = pages.select("page_id", host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumn("fits", fitting_rule(F.col("host"), F.col("path"), rules))
    universe = (
        rows.select(F.col("host").alias("key"), F.lit(False).alias("mark"))
        .union(listed.select("key", F.lit(True).alias("mark")))
        .groupBy("key")
        .agg(F.bool_or("mark").alias("listed"), (~F.bool_and("mark")).alias("seen"))
        .where("seen AND key IS NOT NULL")
        .select("key", "listed")
    )
    cascade = build_cascade(universe, most_bytes)
    if cascade is None:
        known = universe.where("listed").select(F.col("key").alias("host"), F.lit(True).alias("listed"))
        rows = rows.join(known, "host", "left")
        blocked = F.coalesce("listed", F.lit(False))
    else:
        blocked = cascade.contains(F.col("host"))
    verdict = F.coalesce("fits.verdict", F.when(blocked, "block").otherwise("allow"))
    return rows.select(
        "page_id", "host", "path", F.col("fits.pattern").alias("rule"), verdict.alias("verdict")
    )


def query_heavy_hosts(pages: DataFrame, url: str = "url", least_pages: int = 2) -> DataFrame:
    """``(key)``: hosts whose pages mostly carry a query string, as endless calendars and searches do."""
    asks = F.instr(F.col(url), "?") > 0
    return (
        pages.groupBy(host_of(F.col(url)).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(asks).alias("asking"))
        .where((F.col("n") >= least_pages) & (2 * F.col("asking") > F.col("n")))
        .select("key")
    )

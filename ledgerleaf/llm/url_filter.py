"""Verdicts on page addresses: rules by host and path, and a list of domains held in a filter cascade.

Every host of the corpus is known before any is judged.  A first Bloom filter holds the listed
hosts; a second holds those of the others that the first admits, a third the listed ones that
the second admits, and so on until nothing is admitted wrongly.  The first level that refuses a
host settles it, so for the hosts of the corpus the cascade is exact, and pages are judged where
they are read, without a join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import staged

#: Verdict, host and path of the rules; a host stands for its subdomains too.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Words of the names of sites that are not wanted, between dots and hyphens.
LISTED_WORDS = (
    "ads", "adult", "bets", "betting", "casino", "crack", "keygen", "malware", "phish", "pills", "poker", "porn", "spam",
    "track", "tracker", "viagra", "warez", "xxx",
)

#: Listed hosts of one filter; more are dealt to several, each with its own pass over the pages.
KEYS_PER_FILTER = 1 << 24
#: Bits of one stored bitmap, and the most levels; each level holds about half of the one two before.
BITMAP = 1 << 15
MOST_LEVELS = 80
#: A domain name has at most so many labels.
LABELS = 127
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path of an address; both empty where it is null or has no ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    start = F.instr(text, "://")
    rest = F.when(start > 0, F.substring(text, start + 3, F.length(text))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), CAPITALS, SMALL)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (null if none) and its verdict."""
    fits = [
        (((host == h) | host.endswith("." + h)) & path.startswith(p), h + p, verdict)
        for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    ]
    return (F.coalesce(*[F.when(hit, F.lit(name)) for hit, name, _ in fits]),
            F.coalesce(*[F.when(hit, F.lit(verdict)) for hit, _, verdict in fits]))


def domains(host: Column) -> Column:
    """A host and the domains it lies in, up to :data:`LABELS` labels."""
    n = F.least(F.size(F.split(host, r"\.")), F.lit(LABELS))
    parents = F.transform(F.sequence(F.lit(1), n), lambda k: F.call_function("substring_index", host, F.lit("."), -k))
    return F.array_distinct(F.array_append(parents, host))


def listed_domains(hosts: DataFrame, words: Sequence[str] = LISTED_WORDS) -> DataFrame:
    """``domain`` of every site among ``hosts(host)`` whose name holds a listed word."""
    pattern = rf"(?:^|\.)((?:[^.]*-)?(?:{'|'.join(words)})(?:-[^.]*)?(?:\..*)?)$"
    found = hosts.select(F.regexp_extract("host", pattern, 1).alias("domain"))
    return found.filter("domain <> ''").distinct()


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``bits`` is a one-row table with the bitmaps in order."""

    bits: DataFrame
    size: int
    hashes: int
    seed: int

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.seed), F.lit(i)), F.lit(self.size)) for i in range(self.hashes)]

    def admits(self, key: Column) -> Column:
        """Whether all places of a key are set; the filter is read as a scalar, once per query."""
        maps = self.bits.scalar()

        def is_set(place: Column) -> Column:
            bitmap = F.get(maps, F.floor(place / BITMAP).cast("int"))
            within = (place % BITMAP).cast("int")
            byte = F.ascii(F.decode(F.substring(bitmap, F.floor(within / 8).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
            return F.floor(byte / F.pow(F.lit(2), within % 8)) % 2 == 1

        return reduce(lambda a, b: a & b, [is_set(p) for p in self.places(key)])


def level(keys: DataFrame, n: int, hashes: int, seed: int) -> Level:
    """A filter of the ``n`` rows of ``keys(key)``, half of its bits set."""
    size = max(64, math.ceil(n * hashes / math.log(2)))
    count = -(-size // BITMAP)
    made = Level(keys, size, hashes, seed)
    places = keys.select(F.explode(F.array(*made.places(F.col("key")))).alias("place"))
    bitmaps = places.groupBy(F.floor(F.col("place") / BITMAP).alias("at")).agg(
        F.bitmap_construct_agg(F.col("place") % BITMAP).alias("bitmap"))
    blank = keys.sparkSession.range(count).select(
        F.col("id").alias("at"), F.unhex(F.repeat(F.lit("00"), F.lit(BITMAP // 8))).alias("bitmap"))
    filled = bitmaps.unionByName(blank).groupBy("at").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    in_order = F.array_sort(F.collect_list(F.struct("at", "bitmap")))
    bits = filled.agg(F.transform(in_order, lambda b: b["bitmap"]).alias("bits"))
    return Level(staged(bits, "filter-bits"), size, hashes, seed)


def cascade(keys: DataFrame) -> list[Level]:
    """Levels for ``keys(key, listed)``, each key once; none where nothing is listed.

    Half of the keys that a level is asked about pass it, so the levels shrink and their number
    grows with the logarithm of the keys.  The first one is sized by how many others there are.
    """
    sizes = {row["listed"]: row["n"] for row in keys.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    held, asked = keys.filter("listed").select("key"), keys.filter("not listed").select("key")
    n, others, levels = sizes.get(True, 0), sizes.get(False, 0), []
    while n:
        if len(levels) == MOST_LEVELS:
            raise RuntimeError("the filters of the cascade do not shrink")
        hashes = 1 if levels else max(1, math.ceil(math.log2(max(others, 1) / n) + 0.5)) if others > n else 1
        levels.append(level(held, n, hashes, len(levels)))
        wrong = staged(asked.filter(levels[-1].admits(F.col("key"))), "filter-admitted")
        held, asked, n = wrong, held, wrong.count()
    return levels


def is_listed(levels: list[Level], key: Column) -> Column:
    """Whether a key of the corpus is listed: the first level that refuses it settles that."""
    if not levels:
        return F.lit(False)
    verdict = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        verdict = F.when(~levels[i].admits(key), F.lit(i % 2 == 1)).otherwise(verdict)
    return verdict


def judged(pages: DataFrame, listed: DataFrame | None = None, rules: Sequence[tuple[str, str, str]] = RULES,
           keys_per_filter: int = KEYS_PER_FILTER) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``.

    ``listed`` has a column ``domain`` and stands for these hosts and their subdomains; without
    it the sites of :func:`listed_domains` are listed.  A page without a rule is blocked if its
    host is listed.  An address that is null or has no ``://`` has an empty host, which is never
    listed, and is allowed.  Repeated rows are judged each; an empty table gives an empty one.
    """
    host, path = host_and_path(F.col("url"))
    addresses = pages.select("page_id", host.alias("host"), path.alias("path"))
    hosts = staged(addresses.select("host").filter("host <> ''").distinct(), "hosts")
    listed = listed_domains(hosts) if listed is None else listed.select(F.translate("domain", CAPITALS, SMALL).alias("domain"))
    within = hosts.select("host", F.explode(domains(F.col("host"))).alias("domain"))
    covered = within.join(listed, "domain", "left_semi").select("host").distinct().withColumn("listed", F.lit(True))
    every = covered.unionByName(hosts.withColumn("listed", F.lit(False)))
    keys = staged(every.groupBy(F.col("host").alias("key")).agg(F.max("listed").alias("listed")), "filter-keys")

    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    shards = 1 + keys.filter("listed").count() // keys_per_filter
    shard = F.pmod(F.xxhash64("host", F.lit("shard")), F.lit(shards))
    out = []
    for i in range(shards):
        own = F.pmod(F.xxhash64("key", F.lit("shard")), F.lit(shards)) == i
        levels = cascade(keys if shards == 1 else keys.filter(own))
        some = addresses if shards == 1 else addresses.filter(shard == i)
        blocked = (F.col("host") != "") & is_listed(levels, F.col("host"))
        out.append(some.select("page_id", "host", "path", rule.alias("rule"),
                               F.coalesce(verdict, F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict")))
    return reduce(DataFrame.unionByName, out)


def op13(pages: DataFrame) -> DataFrame:
    return judged(pages.select("page_id", "url"))


OP13_SQL = rf"""
with rests as (select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
parts as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{CAPITALS}', '{SMALL}') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from rests),
ruled as (
  select *, case
    when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
    when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/' end as rule
  from parts)
select page_id, host, path, rule, case
  when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
  when regexp_matches(host, '(^|[.-])({"|".join(LISTED_WORDS)})([.-]|$)') then 'block' else 'allow' end as verdict
from ruled
"""

"""URL filter: rules on host and path, and a list of domains kept as a cascade of Bloom filters.

The first filter encodes the listed keys. The keys of the corpus that it lets through wrongly are encoded by
a second one, the listed keys that this one lets through by a third, and so on until none is left. For every
key of the corpus the first filter that refuses it then says exactly whether it is listed, without a join.
The size follows the list (about log2 of the corpus keys per listed key, in bits), and each filter is bounded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import bloom
from panelcast.llm.common import ascii_lower, written

#: Fixed values: (verdict, host and path). A rule holds for its host and all subdomains.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Second-level names whose domains are listed, below each of these ends.
LISTED_NAMES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_ENDS = ("example.com", "example.net", "example.org")


def listed_domains() -> list[str]:
    return [f"{name}.{end}" for name in LISTED_NAMES for end in LISTED_ENDS]


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, hash or the end, A to Z lower-cased."""
    return ascii_lower(F.regexp_extract(_behind(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_behind(url), r"^[^/?#]*([^?#]*)", 1)


def _behind(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def fits(host: Column, path: Column, rule: str) -> Column:
    domain, slash, rest = rule.partition("/")
    inside = (host == domain) | F.endswith(host, F.lit("." + domain))
    return inside & F.startswith(path, F.lit(slash + rest))


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(verdict, rule) of the longest rule that fits, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    out = F.lit(None).cast("struct<verdict: string, rule: string>")
    for verdict, rule in reversed(ordered):
        out = F.when(fits(host, path, rule), F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def domains_of(host: Column) -> Column:
    """The host and all domains above it."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


@dataclass(frozen=True)
class Level:
    words: Column
    bits: int
    hashes: int


class Cascade:
    """Exact membership of a universe's keys in a list."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @staticmethod
    def build(listed: DataFrame, universe: DataFrame, most_levels: int = 64) -> Cascade:
        """``listed`` and ``universe`` have one text column ``key``; nulls are left out, repeats do no harm."""
        flagged = listed.select("key", F.lit(1).alias("l")).union(universe.select("key", F.lit(0).alias("l")))
        keys = written(flagged.where("key IS NOT NULL").groupBy("key").agg(F.max("l").alias("l")), "keys")
        inside, outside = keys.where("l = 1").select("key"), keys.where("l = 0").select("key")
        n_in, n_out = inside.count(), outside.count()
        levels: list[Level] = []
        rate = min(0.5, 0.5**0.5 * n_in / max(1, n_out))
        while n_in:
            if len(levels) == most_levels:
                raise ValueError("the cascade does not end: the list is too long for filters of this size")
            number = len(levels) + 1
            bits, hashes = bloom.shape(n_in, max(rate, 1e-9))
            level = Level(bloom.fetched(bloom.build(inside, "key", number, bits, hashes)), bits, hashes)
            levels.append(level)
            passed = written(outside.where(bloom.holds(level.words, F.col("key"), number, bits, hashes)), "passed")
            inside, outside, n_in, n_out = passed, inside, passed.count(), n_in
            rate = 0.5
        return Cascade(levels)

    def member(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the first filter that refuses it decides."""
        out = F.lit(len(self.levels) % 2 == 1)
        for number, level in reversed(list(enumerate(self.levels, 1))):
            inside = bloom.holds(level.words, key, number, level.bits, level.hashes)
            out = F.when(~inside, F.lit(number % 2 == 0)).otherwise(out)
        return out


def key_table(spark: SparkSession, keys: list[str]) -> DataFrame:
    return spark.createDataFrame([(k,) for k in keys], "key string")


def judge(df: DataFrame, listed: DataFrame | None = None, url: str = "url", rules=RULES) -> DataFrame:
    """Add host, path, rule and verdict of every url.

    The longest rule that fits decides; else a host is blocked if it or a domain above it is listed (``listed``
    has one text column ``key``; without it the fixed domains above). A null url, or one without ``://``, has an
    empty host and path, fits no rule and is allowed. Columns of these names are replaced, others and repeated
    rows stay; an empty table gives an empty result.
    """
    spark = df.sparkSession
    listed = key_table(spark, listed_domains()) if listed is None else listed
    placed = df.withColumns({"host": F.coalesce(host_of(F.col(url)), F.lit("")), "path": F.coalesce(path_of(F.col(url)), F.lit(""))})
    universe = placed.select("host").distinct().select(F.explode(domains_of(F.col("host"))).alias("key")).distinct()
    cascade = Cascade.build(listed.select("key"), universe)
    hit = F.exists(domains_of(F.col("host")), cascade.member) if cascade.levels else F.lit(False)
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    judged = placed.withColumn("_rule", rule)
    return judged.withColumns(
        {
            "rule": F.col("_rule.rule"),
            "verdict": F.coalesce(F.col("_rule.verdict"), F.when(hit, "block").otherwise("allow")),
        }
    ).drop("_rule")


def judge_sql(pages: str = "pages") -> str:
    """The same in SQL, with the list compared directly."""
    names = ", ".join(f"'{d}'" for d in listed_domains())
    ordered = sorted(RULES, key=lambda r: (-len(r[1]), r[1]))

    def test(rule: str) -> str:
        domain, slash, rest = rule.partition("/")
        return f"(host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{slash + rest}')"

    rules = " ".join(f"WHEN {test(r)} THEN '{r}'" for _, r in ordered)
    verdicts = " ".join(f"WHEN {test(r)} THEN '{v}'" for v, r in ordered)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
        WITH behind AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS b FROM {pages}
        ), placed AS (
            SELECT page_id, translate(regexp_extract(b, '^[^/?#]*', 0), '{upper}', '{upper.lower()}') AS host,
                   regexp_extract(b, '^[^/?#]*([^?#]*)', 1) AS path FROM behind
        ), listed AS (SELECT unnest([{names}]) AS d)
        SELECT page_id, host, path, CASE {rules} END AS rule,
               CASE {verdicts} WHEN EXISTS (SELECT 1 FROM listed WHERE host = d OR ends_with(host, '.' || d)) THEN 'block' ELSE 'allow' END AS verdict
        FROM placed"""

"""URL filter with host rules and a weighted vocabulary.

Rules come first: the longest rule whose host is the URL's host or a parent of
it, and whose path begins the URL's path, decides.  URLs without a rule are
judged by words.  One Aho-Corasick pass over the lower-cased URL finds all
terms; a hit counts only where no letter or digit touches it.  One strict term,
or enough distinct soft terms, blocks the URL.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One of these blocks a URL.
STRICT = tuple("porn xxx hentai camgirl camgirls escort escorts nsfw pornstar sexcam".split())
#: This many distinct ones of these block a URL.
SOFT = tuple("adult amateur babe bet bets bingo casino dating erotic fetish gambling girls hot jackpot lingerie lotto naked nude poker sex sexy slots teen video viagra webcam".split())
SOFT_HITS = 2

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Vocabulary:
    strict: tuple[str, ...] = STRICT
    soft: tuple[str, ...] = SOFT
    soft_hits: int = SOFT_HITS

    def machine(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for kind, terms in enumerate((self.soft, self.strict)):
            for term in terms:
                machine.add_word(term.lower(), (kind, term.lower()))
        if self.strict or self.soft:
            machine.make_automaton()
        return machine

    def hits(self, url: str | None, machine) -> tuple[int, int]:
        """(strict hits, distinct soft terms) of a URL; null has none."""
        text = (url or "").translate(_ASCII_LOWER)
        strict, soft = 0, set()
        for end, (kind, term) in machine.iter(text) if len(machine) else ():
            start = end - len(term) + 1
            if (start == 0 or not _joins(text[start - 1])) and (end + 1 == len(text) or not _joins(text[end + 1])):
                if kind:
                    strict += 1
                else:
                    soft.add(term)
        return strict, len(soft)


_ASCII_LOWER = str.maketrans(UPPER, LOWER)


def _joins(sign: str) -> bool:
    return "a" <= sign <= "z" or "0" <= sign <= "9"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty where it is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"(?s)^([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (null if none), and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, vocabulary: Vocabulary = Vocabulary(), rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, strict_hits, soft_hits.

    Pages are judged one by one: repeated rows repeat, a null or empty URL has
    empty host and path, no rule and no hits and is allowed; an empty table
    gives no rows; other columns are ignored.  Rules of equal length: the later
    one in the list decides.
    """

    def count(batches):
        machine = vocabulary.machine()
        for batch in batches:
            found = [vocabulary.hits(u, machine) for u in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32())], ["page_id", "url", "strict_hits", "soft_hits"])

    counted = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url")).mapInArrow(count, "page_id long, url string, strict_hits int, soft_hits int")
    host, path = host_and_path(F.col("url"))
    split = counted.select("page_id", host.alias("host"), path.alias("path"), "strict_hits", "soft_hits")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    words = F.when((F.col("strict_hits") >= 1) | (F.col("soft_hits") >= vocabulary.soft_hits), "block").otherwise("allow")
    return split.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, words).alias("verdict"), "strict_hits", "soft_hits")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _fits(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


_BEST_FIRST = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
_SOFT = " + ".join(f"CAST(regexp_matches(u, '(^|[^a-z0-9]){t}($|[^a-z0-9])') AS INTEGER)" for t in SOFT)
# The signs between words are doubled, so that each may close one hit and open the next.
_STRICT = " + ".join(f"len(regexp_extract_all(u2, '[^a-z0-9]{t}[^a-z0-9]'))" for t in STRICT)

OP8_SQL = f"""
WITH a AS (
  SELECT page_id, coalesce(url, '') AS url, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS u FROM pages
), r AS (
  SELECT page_id, u, '|' || regexp_replace(u, '([^a-z0-9])', '\\1\\1', 'g') || '|' AS u2,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM a
), h AS (
  SELECT page_id, u, u2, rest, regexp_extract(rest, '(?s)^([^/?#]*)', 1) AS raw FROM r
), p AS (
  SELECT page_id, u, u2, translate(raw, '{UPPER}', '{LOWER}') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '(?s)^([^?#]*)', 1) AS path FROM h
), c AS (
  SELECT page_id, host, path,
         CASE {" ".join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for h, p, _ in _BEST_FIRST)} END AS rule,
         CASE {" ".join(f"WHEN {_fits(h, p)} THEN '{v}'" for h, p, v in _BEST_FIRST)} END AS said,
         CAST({_STRICT} AS INTEGER) AS strict_hits, CAST({_SOFT} AS INTEGER) AS soft_hits FROM p
)
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN strict_hits >= 1 OR soft_hits >= {SOFT_HITS} THEN 'block' ELSE 'allow' END) AS verdict,
       strict_hits, soft_hits FROM c
"""

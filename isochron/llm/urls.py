"""URL filter: host and path rules first, then a weighted vocabulary found by an Aho-Corasick automaton.

Strict terms reject on one hit; soft terms reject when enough different ones are found. A hit counts only between boundaries
(characters other than letters, or the ends), so "bet" is not found in "alphabet".
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Terms of unwanted sites. One of these is enough.
STRICT_TERMS = tuple(
    "porn porno pornos xxx sex sexcam sexcams hentai milf nsfw escort escorts camgirl camgirls hardcore bdsm fetish "
    "casino casinos sportsbook bookmaker roulette blackjack baccarat viagra cialis levitra xanax tramadol steroids pills "
    "malware phishing ransomware keylogger botnet spyware trojan warez crackz keygen keygens serialz spam spammer "
    "counterfeit replicas darknet fakeid".split()
)
# Terms that many good sites have too. Only several different ones together reject.
SOFT_TERMS = tuple(
    "adult adults nude nudes naked erotic dating hookup hookups singles webcam webcams cams gambling gamble bet bets betting jackpot lottery lotto "
    "poker slots bingo payday loan loans credit bonus bonuses cheap discount coupon coupons promo promos deal deals free freebie freebies giveaway "
    "win winner winners prize prizes earn cash money investment forex crypto bitcoin ads adserver affiliate affiliates popup popups banner tracker "
    "track click clicks clickbait farm hack hacks hacked crack cracked torrent torrents pirate pirated leaked proxy replica rolex weightloss diet "
    "miracle cure".split()
)
SOFT_LIMIT = 2


@dataclass(frozen=True)
class SiteRule:
    """What begins with `path` on `host` and its subdomains is allowed or blocked."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


SITE_RULES = (
    SiteRule("org", "/", "allow"),
    SiteRule("example.org", "/es/", "block"),
    SiteRule("example.org", "/en/1", "block"),
    SiteRule("com", "/fr/", "allow"),
    SiteRule("com", "/de/", "block"),
)

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(rest, CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[SiteRule]) -> Column:
    """The longest rule that fits, as a struct of name and verdict; null if none does."""
    found = F.lit(None)
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


@lru_cache(maxsize=8)
def automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for kind, terms in (("strict", strict), ("soft", soft)):
        for term in terms:
            built.add_word(term, (kind, term))
    built.make_automaton()
    return built


def hits(url: str, strict: tuple[str, ...], soft: tuple[str, ...]) -> tuple[int, int]:
    """How many strict hits and how many different soft terms a URL has."""
    n, distinct = 0, set()
    for last, (kind, term) in automaton(strict, soft).iter(url):
        first = last - len(term) + 1
        if (first and "a" <= url[first - 1] <= "z") or (last + 1 < len(url) and "a" <= url[last + 1] <= "z"):
            continue
        if kind == "strict":
            n += 1
        else:
            distinct.add(term)
    return n, len(distinct)


def count_terms(url: Column, strict: Sequence[str], soft: Sequence[str]) -> Column:
    strict, soft = tuple(strict), tuple(soft)

    @F.pandas_udf("struct<strict_hits:bigint,soft_terms:bigint>")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            yield pd.DataFrame([hits(u, strict, soft) for u in urls], columns=["strict_hits", "soft_terms"], dtype="int64")

    return count(F.translate(F.coalesce(url, F.lit("")), CAPITALS, SMALL))


def judge(
    pages: DataFrame, url: str = "url", rules: Sequence[SiteRule] = SITE_RULES, strict: Sequence[str] = STRICT_TERMS,
    soft: Sequence[str] = SOFT_TERMS, soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """All columns of `pages`, plus host, path, rule (null if none fits), strict_hits, soft_terms and verdict.

    The verdict is the rule's, else block on one strict hit or `soft_limit` different soft terms, else allow. A null, empty or
    malformed URL has an empty host and path; its terms still count. Columns that carry a name of the result are
    replaced. A map over the rows: no shuffle.
    """
    made = {"host", "path", "rule", "strict_hits", "soft_terms", "verdict", "_rule", "_terms", "_url"}
    rows = pages.select(*[c for c in pages.columns if c not in made or c == url], F.col(url).alias("_url"))
    rows = rows.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))})
    rows = rows.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("_terms", count_terms(F.col("_url"), strict, soft))
    bad = (F.col("_terms.strict_hits") >= 1) | (F.col("_terms.soft_terms") >= soft_limit)
    by_terms = F.when(bad, "block").otherwise("allow")
    return rows.withColumns({
        "rule": F.col("_rule.name"), "strict_hits": F.col("_terms.strict_hits"), "soft_terms": F.col("_terms.soft_terms"),
        "verdict": F.coalesce("_rule.verdict", by_terms),
    }).drop("_rule", "_terms", "_url")

"""URL filters: rules indexed by their rarest literal token; only candidate rules run their patterns."""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

_TOKENS = re.compile(r"[A-Za-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """A pattern over host, a zero byte, path. tokens: runs of ASCII letters and digits that every url it fits has as runs of
    their own; a rule without any is tried on every url. Among rules that fit, the longest name wins."""

    verdict: str
    name: str
    pattern: str
    tokens: tuple[str, ...]


def host_rule(verdict: str, host: str, path: str = "/") -> Rule:
    """Fits the host and all its subdomains where the path starts with `path`. It is matched against host, a zero byte, path."""
    ended = re.match(r".*(?![A-Za-z0-9]).", path, re.DOTALL)  # a path may go on after what the rule ends with
    return Rule(verdict, host + path, rf"(?:^|\.){re.escape(host)}\x00{re.escape(path)}", tuple(_TOKENS.findall(host) + _TOKENS.findall(ended[0] if ended else "")))


def word_rule(verdict: str, word: str) -> Rule:
    """Fits hosts with a label that has the word or words, such as cheap-pills."""
    return Rule(verdict, word, rf"(?:^|[.-]){re.escape(word)}(?:[.-][^\x00]*)?\x00", tuple(_TOKENS.findall(word)))


def path_rule(verdict: str, part: str) -> Rule:
    """Fits paths that have the part between slashes (at the path's end one may be missing), such as wp-admin."""
    return Rule(verdict, f"/{part}/", rf"\x00(?:[^\x00]*/)?{re.escape(part)}(?:/|$)", tuple(_TOKENS.findall(part)))


#: Words of hosts, by what such hosts offer; rules of the method, beside those that a caller gives.
# Labels that sites of these kinds put into their names (categories as public block lists have them).
HOST_WORDS = {
    "spam and unsolicited offers": "spam spam-farm linkfarm clickbait cashback payday-loans getrichquick freegift giveaway",
    "medicine without prescription": "cheap-pills pills viagra cialis levitra tramadol xanax steroids",
    "gambling": "casino casinos poker roulette blackjack slots betting bookmaker jackpot lottery sportsbook",
    "adult": "porn porno xxx sex sexcams hentai escorts camgirls adultdating hookup milf",
    "advertising and tracking": "ads adserver adservice adsystem adnetwork doubleclick popads popunder tracker tracking pixel telemetry beacon affiliate affiliates",
    "unlicensed copies": "warez torrent torrents keygen cracks nulled serialz",
    "fraud and attacks": "phishing malware ransomware botnet exploit spyware stealer carding fakelogin",
}
# Parts of paths that lead to no text worth reading.
PATH_PARTS = {
    "administration and sign-in": "wp-admin wp-login.php phpmyadmin cpanel administrator login signin signup register",
    "programs and feeds": "cgi-bin xmlrpc.php feed rss trackback",
    "shops and sessions": "cart checkout basket wishlist order-status",
    "advertising and redirects": "adclick adserve banner banners popunder outgoing redirect.php goto.php",
}
DEFAULT_RULES = (*(word_rule("block", w) for words in HOST_WORDS.values() for w in words.split()), *(path_rule("block", x) for parts in PATH_PARTS.values() for x in parts.split()))


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end; A-Z in lower case; empty for null and for urls without ://."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def index_rules(pages: DataFrame, rules: tuple[Rule, ...], host_col: str = "host", path_col: str = "path") -> dict[str | None, list[Rule]]:
    """Token to rules: each rule under the one of its tokens that the fewest urls have (ties: the first in order); under None
    the rules without tokens, which are always tried.

    Counts cover all rows; only tokens that some rule has are counted, so what comes back is bounded by the rules."""
    named = sorted({t for r in rules for t in r.tokens})
    tokens = F.array_distinct(F.regexp_extract_all(F.concat_ws(" ", host_col, path_col), F.lit("([A-Za-z0-9]+)"), 1))
    counts = {r[0]: r[1] for r in pages.select(F.explode(F.array_intersect(tokens, F.array(*map(F.lit, named)) if named else F.array().cast("array<string>"))).alias("t")).groupBy("t").count().collect()}
    index: dict[str | None, list[Rule]] = {}
    for r in rules:
        index.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), t), default=None), []).append(r)
    return index


def judge(pages: DataFrame, rules: tuple[Rule, ...], defaults: tuple[Rule, ...] = DEFAULT_RULES, url_col: str = "url") -> DataFrame:
    """pages with host, path, rule, verdict, reason; columns of those names are replaced.

    The tokens of a url's host and path fetch the rules indexed under them, and only these run their patterns. Of `rules` that fit, the one of
    the longest name decides (ties: the first in order of name); rule is its name. Otherwise rule is null and `defaults`
    decide the same way; where none fits the url is allowed. reason: the name of what decided, null for nothing. Null
    urls have an empty host and path, which no rule with tokens fits. Rows that repeat each have their row, whole urls are
    judged however long, an empty table gives no rows; no row moves.
    """
    url = F.col(url_col)
    held = pages.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    index = pages.sparkSession.sparkContext.broadcast(index_rules(held, (*rules, *defaults)))
    mine = frozenset(rules)

    @F.pandas_udf("rule string, verdict string, reason string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        compiled: dict[str, re.Pattern] = {}
        lists = {t: list(rs) for t, rs in index.value.items()}

        def decide(host, path):
            best = None
            for token in {None, *_TOKENS.findall(host), *_TOKENS.findall(path)}.intersection(lists):
                for r in lists[token]:
                    p = compiled.get(r.pattern) or compiled.setdefault(r.pattern, re.compile(r.pattern))
                    if p.search(f"{host}\x00{path}"):
                        key = (r not in mine, -len(r.name), r.name)
                        if best is None or key < best[0]:
                            best = (key, r)
            if best is None:
                return None, "allow", None
            r = best[1]
            return (r.name if r in mine else None), r.verdict, r.name

        for hosts, paths in batches:
            yield pd.DataFrame([decide(h, p) for h, p in zip(hosts, paths, strict=True)], columns=["rule", "verdict", "reason"], dtype=object)

    judged = free_name(held, "judged")
    found = held.withColumn(judged, run("host", "path"))
    return found.withColumns({c: F.col(f"{judged}.{c}") for c in ("rule", "verdict", "reason")}).drop(judged)

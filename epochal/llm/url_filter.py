"""URL filters: host and path rules, then a weighted URL vocabulary counted by Aho-Corasick.

A rule is (verdict, host, path): it fits its host and all subdomains where the url's path starts with
the rule's path; the longest fitting rule text ``host + path`` wins. Urls that no rule fits are judged by
the vocabulary: one pass of an automaton over the lower-cased url finds strict and soft terms; a hit
counts only if no letter or digit stands beside it. One strict hit or several distinct soft hits block.

Edge cases: a null url, or one without ``://``, has an empty host and path and is still searched for
terms (a null one is allowed); rows are judged one by one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package

# fixed values: the vocabulary of the production query
STRICT = (
    "porn", "porno", "pornos", "pornstar", "pornographie", "xxx", "xvideos", "hentai", "camgirl", "camgirls", "sexcam", "sexcams", "nudes", "milf", "milfs",
    "escorts", "escortgirls", "escorte", "putas", "hookers", "blowjob", "creampie", "gangbang", "deepthroat", "fetisch", "bdsm", "upskirt", "incest",
    "sexchat", "sexshop", "sextreff", "sexkontakte", "erotik", "erotikfilme", "erotica", "erotique", "striptease", "swinger", "bangbros", "livesex",
)
SOFT = (
    "adult", "adults", "sex", "sexy", "nude", "naked", "nackt", "desnudas", "dating", "flirt", "singles", "hookup", "casino", "casinos", "kasino", "betting",
    "bet", "bets", "wetten", "apuestas", "paris-sportifs", "poker", "roulette", "blackjack", "slots", "jackpot", "bingo", "lottery", "lotto", "loteria", "gambling",
    "viagra", "cialis", "levitra", "kamagra", "steroids", "pharmacy", "apotheke", "farmacia", "pills", "torrent", "torrents", "warez", "crack", "cracked", "keygen",
    "serials", "nulled", "payday", "loan", "loans", "kredit", "prestamos", "forex", "crypto", "bitcoin", "replica", "replicas", "freebies", "giveaway", "proxy",
)
MIN_SOFT = 2
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty if it is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def vocabulary(strict, soft) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for weight, terms in (("strict", strict), ("soft", soft)):
        for term in terms:
            automaton.add_word(term, (weight, term))
    automaton.make_automaton()
    return automaton


def _part(c: str) -> bool:
    return c.isascii() and c.isalnum()


def count_terms(automaton: ahocorasick.Automaton, url: str) -> tuple[int, int]:
    """Distinct strict and distinct soft terms in a lower-cased url, bounded by neither letter nor digit."""
    hits = set()
    for end, (weight, term) in automaton.iter(url):
        start = end - len(term)
        if (start < 0 or not _part(url[start])) and (end + 1 == len(url) or not _part(url[end + 1])):
            hits.add((weight, term))
    strict = sum(w == "strict" for w, _ in hits)
    return strict, len(hits) - strict


def longest_rule(rules: dict[str, list[tuple[str, str]]], host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule for a host's suffixes; ties go to the longer host."""
    best = None
    at = 0
    while host and at >= 0:
        suffix = host[at:]
        for start, verdict in rules.get(suffix, ()):
            if path.startswith(start) and (best is None or len(suffix + start) > len(best[0])):
                best = (suffix + start, verdict)
        at = host.find(".", at) + 1 or -1
    return best


def judge(pages: DataFrame, *, rules=RULES, strict=STRICT, soft=SOFT, min_soft: int = MIN_SOFT) -> DataFrame:
    """Per row of (page_id, url): page_id, host, path, rule, verdict, n_strict, n_soft."""
    ship_package(pages.sparkSession)
    by_host: dict[str, list[tuple[str, str]]] = {}
    for verdict, host, path in rules:
        by_host.setdefault(host, []).append((path, verdict))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = vocabulary(strict, soft)
        for batch in batches:
            rows = []
            for url, host, path in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                n_strict, n_soft = count_terms(automaton, (url or "").lower())
                rule, verdict = longest_rule(by_host, host, path) or (None, "block" if n_strict or n_soft >= min_soft else "allow")
                rows.append((rule, verdict, n_strict, n_soft))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            made = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), *made],
                ["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft"],
            )

    host, path = host_and_path(F.col("url"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", host.alias("host"), path.alias("path")).mapInArrow(
        run, f"page_id {kind}, host string, path string, rule string, verdict string, n_strict long, n_soft long"
    )


def sql(rules=RULES, strict=STRICT, soft=SOFT, min_soft: int = MIN_SOFT) -> str:
    """The same verdicts in DuckDB SQL."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [(v, h + p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for v, h, p in longest]
    hit = lambda t: f"regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::BIGINT"
    return f"""
WITH p AS (SELECT page_id, lower(coalesce(url, '')) AS low,
  CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
  regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path,
  {" + ".join(map(hit, strict))} AS n_strict, {" + ".join(map(hit, soft))} AS n_soft FROM p),
r AS (SELECT *, CASE {" ".join(f"WHEN {c} THEN '{t}'" for _, t, c in fits)} END AS rule,
  CASE {" ".join(f"WHEN {c} THEN '{v}'" for v, _, c in fits)} END AS ruled FROM q)
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN n_strict > 0 OR n_soft >= {min_soft} THEN 'block' ELSE 'allow' END) AS verdict,
  n_strict, n_soft FROM r"""

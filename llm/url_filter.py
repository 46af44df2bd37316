"""URL filters: a weighted vocabulary counted by one Aho-Corasick scan, below host and path rules.

The vocabulary has strict terms (one hit rejects) and soft terms (several *distinct* hits reject).
A hit counts only between boundaries: the character before and after it is no ASCII letter or digit.
Explicit rules on host and path come first; the longest rule that fits decides.

Defined cases: a null url, or one without ``://``, has an empty host and path and no rule; a null url has no
hits. Repeated rows are judged each for itself. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# The vocabulary of this filter.
STRICT = ("bestiality", "camgirl", "camgirls", "hentai", "hardcore", "milf", "nsfw", "porn", "porno", "pornography", "sexcam", "xxx")
SOFT = (
    "adult", "babes", "bet", "betting", "bonus", "casino", "cheap", "dating", "escort", "free", "gambling", "girls",
    "hot", "jackpot", "lottery", "naked", "nude", "pills", "poker", "pussy", "sex", "sexy", "slots", "teen", "torrent",
    "viagra", "warez", "webcam", "wild", "win",
)
SOFT_LIMIT = 2


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_AUTOMATA: dict[tuple[str, ...], ahocorasick.Automaton] = {}


def host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased."""
    after = F.substr(url, F.instr(url, "://") + F.lit(3))
    found = F.regexp_extract(after, r"(?s)^[^/?#]*", 0)
    return F.when(F.instr(url, "://") > 0, F.translate(found, _UPPER, _LOWER)).otherwise("")


def path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    after = F.substr(url, F.instr(url, "://") + F.lit(3))
    found = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, found).otherwise("")


def _fits(rule: Rule, host_: Column, path_: Column) -> Column:
    return ((host_ == rule.host) | host_.endswith("." + rule.host)) & path_.startswith(rule.path)


def automaton(terms: tuple[str, ...]) -> ahocorasick.Automaton:
    """One automaton per worker process and vocabulary."""
    if terms not in _AUTOMATA:
        made = ahocorasick.Automaton()
        for number, term in enumerate(terms):
            made.add_word(term, (number, len(term)))
        made.make_automaton()
        _AUTOMATA[terms] = made
    return _AUTOMATA[terms]


def _bounded(text: str, start: int, end: int) -> bool:
    outside = (text[start - 1 : start] if start else "", text[end : end + 1])
    return not any(c.isascii() and c.isalnum() for c in outside)


def term_hits(url: str | None, terms: tuple[str, ...]) -> set[int]:
    """Numbers of the terms that occur between boundaries."""
    text = (url or "").translate({ord(u): l for u, l in zip(_UPPER, _LOWER)})
    return {
        number for end, (number, length) in automaton(terms).iter(text) if _bounded(text, end - length + 1, end + 1)
    }


def judge(
    pages: DataFrame,
    strict: tuple[str, ...] = STRICT,
    soft: tuple[str, ...] = SOFT,
    soft_limit: int = SOFT_LIMIT,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """page_id, host, path, n_strict, n_soft (distinct terms), rule, verdict for each row of (page_id, url)."""
    terms = tuple(strict) + tuple(soft)

    @F.pandas_udf("struct<n_strict: int, n_soft: int>")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            hits = [term_hits(u, terms) for u in urls]
            strict_hits = [sum(n < len(strict) for n in h) for h in hits]
            yield pd.DataFrame({"n_strict": strict_hits, "n_soft": [len(h) - s for h, s in zip(hits, strict_hits)]}).astype("int32")

    seen = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    seen = seen.select("page_id", "host", "path", counted("url").alias("hits"))
    rule, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):  # later, longer rules overrule
        fits = _fits(r, F.col("host"), F.col("path"))
        rule, decided = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(decided)
    by_terms = F.when((F.col("hits.n_strict") >= 1) | (F.col("hits.n_soft") >= soft_limit), "block").otherwise("allow")
    return seen.select(
        "page_id", "host", "path", "hits.n_strict", "hits.n_soft", rule.alias("rule"), F.coalesce(decided, by_terms).alias("verdict")
    )


def sql() -> str:
    """The same as SQL: each term is one pattern with boundaries."""
    def hits(terms):
        return " + ".join(
            f"regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::INT" for t in terms
        )

    ordered = sorted(RULES, key=lambda r: -len(r.text))
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in ordered]
    rule = " ".join(f"WHEN {f} THEN '{r.text}'" for f, r in zip(fits, ordered))
    verdict = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, ordered))
    return f"""
        WITH cut AS (
            SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low,
                   CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        parts AS (
            SELECT page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
        hits AS (SELECT *, ({hits(STRICT)})::INT AS n_strict, ({hits(SOFT)})::INT AS n_soft FROM parts)
        SELECT page_id, host, path, n_strict, n_soft, CASE {rule} END AS rule,
               CASE {verdict} WHEN n_strict >= 1 OR n_soft >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
        FROM hits"""

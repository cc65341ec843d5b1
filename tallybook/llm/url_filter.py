"""URL filter: host/path rules first, then a weighted vocabulary matched by Aho-Corasick.

A rule fits its host and all subdomains where the path starts with the rule's path; the longest fitting rule decides.
The automaton scans every lower-cased url once for all terms. A hit counts only where the characters before and after it are
not ASCII letters or digits. Each distinct term found adds its weight, and a weight of ``limit`` blocks the url where no rule fits:
one strict term (whose weight is the limit) or several distinct soft ones.

Rules are plain expressions. Urls pass through an Arrow batch UDF; the automaton is built once per task. The vocabulary is a
mapping or a table (term, weight) of at most MOST_TERMS rows, which is checked.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is allowed unless its text
holds the terms; very long urls are scanned whole; repeated rows are judged alike; an empty table gives no rows; an empty vocabulary
blocks nothing; of rules of one length that fit, the one listed last decides; other columns are left alone, but for those that are named like a result.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator, Mapping

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import table

#: (action, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Terms that block alone, by theme: adult, drugs sold without prescription, gambling, piracy, deceit.
STRICT = (
    "adult-x", "porn", "porno", "xxx", "hentai", "camgirls", "sexcam", "milf", "nudes", "onlynudes",
    "cheap-pills", "viagra", "cialis", "levitra", "no-prescription", "tramadol-online",
    "casino-win", "online-casino", "casino-bonus", "slot-machines",
    "warez", "keygen", "serialz", "nulled", "crackz",
    "spam-farm", "link-farm", "phishing", "ddos-for-hire", "get-rich-quick", "buy-followers",
)
#: Terms that also stand in decent urls, so that two distinct ones are needed.
SOFT = (
    "adult", "sex", "nude", "escort", "dating", "webcam", "fetish", "erotic", "singles",
    "pills", "pharmacy", "diet", "supplements", "cbd", "vape", "cannabis",
    "casino", "bets", "betting", "free-bets", "poker", "roulette", "slots", "jackpot", "bingo", "lottery", "bonus",
    "torrent", "crack", "serial", "mp3", "rapidshare", "download-free", "stream-free",
    "ads-track", "popunder", "clickbait", "affiliate", "loan", "payday", "credit-repair", "replica", "giveaway", "forex", "binary-options", "crypto-doubler",
)
LIMIT = 1.0
#: One strict term or two distinct soft ones reach the limit.
VOCABULARY = {t: LIMIT for t in STRICT} | {t: LIMIT / 2 for t in SOFT}
MOST_TERMS = 1_000_000
_WORD = frozenset(string.ascii_letters + string.digits)
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _automaton(weights: Mapping[str, float]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for term, weight in weights.items():
        a.add_word(term, (term, weight))
    a.make_automaton()
    return a


def found_terms(url: str, automaton: ahocorasick.Automaton) -> dict[str, float]:
    """Distinct terms that stand in ``url`` between boundaries, with their weights."""
    found = {}
    for end, (term, weight) in automaton.iter(url):
        start = end - len(term) + 1
        if (start == 0 or url[start - 1] not in _WORD) and (end + 1 == len(url) or url[end + 1] not in _WORD):
            found[term] = weight
    return found


def vocabulary_of(terms: Mapping[str, float] | DataFrame) -> dict[str, float]:
    """Lower-cased terms with their largest weight; a table (term, weight) of more than MOST_TERMS rows is refused, blank terms are left out."""
    if isinstance(terms, DataFrame):
        rows = terms.select("term", "weight").where("term IS NOT NULL AND weight IS NOT NULL").limit(MOST_TERMS + 1).collect()
        if len(rows) > MOST_TERMS:
            raise ValueError(f"a vocabulary of more than {MOST_TERMS} terms")
    else:
        rows = terms.items()
    out: dict[str, float] = {}
    for term, weight in rows:
        term = term.translate(_LOWER)
        if term:
            out[term] = max(float(weight), out.get(term, float(weight)))
    return out


def _lower(url: Column) -> Column:
    return F.translate(url, string.ascii_uppercase, string.ascii_lowercase)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path, both empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = _lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    there = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    return F.when(there, host).otherwise(""), F.when(there, path).otherwise("")


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, vocabulary: Mapping[str, float] | DataFrame = VOCABULARY, limit: float = LIMIT) -> DataFrame:
    """``pages`` with host, path, rule, n_strict, n_soft (distinct terms that block alone, and others), weight and verdict (columns of these names are replaced)."""
    weights = vocabulary_of(vocabulary)
    host, path = split_url(F.col("url"))
    out = pages.withColumns({"host": host, "path": path})
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for does, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest last: it is asked first
        fits = ((F.col("host") == rule_host) | F.col("host").endswith("." + rule_host)) & F.col("path").startswith(rule_path)
        rule, action = F.when(fits, rule_host + rule_path).otherwise(rule), F.when(fits, does).otherwise(action)
    out = out.withColumns({"rule": rule, "__action": action})

    @F.pandas_udf("n_strict int, n_soft int, weight double")
    def terms(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(weights)
        for urls in batches:
            found = [list(found_terms(u, automaton).values()) if u and weights else [] for u in urls]
            yield pd.DataFrame([(sum(w >= limit for w in f), sum(w < limit for w in f), float(sum(f))) for f in found], columns=["n_strict", "n_soft", "weight"])

    counts = terms(_lower(F.col("url")))
    out = out.withColumn("__n", counts).withColumns({c: F.col(f"__n.{c}") for c in ("n_strict", "n_soft", "weight")})
    by_terms = F.when(F.col("weight") >= limit, "block").otherwise("allow")
    return out.withColumn("verdict", F.coalesce(F.col("__action"), by_terms)).drop("__action", "__n")


def op7_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft")


def _sql_count(terms: tuple[str, ...]) -> str:
    return " + ".join(f"(regexp_matches(u, '(^|[^a-zA-Z0-9]){t}($|[^a-zA-Z0-9])'))::INT" for t in terms)


ORACLE = f"""
WITH a AS (SELECT page_id, url, instr(coalesce(url, ''), '://') AS pos, translate(coalesce(url, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS u FROM pages),
b AS (SELECT *, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM a),
c AS (SELECT page_id, u, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM b),
d AS (SELECT *, ({_sql_count(STRICT)})::INT AS n_strict, ({_sql_count(SOFT)})::INT AS n_soft,
  CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
       WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
       WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
       WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM c)
SELECT page_id, host, path, rule, n_strict, n_soft,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN n_strict >= 1 OR n_soft >= 2 THEN 'block' ELSE 'allow' END AS verdict FROM d
"""

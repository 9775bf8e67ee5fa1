"""URL filter: host and path rules first, then a weighted vocabulary.

One Aho-Corasick pass over the lower-cased URL finds all terms; a hit counts where no ASCII letter
or digit touches it. A strict term weighs BLOCK_WEIGHT alone, distinct soft terms weigh 1 each, and
a URL that reaches BLOCK_WEIGHT is blocked. A rule fits its host and subdomains where the path
starts with the rule's path; the longest rule wins over the vocabulary.

Null URLs and those without :// have an empty host and path and no rule; null URLs have no terms
and are allowed. Repeated rows are each judged. Extra columns are ignored. An empty table gives
an empty result.
"""

import pyarrow as pa
from pyspark.sql import functions as F

from quillon.session import ship_package

STRICT = ("adult", "casino", "escort", "hentai", "porn", "sex", "viagra", "xxx")
SOFT = ("bet", "bets", "bonus", "cash", "cheap", "click", "farm", "free", "jackpot", "loan", "poker", "prize", "spam", "win", "winner")
BLOCK_WEIGHT = 2
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALNUM = set(_LOWER + _UPPER + "0123456789")
_FOLD = str.maketrans(_UPPER, _LOWER)


def automaton(strict, soft):
    import ahocorasick

    a = ahocorasick.Automaton()
    for i, (word, weight) in enumerate([*((w, BLOCK_WEIGHT) for w in strict), *((w, 1) for w in soft)]):
        a.add_word(word, (i, len(word), weight))
    a.make_automaton()
    return a


def weight(a, url):
    """Summed weight of the distinct terms that stand alone in the URL."""
    url = url.translate(_FOLD)
    found = {}
    for end, (i, n, w) in a.iter(url):
        start = end - n + 1
        if (start == 0 or url[start - 1] not in _ALNUM) and (end + 1 == len(url) or url[end + 1] not in _ALNUM):
            found[i] = w
    return sum(found.values())


def _weigh(batches, strict, soft):
    a = automaton(strict, soft)
    for batch in batches:
        got = [weight(a, u) if u else 0 for u in batch.column("url").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(got, pa.int64())], ["page_id", "url", "weight"])


def judge_urls(pages, rules=RULES, strict=STRICT, soft=SOFT):
    """page_id, host, path, rule, verdict, weight."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.mapInArrow(lambda it: _weigh(it, strict, soft), "page_id long, url string, weight long")
    rows = rows.withColumn("rest", F.expr("CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"))
    rows = rows.withColumn("host", F.translate(F.regexp_extract("rest", "^[^/?#]*", 0), _UPPER, _LOWER)).withColumn("path", F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1))
    rule, verdict = F, F
    for i, (name, what) in enumerate(sorted(rules, key=lambda r: (-len(r[0]), r[0]))):
        host, _, path = name.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(f"/{path}")
        rule, verdict = rule.when(fits, F.lit(name)), verdict.when(fits, F.lit(what))
    by_terms = F.when(F.col("weight") >= BLOCK_WEIGHT, "block").otherwise("allow")
    none = F.lit(None).cast("string")
    return rows.select("page_id", "host", "path", (rule.otherwise(none) if rules else none).alias("rule"), F.coalesce(verdict.otherwise(none) if rules else none, by_terms).alias("verdict"), "weight")


def oracle():
    """DuckDB SQL for judge_urls over pages."""
    alone = lambda w: f"(CASE WHEN regexp_matches(low, '(^|[^a-z0-9]){w}([^a-z0-9]|$)') THEN 1 ELSE 0 END)"
    total = " + ".join([*(f"{BLOCK_WEIGHT} * {alone(w)}" for w in STRICT), *(alone(w) for w in SOFT)])
    fits, names, verdicts = [], "CASE", "CASE"
    for name, what in sorted(RULES, key=lambda r: (-len(r[0]), r[0])):
        host, _, path = name.partition("/")
        fits = f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}'))"
        names += f" WHEN {fits} THEN '{name}'"
        verdicts += f" WHEN {fits} THEN '{what}'"
    return f"""
WITH a AS (SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, CAST({total} AS BIGINT) AS weight FROM a)
SELECT page_id, host, path, {names} END AS rule,
    coalesce({verdicts} END, CASE WHEN weight >= {BLOCK_WEIGHT} THEN 'block' ELSE 'allow' END) AS verdict, weight FROM b"""

"""URL filter: host and path rules, and a weighted vocabulary found by Aho-Corasick.

One automaton of all terms, built once a task, runs over each lower-cased url. A
hit counts if the characters on both sides of it aren't letters or digits. Each
distinct term counts once; a url is rejected by one strict term, or when its distinct soft
terms weigh ``limit`` or more together. The vocabulary is a table (term, weight; a null
weight: strict), a mapping of the same, or the short list below. Where a rule fits the host (or a parent domain) and the path's
beginning, the longest such rule decides instead. There is no shuffle.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import per_batch, pick

STRICT = ["casino", "cheap-pills", "hardcore", "malware", "phishing", "porn", "spam-farm", "viagra", "warez", "xxx"]
SOFT = ["adult", "bet", "bets", "bonus", "cheap", "crack", "dating", "free", "gambling", "jackpot", "keygen", "loan",
        "loans", "lottery", "pills", "poker", "sex", "slots", "spam", "torrent", "win"]
LIMIT = 2

#: (verdict, host, path): the host and all its subdomains, paths that begin so.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(strict: list[str] = STRICT, soft: list[str] | dict[str, int] = SOFT) -> dict[str, int | None]:
    """Term -> weight, None for a strict one; soft terms without a weight weigh 1. A term in both is strict."""
    weights = soft if isinstance(soft, dict) else dict.fromkeys(soft, 1)
    return weights | dict.fromkeys(strict, None)


#: Terms a vocabulary may have: the automaton is built in every task.
MAX_TERMS = 1_000_000


def terms_of(given: DataFrame | dict[str, int | None]) -> dict[str, int | None]:
    """A checked vocabulary, lower-cased A-Z. Of rows that repeat a term the strict, else the heaviest counts;
    a null term is skipped. Raises for an empty term, a weight under 1 and more than ``MAX_TERMS`` terms."""
    if isinstance(given, DataFrame):
        rows = given.where("term IS NOT NULL").select("term", "weight").distinct().limit(MAX_TERMS + 1).collect()
    else:
        rows = list(given.items())
    if len(rows) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} terms")
    out: dict[str, int | None] = {}
    for term, weight in rows:
        if not term or (weight is not None and weight < 1):
            raise ValueError("an empty term or a weight under 1")
        term = term.translate(str.maketrans(UPPER, LOWER))
        known = out.get(term, 0)
        out[term] = None if weight is None or known is None else max(known, int(weight))
    return out


def automaton(terms: dict[str, int | None]) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for term in terms:
        out.add_word(term, term)
    out.make_automaton()
    return out


def distinct_hits(found: ahocorasick.Automaton, text: str) -> set[str]:
    """The terms that stand in the text as whole words; ``text`` is lower case."""
    inner = lambda c: "a" <= c <= "z" or "0" <= c <= "9"
    out = set()
    for last, term in found.iter(text):
        first = last - len(term) + 1
        if (not first or not inner(text[first - 1])) and (last + 1 == len(text) or not inner(text[last + 1])):
            out.add(term)
    return out


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=None,
          terms: DataFrame | dict[str, int | None] | None = None, limit: int = LIMIT) -> DataFrame:
    """(id, host, path, rule, verdict, strict_hits, soft_hits, soft_weight): one row per row.

    A null url, or one without ``://``, has an empty host and path, so no rule fits
    it; its text, if any, is still searched. Hosts are compared whole, with a port or
    user name if there is one. Of equally long rules the first listed wins.
    """
    rules = RULES if rules is None else rules
    terms = terms_of(vocabulary() if terms is None else terms)
    rows = pick(pages, id=id_col, url=url_col)
    schema = T.StructType([rows.schema["id"], rows.schema["url"], T.StructField("strict_hits", T.IntegerType()),
                           T.StructField("soft_hits", T.IntegerType()), T.StructField("soft_weight", T.LongType())])
    lower = str.maketrans(UPPER, LOWER)

    def work():
        found = automaton(terms) if terms else None

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            hits = [distinct_hits(found, u.translate(lower)) if u and found else () for u in b.column(1).to_pylist()]
            soft = [[terms[t] for t in h if terms[t] is not None] for h in hits]
            strict = [len(h) - len(s) for h, s in zip(hits, soft, strict=True)]
            return pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(strict, pa.int32()), pa.array([len(s) for s in soft], pa.int32()),
                 pa.array([sum(s) for s in soft], pa.int64())], names=schema.names)
        return step

    found = per_batch(rows, work, schema, text_at=1)
    rest = F.coalesce(F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    found = found.select("id", host.alias("host"), path.alias("path"), "strict_hits", "soft_hits", "soft_weight")
    fits = F.lit(None).cast("string")
    verdict = F.when((F.col("strict_hits") > 0) | (F.col("soft_weight") >= limit), "block").otherwise("allow")
    for says, h, p in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):
        fit = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        fits, verdict = F.when(fit, h + p).otherwise(fits), F.when(fit, says).otherwise(verdict)
    return found.select("id", "host", "path", fits.alias("rule"), verdict.alias("verdict"), "strict_hits", "soft_hits",
                        "soft_weight")


def _sql_hits(terms: list[str]) -> str:
    return " + ".join(f"CAST(regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS INT)" for t in terms)


def _sql_rules(what) -> str:
    ordered = sorted(RULES, key=lambda r: -len(r[1]) - len(r[2]))
    return " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{what(v, h, p)}'"
                    for v, h, p in ordered)


ORACLE = f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS u,
    CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
cut AS (
  SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
hits AS (SELECT *, {_sql_hits(STRICT)} AS strict_hits, {_sql_hits(SOFT)} AS soft_hits FROM cut)
SELECT page_id, host, path, CASE {_sql_rules(lambda v, h, p: h + p)} END AS rule,
  CASE {_sql_rules(lambda v, h, p: v)} WHEN strict_hits > 0 OR soft_hits >= {LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
  strict_hits, soft_hits, CAST(soft_hits AS BIGINT) AS soft_weight
FROM hits
"""

import random
import re

import pytest

from quayside.llm import urlfilter as U

URLS = [None, "", "no scheme casino", "http://", "https://A.B.Example.ORG/es/1", "http://example.org/en/12?x=/es/", "http://example.org:80/es/",
        "http://notexample.org/es/", "http://x.com/fr/a", "http://x.com/de/a", "http://com/de/", "http://free-bets.net/", "http://freebets.net/",
        "http://a.net/Casino", "http://a.net/casinos", "http://a.net/?q=cheap+pills", "http://a.net/win", "x://y.com#/fr/", "://org/",
        "http://spam-farm.example.org/en/7", "http://a.net/" + "win-" * 5000, "http://É.com/fr/", "http://a.net/win/\nhttp://b.org/", "a://b://c.org/"]


def plain(url):
    u = re.sub("[A-Z]", lambda m: m[0].lower(), url or "")
    rest = (url or "").partition("://")[2]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.split(r"[/?#]", rest)[0])
    path = re.split(r"[?#]", rest[len(host):])[0]
    words = lambda t: re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", u)
    strict, soft = sum(bool(words(t)) for t in U.STRICT), sum(bool(words(t)) for t in U.SOFT)
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits)[1:] if fits else (None, "block" if strict or soft >= 2 else "allow")
    return host, path, rule, verdict, strict, soft, soft


def test_as_brute_force(spark):
    r = random.Random(6)
    urls = URLS + ["http://" + "".join(r.choices([*U.STRICT, *U.SOFT, "-", ".", "/", "x", "1", ".com", ".org", "/fr/", "?", "%20"], k=8)) for _ in range(500)]
    pages = spark.createDataFrame([(k, u, "h", 1) for k, u in enumerate(urls)], "page_id long, url string, host string, verdict int")
    got = {x.id: tuple(x)[1:] for x in U.judge(pages).collect()}
    assert got == {k: plain(u) for k, u in enumerate(urls)}


def test_repeats_nulls_other_vocabularies_and_empty_tables(spark):
    pages = spark.createDataFrame([(None, "http://a.net/foo-bar"), (None, "http://a.net/foo-bar"), (1, None)], "page_id long, url string")
    judge = lambda **a: sorted((str(x.id), x.verdict) for x in U.judge(pages, **a).collect())
    assert judge() == [("1", "allow"), ("None", "allow"), ("None", "allow")]
    assert judge(terms=U.vocabulary(["foo"], [])) == [("1", "allow"), ("None", "block"), ("None", "block")]
    assert judge(terms={}, rules=[("block", "net", "/"), ("allow", "a.net", "/")]) == judge()
    assert U.judge(pages.limit(0)).count() == 0
    for bad in ({"": 1}, {"x": 0, "y": 9}):
        with pytest.raises(ValueError):
            U.judge(pages, terms=bad, limit=4)


def test_a_weighted_vocabulary_of_thousands_of_terms_from_a_table(spark, monkeypatch):
    r = random.Random(8)
    terms = {f"t{k}{r.choice('abcdef')}": r.randrange(1, 6) for k in range(4000)} | {f"s{k}": None for k in range(500)}
    table = spark.createDataFrame([*terms.items(), ("T1A-b", 5), ("t1a-b", 2), ("s7", 1), (None, 3)], "term string, weight int")
    known = {**terms, "t1a-b": 5}
    urls = ["http://a.net/" + "-".join(r.choices([*known, "x", "plain"], weights=[1] * len(known) + [3000, 3000], k=r.randrange(1, 9)))
            for _ in range(600)] + ["http://T1A-B.net/", "http://a.net/s7/s7", "http://a.net/t1a-bc", "http://a.net/" + "t2a,t2b." * 4000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {x.id: (x.verdict, x.strict_hits, x.soft_hits, x.soft_weight) for x in U.judge(pages, terms=table, rules=[], limit=6).collect()}
    for k, u in enumerate(urls):
        low = u.lower()
        found = {t for t in known if t in low and re.search(rf"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", low)}
        strict = sum(known[t] is None for t in found)
        weight = sum(known[t] or 0 for t in found)
        assert got[k] == ("block" if strict or weight >= 6 else "allow", strict, len(found) - strict, weight), u
    assert {v[0] for v in got.values()} == {"allow", "block"}
    monkeypatch.setattr(U, "MAX_TERMS", 100)
    with pytest.raises(ValueError):
        U.judge(pages, terms=table)

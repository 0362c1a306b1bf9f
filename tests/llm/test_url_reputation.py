"""URL filters: cutting urls, rules, shrinkage and verdicts against plain Python, odd rows."""

import math
import re

import pytest
from pyspark.sql import functions as F

from contentspark.llm import url_reputation as op

PAGES, LABELS = "page_id long, url string, host string, n int", "doc_id long, quality int"

URLS = ["http://a.example.net/en/1", "https://EXAMPLE.net/EN/1", "http://example.net/en", "http://net/", "http://net", "http://xnet/",
        "http://b.example.com/de/x?y#z", "http://example.com/fr/", "http://x.org/fr/a", "http://x.org/en/a", "http://org/fr/", "",
        None, "no scheme", "http://", "://h/p", "a://b://c/d", "http://h?q=/net/", "http://h#f", "http://user@H.net:80/en/x?y",
        "HTTP://É.net/ä?x", "http://example.net/en/?a://b", "http://x.net/" + "p" * 50_000, "http://a.co.uk/x", "http://1.2.3.4/x",
        "http://a\nb.net/c\nd", "http://.net/", "http://a..net/en/"]


def plain_cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match(r"[^?#]*", rest[len(host):]).group()


def plain_rule(host, path):
    fit = [(len(r), r, v) for v, r in op.RULES for h, _, p in [r.partition("/")]
           if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fit)[1:] if fit else (None, None)


def test_cut_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash", 1) for i, u in enumerate(URLS)], PAGES)
    got = {r.page_id: r for r in op.judge(pages, spark.createDataFrame([], LABELS)).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = plain_cut(u)
        rule, verdict = plain_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == (verdict or "allow")


@pytest.mark.parametrize("host, domain, suffix", [
    ("www.a.example.org", "example.org", "org"), ("x.a.co.uk", "a.co.uk", "co.uk"), ("a.b", "a.b", "b"), ("host", "host", "host"),
    ("u@www.a.com:8080", "a.com", "com"), ("10.0.0.1", "10.0.0.1", "10.0.0.1"), ("", "", "")])
def test_domains(spark, host, domain, suffix):
    d, s = op.domains(F.col("h"))
    r = spark.createDataFrame([(host,)], "h string").select(d.alias("d"), s.alias("s")).first()
    assert (r.d, r.s) == (domain, suffix)


def counts():
    rows = []  # (host, good, bad)
    rows += [(f"h{i}.clean.org", 9, 0) for i in range(6)] + [(f"h{i}.spam.org", 1, 12) for i in range(6)]
    rows += [("new.spam.org", 0, 0), ("new.clean.org", 0, 0), ("one.clean.org", 0, 1), ("big.bad.com", 5, 400), ("tiny.bad.com", 0, 2)]
    return rows


def test_shrinkage(spark):
    pages, labels, n = [], [], 0
    for host, good, bad in counts():
        for quality, k in ((1, good), (0, bad), (None, 1)):
            for _ in range(k):
                pages.append((n, f"http://{host}/", "x", 0))
                labels.append((n, quality))
                n += 1
    labels += [(0, 1), (0, None)]
    out = op.judge(spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, LABELS), rules=[("allow", "nothing/")])
    r = {x.host: x for x in out.dropDuplicates(["host"]).collect()}
    assert r["h0.clean.org"].verdict == "allow" and r["big.bad.com"].verdict == "block" and r["h0.spam.org"].verdict == "block"
    assert r["one.clean.org"].verdict == "allow"  # one bad page doesn't outweigh the domain
    assert r["new.clean.org"].bad_rate < 0.2 < 0.7 < r["new.spam.org"].bad_rate  # from the domain alone
    assert r["h0.clean.org"].bad_rate < r["one.clean.org"].bad_rate < 1
    for x in r.values():
        assert 0 < x.bad_rate < 1 and x.bad_bound < x.bad_rate


def test_odd_rows(spark):
    pages = spark.createDataFrame([(None, "http://a.b/"), (1, "http://a.b/"), (1, "http://a.b/"), (2, None)], "page_id long, url string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 0), (7, None)], LABELS)
    assert op.judge(pages, labels).count() == 4
    assert op.judge(pages.limit(0), labels).count() == 0
    assert not math.isnan(op.judge(pages, labels).first().bad_bound)

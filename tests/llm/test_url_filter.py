"""URL rules against brute force, held-out accuracy of the trees, defined results for odd rows."""

import random

import numpy as np
import pytest

from orderlens.llm.queries import URL_RULES
from orderlens.llm.url_filter import FORM, form_of, judge, with_host_and_path, with_rule

from .conftest import held_out

PAGE = "page_id long, url string, html string, host string, rule string, label string, weight int"


def pages(spark, urls, ids=None):
    """Rows of the pages table, with further columns of names that the operator uses."""
    ids = range(len(urls)) if ids is None else ids
    return spark.createDataFrame(
        [(i, u, "<p>", "h", "r", "l", 1) for i, u in zip(ids, urls, strict=True)], PAGE
    )


def parts(url):
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule_of(url, rules):
    host, path = parts(url)
    fits = []
    for text, verdict in rules:
        h, slash, p = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((len(text), text, verdict))
    return max(fits)[1:] if fits else (None, None)


ODD = [
    None, "", "no scheme", "://", "http://", "http://ORG", "http://Org/", "http://a.ORG/x",
    "http://forg/", "http://example.org/en/1", "http://example.org/en/12?q", "http://x.example.org/en/2",
    "http://example.org/es/", "http://example.org/es", "http://example.org/ES/",
    "http://example.org?a/es/", "http://a#b://x.com/fr/", "http://com/de/", "http://a.b.c.com/de/x#y",
    "http://notexample.org/es/1", "http://example.org:80/es/", "http://.org/", "http://..com/fr/",
    "http://u\nv.com/de/", "ftp://ex://y.org/", "http://x.com/de/\n/", "http://ÄB.com/fr/é",
    "http://İ.org/", "http://x.com/frx/", "http://" + "a." * 50_000 + "com/de/" + "y" * 100_000,
]


def test_rules_equal_brute_force(spark):
    rng = random.Random(5)
    hosts = ["org", "com", "a.org", "example.org", "www.example.org", "x.com", "y.a.org", "net"]
    paths = ["", "/", "/es/", "/en/1", "/en/12", "/fr/x", "/de/", "/de", "?q=/es/", "#/de/"]
    urls = ODD + ["http://" + rng.choice(hosts) + rng.choice(paths) for _ in range(200)]
    more = [("a.org/en/", "block"), ("a.org/en/1", "allow"), ("net", "block"), ("y.a.org/", "block")]
    for rules in (URL_RULES, URL_RULES + more, []):
        found = with_rule(with_host_and_path(pages(spark, urls).drop("rule")), rules).collect()
        assert len(found) == len(urls)
        for r in found:
            assert (r["host"], r["path"]) == parts(r["url"])
            assert (r["rule"], r["verdict"]) == rule_of(r["url"], rules)


def test_a_small_rule_table_is_not_shuffled(spark):
    urls = with_rule(with_host_and_path(pages(spark, ODD).drop("rule")), URL_RULES)
    assert "Exchange hash" not in urls._jdf.queryExecution().toString()


def test_verdicts_on_odd_rows(spark):
    urls = ODD + ODD[:6]
    ids = [*range(len(urls) - 1), None]
    rows = judge(spark, pages(spark, urls, ids), URL_RULES).collect()
    assert len(rows) == len(urls) and None in {r["page_id"] for r in rows}
    of = {r["page_id"]: r for r in rows}
    for i, url in zip(ids, urls, strict=True):
        rule, verdict = rule_of(url, URL_RULES)
        assert of[i]["rule"] == rule and 0 <= of[i]["score"] <= 1
        assert of[i]["verdict"] == (verdict or ("block" if of[i]["score"] >= 0.5 else "allow"))
    assert judge(spark, pages(spark, []), URL_RULES).collect() == []


@pytest.mark.parametrize("verdict", ["allow", "block"])
def test_one_label_only(spark, verdict):
    rows = judge(spark, pages(spark, ["http://a.org/", "http://b.net/", "x"]), [("org/", verdict)])
    assert {(r["verdict"], r["score"]) for r in rows.collect()} <= {(verdict, 1.0), (verdict, 0.0)}


def test_no_labelled_url(spark):
    rows = judge(spark, pages(spark, ["http://a.org/", None]), []).collect()
    assert [(r["verdict"], r["score"]) for r in rows] == [("allow", 0.0)] * 2


def test_held_out_accuracy_on_labelled_urls(spark):
    """Bad URLs have long query strings or lie under one bad host, at random."""
    rng = np.random.default_rng(3)
    urls, labels = [], []
    for k in range(800):
        bad = k % 3 == 0
        host = f"h{rng.integers(9)}.good{rng.integers(4)}.net"
        if bad and k % 2:
            host = f"h{rng.integers(9)}.bad.net"
        query = "&".join(f"p{j}={rng.integers(10**9)}" for j in range(rng.integers(6, 12)))
        urls.append(f"http://{host}/a/{k}" + (f"?{query}" if bad and not k % 2 else ""))
        labels.append(int(bad))
    rows = [(u, b) for k, (u, b) in enumerate(zip(urls, labels, strict=True)) if not held_out(k)]
    labelled = spark.createDataFrame(rows + rows[:50] + [(None, None)], "url string, label int")
    found = judge(spark, pages(spark, urls), [], labelled).collect()
    apart = [r for r in found if r["held_out"]]
    assert len(apart) > 100
    right = [(r["verdict"] == "block") == labels[r["page_id"]] for r in apart]
    assert np.mean(right) > 0.97


def test_numbers_of_a_url():
    numbers = dict(zip(FORM, form_of(b"http://a.b1/c/D-e?x=1&y=2#z", b"a.b1", b"/c/D-e"), strict=True))
    assert (numbers["length"], numbers["depth"], numbers["labels"]) == (27, 2, 2)
    assert (numbers["parameters"], numbers["query_length"], numbers["fragment"]) == (2, 7, 1)
    assert numbers["host_digits"] == 0.25 and numbers["host_entropy"] == 2.0
    assert (numbers["hyphens"], numbers["capitals"]) == (1, 1)
    assert set(form_of(b"", b"", b"")) == {0.0}

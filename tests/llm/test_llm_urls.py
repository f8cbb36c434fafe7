import math

import pytest

from tidemark.llm import urls
from tidemark.llm.queries import URL_RULES


@pytest.fixture
def judge(spark):
    def run(pages, rules=URL_RULES):
        frame = spark.createDataFrame([(i, u, "x") for i, u in pages], "page_id long, url string, host string")
        return {r["page_id"]: r for r in urls.filter_urls(frame, rules).collect()}

    return run


def test_hosts_paths_and_rules(judge):
    cases = [
        ("HTTP://WWW.A.NET/x?q#f", "www.a.net", "/x", "net/", "block"),
        ("http://net", "net", "", None, None),
        ("http://net/", "net", "/", "net/", "block"),
        ("x://planet/", "planet", "/", None, None),
        ("http://example.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"),
        ("http://a.b.example.net/en", "a.b.example.net", "/en", "net/", "block"),
        ("http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
        ("http://example.com/de/x", "example.com", "/de/x", "example.com/de/", "block"),
        ("http://example.com/DE/x", "example.com", "/DE/x", None, None),
        ("https://É.org/fr/?a=b", "É.org", "/fr/", "org/fr/", "allow"),
        ("a://b://c/d", "b:", "//c/d", None, None),
        ("http://h?x/y", "h", "", None, None),
        ("no scheme.net/", "", "", None, None),
        ("", "", "", None, None),
        (None, "", "", None, None),
        ("http://" + "a" * 5000 + ".net/" + "b" * 5000, "a" * 5000 + ".net", "/" + "b" * 5000, "net/", "block"),
    ]
    found = judge([(i, c[0]) for i, c in enumerate(cases)])
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (found[i]["host"], found[i]["path"], found[i]["rule"]) == (host, path, rule)
        assert found[i]["verdict"] == verdict if rule else found[i]["verdict"] in ("allow", "block")


def test_trees_learn_from_the_rules(judge):
    pages = [(i, f"http://s{i % 7}.example.com/{'de' if i % 2 else 'fr'}/{i}") for i in range(300)]
    pages += [(1000 + i, f"http://s{i % 7}.example.org/fr/{i}.html") for i in range(200)]
    found = judge(pages)
    assert all(found[i]["verdict"] == "block" for i in range(300)) and found[1000]["verdict"] == "allow"


def test_without_labels_or_rows(judge):
    assert judge([]) == {}
    assert judge([(1, "http://a.xyz/")])[1]["verdict"] == "allow"
    assert judge([(1, "http://a.xyz/"), (2, "http://a.net/")])[1]["verdict"] == "block"
    assert judge([(1, "http://a.xyz/")], [])[1]["verdict"] == "allow"


@pytest.mark.parametrize("shuffled", [False, True])
def test_statistics_cover_all_suffixes(spark, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(urls, "BROADCAST_ROWS", 1)
        monkeypatch.setattr(urls, "HOT_ROWS", 50)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        hosts = [f"s{i}.net" for i in range(11_000)] + ["hot.org"] * 100
        schema = "_url string, host string, path string, label int"
        labelled = spark.createDataFrame([(f"http://{h}/{i}", h, f"/{i}", 1) for i, h in enumerate(hosts)], schema)
        model = urls.train(labelled)
        others = spark.createDataFrame([(f"http://{h}/x", h, "/x") for h in [*hosts[9_000:10_000], *hosts[11_000:], *["new.com"] * 70]], "_url string, host string, path string")
        seen = {r["host"]: (r["site_seen"], r["top_seen"]) for r in urls._with_features(others, model.suffixes, model.base).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert seen.pop("new.com") == (0.0, 0.0)
    assert seen.pop("hot.org") == pytest.approx((math.log1p(100), math.log1p(100)))
    assert len(seen) == 1000 and set(seen.values()) == {(math.log1p(1), math.log1p(11_000))}


def by_model(url, rules):
    """Host, path and rule of one URL, character by character."""
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        rest = url[url.index("://") + 3 :]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:end], rest[end:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    best = None
    for rule in rules:
        own, _, tail = rule.text.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + tail) and (best is None or len(rule.text) > len(best)):
            best = rule.text
    return host, path, best


def test_random_urls_equal_a_model_and_repeated_rows_stay(judge, spark, rng):
    parts = ["http", "://", "a", "B", ".", "net", "example.net", "example.com", "org", "/", "en/", "de/", "fr/", "?", "#", "É", "www."]
    texts = [None, ""] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(200)]
    texts += [f"{rng.choice(['http', 'X'])}://{rng.choice(['', 'a.', 'not'])}{rng.choice(parts)}{rng.choice(['/', '', '?'])}{rng.choice(parts)}" for _ in range(300)]
    found = judge(list(enumerate(texts)))
    verdicts = {r.text: r.verdict for r in URL_RULES}
    for i, url in enumerate(texts):
        host, path, rule = by_model(url, URL_RULES)
        assert (found[i]["host"], found[i]["path"], found[i]["rule"]) == (host, path, rule), url
        assert rule is None or found[i]["verdict"] == verdicts[rule]
    frame = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None), (None, None)], "page_id long, url string")
    rows = urls.filter_urls(frame, URL_RULES).collect()
    assert sorted((r["page_id"] or 0, r["host"], r["verdict"]) for r in rows) == [(0, "", "block")] * 2 + [(1, "a.net", "block")] * 2

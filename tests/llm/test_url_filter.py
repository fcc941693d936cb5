import random
import re
import time

import pytest

from stepstream.llm import url_filter as U

PAGES, LABELS = "page_id bigint, url string, host string, tokens string", "doc_id bigint, quality int"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(url):
    host, path = plain_parts(url)
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/")]
    rules += [("block", "net", "/es/"), ("block", "net", "/fr/")]
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    verdict, *rule = max(fits, key=lambda r: len(r[1] + r[2]), default=(None, None, None))
    return (None, None) if verdict is None else ("".join(rule), verdict)


ODD = [None, "", "no scheme/path", "http://", "http://COM", "http://com/", "http://x.com", "http://x.com?q=/en/", "a://b://c/d"]
ODD += ["http://WWW.Example.COM/en/1", "http://m.example.com/en/", "http://example.com/en", "https://net/es/", "ftp://a.net/fr/#x"]
ODD += ["http://É.net/es/\n1", "http://xnet/es/", "http://a.net/ES/", "http://u:p@a.net/fr/2?://", "http://a.org/x?y&&z=1#q", "x" * 9000]


@pytest.fixture
def tables(spark):
    def make(urls, labels=()):
        rows = [(i, u, "own", "own") for i, u in enumerate(urls)]
        return spark.createDataFrame(rows, PAGES).repartition(3), spark.createDataFrame(list(labels), LABELS)

    return make


def test_parts_and_site_rules(tables):
    urls = ODD * 2
    found = U.filter_urls(*tables(urls), "page_id").collect()
    assert len(found) == len(urls)
    for r in found:
        url = urls[r["page_id"]]
        rule, verdict = plain_rule(url)
        assert (r["host"], r["path"], r["rule"]) == (*plain_parts(url), rule), url
        assert r["verdict"] == verdict or verdict is None and (r["learned"] or r["verdict"] == "allow")


def test_rules_of_pairs_are_mined(tables):
    """Neither the host nor the folder is bad, but both together."""
    rng, urls, labels = random.Random(1), [], []
    for i in range(400):
        host, folder = rng.choice(["one", "two", "three"]), rng.choice(["win", "news", "shop"])
        urls.append(f"http://{host}.org/{folder}/{i}?page={i}")
        if i < 300:
            labels += [(i, int((host, folder) != ("one", "win")))]
    labels += [(0, None), (10**9, 0)]
    found = U.filter_urls(*tables(urls, labels), "page_id").collect()
    for r in found:
        bad = "one.org/win/" in urls[r["page_id"]]
        assert r["verdict"] == ("block" if bad else "allow"), urls[r["page_id"]]
        if bad:
            assert "p=win" in r["learned"] and "one" in r["learned"]


def test_rules_and_matching_equal_brute_force(spark):
    rng = random.Random(7)
    baskets = []
    for i in range(200):
        tokens = sorted(rng.sample("abcdefg", rng.randint(1, 5)))
        baskets.append((tokens, "block" if {"a", "b"} <= set(tokens) or rng.random() < 0.1 else "allow", i))
    table = spark.createDataFrame(baskets, "tokens array<string>, label string, id int")
    mined, items = (t.collect() for t in U.mine_rules(table, least_urls=10))
    assert sorted((r["token"], r["item"]) for r in items) == [(c, c) for c in "abcdefg"]
    rules = {}
    for mask in range(1, 1 << 7):
        some = {t for i, t in enumerate("abcdefg") if mask >> i & 1}
        for label in ("block", "allow"):
            have = [b for b in baskets if some <= set(b[0])]
            hits = sum(b[1] == label for b in have)
            if hits >= 0.05 * len(baskets) and hits / len(have) >= 0.8:
                rules[frozenset(some), label] = hits / len(have)
    short = {k: c for k, c in rules.items() if not any(o[0] < k[0] and o[1] == k[1] and rules[o] >= c for o in rules)}
    assert {(frozenset(r["tokens"]), r["verdict"]): pytest.approx(r["confidence"]) for r in mined} == short
    sets = spark.createDataFrame([(t,) for t in sorted({tuple(b[0]) for b in baskets})], "tokens array<string>")
    table = spark.createDataFrame(mined)
    matched = {tuple(r["tokens"]): r["learned"]["confidence"] for r in U.match_rules(sets, table).collect()}
    expected = {}
    for (t,) in [tuple(r) for r in sets.collect()]:
        fits = [c for (some, _), c in short.items() if some <= set(t)]
        if fits:
            expected[tuple(t)] = pytest.approx(max(fits))
    assert matched == expected


def test_tokens_that_occur_together_are_one_item(spark):
    """Rules over items fit the URLs that rules over any of their tokens would."""
    rng, baskets = random.Random(3), []
    for i in range(150):
        tokens = ["x1", "x2", "x3"] * (rng.random() < 0.5) + ["y1", "y2"] * (rng.random() < 0.5) + rng.sample("abc", 2)
        baskets.append((i, sorted(tokens), "block" if "x1" in tokens and "y1" in tokens else "allow"))
    mined, items = U.mine_rules(spark.createDataFrame(baskets, "id int, tokens array<string>, label string"), least_urls=10)
    of = {r["token"]: r["item"] for r in items.collect()}
    assert of == {"x1": "x1", "x2": "x1", "x3": "x1", "y1": "y1", "y2": "y1", "a": "a", "b": "b", "c": "c"}
    assert ["x1", "y1"] in [r["tokens"] for r in mined.where("verdict = 'block'").collect()]
    rows = spark.createDataFrame([(1, ["q", "x3", "y2"]), (2, ["x2", "x3"]), (3, ["q"])], "id int, tokens array<string>")
    assert sorted(map(tuple, U.as_items(rows, items).collect())) == [(1, ["x1", "y1"]), (2, ["x1"])]


def test_many_copies_of_long_urls(tables):
    """URLs of 60 tokens, the same each time, and others that each lack one of theirs."""
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    urls = [f"http://bad.org/{'/'.join(words)}?n={i}" for i in range(1000)] + [f"http://bad.org/{'/'.join(words)}"] * 1000
    urls += [f"http://odd.org/{'/'.join('v' + w for j, w in enumerate(words) if j != i % 60)}/{i}" for i in range(600)]
    urls += [f"http://fine.org/{i}/{chr(97 + i % 26)}" for i in range(400)] + ["http://bad.org/unseen", "http://new.org/waa"]
    labels = [(i, int("fine" in u or "odd" in u)) for i, u in enumerate(urls[:-2])]
    begun = time.time()
    found = {r["page_id"]: r["verdict"] for r in U.filter_urls(*tables(urls, labels), "page_id").collect()}
    assert time.time() - begun < 90
    assert [i for i, u in enumerate(urls) if (found[i] == "block") != ("bad" in u or "new" in u)] == []


def test_empty_tables(tables):
    pages, labels = tables(ODD)
    assert {r["verdict"] for r in U.filter_urls(pages, labels, "page_id").collect()} == {"allow", "block"}
    assert U.filter_urls(pages.where("page_id < 0"), labels, "page_id").count() == 0


def test_rules_of_the_least_telling_items(spark):
    """Of 15 items, the two that say nothing alone decide together; the others are noise that says a little each."""
    rng, baskets = random.Random(5), []
    for i in range(400):
        a, b = i % 2, i // 2 % 2
        label = "block" if a == b else "allow"
        noise = [f"n{j:02}" for j in range(13) if rng.random() < (0.45 if label == "block" else 0.3)]
        baskets.append((i, ["a"] * a + ["b"] * b + noise + ["sure"] * (i % 4 == 3), label))
    mined, items = U.mine_rules(spark.createDataFrame(baskets, "id int, tokens array<string>, label string"))
    rules = {tuple(r["tokens"]): (r["verdict"], r["confidence"], r["support"]) for r in mined.collect()}
    assert rules["sure",] == ("block", 1.0, 0.25)  # occurs with a and b only
    assert {r["token"]: r["verdict"] for r in items.collect() if r["token"] in ("a", "sure")} == {"a": None, "sure": "block"}
    assert rules["a", "b"] == ("block", 1.0, 0.25)


def test_a_rule_needs_no_more_urls_than_stated(spark):
    for extra in range(8):
        rows = [(i, ["x"] if i < 20 else [f"y{i % 2}"], "block" if i % 10 else "allow") for i in range(60 + 7 * extra)]
        mined, _ = U.mine_rules(spark.createDataFrame(rows, "id int, tokens array<string>, label string"), least_urls=18)
        assert ["x"] in [r["tokens"] for r in mined.collect()]

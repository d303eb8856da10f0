import random

from retail_analytics.llm.url_filter import RULES, Trie, url_filter

ODD = ["http://EXAMPLE.net/en/1", "https://a.b.example.net/en/x?y#z", "http://example.net/de", "http://notexample.net/en/", "http://x.org/fr/",
       "http://org/fr/q", "http://example.com/de/a/b", "http://example.com/DE/", "http://net", "http://net/", "net/", "", None, "http://a.net?q=/en/",
       "ftp://u@example.com/de/#://b.net/", "http://" + "a." * 3000 + "net/" + "p/" * 3000]


def plain(url, rules=RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(r), r, v) for v, r in rules for h, p in [r.split("/", 1)]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_odd_urls_and_repeated_rows(spark):
    rows = [(i, u, "x") for i, u in enumerate(ODD)] + [(0, ODD[0], "x"), (None, ODD[0], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")       # host clashes with an output name
    want = sorted(map(str, ((i, *plain(u)) for i, u, _ in rows)))
    for most in (100, 1):                                                              # the trie, and the join beyond it
        got = url_filter(pages, RULES, max_trie_rules=most)
        assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
        assert sorted(str(tuple(r)) for r in got.collect()) == want


def test_empty_table(spark):
    assert url_filter(spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0


def test_trie_against_all_rules():
    rnd = random.Random(3)
    label, seg = ["a", "b", "net", "org"], ["", "en", "e", "en2", "x"]
    rules = list({".".join(rnd.choices(label, k=rnd.randint(1, 3))) + "/" + "/".join(rnd.choices(seg, k=rnd.randint(0, 2))): 0 for _ in range(60)})
    rules = [(rnd.choice(["allow", "block"]), r) for r in rules]
    trie = Trie()
    for v, r in rules:
        trie.add(r.split("/")[0], "/" + r.split("/", 1)[1], v)
    for _ in range(500):
        host, path = ".".join(rnd.choices(label, k=rnd.randint(1, 4))), "/" + "/".join(rnd.choices(seg, k=rnd.randint(0, 3)))
        fits = [r for _, r in rules for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        got, _ = trie.longest(host, path)
        assert (got is None) == (not fits) and (not fits or len(got) == max(map(len, fits)) and got in fits)

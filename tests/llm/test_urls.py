import pytest

from posttrend.llm import urls

PAGES = "page_id long, url string, html string"


def test_rules_longest_wins(make, by_id):
    cases = [
        (1, "https://EXAMPLE.org/es/1?x", "example.org", "/es/1", "example.org/es/", "block"),
        (2, "http://a.example.org/en/12#t", "a.example.org", "/en/12", "example.org/en/1", "block"),
        (3, "http://b.org/x", "b.org", "/x", "org/", "allow"),
        (4, "http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        (5, "http://b.com/fr/1", "b.com", "/fr/1", "com/fr/", "allow"),
        (6, "http://b.com/de/1", "b.com", "/de/1", "com/de/", "block"),
        (7, "http://b.org", "b.org", "", None, "allow"),
        (8, None, "", "", None, "allow"),
        (9, "b.org/x", "", "", None, "allow"),
        (10, "http://b.org?q=/x", "b.org", "", None, "allow"),
    ]
    got = by_id(urls.filter_urls(make([(c[0], c[1], None) for c in cases], PAGES)), "page_id")
    for number, _, *want in cases:
        assert list(got[number])[1:] == want, number


def test_links_spread_trust_and_distrust(make, by_id):
    a = lambda *hosts: "".join(f'<a class="x" href="//{h}/p">x</a>' for h in hosts)
    rows = [
        (1, "http://good.org/", a("friend.net")), (2, "http://bad.com/de/", None), (3, "http://friend.net/", ""),
        (4, "http://spam.net/", a("bad.com", "bad.com")), (5, "http://spam.net/2", None), (6, "http://alone.net/", a("nobody.net")),
        (6, "http://alone.net/", a("nobody.net")),
    ]
    got = urls.filter_urls(make(rows, PAGES))
    assert got.count() == len(rows)
    verdicts = by_id(got, "page_id")
    assert [verdicts[i].verdict for i in (1, 2, 3, 4, 5, 6)] == ["allow", "block", "allow", "block", "block", "allow"]


def brute(edges, seeds, rounds):
    ranks = dict(seeds)
    out = {}
    for (src, _), n in edges.items():
        out[src] = out.get(src, 0) + n
    for _ in range(rounds):
        moved = {}
        for (src, dst), n in edges.items():
            moved[dst] = moved.get(dst, 0) + ranks.get(src, 0) * n / out[src]
        lost = 1 - sum(moved.values())
        ranks = {h: 0.85 * moved.get(h, 0) + seeds.get(h, 0) * (0.15 + 0.85 * lost) for h in set(moved) | set(seeds)}
    return ranks


def test_propagation_matches_brute_force(spark):
    edges = {("a", "b"): 2, ("b", "c"): 1, ("c", "a"): 1, ("a", "c"): 1, ("d", "a"): 3, ("c", "e"): 5}
    seeds = {"a": 0.25, "d": 0.75}
    frame = spark.createDataFrame([(s, d, n) for (s, d), n in edges.items()], "src string, dst string, links long")
    start = spark.createDataFrame([("trust", h, v) for h, v in seeds.items()], "kind string, host string, seed double")
    got = {r.host: r["rank"] for r in urls.propagate(frame, start, rounds=5).collect()}
    want = brute(edges, seeds, 5)
    assert got.keys() == want.keys() and all(abs(got[h] - want[h]) < 1e-9 for h in want)


def test_spread_goes_on_until_it_settles(spark):
    edges = {("a", "b"): 2, ("b", "c"): 1, ("c", "a"): 1, ("a", "c"): 1, ("d", "a"): 3, ("c", "e"): 1}
    edges |= {(f"h{i}", f"h{i + 1}"): 1 for i in range(15)} | {("e", "h0"): 1}
    seeds = {"a": 0.25, "d": 0.75}
    frame = spark.createDataFrame([(s, d, n) for (s, d), n in edges.items()], "src string, dst string, links long")
    start = spark.createDataFrame([("trust", h, v) for h, v in seeds.items()], "kind string, host string, seed double")
    got = {r.host: r["rank"] for r in urls.propagate(frame, start).collect()}
    want = brute(edges, seeds, 1000)
    assert got.keys() == want.keys() and all(abs(got[h] - want[h]) < 1e-9 for h in want) and got["h15"] > 1e-3
    with pytest.raises(RuntimeError):
        urls.settle(frame, start, most_rounds=2)


def test_distrust_reaches_along_a_long_chain(make, by_id):
    rows = [(0, "http://bad.com/de/", None), *[(i, f"http://h{i}.net/", f'<a href="//{"bad.com" if i == 1 else f"h{i - 1}.net"}/">') for i in range(1, 16)]]
    got = by_id(urls.filter_urls(make([*rows, (99, "http://alone.net/", None)], PAGES)), "page_id")
    assert {i for i, r in got.items() if r.verdict == "block"} == set(range(16))


def _linked(copies):
    """Hosts with little rank each: one links to a blocked host, one is linked by an allowed one, one has as much of both."""
    rows = []
    for c in range(copies):
        bad, good = f'<a href="//bad{c}.com/">', f'<a href="//liked{c}.net/"><a href="//even{c}.net/">'
        rows += [
            (f"http://bad{c}.com/de/", None), (f"http://good{c}.org/", good), (f"http://spam{c}.net/", bad),
            (f"http://liked{c}.net/", None), (f"http://even{c}.net/", f'{bad}<a href="//other{c}.net/">'), (f"http://other{c}.net/", f"{bad}{bad}"),
        ]
    return [(i, *r) for i, r in enumerate(rows)]


@pytest.mark.parametrize("copies", [1, 40])
def test_verdicts_do_not_depend_on_the_size_of_the_graph(make, by_id, copies):
    got = by_id(urls.filter_urls(make(_linked(copies), PAGES)), "page_id")
    each = ["block", "allow", "block", "allow", None, "block"]
    for c in range(copies):
        verdicts = [got[6 * c + i].verdict for i in range(6)]
        assert [v for v, w in zip(verdicts, each) if w] == [w for w in each if w]
        assert verdicts == [got[i].verdict for i in range(6)]


def test_tiny_ranks_are_compared_by_their_ratio(spark):
    hub = [(f"x{i}", "hub", 1) for i in range(3000)]
    edges = spark.createDataFrame([*hub, ("y", "bad", 1), ("x0", "bad", 10**7)], "src string, dst string, links long")
    seeds = spark.createDataFrame([("distrust", "bad", 1.0)], "kind string, host string, seed double")
    got = {r.host: r["rank"] for r in urls.propagate(edges, seeds).collect()}
    assert 0 < got["y"] < 1e-7 and set(got) == {"bad", "x0", "y"}


def test_unclosed_tags_are_read_once(make):
    import time

    pages = [(1, "http://a.net/", "<a " * 100_000), (2, "http://b.net/", '<a <a href="//bad.com/">'), (3, "http://bad.com/de/", '<a href="' * 50_000)]
    frame = make(pages, PAGES)
    urls.filter_urls(make(pages[1:2], PAGES)).collect()
    began = time.time()
    got = {r.page_id: r.verdict for r in urls.filter_urls(frame).collect()}
    assert got == {1: "allow", 2: "block", 3: "block"} and time.time() - began < 60


def test_empty_table(make):
    assert urls.filter_urls(make([], PAGES)).count() == 0

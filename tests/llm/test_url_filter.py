import random
from datetime import date, timedelta

from heartwood.llm.url_filter import judge_captures, validity_intervals

DAY = date(2024, 1, 1)


def frames(spark, captures, entries):
    return (
        spark.createDataFrame(
            [(*c, "x", 1) for c in captures],
            "capture_id long, url string, fetched_on date, list string, n_active int",
        ),
        spark.createDataFrame(
            entries, "list string, kind string, pattern string, action string, day date"
        ),
    )


def test_equals_a_plain_loop(spark):
    r = random.Random(1)
    hosts = ["a.com", "www.a.com", "x.www.a.com", "b.org", "ab.org", "localhost"]
    paths = ["", "/", "/en", "/en/", "/en/x.html?q=/de/", "/de/en/#/y", "//en/"]
    captures = [
        (i, f"HTTPS://{'u@' if r.random() < 0.2 else ''}{r.choice(hosts).upper()}"
         f"{':80' if r.random() < 0.2 else ''}{r.choice(paths)}", DAY + timedelta(r.randrange(300)))
        for i in range(300)
    ] + [(400, None, DAY), (401, "no scheme", DAY), (402, "http://a.com/", None), (403, "", DAY)]
    patterns = [("domain", x) for x in ("A.com", "www.a.com", "b.org", "com", "org")] + [
        ("url", x) for x in ("a.com/en/", "b.org/", "www.a.com/de/", "www.a.com//")
    ]
    entries = []
    for _ in range(120):
        kind, pattern = r.choice(patterns)
        entries.append((r.choice("PQ"), kind, pattern, r.choice(["add", "remove"]),
                        DAY + timedelta(r.randrange(300))))
    entries += [("P", "domain", None, "add", DAY), ("P", "domain", "b.org", "what", DAY)]

    def matches(kind, pattern, url):
        if url is None or "://" not in url:
            return False
        rest = url.split("://", 1)[1]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host, path = rest[:cut].split("@")[-1].split(":")[0].lower(), rest[cut:]
        path = path.split("?")[0].split("#")[0] or "/"
        if kind == "domain":
            return host == pattern.lower() or host.endswith("." + pattern.lower())
        return (host + path).startswith(pattern)

    expected = set()
    for key, url, day in captures:
        active = []
        for which in {(e[0], e[1], e[2]) for e in entries if e[2]}:
            past = [e for e in entries if e[:3] == which and day and e[4] <= day
                    and e[3] in ("add", "remove")]
            if past and matches(which[1], which[2], url):
                newest = max(e[4] for e in past)
                if all(e[3] == "add" for e in past if e[4] == newest):
                    active.append(which[2].lower() if which[1] == "domain" else which[2])
        expected.add((key, day, len(active), min(active, default=None), bool(active)))
    got = {tuple(x) for x in judge_captures(*frames(spark, captures, entries)).collect()}
    assert got == expected
    assert sum(x[4] for x in expected) > 50


def test_intervals(spark):
    d = lambda n: DAY + timedelta(n)
    entries = [("L", "url", "p/", a, d(n)) for a, n in
               (("remove", 0), ("add", 2), ("add", 3), ("remove", 5), ("remove", 7), ("add", 9),
                ("add", 11), ("remove", 11), ("add", 20))]
    _, e = frames(spark, [(1, "", DAY)], entries)
    got = sorted((r.since, r.until) for r in validity_intervals(e).collect() if r.until)
    assert got == [(d(2), d(5)), (d(9), d(11))]
    assert [r.since for r in validity_intervals(e).where("until is null").collect()] == [d(20)]


def test_empty_and_repeated(spark):
    captures, entries = frames(spark, [(1, "http://a.b/", DAY)] * 2 + [(None, "http://a.b/", DAY)], [])
    rows = judge_captures(captures, entries).collect()
    assert [r.blocked for r in rows] == [False] * 3
    captures, entries = frames(spark, [(1, "http://a.b/", DAY)] * 2 + [(None, "http://a.b/", DAY)],
                               [("L", "domain", "b", "add", DAY)])
    assert [r.n_active for r in judge_captures(captures, entries).collect()] == [1] * 3
    assert judge_captures(captures.where("false"), entries).count() == 0


def test_pages_and_paths_without_a_final_slash(spark):
    urls = ["http://h.org/a/b.html?q=1", "http://h.org/a/b.html/c", "http://h.org/a",
            "http://h.org/a/", "http://h.org/ab", "http://h.org", "http://h.org/A/b.html",
            "http://x.h.org/a/"]
    expected = {
        "h.org/a/b.html": [1, 1, 0, 0, 0, 0, 0, 0],
        "h.org/a": [1, 1, 1, 1, 0, 0, 0, 0],
        "h.org/a/": [1, 1, 0, 1, 0, 0, 0, 0],
        "h.org": [1, 1, 1, 1, 1, 1, 1, 0],
        "h.org/": [1, 1, 1, 1, 1, 1, 1, 0],
    }
    captures = [(i, u, DAY) for i, u in enumerate(urls)]
    for pattern, hits in expected.items():
        got = judge_captures(*frames(spark, captures, [("L", "url", pattern, "add", DAY)])).collect()
        assert [int(r.blocked) for r in sorted(got)] == hits, pattern
        assert {r.n_active for r in got} <= {0, 1}

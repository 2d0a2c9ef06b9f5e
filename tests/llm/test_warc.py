import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from changeguard.llm import warc as W

SCHEMA = "record_id long, url string, date timestamp, is_full boolean, status int, headers map<string,string>, payload_digest string, canonical_url string"
START = datetime(2024, 1, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


def full(i, url, minutes, etag="a", **headers):
    return (i, url, minutes if minutes is None else at(minutes), True, 200, {"etag": etag, "content-length": "9", **headers}, f"d{i}", "clash")


def revisit(i, url, minutes, etag="a", digest=None, **headers):
    return (i, url, minutes if minutes is None else at(minutes), False, 304, ({"etag": etag} if etag else {}) | headers, digest, "clash")


def resolved(rows, records):
    return {r.record_id: r for r in W.resolve_revisits(rows(records, SCHEMA)).collect()}


def test_canonical_urls(rows):
    same = ["http://www.A.example/b/?y=2&x=1", "https://a.example:443/b?x=1&y=2&utm_source=f#top", " a.example/b?ref=q&x=1&y=2"]
    got = rows([(u,) for u in [*same, "a.example/B?x=1&y=2", None]], "u string").select(W.canonical_url(F.col("u")).alias("c")).collect()
    assert [r.c for r in got] == ["a.example/b?x=1&y=2"] * 3 + ["a.example/B?x=1&y=2", None]


def test_outcomes_and_headers(rows):
    u = "http://h/p"
    out = resolved(rows, [
        full(1, u, 0, "old"), full(2, u, 10, "a", server="s", expires="1"), full(3, u, 20, "new"),
        revisit(10, "https://www.h/p/", 15, 'a', server="no", expires="5", date="now"), revisit(11, u, 25, "a"), revisit(12, u, -1), revisit(13, u, 10, "old"),
        revisit(14, u, 16, None, "d2"), revisit(15, u, 16, None), revisit(16, None, 16), revisit(17, u, None), revisit(18, u, 16, "W/a"),
    ])
    assert {i: (r.outcome, r.refers_to) for i, r in out.items()} == {
        10: ("resolved", 2), 11: ("changed", 3), 12: ("missing", None), 13: ("resolved", 1), 14: ("resolved", 2), 15: ("unproved", 2),
        16: ("missing", None), 17: ("missing", None), 18: ("resolved", 2),
    }
    assert out[10].headers == {"etag": "a", "content-length": "9", "server": "s", "expires": "5", "date": "now"}
    assert (out[10].status, out[10].payload_digest) == (200, "d2")
    assert (out[11].status, out[11].headers) == (None, None)


def test_hot_url_over_many_ranges_equals_brute_force(rows):
    rng = random.Random(5)
    urls = ["h/hot"] * 3 + [f"h/{i}" for i in range(6)]
    events = [(i, rng.choice(urls), rng.randint(0, 300), rng.random() < 0.3) for i in range(1500)]
    records = [full(i, u, m) if f else revisit(i, u, m) for i, u, m, f in events]
    names = ["record_id", "url", "date", "is_full"]
    out = W.latest_earlier(rows(records, SCHEMA).select(*names), ranges=16).collect()
    want = {}
    for i, u, m, f in events:
        if not f:
            before = [(m2, i2) for i2, u2, m2, f2 in events if f2 and u2 == u and m2 < m]
            want[i] = max(before)[1] if before else None
    assert {r.record_id: r.refers_to for r in out} == want and len(out) == len(want)


def test_empty_and_repeated_rows(rows):
    assert resolved(rows, []) == {}
    assert resolved(rows, [full(1, "h/p", 0)]) == {}
    assert resolved(rows, [revisit(2, "h/p", 5)])[2].outcome == "missing"

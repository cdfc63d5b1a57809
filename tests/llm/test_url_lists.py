import random
from urllib.parse import urlsplit

from tidemark.llm import url_lists

ENTRY = "list string, kind string, pattern string, action string, op string, at long, bucket int"


def brute(captures, entries):
    events = {}
    for e in set(entries):
        if all(e[i] is not None for i in (0, 1, 2, 4, 5)):
            events.setdefault((e[0], e[1], e[2].lower()), set()).add((e[5], e[4] == "add", e[3]))
    valid = []
    for (name, kind, pattern), es in events.items():
        es = sorted(es, key=lambda e: (e[0], e[1], (e[2] is not None, e[2] or "")))
        for (at, add, action), nxt in zip(es, es[1:] + [None]):
            if add and (nxt is None or nxt[0] > at):
                valid.append((name, kind, pattern, action, at, nxt and nxt[0]))
    out = []
    for cid, url, t in captures:
        parts = urlsplit(url) if url and "://" in url else None
        host = ((parts.hostname or "").rstrip(".") or None) if parts else None
        best, n = None, 0
        if host and t is not None:
            path = (parts.path or "/").lower()
            for name, kind, pattern, action, lo, hi in valid:
                hit = (host == pattern or host.endswith("." + pattern)) if kind == "domain" else (
                    kind == "prefix" and pattern.endswith("/") and (host + path).startswith(pattern))
                if hit and lo <= t and (hi is None or t < hi):
                    n += 1
                    rank = (kind != "prefix", -len(pattern), action != "allow", name, pattern, lo)
                    best = min(best or (rank, action), (rank, action), key=lambda x: x[0])
        out.append((cid, host, *((best[1], best[0][3], best[0][4], best[0][5]) if best else (None,) * 4), n))
    return sorted(out, key=repr)


def got(spark, captures, entries, **params):
    c = spark.createDataFrame([(*x, "extra") for x in captures], "id long, url string, fetched_at long, bucket string")
    e = spark.createDataFrame([(*x, 1) for x in entries], ENTRY)
    out = url_lists.evaluate(c, e, **params)
    assert out.columns[:4] == c.columns
    return sorted(((r["id"], r["host"], r["action"], r["list"], r["pattern"], r["valid_from"], r["n_active"])
                   for r in out.collect()), key=repr)


def test_defined_cases(spark):
    entries = [("a", "domain", "Bad.example", "block", "add", 100), ("a", "domain", "bad.example", "block", "remove", 200),
               ("a", "domain", "bad.example", "block", "add", 200), ("a", "domain", "bad.example", "block", "remove", 300),
               ("b", "prefix", "ok.bad.example/x/", "allow", "add", 0), ("b", "prefix", "ok.bad.example/x/", "allow", "add", 0),
               ("c", "domain", "ok.bad.example", "block", "add", 150), ("c", "domain", None, "block", "add", 1),
               ("c", "domain", "example", None, "add", 250), (None, "domain", "bad.example", "block", "add", 0),
               ("d", "domain", "bad.example", "block", "add", None)]
    captures = [(1, "http://bad.example", 99), (2, "http://bad.example/", 100), (3, "HTTP://u:p@BAD.example.:80/q?x#y", 199),
                (4, "http://bad.example/", 200), (5, "http://bad.example/", 300), (6, "https://ok.bad.example/X/y", 160),
                (7, "https://ok.bad.example/xy", 160), (8, None, 100), (9, "no url", 100), (10, "http://bad.example/", None),
                (11, "http://notbad.example/", 150), (12, "", 5), (13, "http://bad.example/", 100), (13, "http://bad.example/", 100),
                (None, "http://bad.example/", 100), (14, "http://bad.example/" + "a/" * 30000, 100), (15, "http:///x", 100)]
    assert got(spark, captures, entries) == brute(captures, entries)
    assert got(spark, captures, []) == brute(captures, [])
    assert got(spark, [], entries) == []


def test_random_lists_and_buckets(spark):
    rng = random.Random(9)
    hosts = ["x.a.com", "a.com", "b.a.com", "c.org", "www.c.org", "d.net"]
    entries = [(rng.choice("lm"), k, rng.choice(hosts) + ("/" + rng.choice(["p/", "p/q/", "r/"]) if k == "prefix" else ""),
                rng.choice(["block", "allow"]), rng.choice(["add", "add", "remove"]), rng.randrange(0, 1000))
               for k in rng.choices(["domain", "prefix"], k=120)]
    captures = [(i, f"http://{rng.choice(hosts)}/{rng.choice(['', 'p/', 'p/q/z', 'p', 'r/x?p/q/'])}", rng.randrange(-5, 1100))
                for i in range(300)]
    want = brute(captures, entries)
    for bucket in (7, 250, 10_000):
        assert got(spark, captures, entries, bucket_seconds=bucket) == want


def test_clashing_columns_are_replaced(spark):
    entries = [("a", "domain", "bad.example", "block", "add", 100, 1)]
    c = spark.createDataFrame([(1, "http://bad.example/", 150, "x", "y", "z", "p", 4, 5)],
                              "id long, url string, fetched_at long, action string, host string, list string, pattern string, "
                              "valid_from long, n_active long")
    out = url_lists.evaluate(c, spark.createDataFrame(entries, ENTRY))
    assert out.columns == ["id", "url", "fetched_at", "host", "action", "list", "pattern", "valid_from", "n_active"]
    assert [tuple(r) for r in out.collect()] == [(1, "http://bad.example/", 150, "bad.example", "block", "a", "bad.example", 100, 1)]

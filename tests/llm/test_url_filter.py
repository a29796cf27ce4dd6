import datetime as dt
import random
import re

from funnelspark.llm.url_filter import evaluate
from tests.llm.oracle import both

DAY = dt.datetime(2024, 1, 1)


def brute(url, at, entries):
    m = re.match(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:]*)[^/?#]*([^?#]*)", url or "")
    if not m or at is None or not m[1]:
        return None, None
    host = m[1].lower().rstrip(".")
    segments = [s for s in m[2].split("/") if s]
    best = None
    by_pattern = {}
    for p, action, when in entries:
        if p is None or when is None or action not in ("block", "allow", "remove"):
            continue
        p = re.sub(r"/+$", "", re.sub(r"^\*?\.", "", p))
        h, slash, rest = p.partition("/")
        by_pattern.setdefault(h.lower() + slash + rest, []).append((when, {"block": 2, "allow": 1, "remove": 0}[action], action))
    for p, dated in by_pattern.items():
        valid = [d for d in dated if d[0] <= at]
        if not p or not valid or max(valid)[2] == "remove":
            continue
        h, *path = p.split("/")
        hit = host == h and segments[: len(path)] == path if path else host == h or host.endswith("." + h)
        if hit:
            best = max(best or (-1, 0, "", ""), (len(path), len(h.split(".")), max(valid)[2], p))
    return (best[2], best[3]) if best else (None, None)


def test_as_brute_force(spark):
    r = random.Random(5)
    hosts = ["a.example.com", "b.example.com", "x.org", "EXAMPLE.com", "[::1]", "t.co."]
    urls = [f"{r.choice(['http', 'HTTPS'])}://{r.choice(['', 'me:pw@'])}{h}{r.choice(['', ':80'])}{p}" for h in hosts for p in ("", "/", "/en", "/en/1?q=/x", "/fr//2#y", "/en/1/2/3")]
    urls += [None, "", "not a url", "//a.example.com/en", "http:///en", "mailto:x@x.org"]
    captures = [(i, r.choice(urls), DAY + dt.timedelta(days=r.randrange(400), seconds=r.choice([0, 1]))) for i in range(300)]
    captures += [(900, u, None) for u in urls[:2]] + [captures[0]] * 2
    patterns = ["example.com", "*.example.com", ".x.org", "a.example.com/en", "A.example.com/en/1/", "b.example.com/fr/2", "t.co", "[::1]", None, "com", "/", "x.org/EN"]
    entries = [(r.choice(patterns), r.choice(["block", "allow", "remove", "remove", "odd", None]), DAY + dt.timedelta(days=r.randrange(400))) for _ in range(120)]
    entries += [("x.org", a, DAY) for a in ("allow", "block", "remove")] + [("x.org", "block", None)]
    got = evaluate(
        spark.createDataFrame([(*c, "clash") for c in captures], "capture_id long, url string, fetched_at timestamp, verdict string"),
        spark.createDataFrame(entries, "pattern string, action string, listed_at timestamp"),
    ).collect()
    assert len(got) == len(set(captures))
    found = {(r.capture_id, r.url, r.fetched_at): (r.verdict, r.pattern) for r in got}
    want = {c: brute(c[1], c[2], entries) for c in captures}
    assert found == want and len({v[0] for v in want.values()}) == 3


def test_empty_tables(spark):
    captures = spark.createDataFrame([(1, "http://a.b/c", DAY)], "capture_id long, url string, fetched_at timestamp")
    entries = spark.createDataFrame([("b", "block", DAY)], "pattern string, action string, listed_at timestamp")
    assert evaluate(captures.limit(0), entries).count() == 0
    assert [r.verdict for r in evaluate(captures, entries.limit(0)).collect()] == [None]
    assert [r.verdict for r in evaluate(captures, entries).collect()] == ["block"]


def test_same_as_sql(spark):
    got, want = both(spark, "/root/testdata/sf0.01", "op9_temporal_lists", ["pages"])
    assert got == want and sum(r[0] for r in got) > 10

import random
from datetime import date, datetime, timedelta

from sortproof.llm import urllist as U

DDL = "page_id long, url string, fetched timestamp, list string, pattern string, best string"


def keys(url):
    import re
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[^/?#]*)?(?:/([^?#]*))?", url or "")
    if not m or not m[1]:
        return set()
    labels = m[1].lower().split(".")
    hosts = [".".join(labels[i:]) for i in range(max(1, len(labels) - 1))]
    steps = [s for s in (m[2] or "").split("/") if s]
    return {"/".join([h, *steps[:k]]) for h in hosts for k in range(len(steps) + 1)}


def brute(caps, log):
    out = []
    for pid, url, t in caps:
        active = []
        if t is not None:
            for li, pat in {(a, p) for a, p, *_ in log}:
                h, _, rest = (pat or "").partition("/")
                p = h.lower() + ("/" + rest if rest else "")
                ev = {}
                for a, q, act, day in log:
                    qh, _, qr = (q or "").partition("/")
                    if a == li and qh.lower() + ("/" + qr if qr else "") == p and day and act in ("add", "remove"):
                        ev[day] = max(ev.get(day, ""), act)
                past = [d for d in ev if datetime(d.year, d.month, d.day) <= t]
                if past and ev[max(past)] == "add" and p in keys(url) and li in ("allow", "block"):
                    active.append((len(p), li == "allow", li, p))
        active = sorted(set(active))
        best = active[-1] if active else None
        out.append((pid, bool(best and best[2] == "block"), best and best[2], best and best[3], len(active)))
    return sorted(out, key=str)


def test_brute_force(spark):
    rng = random.Random(6)
    hosts = ["a.com", "b.a.com", "x.b.a.com", "c.org", "HOT.net", "localhost"]
    pats = ["a.com", "B.A.com", "c.org/x", "c.org/x/y", "hot.net", "net", "localhost", "a.com/p", "org", "x.b.a.com/q"]
    day0 = date(2023, 1, 1)
    log = [(rng.choice(["block", "block", "allow", "other", None]), rng.choice(pats), rng.choice(["add", "add", "remove"]),
            day0 + timedelta(rng.randint(0, 60))) for _ in range(80)]
    log += log[:5] + [("block", None, "add", day0), ("block", "c.org", "add", None), ("block", "c.org", None, day0)]
    caps = []
    for i in range(400):
        h = rng.choice(hosts + ["hot.net"] * 5)
        path = rng.choice(["", "/", "/x", "/x/y/z?q=1", "//x//y", "/p#f", "/q/r.html"])
        caps.append((i % 390, f"https://{rng.choice(['', 'u@'])}{h}{rng.choice(['', ':8080'])}{path}",
                     datetime(2023, 1, 1) + timedelta(hours=rng.randint(-10, 70 * 24))))
    caps += [(500, None, datetime(2023, 1, 9)), (501, "nonsense", datetime(2023, 1, 9)), (502, "http://a.com/", None),
             (None, "http://a.com/", datetime(2023, 2, 1)), (503, "http://a.com/" + "s/" * 300, datetime(2023, 2, 1))]
    c = spark.createDataFrame([(*x, "l", "p", "b") for x in caps], DDL)
    e = spark.createDataFrame(log, "list string, pattern string, action string, day date")
    got = sorted(((r.id, r.blocked, r.list, r.pattern, r.n_active) for r in U.judge(c, e).collect()), key=str)
    assert got == brute(caps, log)
    assert sum(b for _, b, *_ in got) > 20


def test_intervals(spark):
    d = date
    log = [("block", "a.com", "add", d(2023, 1, 1)), ("block", "a.com", "add", d(2023, 1, 5)),
           ("block", "a.com", "remove", d(2023, 1, 9)), ("block", "a.com", "add", d(2023, 1, 9)),
           ("block", "a.com", "add", d(2023, 2, 1))]
    e = spark.createDataFrame(log, "list string, pattern string, action string, day date")
    got = sorted((r.valid_from.date(), r.valid_to and r.valid_to.date()) for r in U.intervals(e).collect())
    assert got == [(d(2023, 1, 1), d(2023, 1, 5)), (d(2023, 1, 5), d(2023, 1, 9)), (d(2023, 2, 1), None)]


def test_empty(spark):
    c = spark.createDataFrame([], DDL)
    e = spark.createDataFrame([], "list string, pattern string, action string, day date")
    assert U.judge(c, e).count() == 0
    one = spark.createDataFrame([(1, "http://a.com", datetime(2023, 1, 1), "", "", "")], DDL)
    assert [r.blocked for r in U.judge(one, e).collect()] == [False]


def test_days_start_in_utc_whatever_the_session(spark):
    log = spark.createDataFrame([("block", "x.com", "add", "2024-03-05")], "list string, pattern string, action string, day string")
    caps = spark.createDataFrame([(1, "http://x.com/a", 1709596800), (2, "http://x.com/a", 1709596799)],
                                 "page_id long, url string, s long").selectExpr(
        "page_id", "url", "timestamp_seconds(s) as fetched")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert {r.id: r.blocked for r in U.judge(caps, log).select("id", "blocked").collect()} == {1: True, 2: False}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_long_urls_explode_to_the_depth_of_the_log_only(spark):
    log = spark.createDataFrame([("block", "x.com/s0/s1", "add", "2024-01-01"), ("allow", "x.com", "add", "2024-01-01")],
                                "list string, pattern string, action string, day string")
    url = "http://www.x.com/" + "/".join(f"s{i}" for i in range(2000))
    caps = spark.createDataFrame([(1, url), (2, "http://x.com/s1/s0")], "page_id long, url string").selectExpr(
        "*", "timestamp'2024-02-01 00:00:00' as fetched")
    assert {r.id: r.pattern for r in U.judge(caps, log).select("id", "pattern").collect()} == {
        1: "x.com/s0/s1", 2: "x.com"}
    sizes = caps.select(U.F.size(U.patterns("url", 2)).alias("n")).collect()
    assert [r.n for r in sizes] == [6, 3]

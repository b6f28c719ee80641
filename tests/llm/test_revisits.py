import random

from pyspark.sql import functions as F

from dimforge.llm import revisits

SCHEMA = f"rec_id long, url string, ts long, kind string, status int, headers {revisits.HEADERS}, digest string"


def test_canonical_urls(spark):
    urls = {"https://WWW.Example.com:443/a/?b=2&a=1&utm_source=x#top": "example.com/a?a=1&b=2", "http://example.com": "example.com", "http://example.com/": "example.com",
            "example.com/a/b//": "example.com/a/b", "http://e.com/?": "e.com", None: None, "": ""}
    got = spark.createDataFrame([(u,) for u in urls], "u string").select("u", revisits.canonical_url(F.col("u")).alias("c")).collect()
    assert {r.u: r.c for r in got} == urls


def brute(records):
    out = {}
    canon = lambda u: None if u is None else u.removeprefix("http://").removeprefix("https://").rstrip("/")
    for r in records:
        if r[3] != "revisit":
            continue
        head = {n.lower(): v for n, v in r[5] or []}
        fulls = [x for x in records if x[3] == "response" and x[4] == 200 and None not in (x[1], x[2], r[1], r[2]) and canon(x[1]) == canon(r[1]) and x[2] < r[2]]
        if not fulls:
            out[r[0]] = ("no_response", None, None)
            continue
        f = max(fulls, key=lambda x: (x[2], x[0]))
        old = {n.lower(): v for n, v in f[5] or []}
        ok = head["etag"] == old.get("etag") if "etag" in head else head["last-modified"] == old.get("last-modified") if "last-modified" in head else r[6] is None or r[6] == f[6]
        out[r[0]] = ("resolved", f[0], sorted({**old, **{n: v for n, v in head.items() if n in revisits.PERMITTED}}.items())) if ok else ("mismatch", None, None)
    return out


def test_resolution_matches_brute_force(spark):
    r = random.Random(2)
    tags = ['"a"', '"b"']
    data = []
    for i in range(500):
        kind = r.choice(["response", "revisit"])
        url = r.choice(["http://hot.com/x"] * 5 + ["https://hot.com/x/", "http://b.com/y", "http://c.com/z", None])
        heads = [(n, v) for n, v in (("ETag", r.choice(tags)), ("Last-Modified", r.choice("12")), ("Cache-Control", str(i)), ("Content-Length", str(i)), ("Server", "s")) if r.random() < 0.6]
        data.append((i, url, r.choice([None, *range(40)]), kind, r.choice([200, 200, 404]) if kind == "response" else 304, heads if r.random() < 0.9 else None, r.choice(["d1", "d2", None])))
    df = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit("clash") for c in ("bucket", "canonical", "full", "to", "within", "merged", "outcome")})
    want = brute(data)
    for seconds in (5, 86400):
        got = {x.rec_id: x for x in revisits.resolve_revisits(df, seconds).collect()}
        assert set(got) == set(want)
        for k, (outcome, to, merged) in want.items():
            assert got[k].outcome == outcome and got[k].resolved_to == to and ([tuple(h) for h in got[k].merged] if got[k].merged is not None else None) == merged, k


def test_repeats_and_empty(spark):
    row = (1, "http://a/", 5, "revisit", 304, None, None)
    data = [(0, "http://a", 1, "response", 200, [("ETag", "x")], "d")] * 2 + [row] * 3
    got = revisits.resolve_revisits(spark.createDataFrame(data, SCHEMA)).collect()
    assert [(x.outcome, x.resolved_to, x.body_digest) for x in got] == [("resolved", 0, "d")] * 3
    assert revisits.resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_query_reaches_every_outcome_by_every_validator(spark):
    from dimforge.llm.queries import op3_warc_revisits

    got = {(r.rec_id % 8, r.outcome) for r in op3_warc_revisits(spark, "/root/testdata/sf0.001").collect()}
    both = {"resolved", "mismatch"}
    for k in (3, 4, 5):  # ETag, Last-Modified, digest
        assert {o for x, o in got if x == k} == both
    assert (6, "resolved") in got and (7, "no_response") in got

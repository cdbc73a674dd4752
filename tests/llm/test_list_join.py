from pyspark.sql import functions as F

from pulsemill.llm import list_join as J

CAPTURES, ENTRIES = "page_id long, url string, fetched_at long", "pattern string, action string, at long"


def test_patterns(spark):
    def of(url):
        return spark.range(1).select(J.patterns(F.lit(url)).alias("p")).first().p

    assert of("http://me@A.b.Org:80/x/y?z/q#f") == [
        "d:org", "d:b.org", "d:a.b.org", "p:a.b.org/", "p:a.b.org/x/", "p:a.b.org/x/y"]
    assert of("http://b.org") == ["d:org", "d:b.org", "p:b.org/"]
    assert of("nothing") == [] and of("") == []
    assert of("http://b.org/x/") == ["d:org", "d:b.org", "p:b.org/", "p:b.org/x/"]


def test_patterns_of_a_lists_shapes(spark):
    entries = spark.createDataFrame([("d:b.org",), ("p:b.org/x/",), ("p:b.org/",), ("q:a/b/c/d",)], "pattern string")
    assert J.shapes(entries) == ([2], [1, 2])
    assert J.shapes(entries.limit(0)) == ([], [])

    def of(url):
        return spark.range(1).select(J.patterns(F.lit(url), [2], [1, 2]).alias("p")).first().p

    assert of("http://a.b.org/x/y/z") == ["d:b.org", "p:a.b.org/", "p:a.b.org/x/"]
    assert of("http://b.org/x/y") == ["d:b.org", "p:b.org/", "p:b.org/x/", "p:b.org/x/y"]
    assert of("http://org") == ["p:org/"] and of("") == []


def test_the_screen_lets_all_listed_patterns_pass(spark):
    listed = spark.range(3000).select(F.concat(F.lit("d:"), F.col("id").cast("string")).alias("pattern"))
    probes = spark.range(6000).select("id", F.concat(F.lit("d:"), F.col("id").cast("string")).alias("pattern"))
    left = [r.id for r in J.listed_only(probes, listed).collect()]
    assert set(range(3000)) <= set(left) and len(left) < 3010 and len(set(left)) == len(left)


def test_very_long_urls(spark):
    deep = "http://b.org/x" + "/a" * 50_000
    wide = "http://" + "s." * 30_000 + "b.org/"
    whole = "p:b.org/x" + "/a" * 50_000
    captures = spark.createDataFrame([(1, deep, 300), (2, wide, 300), (3, deep + "/z", 300)], CAPTURES)
    log = spark.createDataFrame([("d:b.org", "block", 100), ("p:b.org/x/a/", "allow", 200), (whole, "block", 250)], ENTRIES)
    rows = {r.page_id: (r.pattern, r.blocked) for r in J.as_of(captures, log).collect()}
    assert rows == {1: (whole, True), 2: ("d:b.org", True), 3: ("p:b.org/x/a/", False)}


def brute(captures, entries, spark):
    log = {}
    rank = {"block": 0, "allow": 1}
    for p, a, at in entries:
        if p is not None and at is not None:
            r = rank.get(a, 2)
            log.setdefault(p, {})[at] = min(log.get(p, {}).get(at, 9), r)
    out = []
    for page, url, at in captures:
        best = None
        own = spark.range(1).select(J.patterns(F.lit(url)).alias("p")).first().p if url else []
        for p in own:
            times = [t for t in log.get(p, {}) if at is not None and t <= at]
            if times and log[p][max(times)] < 2:
                best = max(best or (), (p.startswith("p:"), len(p), p, ("block", "allow")[log[p][max(times)]], max(times)))
        out.append((page, url, at, best[2] if best else None, best[3] if best else None, best[4] if best else None,
                    bool(best and best[3] == "block")))
    return sorted(out, key=str)


def test_as_of(spark):
    entries = [("d:b.org", "block", 100), ("d:b.org", "allow", 200), ("d:b.org", "drop", 300), ("d:b.org", "block", 1000),
               ("d:a.b.org", "allow", 150), ("p:b.org/x/", "block", 250), ("p:b.org/x/y", "allow", 260),
               ("d:b.org", "allow", 100), ("d:org", "block", 5), (None, "block", 1), ("d:c.net", "block", None),
               *[("d:t.net", "block" if i % 2 else "drop", 10 * i) for i in range(60)]]
    urls = ["http://b.org/", "http://a.b.org/x", "http://b.org/x/y", "http://b.org/x/z?q", None, "bad", "http://t.net/"]
    captures = [(i, u, at) for u in urls for i, at in enumerate((99, 100, 199, 200, 255, 299, 300, 999, 5000, 4, None))]
    captures += captures[:3]
    df, log = spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES)
    expected = brute(captures, entries, spark)
    for seconds in (1, 70, 100_000):
        assert sorted(map(tuple, J.as_of(df, log, seconds).collect()), key=str) == expected


def test_empty_tables(spark):
    none, log = spark.createDataFrame([], CAPTURES), spark.createDataFrame([], ENTRIES)
    assert J.as_of(none, log).count() == 0
    rows = J.as_of(spark.createDataFrame([(1, "http://a.org", 5)], CAPTURES), log).collect()
    assert [(r.page_id, r.pattern, r.blocked) for r in rows] == [(1, None, False)]

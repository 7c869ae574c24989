import random

import pytest
from pyspark.sql import types as T

from quire.llm import url_filters as u

CAPTURES = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("day", T.IntegerType()),
     T.StructField("host", T.StringType()), T.StructField("domain", T.StringType())]
)
ENTRIES = T.StructType(
    [T.StructField("list", T.StringType()), T.StructField("allows", T.BooleanType()), T.StructField("domain", T.StringType()),
     T.StructField("day", T.IntegerType()), T.StructField("added", T.BooleanType())]
)

ROWS = [
    (1, "http://a.bad.com/x", 5), (2, "http://a.bad.com/x", 15), (3, "https://user@BAD.com.:80/", 10),
    (4, "http://ok.bad.com", 12), (5, "nonsense", 12), (6, None, 12), (7, "http://bad.com", None),
    (8, "http://bad.com", 200), (9, "http://com", 12), (10, "http://notbad.com", 12), (3, "https://user@BAD.com.:80/", 10),
    (11, "http://deep.ok.bad.com", 12), (12, "http://bad.com", 19), (13, "http://bad.com", 20),
]
LISTED = [
    ("spam", False, "bad.com", 10, True), ("spam", False, "bad.com", 20, False), ("spam", False, "bad.com", 100, True),
    ("partners", True, "ok.bad.com", 0, True), ("adult", False, "a.bad.com", 3, True), ("adult", False, "a.bad.com", 3, False),
    ("adult", False, "a.bad.com", 6, True), (None, False, "bad.com", 1, True), ("spam", False, None, 1, True),
    ("spam", False, "bad.com", None, True), ("spam", False, "bad.com", 10, True), ("spam", False, "com", 0, True),
]


def frames(spark, rows=ROWS, listed=LISTED):
    return (
        spark.createDataFrame([(*r, "h", "d") for r in rows], CAPTURES).repartition(2),
        spark.createDataFrame(listed, ENTRIES),
    )


def test_as_of_the_fetch_day(spark):
    for period in (1, 7, 32):
        out = u.evaluate(*frames(spark), period)
        assert sorted(out.columns) == sorted(["id", "url", "day", "domain", "host", "lists", "n_lists", "verdict"])
        got = sorted((r.id, r.host, r.lists, r.n_lists, r.verdict) for r in out.collect() if r.id not in (5, 6))
        assert got == [
            (1, "a.bad.com", "", 0, "keep"),
            (2, "a.bad.com", "adult,spam", 2, "drop"),
            (3, "bad.com", "spam", 1, "drop"),
            (3, "bad.com", "spam", 1, "drop"),
            (4, "ok.bad.com", "partners,spam", 2, "keep"),
            (7, "bad.com", "", 0, "keep"),
            (8, "bad.com", "spam", 1, "drop"),
            (9, "com", "", 0, "keep"),
            (10, "notbad.com", "", 0, "keep"),
            (11, "deep.ok.bad.com", "partners,spam", 2, "keep"),
            (12, "bad.com", "spam", 1, "drop"),
            (13, "bad.com", "", 0, "keep"),
        ]
        odd = [r for r in out.collect() if r.id in (5, 6)]
        assert [(r.host, r.verdict) for r in odd] == [(None, "keep")] * 2


def test_empty_tables(spark):
    assert u.evaluate(*frames(spark, [], LISTED)).collect() == []
    assert {r.verdict for r in u.evaluate(*frames(spark, ROWS, [])).collect()} == {"keep"}


def test_no_python_and_no_cross_join(spark):
    plan = u.evaluate(*frames(spark))._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def brute(captures, listed):
    """Each capture against the state of every list on its day, entry by entry."""
    out = []
    for i, host, day in captures:
        valid = {}
        if host and day is not None:
            labels = host.split(".")
            for k in range(len(labels) - 1):
                domain = ".".join(labels[k:])
                for name in {x[0] for x in listed}:
                    # of one day's entries a removal comes last
                    past = sorted((d, not added, allows) for n, allows, x, d, added in listed if n == name and x == domain and d <= day)
                    if past and not past[-1][1]:
                        allows = max(a for d, _, a in past if d == past[-1][0])
                        valid[name] = max(valid.get(name, (0, False)), (len(labels) - k, allows))
        best = max(((n, a, name) for name, (n, a) in valid.items()), default=None)
        verdict = "keep" if best is None or best[1] else "drop"
        out.append((i, ",".join(sorted(valid)), len(valid), verdict))
    return sorted(out)


@pytest.mark.parametrize("period", [5, 32])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_histories_equal_brute_force(spark, seed, period):
    rng = random.Random(seed)
    domains = ["a.com", "x.a.com", "y.x.a.com", "b.org", "z.b.org"]
    listed = [
        (name, allows, rng.choice(domains), rng.randrange(0, 120), rng.random() < 0.6)
        for name, allows in (("l1", False), ("l2", True), ("l3", False)) for _ in range(40)
    ]
    hosts = [rng.choice(["", "w."]) + rng.choice(domains) for _ in range(300)]
    captures = [(k, h, rng.randrange(0, 150)) for k, h in enumerate(hosts)]
    rows = [(k, f"http://{h}/{k}", d) for k, h, d in captures]
    got = u.evaluate(*frames(spark, rows, listed), period).collect()
    assert sorted((r.id, r.lists, r.n_lists, r.verdict) for r in got) == brute(captures, listed)

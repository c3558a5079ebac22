import random
from collections import Counter, defaultdict

from postloom.operators import keyed_totals as kt
from postloom.operators.keyed_totals import heavy_keys, keyed_totals


def rows(n=20_000):
    r = random.Random(3)
    return [(r.choice(["hot"] * 6 + [f"k{r.randint(0, 3000)}", "", None, "é"]), r.choice(["a", "b", None, f"s{i % 97}"]), r.choice([None, r.randint(-5, 50)]), i) for i in range(n)]


def test_against_a_counter(spark):
    data = rows()
    df = spark.createDataFrame(data, "k string, s string, v int, pos long").repartition(7)
    got = {(r.field_name, r.key_value): (r.n, r.total, r.low, r.high) for r in keyed_totals(df, ["k", "s"], {"total": ("v", "sum"), "low": ("v", "min"), "high": ("pos", "max")}, blocks=5, held=500, fan_in=2).collect()}
    want = defaultdict(lambda: [0, 0, None, -1])
    for k, s, v, p in data:
        for name, key in (("k", k), ("s", s)):
            if key:
                w = want[name, key]
                w[0] += 1
                w[1] += v or 0
                w[2] = v if w[2] is None else w[2] if v is None else min(v, w[2])
                w[3] = max(w[3], p)
    assert got == {k: tuple(v) for k, v in want.items()}


def test_heavy_keys(spark):
    data = rows(5000)
    df = spark.createDataFrame(data, "k string, s string, v int, pos long")
    counts = Counter(k for k, *_ in data if k)
    assert {r.key_value for r in heavy_keys(df, ["k"], 0.02).collect()} == {k for k, n in counts.items() if n >= 100}


def test_empty_nulls_and_extra_columns(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert keyed_totals(df, ["k"], {"t": ("v", "sum")}).count() == 0
    assert heavy_keys(df, ["k"], 0.02).count() == 0
    df = spark.createDataFrame([(None, 1), (None, 2)], "k string, v int")
    assert keyed_totals(df, ["k"]).count() == 0
    df = spark.createDataFrame([("a", 1, "x", "y")], "_m0 string, v int, field string, keys string")
    assert [tuple(r) for r in keyed_totals(df, ["_m0", "field"], {"t": ("v", "sum")}).orderBy("field_name").collect()] == [("_m0", "a", 1, 1), ("field", "x", 1, 1)]


def test_very_long_keys(spark):
    key = "x" * 300_000
    df = spark.createDataFrame([(key,), (key,), ("y",)], "k string")
    assert {(len(r.key_value), r.n) for r in keyed_totals(df, ["k"]).collect()} == {(300_000, 2), (1, 1)}


def test_key_ranges_follow_the_keys(spark, monkeypatch):
    monkeypatch.setattr(kt, "KEYS_IN_BLOCK", 10)
    monkeypatch.setattr(kt, "SLICE", 3)
    df = spark.range(1000).selectExpr("cast(id % 500 as string) as k", "id as v").repartition(3)
    assert {(r.key_value, r.n) for r in keyed_totals(df, ["k"]).collect()} == {(str(i), 2) for i in range(500)}

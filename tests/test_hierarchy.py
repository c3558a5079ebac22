import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postloom.operators.hierarchy import LOOP, OPEN, contract, expand_paths, loops, message_descendants, message_hierarchy, message_paths, resolve_forest, sums_above, sums_below


def brute(parents):
    out = {}
    for x in parents:
        seen, at, depth = set(), x, 0
        while parents[at] is not None and at not in seen:
            seen.add(at)
            at, depth = parents[at], depth + 1
        out[x] = (None, -1) if parents[at] is not None else (at, depth)
    return out


def forest(n, seed, near=True, loops=True):
    r = random.Random(seed)
    parents = {}
    for i in range(n):
        if r.random() < 0.2:
            parents[i] = None
        else:
            parents[i] = r.randrange(max(0, i - 20), i) if near and i else r.randrange(n)
    if loops:
        for i in range(0, n, n // 5):
            parents[i] = min(n - 1, i + 3)
    return parents


@pytest.mark.parametrize(("n", "near", "span", "one_task"), [(3000, True, 64, 1), (3000, True, 64, 10**6), (1500, False, 16, 1), (400, True, 10**6, 1)])
def test_against_brute_force(spark, n, near, span, one_task):
    parents = forest(n, n + span, near)
    df = spark.createDataFrame(list(parents.items()), "node long, parent long")
    got = {r.node: (r.root, r.depth) for r in resolve_forest(df, span, one_task).collect()}
    assert got == brute(parents)


def test_deep_chain_over_many_fragments(spark):
    n = 5000
    df = spark.range(n).select(F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"))
    got = resolve_forest(df, 32, 1)
    assert got.filter("root <> 0 or depth <> node").count() == 0 and got.count() == n


def test_contract_marks_local_loops_only():
    node = np.array([1, 2, 3, 4, 5])
    exit_, hops, state = contract(node, np.array([2, 1, 1, 9, 4]), np.ones(5, np.int64), np.full(5, OPEN))
    assert state.tolist() == [LOOP, LOOP, LOOP, OPEN, OPEN] and exit_[4] == 9 and hops[4] == 2


def mails(spark, rows):
    return spark.createDataFrame(rows, "pos long, message_id string, parent_id string, children_ids array<string>")


def test_message_rules(spark):
    rows = [
        (1, "a", None, ["b", "", None, "gone"]),  # b is known from this end only
        (2, "b", None, None),
        (3, "c", "b", []),
        (4, "c", "b", []),  # delivered twice
        (5, "d", "lost", []),
        (6, "", "a", ["a"]),
        (7, None, "a", ["a"]),
        (8, "x", "y", []),
        (9, "y", "x", []),
        (10, "z", "y", []),
        (11, "me", "me", []),
        (12, "two", "a", []),  # two parents: the least id counts
        (13, "b", None, ["two"]),
    ]
    got = {r.message_id: (r.root_id, r.node_depth) for r in message_hierarchy(mails(spark, rows), span=3, one_task=2).collect()}
    assert got == {"a": ("a", 0), "b": ("a", 1), "c": ("a", 2), "d": ("d", 0), "x": ("", -1), "y": ("", -1), "z": ("", -1), "me": ("", -1), "two": ("a", 1)}


def test_paths_and_descendants(spark):
    rows = [(i, f"m{i}", f"m{i - 1}" if i % 40 else None, []) for i in range(1, 200)] + [(500, "l", "l", [])]
    out = {r.message_id: r for r in message_paths(mails(spark, rows), span=8).collect()}
    assert out["m39"].path.split() == [f"m{i}" for i in range(1, 40)][1:] or out["m39"].path.split()[-1] == "m39"
    for r in out.values():
        if r.node_depth >= 0:
            ids = r.path.split()
            assert ids[0] == r.root_id and ids[-1] == r.message_id and len(ids) == r.node_depth + 1
    assert (out["l"].path, out["l"].n_descendants, out["l"].root_id) == ("", 0, "")
    pairs = message_descendants(mails(spark, rows), span=8).collect()
    assert sum(r.n_descendants for r in out.values()) == len(pairs) == sum(max(0, r.node_depth) for r in out.values())


def test_empty_and_null_places(spark):
    assert message_hierarchy(mails(spark, [])).count() == 0
    got = message_hierarchy(mails(spark, [(None, "a", None, []), (None, "b", "a", [])])).collect()
    assert {(r.message_id, r.root_id, r.node_depth) for r in got} == {("a", "a", 0), ("b", "a", 1)}


@pytest.mark.parametrize(("n", "near", "span", "one_task"), [(1500, True, 32, 1), (800, False, 16, 1), (800, False, 16, 10**6)])
def test_sums_and_paths_against_brute_force(spark, n, near, span, one_task):
    r = random.Random(n)
    parents = {i: None if not i or r.random() < 0.1 else r.randrange(max(0, i - 20), i) if near else r.randrange(i) for i in range(n)}
    weight = {i: r.randint(0, 3) for i in parents}
    df = spark.createDataFrame([(i, p, weight[i], f"n{i}") for i, p in parents.items()], "node long, parent long, weight long, name string")
    above, below, paths = {}, dict(weight), {}
    for i, p in parents.items():
        above[i] = weight[i] + (0 if p is None else above[p])
        paths[i] = [*([] if p is None else paths[p]), f"n{i}"]
    for i in reversed(range(n)):
        if parents[i] is not None:
            below[parents[i]] += below[i]
    assert {x.node: x.total for x in sums_above(df, span, one_task).collect()} == above
    assert {x.node: x.total for x in sums_below(df, span, one_task).collect()} == below
    assert {x.node: x.path for x in expand_paths(df, span).collect()} == paths


@pytest.mark.parametrize("one_task", [0, 10**6])
def test_loops(spark, one_task):
    steps = [(1, 2), (2, 3), (3, 1), (4, 3), (5, 4), (7, 7), (8, 7), (10, 11), (11, 10), (20, 21), (21, 99)]
    got = {(r.node, r.loop) for r in loops(spark.createDataFrame(steps, "node long, parent long"), one_task).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (7, 7), (10, 10), (11, 10)}
    assert loops(spark.createDataFrame([], "node long, parent long"), one_task).count() == 0


def test_hot_parent(spark):
    links = spark.range(1, 2000).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("parent"), F.lit(1).alias("weight")).union(spark.createDataFrame([(0, None, 1)], "node long, parent long, weight int"))
    assert sums_below(links, 100, 1).filter("node = 0").first().total == 2000

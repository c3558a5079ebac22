import pytest

from postloom.llm.mixing import mix_sources


def docs(spark, sizes):
    rows = [(f"{s}{i}", s, "word " * n) for s, ns in sizes.items() for i, n in enumerate(ns)]
    return spark.createDataFrame(rows, "doc_id string, source string, text string")


def targets(spark, rows):
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int")


def test_shares_and_caps(spark):
    d = docs(spark, {"big": [10] * 400, "small": [10] * 20, "tiny": [5] * 8})
    plan = targets(spark, [("big", 0.6, 1), ("small", 0.3, 3), ("tiny", 0.1, 4)])
    mix, report = mix_sources(d, plan)
    rows = {r.source: r for r in report.collect()}
    assert abs(sum(r.actual_share for r in rows.values()) - 1) < 1e-9
    for s, cap in (("big", 1), ("small", 3), ("tiny", 4)):
        assert abs(rows[s].actual_share - rows[s].target_share) < 0.02 and rows[s].tokens <= rows[s].available * cap
        assert abs(rows[s].tokens - rows[s].budget) <= 11
    got = mix.collect()
    assert len({r.doc_id for r in got}) == len(got)
    assert all(1 <= r.copies <= {"big": 1, "small": 3, "tiny": 4}[r.source] for r in got)
    copies = {r.copies for r in got if r.source == "tiny"}
    assert max(copies) - min(copies) <= 1  # whole passes before a second helping


def test_a_given_total_reports_what_falls_short(spark):
    d = docs(spark, {"a": [10] * 100, "b": [10] * 2})
    rows = {r.source: r for r in mix_sources(d, targets(spark, [("a", 0.5, 1), ("b", 0.5, 2)]), total_tokens=1000)[1].collect()}
    assert rows["b"].tokens == 2 * rows["b"].available and rows["b"].actual_share < 0.1
    assert abs(rows["a"].tokens - 500) <= 10


def test_same_seed_same_mix(spark):
    d, plan = docs(spark, {"a": [3, 4, 5] * 50, "b": [7] * 40}), targets(spark, [("a", 0.5, 1), ("b", 0.5, 1)])
    one, two = ({(r.doc_id, r.copies) for r in mix_sources(d.repartition(n), plan)[0].collect()} for n in (1, 5))
    assert one == two


@pytest.mark.parametrize("rows", [[], [("x", None, "a b"), ("y", "other", "a b"), ("z", "a", None), ("w", "a", "")]])
def test_nothing_to_mix(spark, rows):
    d = spark.createDataFrame(rows, "doc_id string, source string, text string")
    mix, report = mix_sources(d, targets(spark, [("a", 0.5, 1), (None, 0.5, 1), ("b", None, 2)]))
    assert mix.count() == 0
    assert [(r.source, r.tokens, r.actual_share) for r in report.collect()] == [("a", 0, 0.0)]


def test_sources_without_tokens_leave_the_others_whole(spark):
    rows = {r.source: r for r in mix_sources(docs(spark, {"a": [10] * 30}), targets(spark, [("a", 0.5, 1), ("gone", 0.5, 1)]))[1].collect()}
    assert rows["a"].actual_share == 1.0 and rows["a"].tokens == rows["a"].available and rows["gone"].tokens == 0


def test_extra_columns_ties_and_null_keys(spark):
    d = docs(spark, {"a": [10] * 30}).selectExpr("cast(null as string) as doc_id", "source", "text", "1 as n_tokens", "2 as available", "3 as rest")
    mix, report = mix_sources(d, targets(spark, [("a", 1.0, 2)]))
    assert report.collect()[0].tokens == 2 * report.collect()[0].available and mix.count() == 30

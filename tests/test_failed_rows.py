import json
import random
import re

from pyspark.sql import functions as F

from postloom.operators.failed_rows import FLAG_TYPES, judge_rows, valid_rows

GOOD = '0123456789abcdef,1994,cyp-1994.txt,12,Re: hello,"Ann ""A"" <a@b.example>","[""EMPTY_BODY: x""]"'


def fields_of(text):
    """Brute force: fields of a record, or None for broken quoting."""
    out, i, n = [], 0, len(text)
    while True:
        if i < n and text[i] == '"':
            i, value = i + 1, ""
            while True:
                if i >= n:
                    return None
                if text[i] == '"':
                    if text[i + 1 : i + 2] == '"':
                        value, i = value + '"', i + 2
                        continue
                    i += 1
                    break
                value, i = value + text[i], i + 1
            if i < n and text[i] != ",":
                return None
        else:
            j = i
            while j < n and text[j] != ",":
                if text[j] in '"\n\r':
                    return None
                j += 1
            value, i = text[i:j], j
        out.append(value)
        if i >= n:
            return out
        i += 1


def reason_of(text):
    fields = fields_of(text or "")
    if fields is None:
        return "quoting"
    if len(fields) != 7:
        return "column_count"
    id_, year, file, line, _, raw, flags = fields
    try:
        items = json.loads(flags)
        typed = isinstance(items, list) and all(isinstance(x, str) and re.match(rf"(?s)(?:{'|'.join(FLAG_TYPES)}): .", x) for x in items)
    except ValueError:
        typed = False
    ok = re.fullmatch("[0-9a-f]{16}", id_) and re.fullmatch("[0-9]{4}", year) and file == f"cyp-{year}.txt" and re.fullmatch("[0-9]+", line) and int(line) > 0
    return None if ok and typed and not re.search("[\x00-\x1f\x7f-\x9f\ufffd]", raw) else "bad_value"


def judge(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_id long, record_text string")
    return [r.reason for r in judge_rows(df).orderBy("row_id").collect()]


def test_random_damage_against_brute_force(spark):
    r = random.Random(5)
    texts = [GOOD]
    for _ in range(1500):
        t = list(GOOD)
        for _ in range(r.randint(1, 3)):
            i = r.randrange(len(t))
            t[i] = r.choice(['"', ",", "", "\n", "x", "9", '""', "[", "]", "\\", "\a", "\ufffd", "\ufdd0", "\ufdd1", t[i] * 2, " "])
        texts.append("".join(t))
    assert judge(spark, texts) == [reason_of(t) for t in texts]
    assert {*map(reason_of, texts)} == {None, "quoting", "column_count", "bad_value"}


def test_nulls_empty_long_and_repeated(spark):
    long = GOOD.replace("Re: hello", '"' + 'a""' * 200_000 + '"')
    many = GOOD.replace('"[""EMPTY_BODY: x""]"', '"[' + ",".join(['""EMPTY_BODY: x""'] * 20_000) + ']"')
    assert judge(spark, [None, "", GOOD, GOOD, long, many, '"']) == ["column_count", "column_count", None, None, None, None, "quoting"]


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([(1, GOOD, 7, "r")], "row_id long, record_text string, _parts int, reason string").withColumn("_values", F.lit(1))
    row = judge_rows(df).collect()[0]
    assert (row._parts, row.reason, row._values) == (7, None, 1)
    assert judge_rows(df.limit(0)).count() == 0


def test_bad_columns_and_null_keys(spark):
    bad = GOOD.replace("1994", "199").replace(",12,", ",0,")
    df = spark.createDataFrame([(None, bad), (None, GOOD), (3, GOOD)], "row_id long, record_text string")
    got = sorted((str(r.row_id), r.reason or "", len(r.bad_columns or [])) for r in judge_rows(df).collect())
    assert got == [("3", "", 0), ("None", "", 0), ("None", "bad_value", 3)]


def test_valid_rows_are_typed(spark):
    row = valid_rows(spark.createDataFrame([(1, GOOD), (2, "x")], "row_id long, record_text string")).collect()
    assert len(row) == 1
    assert (row[0].year, row[0].line, row[0].from_raw, row[0].flags) == (1994, 12, 'Ann "A" <a@b.example>', ["EMPTY_BODY: x"])


def test_numbers_beyond_their_type_are_named(spark):
    big = GOOD.split(",")
    big[3] = "9" * 40
    rows = valid_rows(spark.createDataFrame([(1, GOOD), (2, ",".join(big))], "row_id long, record_text string")).orderBy("row_id").collect()
    assert [r.beyond_type for r in rows] == [[], ["line"]] and rows[1].line is None and rows[1].year == rows[0].year


def test_many_rows_without_fields(spark):
    df = spark.createDataFrame([(i, "x" if i % 2 else GOOD.replace("cyp-", "cyq-")) for i in range(500)], "row_id long, record_text string")
    got = {(r.row_id % 2, r.reason) for r in judge_rows(df).collect()}
    assert got == {(1, "column_count"), (0, "bad_value")}

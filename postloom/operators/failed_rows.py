"""Separates rows that break the rules of their export from those that keep them, with the reason.

Structure first: quoting is checked by the parts between quotes, the number of fields by the commas outside
them. Then each distinct value of each column is cast once; the failing ones form a dictionary of invalid
values with their reasons, which is joined back to the rows. A hot value thus costs one cast, and only the
keys of failing values travel in the join.

Defined results: a NULL or empty record has one empty field and so fails with ``column_count``; a record
without a failing part is valid; reasons are checked in the order quoting, column_count, bad_value; a row
with several bad values lists them all in ``bad_columns``. Repeated rows are judged one by one, extra columns
of the input are kept. A value beyond the range of its column's type is named in ``beyond_type``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.runtime import broadcast_if_small, cut

# A code point no text may hold; it parts fields once commas inside quotes are out of the way. Real occurrences are escaped first.
_SEP, _ESC = "\ufdd0", "\ufdd1"


@dataclass(frozen=True)
class Rule:
    """A column of the export and the condition its value must meet, as a function from value to a boolean column."""

    name: str
    type: str
    valid: object
    reason: str
    needs: str | None = None  # another column whose value the condition also takes


FLAG_TYPES = ("NO_EMAIL_FOUND", "OBFUSCATED_EMAIL", "MISSING_HEADER", "CORRUPTED_DATE", "UNPARSEABLE_DATE", "EMPTY_BODY")
_ITEM = "\x01"  # stands for a JSON string; no JSON text holds it


def _flag_list(value: Column) -> Column:
    """A JSON array of strings TYPE: detail, in time linear in its length: strings are folded to one sign, then the frame is tested."""
    items = F.from_json(value, "array<string>", {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowUnquotedFieldNames": "false"})
    # A backslash pair is taken out first, so that what is left between two quotes is one string.
    pairs = F.regexp_replace(value, r'\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})', "e")
    frame = F.regexp_replace(F.regexp_replace(pairs, r'"[^"\\\x00-\x1f]*+"', _ITEM), r"[ \t\r\n]+", "")
    whole = (frame == "[]") | (F.replace(frame, F.lit("," + _ITEM), F.lit("")) == f"[{_ITEM}]")
    typed = F.forall(items, lambda x: x.isNotNull() & x.rlike(rf"(?s)^(?:{'|'.join(FLAG_TYPES)}): ."))
    return F.coalesce(whole & items.isNotNull() & typed, F.lit(False))


REVIEW_RULES: tuple[Rule, ...] = (
    Rule("id", "string", lambda v: v.rlike(r"^[0-9a-f]{16}\z"), "not 16 lower-case hex digits"),
    Rule("year", "int", lambda v: v.rlike(r"^[0-9]{4}\z"), "not a four-digit year"),
    Rule("file", "string", lambda v, year: F.coalesce((v == F.concat(F.lit("cyp-"), year, F.lit(".txt"))) & v.rlike(r"^cyp-[0-9]{4}\.txt\z"), F.lit(False)), "not the file of its year", "year"),
    Rule("line", "bigint", lambda v: v.rlike(r"^0*[1-9][0-9]*\z"), "not a positive line number"),
    Rule("subject", "string", None, ""),
    Rule("from_raw", "string", lambda v: ~v.rlike(r"[\x00-\x1f\x7f-\x9f\ufffd]"), "control or replacement character"),
    Rule("flags", "array<string>", _flag_list, "not a list of known flags"),
)


def _let(value: Column, body) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _outside_ok(x: Column, i: Column, last: Column) -> Column:
    """Whether a part that stands outside quotes may stand there; parts of odd number are inside."""
    plain = ~x.contains("\n") & ~x.contains("\r")
    return (
        (i % 2 == 1)
        | ((i == 0) & ((x == "") | x.endswith(",") | (last == 0)) & plain)
        | ((i == last) & (i > 0) & ((x == "") | x.startswith(",")) & plain)
        | ((i > 0) & (i < last) & ((x == "") | (x.startswith(",") & x.endswith(","))) & plain)
    )


def _parted(parts: Column) -> Column:
    """(broken, text) of the parts between quotes: text has a separator between fields and no quotes of the notation."""

    def run(last: Column) -> Column:
        broken = (last % 2 == 1) | F.exists(F.transform(parts, lambda x, i: ~_outside_ok(x, i, last)), lambda bad: bad)
        # Outside quotes commas part fields; an empty part between two quoted ones is a doubled quote.
        rewritten = F.transform(parts, lambda x, i: F.when(i % 2 == 1, x).when((x == "") & (i > 0) & (i < last), F.lit('"')).otherwise(F.replace(x, F.lit(","), F.lit(_SEP))))
        return F.struct(broken.alias("broken"), F.array_join(rewritten, "").alias("text"))

    return _let(F.size(parts) - 1, run)


def split_records(df: DataFrame, text: str = "record_text") -> DataFrame:
    """df with ``_broken`` (quoting), ``_count`` (fields) and ``_values`` (unquoted field values)."""
    raw = F.coalesce(F.col(text), F.lit(""))
    safe = F.replace(F.replace(raw, F.lit(_ESC), F.lit(_ESC + "b")), F.lit(_SEP), F.lit(_ESC + "a"))
    plain = lambda fields: F.transform(fields, lambda x: F.replace(F.replace(x, F.lit(_ESC + "a"), F.lit(_SEP)), F.lit(_ESC + "b"), F.lit(_ESC)))
    parted = _let(F.split(safe, '"', -1), lambda parts: _let(_parted(parts), lambda p: F.struct(p["broken"].alias("broken"), plain(F.split(p["text"], _SEP, -1)).alias("values"))))
    out = df.withColumn("_split", parted)
    return out.withColumn("_broken", F.col("_split.broken")).withColumn("_values", F.col("_split.values")).withColumn("_count", F.size("_values")).drop("_split")


def invalid_values(values: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(col, value, other, bad_reason) of every distinct value that fails the cast of its column."""
    distinct = values.select("col", "value", "other").distinct()
    verdict = F.lit(None).cast("string")
    for rule in rules:
        if rule.valid is not None:
            ok = rule.valid(F.col("value")) if rule.needs is None else rule.valid(F.col("value"), F.col("other"))
            verdict = F.when((F.col("col") == rule.name) & ~F.coalesce(ok, F.lit(False)), F.lit(rule.reason)).otherwise(verdict)
    return distinct.withColumn("bad_reason", verdict).filter("bad_reason is not null")


def judge_rows(df: DataFrame, text: str = "record_text", rules: tuple[Rule, ...] = REVIEW_RULES) -> DataFrame:
    """df with ``field_values``, ``reason`` (NULL: valid) and ``bad_columns`` (array of ``column: reason``).

    Rows are never grouped or keyed: the dictionary is joined once for each checked column, by value.
    """
    # The caller's columns travel as one struct, so that no working name can clash with them.
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    records = split_records(rows, "_text")
    structure = F.when(F.col("_broken"), "quoting").when(F.col("_count") != len(rules), "column_count")
    # Rows without fields to check get keys of their own, so that they do not meet in one task of a join.
    records = records.withColumn("_structure", structure).withColumn("_row_no", F.monotonically_increasing_id().cast("string"))
    place = {r.name: i + 1 for i, r in enumerate(rules)}
    checked = [r for r in rules if r.valid is not None]
    sound = F.col("_structure").isNull()
    value = lambda r: F.when(sound, F.try_element_at("_values", F.lit(place[r.name]))).otherwise(F.concat(F.lit(_SEP), F.col("_row_no")))
    other = lambda r: F.when(sound, F.try_element_at("_values", F.lit(place[r.needs]))) if r.needs else F.lit("")
    cells = F.array(*[F.struct(F.lit(r.name).alias("col"), value(r).alias("value"), other(r).alias("other")) for r in checked])
    values = records.filter(sound).select(F.explode(cells).alias("_cell")).select("_cell.*")
    bad = cut(invalid_values(values, rules))
    out = records
    for i, r in enumerate(checked):
        own = broadcast_if_small(bad.filter(F.col("col") == r.name).select(F.col("value").alias(f"_v{i}"), F.col("other").alias(f"_o{i}"), F.col("bad_reason").alias(f"_b{i}")))
        out = out.join(own, (value(r) == F.col(f"_v{i}")) & (other(r) == F.col(f"_o{i}")), "left").drop(f"_v{i}", f"_o{i}")
    found = F.array_sort(F.array_compact(F.array(*[F.concat(F.lit(f"{r.name}: "), F.col(f"_b{i}")) for i, r in enumerate(checked)])))
    out = out.withColumn("_bad", F.when(F.size(found) > 0, found))
    reason = F.coalesce(F.col("_structure"), F.when(F.col("_bad").isNotNull(), "bad_value"))
    kept = [F.col(f"_row.`{c}`").alias(c) for c in df.columns if c not in ("field_values", "reason", "bad_columns")]
    return out.select(*kept, F.col("_values").alias("field_values"), reason.alias("reason"), F.col("_bad").alias("bad_columns"))


def rejected_rows(df: DataFrame, text: str = "record_text", rules: tuple[Rule, ...] = REVIEW_RULES) -> DataFrame:
    return judge_rows(df, text, rules).filter("reason is not null")


def valid_rows(df: DataFrame, key: str = "row_id", text: str = "record_text", rules: tuple[Rule, ...] = REVIEW_RULES) -> DataFrame:
    """The typed valid rows: the key, one column for each rule, and ``beyond_type``.

    The rules settle what is valid; the casts here cannot fail on a valid value but for one reason: a number may be
    larger than its type holds. Such a row stays valid, its column is NULL and named in ``beyond_type`` (else empty).
    Only invalid values are kept in a dictionary: one of valid values would be as large as the table.
    """
    out = judge_rows(df.select(key, text), text, rules).filter("reason is null")
    typed, beyond = [], []
    for i, r in enumerate(rules):
        v = F.try_element_at("field_values", F.lit(i + 1))
        cell = F.from_json(v, "array<string>") if r.type == "array<string>" else v.try_cast(r.type)
        typed.append(cell.alias(r.name))
        if r.type not in ("string", "array<string>"):
            beyond.append(F.when(cell.isNull(), F.lit(r.name)))
    return out.select(key, *typed, F.array_compact(F.array(*beyond)).cast("array<string>").alias("beyond_type"))

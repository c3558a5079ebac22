"""Raw mail text to typed records with quality flags.

Every step is a column expression; only RFC 822 dates go through an Arrow function, which parses with the
standard library. Defined results: a message without a blank line has an empty body; a missing header is the
empty string, except In-Reply-To, which is NULL; the last of repeated headers counts; a line without a colon
ends the header before it; flags come in the order sender, date, body, message id, subject.
"""

from __future__ import annotations

import re
from datetime import datetime
from email.utils import parsedate_to_datetime
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions.text import strip

# What an address looks like, and the replacements that undo disguises, in order.
ADDRESS = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
# Bracketed words come first, and bare ones need white space around them, so that words holding them stay whole.
DISGUISES = ((r"(?iU)\s*\[at\]\s*", "@"), (r"(?iU)\s*\[dot\]\s*", "."), (r"[A-Z](?=[a-z0-9.-]+\.[a-z]{2,})", "@"), (r"(?iU)\s+at\s+", "@"), (r"(?iU)\s+dot\s+", "."))
# The same in the order and without the white space of the original archive's parser; a word that holds "at" or "dot" is taken apart.
DISGUISES_IN_ORDER = ((r"[A-Z](?=[a-z0-9.-]+\.[a-z]{2,})", "@"), (r"(?iU)\s*at\s*", "@"), (r"(?iU)\s*\[at\]\s*", "@"), (r"(?iU)\s*dot\s*", "."), (r"(?iU)\s*\[dot\]\s*", "."))
# A name before an address in angle brackets, and one in round brackets behind an address.
NAME_FIRST = r'\A"?([^"<]+?)"?(?U:\s*)<([^>]+)>\z'
NAME_BEHIND = r"\A([^\s(]+@[^\s(]+)\s*\(([^)]+)\)\z"
#: Bodies shorter than this are flagged.
LEAST_BODY = 10


def split_message(raw: Column) -> tuple[Column, Column]:
    """Header block and body: parted at the first empty line."""
    at = F.instr(raw, "\n\n")
    head = F.when(at > 0, F.substring(raw, F.lit(1), at - 1)).otherwise(raw)
    return strip(head), F.when(at > 0, F.substring(raw, at + 2, F.length(raw))).otherwise(F.lit(""))


def header_map(head: Column) -> Column:
    """Lower-case header names to values; folded lines are joined by one blank, the last duplicate wins.

    A fold over the lines: the state holds the finished headers and the open one.
    """
    empty = F.struct(F.array().cast("array<struct<k:string,v:string>>").alias("done"), F.lit(None).cast("string").alias("key"), F.lit("").alias("value"))
    closed = lambda s: F.when(F.length(s["key"]) > 0, F.array_append(s["done"], F.struct(s["key"].alias("k"), s["value"].alias("v")))).otherwise(s["done"])

    def step(state: Column, line: Column) -> Column:
        folded = line.rlike(r"\A[ \t]")
        more = F.struct(state["done"].alias("done"), state["key"].alias("key"), F.when(state["key"].isNotNull(), F.concat_ws(" ", state["value"], strip(line))).otherwise(state["value"]).alias("value"))
        colon = F.instr(line, ":")
        fresh = F.struct(closed(state).alias("done"), F.when(colon > 0, F.lower(strip(F.substring(line, F.lit(1), colon - 1)))).alias("key"), F.when(colon > 0, strip(F.substring(line, colon + 1, F.length(line)))).otherwise(F.lit("")).alias("value"))
        return F.when(folded, more).otherwise(fresh)

    folded = F.aggregate(F.split(head, "\n"), empty, step, closed)
    # Keep the last of equal names, so that the session's policy on duplicate map keys does not matter.
    last = F.filter(folded, lambda x, i: ~F.exists(F.slice(folded, i + 2, F.greatest(F.size(folded) - i - 1, F.lit(0))), lambda y: y["k"] == x["k"]))
    return F.map_from_entries(last)


def header(headers: Column, name: str, default: str = "") -> Column:
    return F.coalesce(F.try_element_at(headers, F.lit(name)), F.lit(default))


def references(raw: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(raw, F.lit("")), F.lit("<[^>]+>"), 0), lambda x: F.btrim(x, F.lit("<>")))


def sender(from_raw: Column, disguises=DISGUISES) -> tuple[Column, Column, Column]:
    """Name, address and flags of a From header; ``disguises`` may be DISGUISES_IN_ORDER."""
    raw = strip(F.coalesce(from_raw, F.lit("")))
    plain = F.regexp_extract(raw, ADDRESS, 0)
    undone = raw
    for pattern, put in disguises:
        undone = F.regexp_replace(undone, pattern, put)
    hidden = F.regexp_extract(undone, ADDRESS, 0)
    first, second = F.regexp_extract(raw, NAME_FIRST, 1), F.regexp_extract(raw, NAME_FIRST, 2)
    name = (
        F.when(raw.rlike(NAME_FIRST), F.when(first.contains("@"), strip(second)).otherwise(strip(first)))
        .when(raw.rlike(NAME_BEHIND), strip(F.regexp_extract(raw, NAME_BEHIND, 2)))
        .otherwise(F.lit(None).cast("string"))
    )
    has, was = plain != "", hidden != ""
    address = F.when(has, F.lower(plain)).when(was, F.lower(hidden))
    flag = (
        F.when(raw == "", F.lit("MISSING_HEADER: From"))
        .when(has, F.lit(None).cast("string"))
        .when(was, F.concat(F.lit("OBFUSCATED_EMAIL: '"), raw, F.lit("' -> '"), hidden, F.lit("'")))
        .otherwise(F.concat(F.lit("NO_EMAIL_FOUND: '"), raw, F.lit("'")))
    )
    return F.when(raw == "", F.lit(None).cast("string")).when(has, name).when(was, F.lit(None).cast("string")).otherwise(raw), address, F.array_compact(F.array(flag))


# The date inside a damaged header, and zone remarks at the end of one.
_DAMAGED_DATE = re.compile(r"((?:Mon|Tue|Wed|Thu|Fri|Sat|Sun),?\s+\d+\s+\w+\s+\d+\s+[\d:]+)")
_ZONE_TAIL = re.compile(r"\s*[-+]\d{4}|\s*\([A-Z]{3,4}\)|\s*[A-Z]{3,4}$")
# Layouts tried after the standard one, in order.
_LAYOUTS = ("%a %b %d %H:%M:%S %Y", "%d %b %Y %H:%M:%S", "%d %b %y %H:%M:%S", "%a, %d %b %Y %H:%M:%S", "%a, %d %b %y %H:%M:%S")


@lru_cache(100_000)
def parse_date(raw: str | None) -> tuple[str | None, tuple[str, ...]]:
    """ISO string (with the offset if one was given) and flags of one Date header."""
    text = (raw or "").strip()
    if not text:
        return None, ("MISSING_HEADER: Date",)
    flags: tuple[str, ...] = ()
    if "sendmail" in text.lower() or "id AA" in text:
        flags = (f"CORRUPTED_DATE: '{text[:80]}...'",)
        inner = _DAMAGED_DATE.search(text)
        text = inner.group(1) if inner else text
    try:
        return parsedate_to_datetime(text).isoformat(), flags
    except (ValueError, TypeError):
        pass
    bare = _ZONE_TAIL.sub("", text).strip()
    for layout in _LAYOUTS:
        try:
            return datetime.strptime(bare, layout).isoformat(), flags
        except ValueError:
            continue
    return None, (*flags, f"UNPARSEABLE_DATE: '{text}'")


@F.pandas_udf(T.StructType([T.StructField("iso", T.StringType()), T.StructField("flags", T.ArrayType(T.StringType()))]))
def parsed_date(raw: pd.Series) -> pd.DataFrame:
    found = [parse_date(x) for x in raw]
    return pd.DataFrame({"iso": [x[0] for x in found], "flags": [list(x[1]) for x in found]})


def mail_id(message_id: Column, year: Column, date_raw: Column, from_raw: Column, subject: Column, body: Column) -> Column:
    """16 hex digits of the message id's hash, or of the content's where there is no id."""
    content = F.concat_ws(":", year.cast("string"), F.coalesce(date_raw, F.lit("")), F.coalesce(from_raw, F.lit("")), F.coalesce(subject, F.lit("")), F.substring(F.coalesce(body, F.lit("")), 1, 100))
    return F.substring(F.sha2(F.when(F.coalesce(message_id, F.lit("")) != "", message_id).otherwise(content), 256), 1, 16)


def quality_flags(sender_flags: Column, date_flags: Column, body: Column, message_id: Column, subject: Column) -> Column:
    size = F.length(F.coalesce(body, F.lit("")))
    rest = F.array_compact(
        F.array(
            F.when(size < LEAST_BODY, F.concat(F.lit("EMPTY_BODY: body length = "), size.cast("string"))),
            F.when(F.coalesce(message_id, F.lit("")) == "", F.lit("MISSING_HEADER: Message-ID")),
            F.when(F.coalesce(subject, F.lit("")) == "", F.lit("MISSING_HEADER: Subject")),
        )
    )
    return F.concat(sender_flags, date_flags, rest)


def parse_messages(raw: DataFrame, disguises=DISGUISES) -> DataFrame:
    """Records from rows with ``raw`` (text of one message) and ``file_year``; further columns are kept."""
    head, body = split_message(F.col("raw"))
    step = raw.withColumn("_h", header_map(head)).withColumn("_body", body)
    h = F.col("_h")
    name, address, from_flags = sender(header(h, "from"), disguises)
    out = step.select(
        *[F.col(f"`{c}`") for c in raw.columns if c != "raw"],
        header(h, "from").alias("from_raw"),
        name.alias("from_name"),
        address.alias("from_email"),
        header(h, "date").alias("date_raw"),
        header(h, "subject").alias("subject"),
        F.btrim(header(h, "message-id"), F.lit("<>")).alias("message_id"),
        F.nullif(F.btrim(header(h, "in-reply-to"), F.lit("<>")), F.lit("")).alias("in_reply_to"),
        references(header(h, "references")).alias("refs"),
        header(h, "to").alias("to_addr"),
        header(h, "cc").alias("cc"),
        strip(F.substring_index(header(h, "content-type", "text/plain"), ";", 1)).alias("content_type"),
        strip(F.col("_body")).alias("body"),
        F.col("_body").contains("BEGIN PGP").alias("has_pgp"),
        from_flags.alias("_from_flags"),
        parsed_date(header(h, "date")).alias("_date"),
    )
    flags = quality_flags(F.col("_from_flags"), F.col("_date.flags"), F.col("body"), F.col("message_id"), F.col("subject"))
    return out.withColumn("date_parsed", F.col("_date.iso")).withColumn("body_length", F.length("body")).withColumn("flags", flags).withColumn(
        "id", mail_id(F.col("message_id"), F.col("file_year"), F.col("date_raw"), F.col("from_raw"), F.col("subject"), F.col("body"))
    ).drop("_from_flags", "_date")


def flag_type(flag: Column) -> Column:
    return F.substring_index(flag, ":", 1)


def flag_histogram(mails: DataFrame) -> DataFrame:
    """(flag_type, n) over all flags."""
    return mails.select(F.explode("flags").alias("flag")).groupBy(flag_type(F.col("flag")).alias("flag_type")).agg(F.count("*").alias("n"))


def parse_stats(mails: DataFrame) -> DataFrame:
    """One row: mails, flagged mails and their share in percent."""
    flagged = F.count_if(F.size("flags") > 0)
    return mails.agg(F.count("*").alias("total_parsed"), flagged.alias("total_flagged"), F.try_divide(flagged * 100.0, F.count("*")).alias("flagged_percent"))



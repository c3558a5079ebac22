"""One instant in UTC for each date header, whatever its notation, precision and zone.

An ordered cascade of anchored patterns rewrites a header into one canonical field list; each pattern is
strict, the first that matches decides. The fields are then checked against the calendar, and the offset is
taken from the header itself, from a zone-name table, or from the zone of the sender's site.

Policy for wall clocks without a stated offset: a time that a site's clock showed twice (autumn) is reported
as ``ambiguous``, one that it never showed (spring) as ``nonexistent``; neither gets an instant.

Defined results: NULL and blank headers are ``empty``; headers no pattern matches ``unparsed``; fields outside
the calendar or the clock ``invalid``; a date without a time ``no_time``; a zone name missing from the table
(or listed there with two different offsets) ``unknown_zone``; no zone and no listed site ``no_site``; a site whose zone is no known zone ``bad_site_zone``.
Digits finer than a millisecond are cut off, missing seconds are 0, two-digit years are 19yy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.runtime import broadcast_if_small, cut

# Month names (first letters, lower case) in the languages of the mail programs met so far.
MONTHS = {
    1: "jan january januar janvier enero gennaio januari",
    2: "feb february februar février fevrier febrero febbraio februari fév",
    3: "mar march mär märz maerz mrz mars marzo maart",
    4: "apr april avril abril aprile avr",
    5: "may mai mayo maggio mei",
    6: "jun june juni juin junio giugno",
    7: "jul july juli juillet julio luglio",
    8: "aug august août aout agosto augustus",
    9: "sep sept september septembre septiembre settembre",
    10: "oct october okt oktober octobre octubre ottobre out",
    11: "nov november novembre noviembre",
    12: "dec december dez dezember décembre decembre diciembre dicembre déc",
}

_DAY = r"(?:\p{L}{2,12}\.?,?\s+)?"
_MON = r"(\p{L}{3,10})\.?"
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?"
_ZONE = r"([-+]\d{4}|[-+]\d{2}:\d{2}|[A-Za-z]{1,5})"
_TAIL = r"(?:\s*\([^()]*\))?(?:\s+id\s+\S+(?:\s+for\s+\S+)?)?"

#: Name, pattern, and where year|month|day|hour|minute|second|fraction|half|zone stand in it.
CASCADE: list[tuple[str, str, str]] = [
    ("relay", rf"^by\s+\S+\s+\([^()]*\)\s+id\s+[^;]+;\s*{_DAY}(\d{{1,2}})\s+{_MON}\s+(\d{{4}}|\d{{2}})\s+{_TIME}(?:\s+{_ZONE})?{_TAIL}$", "$3|$2|$1|$4|$5|$6|$7||$8"),
    ("header", rf"^{_DAY}(\d{{1,2}})[ -]{_MON}[ -](\d{{4}}|\d{{2}})\s+{_TIME}(?:\s*{_ZONE})?{_TAIL}$", "$3|$2|$1|$4|$5|$6|$7||$8"),
    ("ctime", rf"^\p{{L}}{{2,10}},?\s+{_MON}\s+(\d{{1,2}})\s+{_TIME}(?:\s+{_ZONE})?\s+(\d{{4}})$", "$8|$1|$2|$3|$4|$5|$6||$7"),
    ("iso", r"^(\d{4})-(\d{2})-(\d{2})[T ](\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?\s*(Z|[-+]\d{2}:?\d{2}|[A-Za-z]{2,5})?$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    ("iso_basic", r"^(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})(Z|[-+]\d{2}:?\d{2})?$", "$1|$2|$3|$4|$5|$6|||$7"),
    ("dashed", rf"^(\d{{1,2}})-(\p{{L}}{{3}})-(\d{{4}}|\d{{2}})\s+{_TIME}(?:\s+{_ZONE})?$", "$3|$2|$1|$4|$5|$6|$7||$8"),
    ("dotted", rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}|\d{{2}})\s+{_TIME}(?:\s+{_ZONE})?$", "$3|$2|$1|$4|$5|$6|$7||$8"),
    ("slashed", rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}|\d{{2}})\s+{_TIME}\s*([AaPp][Mm])?(?:\s+{_ZONE})?$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    ("long", rf"^{_DAY}{_MON}\s+(\d{{1,2}}),\s+(\d{{4}}),?\s+{_TIME}\s*([AaPp][Mm])?(?:\s+{_ZONE})?$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    ("date_only", rf"^{_DAY}(\d{{1,2}})[ .-]+{_MON}[ .-]+(\d{{4}}|\d{{2}})$", "$3|$2|$1||||||"),
]
# Two letters alone are never a zone after a time in the slashed and long forms: they are the half of the day.
_EPOCH = r"^(\d{9,10}|\d{12,13})$"
_DONE = "\x01"


def canonical_fields(raw: Column) -> Column:
    """year|month|day|hour|minute|second|fraction|half|zone of a header, or NULL."""
    text = F.trim(F.regexp_replace(F.coalesce(raw, F.lit("")), r"(?U)\s+", " "))
    text = F.translate(text, _DONE, "\ufffd")
    # Each pattern runs once, and none behind the first that matches: a replacement leaves its mark and the fields behind it.
    return F.coalesce(*[F.try_element_at(F.split(F.regexp_replace(text, pattern, _DONE + fields), _DONE, 2), F.lit(2)) for _, pattern, fields in CASCADE])


def _number(parts: Column, at: int) -> Column:
    return F.element_at(parts, at).try_cast("int")


def _month(parts: Column) -> Column:
    word = F.lower(F.element_at(parts, 2))
    names = F.create_map(*[x for m, ws in MONTHS.items() for w in ws.split() for x in (F.lit(w), F.lit(m))])
    return F.coalesce(word.try_cast("int"), F.try_element_at(names, word))


def _clock_offset(zone: Column, seconds: Column) -> Column:
    """Seconds east of UTC in the zone at the instant given as seconds since the epoch."""
    at = F.timestamp_seconds(seconds)
    return F.unix_seconds(F.from_utc_timestamp(at, zone)) - seconds


def _is_zone(name: Column) -> Column:
    """Whether a zone name can be used: a date with it at its end casts to an instant."""
    shaped = name.rlike(r"^(?:[A-Za-z][A-Za-z0-9_+/-]*|[-+]\d{2}:\d{2})\z")
    return F.coalesce(shaped & F.concat(F.lit("2000-01-01 00:00:00 "), name).try_cast("timestamp").isNotNull(), F.lit(False))


def normalise_dates(df: DataFrame, sites: DataFrame, zone_names: DataFrame, raw: str = "date_raw", sender: str = "from_email") -> DataFrame:
    """df with ``utc_ms`` (NULL where the header settles no instant) and ``date_status``; its own columns stay as they are.

    date_status: offset, zone, site, epoch (these have utc_ms), or why there is none, see the module's text.
    No shuffle: both lookups are broadcast after their size was checked.
    """
    zones = (
        zone_names.filter(F.col("abbr").isNotNull() & F.col("offset_min").isNotNull())
        .groupBy(F.upper("abbr").alias("_abbr"))
        .agg(F.min("offset_min").alias("_least"), F.max("offset_min").alias("_zone_min"))
        .filter("_least = _zone_min")
        .drop("_least")
    )
    places = (
        sites.filter(F.col("site_host").isNotNull() & F.col("tz_name").isNotNull())
        .groupBy(F.lower("site_host").alias("_host"))
        .agg(F.min("tz_name").alias("_least"), F.max("tz_name").alias("_tz"))
        .filter("_least = _tz")
        .drop("_least")
        .withColumn("_known", _is_zone(F.col("_tz")))
        .withColumn("_tz", F.when(F.col("_known"), F.col("_tz")))
    )
    # The caller's columns travel as one struct, so that no working name can clash with them.
    out = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{raw}`").alias("_raw"), F.col(f"`{sender}`").alias("_from"))
    out = out.withColumn("_fields", canonical_fields(F.col("_raw"))).withColumn("_p", F.split("_fields", r"\|"))
    p, text = F.col("_p"), F.trim(F.coalesce(F.col("_raw"), F.lit("")))
    year = _number(p, 1)
    half, hour = F.upper(F.element_at(p, 8)), _number(p, 4)
    hour = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "PM", 12).otherwise(0))
    zone = F.upper(F.element_at(p, 9))
    digits = F.regexp_replace(F.element_at(p, 9), "[^0-9]", "")
    off_h, off_m = F.substring(digits, 1, 2).try_cast("int"), F.substring(digits, 3, 2).try_cast("int")
    out = out.select(
        "_row",
        "_fields",
        F.when(F.length(F.element_at(p, 1)) == 2, year + 1900).otherwise(year).alias("_y"),
        _month(p).alias("_m"),
        _number(p, 3).alias("_d"),
        hour.alias("_h"),
        _number(p, 5).alias("_mi"),
        F.coalesce(_number(p, 6), F.lit(0)).alias("_s"),
        F.rpad(F.substring(F.element_at(p, 7), 1, 3), 3, "0").try_cast("int").alias("_ms"),
        (F.element_at(p, 4) != "").alias("_has_time"),
        zone.alias("_zone"),
        F.when(zone.rlike(r"^[-+]\d") & (off_h <= 14) & (off_m < 60), F.when(zone.startswith("-"), -1).otherwise(1) * (off_h * 60 + off_m)).alias("_off_min"),
        F.lower(F.regexp_extract(F.coalesce(F.col("_from"), F.lit("")), "@([^@]+)$", 1)).alias("_host"),
        F.when(text.rlike(_EPOCH), F.when(F.length(text) > 11, text.try_cast("bigint")).otherwise(text.try_cast("bigint") * 1000)).alias("_epoch_ms"),
        (F.regexp_replace(text, r"(?U)\s+", "") == "").alias("_blank"),
    )
    out = out.withColumn("_day", F.expr("try_make_timestamp_ntz(_y, _m, _d, 0, 0, cast(0 as decimal(16,6)))").cast("date"))
    ok = F.col("_day").isNotNull() & F.col("_h").between(0, 23) & F.col("_mi").between(0, 59) & F.col("_s").between(0, 59)
    wall = F.datediff("_day", F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + F.col("_h") * 3600 + F.col("_mi") * 60 + F.col("_s")
    out = out.withColumn("_wall", F.when(ok, wall))
    out = out.join(broadcast_if_small(cut(zones)), F.col("_zone") == F.col("_abbr"), "left").join(broadcast_if_small(cut(places.withColumnRenamed("_host", "_site"))), F.col("_host") == F.col("_site"), "left")
    # The offsets a day before and after bracket any change of the clock; each candidate counts if the clock showed the wall time then.
    before, after = (F.col("_wall") - _clock_offset(F.col("_tz"), F.col("_wall") + d) for d in (-86400, 86400))
    shown = lambda c: F.when(c + _clock_offset(F.col("_tz"), c) == F.col("_wall"), c)
    out = out.withColumn("_a", shown(before)).withColumn("_b", shown(after))
    once = F.coalesce("_a", "_b")
    twice = F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.col("_a") != F.col("_b"))
    named = (F.col("_zone") != "") & ~F.col("_zone").rlike(r"^[-+]\d")
    status = (
        F.when(F.col("_blank"), "empty")
        .when(F.col("_epoch_ms").isNotNull(), "epoch")
        .when(F.col("_fields").isNull(), "unparsed")
        .when(F.col("_day").isNull(), "invalid")
        .when(~F.col("_has_time"), "no_time")
        .when(F.col("_wall").isNull(), "invalid")
        .when(F.col("_off_min").isNotNull(), "offset")
        .when(F.col("_zone").rlike(r"^[-+]\d"), "invalid")
        .when(named, F.when(F.col("_zone_min").isNotNull(), "zone").otherwise("unknown_zone"))
        .when(~F.col("_known"), "bad_site_zone")
        .when(F.col("_tz").isNull(), "no_site")
        .when(twice, "ambiguous")
        .when(once.isNull(), "nonexistent")
        .otherwise("site")
    )
    out = out.withColumn("date_status", status)
    ms = F.coalesce(F.col("_ms"), F.lit(0))
    utc = (
        F.when(F.col("date_status") == "epoch", F.col("_epoch_ms"))
        .when(F.col("date_status") == "offset", (F.col("_wall") - F.col("_off_min") * 60) * 1000 + ms)
        .when(F.col("date_status") == "zone", (F.col("_wall") - F.col("_zone_min") * 60) * 1000 + ms)
        .when(F.col("date_status") == "site", once * 1000 + ms)
    )
    kept = [F.col(f"_row.`{c}`").alias(c) for c in df.columns if c not in ("utc_ms", "date_status")]
    return out.select(*kept, utc.cast("bigint").alias("utc_ms"), "date_status")

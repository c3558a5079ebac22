"""Text helpers with the semantics of a Unicode-aware scripting language, as Spark columns.

Spark's ``trim`` strips blanks only and its regular expressions take ASCII classes by default; these helpers
strip and match every white-space character. NULL stays NULL throughout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefix of patterns with Unicode classes in which only a line feed ends a line.
UNICODE = "(?Ud)"


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, rf"{UNICODE}\A\s+|\s+\z", "")


def preferred(first: str, second: str) -> Column:
    """The first column unless it is NULL or empty, else the second, else the empty string."""
    return F.coalesce(F.nullif(F.col(first), F.lit("")), F.col(second), F.lit(""))


def normalize_subject(subject: Column) -> Column:
    """Without reply and forward prefixes and [tags], in small letters; '' for NULL."""
    bare = F.regexp_replace(strip(F.coalesce(subject, F.lit(""))), rf"(?iUd)\A(?:(?:re|fwd|fw):\s*|\[[\w\s-]+\]\s*)+", "")
    return F.lower(strip(bare))


def is_reply_subject(subject: Column) -> Column:
    """Whether a subject opens with a reply or forward prefix in one of the usual spellings; "re:" in small letters does not."""
    return F.coalesce(strip(F.coalesce(subject, F.lit(""))).rlike(r"\A(?:Re|RE|Fw|FW|Fwd|FWD):"), F.lit(False))


def normalize_for_matching(text: Column) -> Column:
    """Small letters, single blanks, no punctuation; a removed sign may leave two blanks side by side."""
    return strip(F.regexp_replace(F.regexp_replace(F.lower(text), rf"{UNICODE}\s+", " "), rf"{UNICODE}[^\w\s]", ""))


def local_seconds(date_parsed: Column) -> Column:
    """Seconds of the wall clock of an ISO date string, its offset dropped, whatever the session's zone; NULL where there is none."""
    y, m, d, h, mi, s = (F.substring(date_parsed, at, n).try_cast("int") for at, n in ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2)))
    day = F.substring(date_parsed, 1, 10).try_cast("date")
    ok = y.isNotNull() & m.isNotNull() & d.isNotNull() & h.between(0, 23) & mi.between(0, 59) & s.between(0, 59)
    return F.when(ok, F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + h * 3600 + mi * 60 + s)

"""First clean-up of parsed mails: spam predicate, known senders, anonymous senders, flag rewriting, counters.

Rules are parameters; the defaults are the fixed values below. NULL subjects, senders and flag lists count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import strip
from postloom.operators.parsing import flag_type
from postloom.runtime import broadcast_if_small

# Subject substrings of the first spam pass.
SPAM_SUBJECTS = ("financial information", "urgent buy", "buy alert", "sizzler", "immediate cash", "cable descrambler", "save your life", "online business", "make money", "work from home", "mlm", "adult", "xxx")
# Senders that are anonymous on purpose.
ANONYMOUS = (r"^anonymous", r"^nobody@", r"^<>$", r"@nowhere", r"use-author-address-header", r"^0x[0-9a-f]+@", r"^[0-9a-f]{8}@", r"damien lucifer", r"root@hellspawn")
# Fixed value: a capital N between a name and a host.
CAPITAL_N = r"([a-zA-Z0-9._-]+)N([a-zA-Z0-9.-]+\.[a-zA-Z]{2,})"

NO_ADDRESS, DISGUISED = "NO_EMAIL_FOUND", "OBFUSCATED_EMAIL"


def _flags() -> Column:
    return F.coalesce(F.col("flags"), F.array().cast("array<string>"))


def looks_like_spam(subjects: tuple[str, ...] = SPAM_SUBJECTS) -> Column:
    """No message id, a spam subject, or a sender of eight digits."""
    subject = F.lower(F.coalesce(F.col("subject"), F.lit("")))
    hit = F.exists(_flags(), lambda f: f.contains("MISSING_HEADER: Message-ID"))
    for s in subjects:
        hit = hit | subject.contains(s)
    return hit | F.coalesce(F.col("from_email"), F.lit("")).rlike(r"^\d{8}@")


def is_anonymous(patterns: tuple[str, ...] = ANONYMOUS) -> Column:
    raw = F.lower(F.coalesce(F.col("from_raw"), F.lit("")))
    hit = F.lit(False)
    for p in patterns:
        hit = hit | raw.rlike(p)
    return hit


def undo_capital_n(from_raw: Column) -> Column:
    """A capital N written for the at sign."""
    return F.regexp_replace(from_raw, CAPITAL_N, "$1@$2")


def resolve_senders(mails: DataFrame, known: DataFrame, patterns: tuple[str, ...] = ANONYMOUS) -> DataFrame:
    """mails with addresses of known senders filled in and flags rewritten.

    Adds looked_up, deobfuscated, anonymous, unresolved (counts of flags) for the counters. The join is narrow:
    the dictionary is broadcast after its size was checked, and only mails with the flag look into it.
    """
    keyed = known.filter("from_key is not null").groupBy(F.lower(strip(F.col("from_key"))).alias("_known")).agg(F.max("email").alias("_address"))
    missing = F.exists(_flags(), lambda f: flag_type(f) == NO_ADDRESS)
    key = F.when(missing, F.lower(strip(F.coalesce(F.col("from_raw"), F.lit("")))))
    out = mails.withColumn("_key", key).join(broadcast_if_small(keyed), F.col("_key") == F.col("_known"), "left")
    found, anonymous = F.col("_address").isNotNull(), is_anonymous(patterns)
    renamed = F.concat(F.lit("ANONYMOUS_SENDER: '"), F.coalesce(F.col("from_raw"), F.lit("")), F.lit("'"))
    kept = F.filter(_flags(), lambda f: (flag_type(f) != DISGUISED) & ~((flag_type(f) == NO_ADDRESS) & found))
    count = lambda kind: F.size(F.filter(_flags(), lambda f: flag_type(f) == kind))
    n = count(NO_ADDRESS)
    out = out.select(
        *[F.col(f"`{c}`") for c in mails.columns if c not in ("from_email", "flags")],
        F.coalesce("_address", "from_email").alias("from_email"),
        F.transform(kept, lambda f: F.when((flag_type(f) == NO_ADDRESS) & anonymous, renamed).otherwise(f)).alias("flags"),
        F.when(found, n).otherwise(0).alias("looked_up"),
        count(DISGUISED).alias("deobfuscated"),
        F.when(~found & anonymous, n).otherwise(0).alias("anonymous"),
        F.when(~found & ~anonymous, n).otherwise(0).alias("unresolved"),
    )
    return out


def clean(mails: DataFrame, known: DataFrame, subjects: tuple[str, ...] = SPAM_SUBJECTS, patterns: tuple[str, ...] = ANONYMOUS) -> DataFrame:
    """Mails that pass the first spam predicate, with senders resolved."""
    return resolve_senders(mails.filter(~looks_like_spam(subjects)), known, patterns)


def cleanup_stats(mails: DataFrame, known: DataFrame, subjects: tuple[str, ...] = SPAM_SUBJECTS, patterns: tuple[str, ...] = ANONYMOUS) -> DataFrame:
    """One row of counters; removed mails count in none but the first two."""
    marked = resolve_senders(mails.withColumn("_spam", looks_like_spam(subjects)), known, patterns)
    kept = ~F.col("_spam")
    total = lambda c: F.coalesce(F.sum(F.when(kept, F.col(c))), F.lit(0)).cast("bigint")
    return marked.agg(
        F.count("*").alias("original_count"),
        F.count_if("_spam").alias("spam_removed"),
        F.count_if(kept & ((F.col("looked_up") > 0) | (F.col("deobfuscated") > 0))).alias("emails_fixed"),
        total("looked_up").alias("known_entity_lookups"),
        total("deobfuscated").alias("obfuscation_fixes"),
        total("anonymous").alias("anonymous_kept"),
        total("unresolved").alias("still_no_email"),
        F.count_if(kept).alias("final_count"),
        F.count_if(kept & (F.size("flags") > 0)).alias("final_flagged"),
    )

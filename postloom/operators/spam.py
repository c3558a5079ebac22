"""A rule compiler for spam: tables of named patterns become one decision column.

Mails of senders with more than EXEMPT mails are never spam (NULL senders are never exempt). A mail is spam on
one subject rule; on three body rules; on commercial HTML with a body rule; on a suspicious sender with a body
rule or a shouting subject; or on three reasons of any kind. NULL subjects, bodies and senders count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.runtime import BROADCAST_ROWS, cut, is_small

EXEMPT = 5
SHOWN_BODY_REASONS = 3
# Fixed values: (pattern, name) over the subject in small letters.
SUBJECT_RULES = (
    (r"(make|earn)\s*(big\s*)?(money|cash|\$|bucks)", "make_money"),
    (r"work\s*(from\s*)?home.*\$", "work_from_home"),
    (r"financial\s*(freedom|opportunity)", "financial_opportunity"),
    (r"(xxx|adult|sexy)\s*(image|pic|video|site)", "adult_content"),
    (r"cable\s*(tv\s*)?(de)?scrambler", "cable_scrambler"),
    (r"(stock|buy|sell)\s*alert", "stock_pump"),
    (r"get\s*rich\s*(quick|fast|now)", "get_rich_quick"),
    (r"lose\s*(weight|pounds|lbs)", "weight_loss"),
    (r"viagra|cialis|penis\s*enlarge", "pharma_spam"),
    (r"bulk\s*e?-?mail\s*(list|address|software)", "bulk_email"),
    (r"(\d+,?\d*,?\d*)\s*(fresh\s*)?(e?-?mail|address)", "email_list_sale"),
    (r"free\s*(money|cash|offer|gift|trial)", "free_money"),
    (r"limited\s*time\s*(only|offer)", "limited_time"),
    (r"credit\s*card\s*(machine|terminal|processing)", "cc_processing"),
    (r"internet\s*business\s*opportunity", "biz_opp"),
    (r"mlm|multi.?level\s*market", "mlm"),
    (r"home\s*based\s*business", "home_business"),
    (r"amazing\s*(new\s*)?(product|offer|opportunity)", "amazing_offer"),
    (r"double\s*your\s*(money|income)", "double_money"),
)
# Fixed values: (pattern, name) over the body in small letters.
BODY_RULES = (
    (r"this\s*is\s*not\s*spam", "not_spam_disclaimer"),
    (r"you\s*(are\s*)?receiving\s*this\s*(because|as)", "receiving_disclaimer"),
    (r"to\s*(be\s*)?removed?\s*from\s*(this|our|the)\s*(list|mailing)", "removal_instructions"),
    (r"unsubscribe\s*(instructions|link|here|below)", "unsubscribe_spam"),
    (r"order\s*(now|today)\s*(and\s*)?(receive|get)", "order_now"),
    (r"call\s*(now|today|toll.?free)\s*(to\s*order)?", "call_now"),
    (r"act\s*(now|fast|today)", "act_now"),
    (r"only\s*\$\d+", "price_pitch"),
    (r"satisfaction\s*guarante", "satisfaction_guarantee"),
    (r"risk.?free", "risk_free"),
    (r"(huge|big|massive)\s*discount", "discount"),
)
# Marks of commercial HTML, services with numeric addresses.
HTML_SIGNALS = (r"click\s*here", r"<a\s*href", r"bgcolor", r"font\s*color")
NUMERIC_SERVICES = ("mcimail.com", "compuserve.com", "aol.com", "prodigy.com", "prodigy.net")


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _hits(text: Column, rules, scope: str) -> Column:
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(f"{scope}:{name}")) for p, name in rules]))


def html_signals(body: Column, signals=HTML_SIGNALS) -> Column:
    """Number of signals in the body if it is HTML, else 0."""
    total = F.lit(0)
    for s in signals:
        total = total + body.rlike(s).cast("int")
    return F.when(body.contains("<html") | body.contains("<body"), total).otherwise(0)


def sender_frequency(mails: DataFrame) -> DataFrame:
    """(from_email, n), NULL senders as one."""
    return mails.groupBy("from_email").agg(F.count("*").alias("n"))


def classify(mails: DataFrame, subject_rules=SUBJECT_RULES, body_rules=BODY_RULES, signals=HTML_SIGNALS, services=NUMERIC_SERVICES, exempt: int = EXEMPT, most_senders: int = BROADCAST_ROWS) -> DataFrame:
    """mails with is_spam and reasons (empty for ham).

    Only senders with several mails matter. Where these are few they are broadcast and exempt mails skip all
    patterns; else the patterns run first, and the few mails that they would call spam are joined with the counts.
    Either way no mail is shuffled for its sender, whose frequency may be a third of all.
    """
    several = cut(sender_frequency(mails).filter("n > 1").select(F.col("from_email").alias("_sender"), F.col("n").alias("_n")))
    subject, body, sender, plain = F.lower(_text("subject")), F.lower(_text("body")), F.lower(_text("from_email")), _text("subject")
    known = F.lit(False)
    for d in services:
        known = known | sender.endswith(f"@{d}")
    html = (html_signals(body, signals) >= 2) & (F.length(body) < 5000)
    odd = F.array_compact(F.array(F.when(~known & sender.rlike(r"^\d{7,}@"), F.lit("suspicious_numeric_sender")), F.when(~known & sender.rlike(r"@\d+\.(com|net|org)$"), F.lit("numeric_domain"))))
    caps = (F.upper(plain) == plain) & (F.lower(plain) != plain) & (F.length(plain) > 20) & plain.rlike(r"[!$]{2,}")
    rules = F.struct(_hits(subject, subject_rules, "spam_subject").alias("s"), _hits(body, body_rules, "spam_body").alias("b"), html.alias("h"), odd.alias("o"), caps.alias("c"))
    none = F.array().cast("array<string>")
    r = F.col("_r")

    def reasons(shouts: Column) -> Column:
        return F.concat(r["s"], F.slice(r["b"], 1, SHOWN_BODY_REASONS), F.when(r["h"], F.array(F.lit("html_commercial"))).otherwise(none), r["o"], F.when(shouts, F.array(F.lit("caps_punct_commercial"))).otherwise(none))

    def verdict(shouts: Column) -> Column:
        n_body = F.size(r["b"])
        return F.coalesce((F.size(r["s"]) >= 1) | (n_body >= 3) | (r["h"] & (n_body >= 1)) | ((F.size(r["o"]) > 0) & ((n_body >= 1) | shouts)) | (F.size(reasons(shouts)) >= 3), F.lit(False))

    def judged(df: DataFrame) -> DataFrame:
        shouts = r["c"] & (F.coalesce("_n", F.lit(1)) <= 1)
        out = df.withColumn("is_spam", verdict(shouts)).withColumn("reasons", F.when(F.col("is_spam"), reasons(shouts)).otherwise(none))
        return out.select(*[F.col(f"`{c}`") for c in mails.columns if c not in ("is_spam", "reasons")], "is_spam", "reasons")

    of_sender = F.col("from_email").eqNullSafe(F.col("_sender"))
    safe = F.col("from_email").isNotNull() & (F.coalesce("_n", F.lit(1)) > exempt)
    if is_small(several, most_senders):
        return judged(mails.join(F.broadcast(several), of_sender, "left").withColumn("_r", F.when(~safe, rules)))
    ruled = mails.withColumn("_r", rules)
    suspects = ruled.filter(verdict(r["c"])).join(several, of_sender, "left").withColumn("_r", F.when(~safe, r))
    rest = ruled.filter(~verdict(r["c"])).withColumn("_n", F.lit(2)).withColumn("_r", F.lit(None).cast(ruled.schema["_r"].dataType))
    return judged(suspects).unionByName(judged(rest))


def split_spam(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ham, spam)."""
    return classified.filter("not is_spam"), classified.filter("is_spam")


def spam_review(classified: DataFrame, preview: int = 200) -> DataFrame:
    return classified.filter("is_spam").select("pos", "id", "file_year", "subject", F.coalesce(F.nullif(F.col("from_email"), F.lit("")), F.col("from_raw")).alias("sender"), F.array_join("reasons", ";").alias("reasons"), F.substring(_text("body"), 1, preview).alias("body_preview"))


def reason_counts(classified: DataFrame, most: int = 10) -> DataFrame:
    """The most frequent kinds of reasons (the text before the colon)."""
    kinds = classified.filter("is_spam").select(F.explode("reasons").alias("r")).groupBy(F.substring_index("r", ":", 1).alias("reason")).agg(F.count("*").alias("n"))
    return kinds.orderBy(F.desc("n"), "reason").limit(most)


def spam_by_year(classified: DataFrame) -> DataFrame:
    """Years with spam: spam, all mails and the share in percent."""
    out = classified.groupBy("file_year").agg(F.count_if("is_spam").alias("n_spam"), F.count("*").alias("n_mails")).filter("n_spam > 0")
    return out.withColumn("spam_percent", F.col("n_spam") * 100.0 / F.col("n_mails"))



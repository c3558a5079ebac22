"""The whole archive pipeline: parsed mails to threads, each stage a function from DataFrame to DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from postloom.operators import cleaning, matching, replies, spam, threads
from postloom.runtime import cut, release


def clean_and_filter(mails: DataFrame, known: DataFrame, **rules) -> DataFrame:
    """Stages B and C: resolved senders, without both kinds of spam.

    The parsed mails are written once, as Spark cannot plan these stages over the Python dates of the parser.
    """
    return spam.split_spam(spam.classify(cleaning.clean(cut(mails), known), **rules))[0]


def classified_mails(mails: DataFrame) -> DataFrame:
    """Stages D1 and D2: header links and orphan states."""
    return replies.classify_orphans(replies.link_replies(mails))


def linked_mails(mails: DataFrame, by_subject: bool = True, by_quotes: bool = True, by_time: bool = True, max_days: int = matching.MAX_DAYS) -> DataFrame:
    """Stages D1 to D3c: every kind of link, none that closes a loop; all columns but ``body``.

    The state between the stages is written without the bodies, which only the quotation match reads, by pos.
    """
    bodies = mails.select("pos", "body")
    state = cut(classified_mails(mails.drop("body")))

    def put_in(state: DataFrame, links: DataFrame, status: str) -> DataFrame:
        state = cut(matching.apply_links(state, links, status))
        release(mails.sparkSession)
        return state

    if by_subject:
        state = put_in(state, matching.match_by_subject(state, loop_free=True), "matched_by_subject")
    if by_quotes:
        state = put_in(state, matching.drop_loops(state, matching.match_by_quotes(state, bodies)), "matched_by_quote")
    if by_time:
        state = put_in(state, matching.drop_loops(state, matching.match_by_time(state, max_days)), "matched_by_time_proximity")
    return state


def archive_threads(linked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stage E: (members, threads)."""
    members = cut(threads.thread_members(linked))
    return members, threads.build_threads(members)

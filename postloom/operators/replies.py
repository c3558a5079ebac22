"""Reply links from headers, subjects made comparable, and what stays an orphan.

One record stands for each message id: the one with the highest pos. A record without a message id is a message
of its own that nothing can refer to. NULL and empty In-Reply-To mean no reply. Of several copies of a message
the last one with a known parent decides for all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import is_reply_subject, normalize_subject
from postloom.runtime import filled


def message_index(mails: DataFrame) -> DataFrame:
    """(message_id, at): the pos of the record that stands for each message id."""
    return mails.filter(filled("message_id")).groupBy("message_id").agg(F.max("pos").alias("at"))


def parents_by_header(mails: DataFrame) -> DataFrame:
    """(message_id, parent_id) for each message with a known parent."""
    known = mails.filter(filled("message_id")).select(F.col("message_id").alias("in_reply_to")).distinct()
    replies = mails.filter(filled("message_id") & filled("in_reply_to")).select("message_id", "in_reply_to", "pos")
    return replies.join(known, "in_reply_to", "left_semi").groupBy("message_id").agg(F.max_by("in_reply_to", "pos").alias("parent_id"))


def link_replies(mails: DataFrame) -> DataFrame:
    """mails with ``parent_id`` and ``is_thread_root``; a link column of the input is replaced."""
    bare = mails.drop("parent_id", "is_thread_root")
    out = bare.join(parents_by_header(mails), "message_id", "left")
    return out.withColumn("is_thread_root", F.col("parent_id").isNull())


def children_of(linked: DataFrame) -> DataFrame:
    """(message_id, n_children, first_pos): parents with the number of records that point to them.

    A count, not a list: a hot parent's children are never gathered in one row.
    """
    return linked.filter("parent_id is not null").groupBy(F.col("parent_id").alias("message_id")).agg(F.count("*").alias("n_children"), F.min("pos").alias("first_pos"))


def children_lists(linked: DataFrame) -> DataFrame:
    """(message_id, children_ids) in archive order, for exports of trees of bounded fan-out."""
    pairs = F.array_sort(F.collect_list(F.struct("pos", "message_id")))
    return linked.filter("parent_id is not null").groupBy("parent_id").agg(F.transform(pairs, lambda p: p["message_id"]).alias("children_ids")).withColumnRenamed("parent_id", "message_id")


def link_stats(mails: DataFrame) -> DataFrame:
    """One row of counters of the header links."""
    known = mails.filter(filled("message_id")).select(F.col("message_id").alias("_known")).distinct().withColumn("_found", F.lit(True))
    marked = mails.join(known, F.col("in_reply_to") == F.col("_known"), "left")
    replies, found = filled("in_reply_to"), F.coalesce(F.col("_found"), F.lit(False))
    first = marked.agg(F.count("*").alias("total_emails"), F.countDistinct(F.when(filled("message_id"), F.col("message_id"))).alias("emails_with_message_id"), F.count_if(replies).alias("emails_with_in_reply_to"), F.count_if(replies & found).alias("in_reply_to_matched"), F.count_if(replies & ~found).alias("in_reply_to_unmatched"))
    linked = link_replies(mails)
    second = linked.agg(F.count_if("is_thread_root").alias("root_messages"), F.count_if(~F.col("is_thread_root")).alias("child_messages"))
    third = children_of(linked).agg(F.count("*").alias("emails_as_parents"), F.coalesce(F.max("n_children"), F.lit(0)).alias("max_children"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    return one(first).join(F.broadcast(one(second)), "_one").join(F.broadcast(one(third)), "_one").drop("_one")  # single rows


def fanout_histogram(mails: DataFrame) -> DataFrame:
    """(n_children, n_parents)."""
    return children_of(link_replies(mails)).groupBy("n_children").agg(F.count("*").alias("n_parents"))


def widest_parent(mails: DataFrame) -> DataFrame:
    """The message with the most children and its subject; of equals the one that got its first child first."""
    top = children_of(link_replies(mails)).orderBy(F.desc("n_children"), "first_pos").limit(1)
    own = mails.filter(filled("message_id")).groupBy("message_id").agg(F.max_by("subject", "pos").alias("subject"))
    return own.join(F.broadcast(top), "message_id").select("message_id", "n_children", "subject")  # a single row


def classify_orphans(linked: DataFrame) -> DataFrame:
    """linked with ``normalized_subject``, ``orphan_status`` and ``orphan_type``."""
    reply, orphan = is_reply_subject(F.col("subject")), F.col("parent_id").isNull()
    return (
        linked.withColumn("normalized_subject", normalize_subject(F.col("subject")))
        .withColumn("orphan_status", F.when(~orphan, "has_parent").when(reply, "orphan_reply").otherwise("true_root"))
        .withColumn("orphan_type", F.when(orphan & reply, F.when(F.col("in_reply_to").isNotNull(), "in_reply_to_unmatched").otherwise("no_in_reply_to")))
    )


def orphan_counts(classified: DataFrame) -> DataFrame:
    """One row of counters over statuses and orphan types."""
    reply = is_reply_subject(F.col("subject"))
    status = lambda s: F.col("orphan_status") == s
    kind = lambda t: F.coalesce(F.col("orphan_type") == t, F.lit(False))
    return classified.agg(
        F.count("*").alias("total_emails"),
        F.count_if(status("has_parent")).alias("emails_with_parent"),
        F.count_if(~status("has_parent")).alias("emails_without_parent"),
        F.count_if(status("has_parent") & reply).alias("reply_subjects_with_parent"),
        F.count_if(status("orphan_reply")).alias("reply_subjects_without_parent"),
        F.count_if(status("true_root")).alias("non_reply_without_parent"),
        F.count_if(kind("in_reply_to_unmatched")).alias("in_reply_to_unmatched"),
        F.count_if(kind("no_in_reply_to")).alias("no_in_reply_to"),
    )


def subject_groups(classified: DataFrame, least: int = 2) -> DataFrame:
    """(normalized_subject, n) of the subjects with at least so many mails."""
    return classified.filter("normalized_subject <> ''").groupBy("normalized_subject").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def subject_group_stats(classified: DataFrame) -> DataFrame:
    groups = subject_groups(classified, 1)
    return groups.agg(F.count("*").alias("unique_normalized_subjects"), F.count_if(F.col("n") > 1).alias("subjects_with_multiple_emails"), F.coalesce(F.max("n"), F.lit(0)).alias("largest_subject_group"))


def orphan_subjects(classified: DataFrame) -> DataFrame:
    return classified.filter("orphan_status = 'orphan_reply' and normalized_subject <> ''").select("normalized_subject").distinct()


def anchored_subjects(classified: DataFrame) -> DataFrame:
    """Subjects with a mail that is not an orphan."""
    return classified.filter("orphan_status <> 'orphan_reply' and normalized_subject <> ''").select("normalized_subject").distinct()


def matchable_subjects(classified: DataFrame) -> DataFrame:
    return orphan_subjects(classified).intersect(anchored_subjects(classified))


def unmatchable_subjects(classified: DataFrame) -> DataFrame:
    return orphan_subjects(classified).exceptAll(anchored_subjects(classified))


def matchable_orphans(classified: DataFrame) -> DataFrame:
    return classified.filter("orphan_status = 'orphan_reply'").join(anchored_subjects(classified), "normalized_subject", "left_semi")


def unmatchable_orphans(classified: DataFrame) -> DataFrame:
    return classified.filter("orphan_status = 'orphan_reply'").join(anchored_subjects(classified), "normalized_subject", "left_anti")

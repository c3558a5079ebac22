"""Threads: who belongs to which conversation, what each looks like, and how to browse them.

A thread is a root message with all messages whose parent chains end at it. One record stands for each message
id (the one with the highest pos); records without a message id are threads of their own. Messages on or below
a loop belong to no thread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import preferred
from postloom.operators.hierarchy import resolve_forest
from postloom.operators.ordered import running_sums
from postloom.runtime import cut, filled

#: Upper bounds of the size histogram.
SIZES = ((1, "1"), (2, "2"), (5, "3-5"), (10, "6-10"), (25, "11-25"), (50, "26-50"))
SHOWN_AUTHORS, LEAST_THREADS = 50, 5


def canonical(mails: DataFrame) -> DataFrame:
    """One record for each message id, and all records without one; only thin columns should come in."""
    last = mails.filter(filled("message_id")).groupBy("message_id").agg(F.max("pos").alias("_last"))
    known = mails.join(last, "message_id").filter("pos = _last").drop("_last")
    return known.unionByName(mails.filter(~filled("message_id") | F.col("message_id").isNull()).select(*known.columns))


_THIN = ("pos", "id", "message_id", "parent_id", "subject", "normalized_subject", "from_email", "from_raw", "date_parsed", "has_pgp", "file_year")


def thread_members(linked: DataFrame) -> DataFrame:
    """Thin rows of all messages with root (pos of the thread's root) and depth; root NULL at and below loops."""
    own = cut(canonical(linked.select(*_THIN)))
    nodes = own.filter(filled("message_id")).select(F.col("message_id").alias("parent_id"), F.col("pos").alias("parent"))
    forest = own.select("pos", "parent_id").join(nodes, "parent_id", "left").select(F.col("pos").alias("node"), "parent")
    return own.join(resolve_forest(cut(forest)).withColumnRenamed("node", "pos"), "pos")


def build_threads(members: DataFrame) -> DataFrame:
    """One row for each thread. Aggregates are partial on the map side; no list of messages is gathered."""
    author = preferred("from_email", "from_raw")
    local = F.nullif(F.substring("date_parsed", 1, 19), F.lit(""))
    inside = members.filter("root is not null").withColumn("_author", author).withColumn("_local", local)
    sums = inside.groupBy("root").agg(
        F.count("*").alias("message_count"),
        F.countDistinct(F.nullif(F.col("_author"), F.lit(""))).alias("participant_count"),
        F.min("_local").alias("date_start"),
        F.max("_local").alias("date_end"),
        F.max("depth").alias("depth"),
        F.coalesce(F.bool_or("has_pgp"), F.lit(False)).alias("has_pgp"),
    )
    roots = inside.filter("depth = 0").select("root", F.concat(F.lit("thread_"), F.col("id")).alias("thread_id"), "subject", "normalized_subject", F.col("_author").alias("root_author"))
    out = roots.join(sums, "root")
    return out.select(F.col("root").alias("root_pos"), "thread_id", "subject", "normalized_subject", "message_count", "participant_count", "date_start", "date_end", F.substring("date_start", 1, 4).try_cast("int").alias("year_start"), "depth", "root_author", "has_pgp")


def thread_messages(members: DataFrame) -> DataFrame:
    """(thread_id, ordinal, id): the messages of each thread in the order of their dates, unknown dates first."""
    local = F.coalesce(F.nullif(F.substring("date_parsed", 1, 19), F.lit("")), F.lit(""))
    inside = members.filter("root is not null").select("root", local.alias("_local"), "depth", "pos", "id")
    names = inside.filter("depth = 0").select("root", F.concat(F.lit("thread_"), F.col("id")).alias("thread_id"))
    placed = running_sums(inside, ["root"], ["_local", "depth", "pos"], {"_before": F.lit(1)})
    return placed.join(names, "root").select("thread_id", (F.col("_before") + 1).cast("int").alias("ordinal"), "id")


def thread_participants(members: DataFrame) -> DataFrame:
    """(root_pos, participant) of every thread."""
    return members.filter("root is not null").select(F.col("root").alias("root_pos"), preferred("from_email", "from_raw").alias("participant")).filter("participant <> ''").distinct()


def thread_stats(threads: DataFrame) -> DataFrame:
    """One row over all threads."""
    n = F.col("message_count")
    return threads.agg(
        F.count("*").alias("total_threads"), F.count_if(n == 1).alias("single_message_threads"), F.count_if(n > 1).alias("multi_message_threads"),
        F.avg(n).alias("avg_messages_per_thread"), F.max(n).alias("max_messages_in_thread"), F.avg("participant_count").alias("avg_participants"),
        F.max("participant_count").alias("max_participants"), F.avg("depth").alias("avg_depth"), F.max("depth").alias("max_depth"), F.count_if("has_pgp").alias("threads_with_pgp"),
    )


def size_histogram(threads: DataFrame) -> DataFrame:
    n, bucket = F.col("message_count"), F.lit("51+")
    for top, name in reversed(SIZES):
        bucket = F.when(n <= top, name).otherwise(bucket)
    return threads.groupBy(bucket.alias("size")).agg(F.count("*").alias("n"))


def size_summary(threads: DataFrame) -> DataFrame:
    n = F.col("message_count")
    return threads.agg(F.count_if(n == 1).alias("single_message"), F.count_if(n.between(2, 5)).alias("small_2_5"), F.count_if(n.between(6, 25)).alias("medium_6_25"), F.count_if(n.between(26, 100)).alias("large_26_100"), F.count_if(n > 100).alias("very_large_100plus"))


def largest_threads(threads: DataFrame, most: int = 20) -> DataFrame:
    """The feature is the top-k: largest first, of equals the earlier root."""
    return threads.orderBy(F.desc("message_count"), "root_pos").limit(most)


def rank_by_recency(threads: DataFrame) -> DataFrame:
    """threads with ``rank``, latest start first, of equals the earlier root; unknown starts last.

    A global rank without a global sort in one task: running counts over range partitions.
    """
    keyed = threads.withColumn("_key", F.coalesce("date_start", F.lit("0000")))
    ranked = running_sums(keyed, [], [F.desc("_key"), F.asc("root_pos")], {"_before": F.lit(1)})
    return ranked.withColumn("rank", F.col("_before") + 1).drop("_key", "_before")


def index_by_year(threads: DataFrame) -> DataFrame:
    """(year_start, thread_id): the browse index; one row for each entry, sharded by year when written."""
    return threads.filter("year_start is not null").select("year_start", "thread_id")


def index_by_author(threads: DataFrame, least: int = LEAST_THREADS) -> DataFrame:
    """(author, thread_id) of the authors with at least so many threads."""
    named = threads.select(F.lower("root_author").alias("author"), "thread_id").filter("author <> ''")
    busy = named.groupBy("author").agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).select("author")
    return named.join(busy, "author", "left_semi")


def top_authors(threads: DataFrame, most: int = SHOWN_AUTHORS) -> DataFrame:
    """The feature is the top-k: authors by threads begun, of equals the one seen first."""
    named = threads.select(F.lower("root_author").alias("author"), "root_pos").filter("author <> ''")
    return named.groupBy("author").agg(F.count("*").alias("thread_count"), F.min("root_pos").alias("_first")).orderBy(F.desc("thread_count"), "_first").limit(most).drop("_first")


def count_by_year(df: DataFrame, year: str) -> DataFrame:
    return df.filter(F.col(year).isNotNull() & (F.col(year) != 0)).groupBy(F.col(year).alias("year")).agg(F.count("*").alias("n"))


def subject_index(threads: DataFrame) -> DataFrame:
    """(normalized_subject, n_threads) of subjects longer than three characters."""
    return threads.filter(F.length("normalized_subject") > 3).groupBy("normalized_subject").agg(F.count("*").alias("n_threads"))

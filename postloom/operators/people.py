"""The part of the archive around a list of people: their mails with everything above and below them in the tree.

People come as a table (ord, person, pattern). A mail is a person's if its address equals a pattern or holds
one; equality goes first, then the order of the table. NULL addresses match nobody. The table must be small: it
is counted, and beyond MOST_PATTERNS rows refused, because containment tests cannot be hashed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import preferred, strip
from postloom.operators.hierarchy import sums_above, sums_below
from postloom.runtime import cut, is_small

MOST_PATTERNS = 10_000


def attribute(mails: DataFrame, people: DataFrame) -> DataFrame:
    """mails with ``person``, NULL where no pattern fits.

    Distinct addresses are matched, not mails: the table of patterns travels once as an array column.
    """
    if not is_small(people, MOST_PATTERNS):
        raise ValueError(f"more than {MOST_PATTERNS} patterns")
    listed = people.filter("pattern is not null").select("ord", "person", F.lower(strip(F.col("pattern"))).alias("pattern")).filter("pattern <> ''")
    table = listed.agg(F.array_sort(F.collect_list(F.struct("ord", "pattern", "person"))).alias("_all"))  # bounded by the check above
    senders = mails.filter("from_email is not null").select("from_email").distinct().withColumn("_a", F.lower(strip(F.col("from_email")))).withColumn("_one", F.lit(1))
    found = senders.join(F.broadcast(table.withColumn("_one", F.lit(1))), "_one")  # a single row
    exact = F.filter("_all", lambda x: x["pattern"] == F.col("_a"))
    inside = F.filter("_all", lambda x: F.contains(F.col("_a"), x["pattern"]))
    person = F.coalesce(F.try_element_at(exact, F.lit(1))["person"], F.try_element_at(inside, F.lit(1))["person"])
    matched = found.select("from_email", person.alias("person")).filter("person is not null")
    return mails.join(matched, "from_email", "left")


def people_closure(members: DataFrame, people: DataFrame) -> DataFrame:
    """(root, pos) of every message to keep: the people's own, all above them and all below them.

    members: the rows of ``thread_members``. Marks are summed up and down the forest, which is linear in the
    messages; ancestor pairs are never formed.
    """
    inside = members.filter("root is not null")
    own = attribute(inside.select("pos", "from_email"), people).filter("person is not null").select("pos", F.lit(1).alias("_mark"))
    nodes = inside.filter("message_id <> ''").select(F.col("message_id").alias("parent_id"), F.col("pos").alias("parent"))
    links = inside.select("root", "pos", "parent_id").join(nodes, "parent_id", "left").join(own, "pos", "left")
    links = cut(links.select("root", F.col("pos").alias("node"), "parent", F.coalesce("_mark", F.lit(0)).alias("weight")))
    marked = sums_above(links).unionByName(sums_below(links)).filter("total > 0").select("node").distinct()
    return links.join(marked, "node", "left_semi").select("root", F.col("node").alias("pos"))


def people_threads(members: DataFrame, people: DataFrame, threads: DataFrame) -> DataFrame:
    """One row for each thread with a listed person, over the kept messages only; dates keep their offsets."""
    kept = members.join(people_closure(members, people).select("pos"), "pos", "left_semi")
    kept = attribute(kept, people).withColumn("_author", preferred("from_email", "from_raw")).withColumn("_date", F.nullif(F.col("date_parsed"), F.lit("")))
    out = kept.groupBy("root").agg(F.count("*").alias("message_count"), F.countDistinct(F.nullif(F.col("_author"), F.lit(""))).alias("participant_count"), F.min("_date").alias("date_start"), F.max("_date").alias("date_end"), F.coalesce(F.bool_or("has_pgp"), F.lit(False)).alias("has_pgp"), F.count("person").alias("notable_count"))
    whole = threads.select(F.col("root_pos").alias("root"), "thread_id", "subject", "depth", "root_author", F.col("message_count").alias("original_message_count"))
    return out.join(whole, "root").select("thread_id", "subject", "message_count", "original_message_count", "participant_count", "date_start", "date_end", F.substring("date_start", 1, 4).try_cast("int").alias("year_start"), "depth", "root_author", "has_pgp", "notable_count")


def people_stats(members: DataFrame, people: DataFrame) -> DataFrame:
    """(person, n_posts, n_threads) over messages that belong to a thread."""
    own = attribute(members.filter("root is not null"), people).filter("person is not null")
    return own.groupBy("person").agg(F.count("*").alias("n_posts"), F.countDistinct("root").alias("n_threads"))

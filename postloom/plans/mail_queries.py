"""Queries of the mail-archive operators over the whole mail table, with SQL where SQL can say it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions.text import normalize_subject, preferred
from postloom.operators import cleaning, matching, parsing, people, replies, spam, threads
from postloom.plans.pipeline import archive_threads, classified_mails, linked_mails
from postloom.runtime import cut, shared_folder, table
from postloom.sources import archive

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def _mails(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "emails")


def _people(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "known_entities")
    return known.select(F.row_number().over(_by_key()).alias("ord"), F.col("from_key").alias("person"), F.substring_index("email", "@", 1).alias("pattern"))


def _by_key():
    from pyspark.sql import Window

    return Window.orderBy("from_key")  # a fixed table of a few rows


def _linked(spark: SparkSession, folder: str) -> DataFrame:
    return classified_mails(_mails(spark, folder))


def _threads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return archive_threads(_linked(spark, folder))


# --- SQL shared by several queries

_STRIPPED = r"regexp_replace(coalesce(subject, ''), '^\s+|\s+$', '', 'g')"
_NORMAL = rf"lower(regexp_replace(regexp_replace({_STRIPPED}, '(?i)^(?:(?:re|fwd|fw):\s*|\[[\w\s-]+\]\s*)+', ''), '^\s+|\s+$', '', 'g'))"
_REPLY = rf"regexp_matches({_STRIPPED}, '^(?:Re|RE|Fw|FW|Fwd|FWD):')"
_D2 = f"""
WITH RECURSIVE ids AS (SELECT DISTINCT message_id FROM emails WHERE message_id <> ''),
par AS (SELECT message_id, arg_max(in_reply_to, pos) AS parent_id FROM emails WHERE message_id <> '' AND in_reply_to <> '' AND in_reply_to IN (FROM ids) GROUP BY 1),
d1 AS (SELECT e.* EXCLUDE (parent_id, is_thread_root, normalized_subject, orphan_status, orphan_type), p.parent_id, p.parent_id IS NULL AS is_thread_root FROM emails e LEFT JOIN par p USING (message_id)),
d2 AS (SELECT *, {_NORMAL} AS normalized_subject, {_REPLY} AS is_reply,
  CASE WHEN parent_id IS NOT NULL THEN 'has_parent' WHEN {_REPLY} THEN 'orphan_reply' ELSE 'true_root' END AS orphan_status,
  CASE WHEN parent_id IS NULL AND {_REPLY} THEN CASE WHEN in_reply_to IS NOT NULL THEN 'in_reply_to_unmatched' ELSE 'no_in_reply_to' END END AS orphan_type FROM d1)"""
_AUTHOR = "coalesce(nullif(from_email, ''), from_raw, '')"


def _threads_sql(state: str) -> str:
    """CTEs from a state of the mails to ``threads``."""
    return f""",
last AS (SELECT message_id, max(pos) AS pos FROM emails WHERE message_id <> '' GROUP BY 1),
own AS (SELECT s.* FROM {state} s WHERE coalesce(message_id, '') = '' OR pos IN (SELECT pos FROM last)),
up AS (SELECT o.pos AS node, l.pos AS parent FROM own o LEFT JOIN last l ON o.parent_id = l.message_id),
walk AS (SELECT node, node AS root, CAST(0 AS BIGINT) AS depth FROM up WHERE parent IS NULL UNION ALL SELECT u.node, w.root, w.depth + 1 FROM walk w JOIN up u ON u.parent = w.node),
inside AS (SELECT o.*, w.root, w.depth, {_AUTHOR} AS author, nullif(substr(date_parsed, 1, 19), '') AS local FROM own o JOIN walk w ON o.pos = w.node),
sums AS (SELECT root, count(*) AS message_count, count(DISTINCT nullif(author, '')) AS participant_count, min(local) AS date_start, max(local) AS date_end, max(depth) AS depth, coalesce(bool_or(has_pgp), false) AS has_pgp FROM inside GROUP BY 1),
threads AS (SELECT s.root AS root_pos, 'thread_' || i.id AS thread_id, i.subject, i.normalized_subject, s.message_count, s.participant_count, s.date_start, s.date_end, TRY_CAST(substr(s.date_start, 1, 4) AS INTEGER) AS year_start, s.depth, i.author AS root_author, s.has_pgp
  FROM sums s JOIN inside i ON i.root = s.root AND i.depth = 0)"""


_E = _D2 + _threads_sql("d2")
_SECONDS = "CAST(epoch(TRY_CAST(replace(substr(date_parsed, 1, 19), 'T', ' ') AS TIMESTAMP)) AS BIGINT)"


@query(_E + " SELECT * FROM threads")
def thread_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Flagship: threads over header links with size, people, dates, depth."""
    return _threads(spark, folder)[1]


# --- header links


@query(
    _D2
    + """, kids AS (SELECT parent_id, count(*) AS n FROM d2 WHERE parent_id IS NOT NULL GROUP BY 1)
SELECT count(*) AS total_emails, count(DISTINCT nullif(message_id, '')) AS emails_with_message_id, count(*) FILTER (in_reply_to <> '') AS emails_with_in_reply_to,
  count(*) FILTER (in_reply_to <> '' AND in_reply_to IN (FROM ids)) AS in_reply_to_matched, count(*) FILTER (in_reply_to <> '' AND in_reply_to NOT IN (FROM ids)) AS in_reply_to_unmatched,
  count(*) FILTER (parent_id IS NULL) AS root_messages, count(*) FILTER (parent_id IS NOT NULL) AS child_messages,
  (SELECT count(*) FROM kids) AS emails_as_parents, (SELECT coalesce(max(n), 0) FROM kids) AS max_children FROM d2"""
)
def parent_resolution_stats(spark: SparkSession, folder: str) -> DataFrame:
    return replies.link_stats(_mails(spark, folder))


@query(_D2 + " SELECT pos, message_id, parent_id, is_thread_root FROM d2")
def reply_links(spark: SparkSession, folder: str) -> DataFrame:
    return replies.link_replies(_mails(spark, folder)).select("pos", "message_id", "parent_id", "is_thread_root")


@query(_D2 + " SELECT parent_id AS message_id, string_agg(message_id, ' ' ORDER BY pos) AS children FROM d2 WHERE parent_id IS NOT NULL GROUP BY 1")
def reply_children(spark: SparkSession, folder: str) -> DataFrame:
    lists = replies.children_lists(replies.link_replies(_mails(spark, folder)))
    return lists.select("message_id", F.array_join("children_ids", " ").alias("children"))


@query(_D2 + ", k AS (SELECT parent_id, count(*) AS n_children FROM d2 WHERE parent_id IS NOT NULL GROUP BY 1) SELECT n_children, count(*) AS n_parents FROM k GROUP BY 1")
def fanout_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return replies.fanout_histogram(_mails(spark, folder))


@query(_D2 + ", k AS (SELECT parent_id, count(*) AS n_children, min(pos) AS f FROM d2 WHERE parent_id IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 3 LIMIT 1) SELECT k.parent_id AS message_id, n_children, (SELECT arg_max(subject, pos) FROM emails e WHERE e.message_id = k.parent_id) AS subject FROM k")
def max_fanout(spark: SparkSession, folder: str) -> DataFrame:
    return replies.widest_parent(_mails(spark, folder))


# --- subjects and orphans


@query(f"SELECT pos, {_NORMAL} AS normalized FROM emails")
def normalized_subject(spark: SparkSession, folder: str) -> DataFrame:
    return _mails(spark, folder).select("pos", normalize_subject(F.col("subject")).alias("normalized"))


@query(_D2 + " SELECT pos, normalized_subject, orphan_status, orphan_type FROM d2")
def orphan_status(spark: SparkSession, folder: str) -> DataFrame:
    return _linked(spark, folder).select("pos", "normalized_subject", "orphan_status", "orphan_type")


@query(
    _D2
    + """ SELECT count(*) AS total_emails, count(*) FILTER (orphan_status = 'has_parent') AS emails_with_parent, count(*) FILTER (orphan_status <> 'has_parent') AS emails_without_parent,
  count(*) FILTER (orphan_status = 'has_parent' AND is_reply) AS reply_subjects_with_parent, count(*) FILTER (orphan_status = 'orphan_reply') AS reply_subjects_without_parent, count(*) FILTER (orphan_status = 'true_root') AS non_reply_without_parent,
  count(*) FILTER (orphan_type = 'in_reply_to_unmatched') AS in_reply_to_unmatched, count(*) FILTER (orphan_type = 'no_in_reply_to') AS no_in_reply_to FROM d2"""
)
def orphan_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return replies.orphan_counts(_linked(spark, folder))


@query(_D2 + " SELECT pos, id, subject, normalized_subject, coalesce(nullif(from_email, ''), from_raw, '') AS sender, coalesce(nullif(date_parsed, ''), date_raw, '') AS date, file_year, in_reply_to, orphan_type FROM d2 WHERE orphan_status = 'orphan_reply'")
def orphan_review(spark: SparkSession, folder: str) -> DataFrame:
    """The narrow rows of orphans that people review."""
    orphans = _linked(spark, folder).filter("orphan_status = 'orphan_reply'")
    return orphans.select("pos", "id", "subject", "normalized_subject", preferred("from_email", "from_raw").alias("sender"), preferred("date_parsed", "date_raw").alias("date"), "file_year", "in_reply_to", "orphan_type")


@query(_D2 + " SELECT normalized_subject, count(*) AS n FROM d2 WHERE normalized_subject <> '' GROUP BY 1 HAVING count(*) >= 2")
def subject_groups_having(spark: SparkSession, folder: str) -> DataFrame:
    return replies.subject_groups(_linked(spark, folder))


@query(_D2 + ", g AS (SELECT count(*) AS n FROM d2 WHERE normalized_subject <> '' GROUP BY normalized_subject) SELECT count(*) AS unique_normalized_subjects, count(*) FILTER (n > 1) AS subjects_with_multiple_emails, coalesce(max(n), 0) AS largest_subject_group FROM g")
def subject_group_stats(spark: SparkSession, folder: str) -> DataFrame:
    return replies.subject_group_stats(_linked(spark, folder))


_ORPHAN = "SELECT DISTINCT normalized_subject FROM d2 WHERE orphan_status = 'orphan_reply' AND normalized_subject <> ''"
_ANCHOR = "SELECT DISTINCT normalized_subject FROM d2 WHERE orphan_status <> 'orphan_reply' AND normalized_subject <> ''"


@query(f"{_D2} ({_ORPHAN}) INTERSECT ({_ANCHOR})")
def matchable_subjects(spark: SparkSession, folder: str) -> DataFrame:
    return replies.matchable_subjects(_linked(spark, folder))


@query(f"{_D2} ({_ORPHAN}) EXCEPT ({_ANCHOR})")
def unmatchable_subjects(spark: SparkSession, folder: str) -> DataFrame:
    return replies.unmatchable_subjects(_linked(spark, folder))


@query(f"{_D2} SELECT pos, normalized_subject FROM d2 WHERE orphan_status = 'orphan_reply' AND normalized_subject IN ({_ANCHOR})")
def matchable_orphans(spark: SparkSession, folder: str) -> DataFrame:
    return replies.matchable_orphans(_linked(spark, folder)).select("pos", "normalized_subject")


@query(f"{_D2} SELECT pos, normalized_subject FROM d2 WHERE orphan_status = 'orphan_reply' AND normalized_subject NOT IN ({_ANCHOR})")
def unmatchable_orphans(spark: SparkSession, folder: str) -> DataFrame:
    return replies.unmatchable_orphans(_linked(spark, folder)).select("pos", "normalized_subject")


# --- matches

#: Rounds of rejected links that the SQL writes out; the tables need fewer, and a further round changes nothing.
_ROUNDS = 24


def _subject_sql(state: str, p: str) -> str:
    """CTEs {p}sc: all scored pairs under one subject; {p}hits: the best of each orphan."""
    return f""", {p}st AS (SELECT pos, id, message_id, normalized_subject AS s, orphan_status, {_SECONDS} AS ts, coalesce(nullif(date_parsed, ''), nullif(date_raw, ''), '') AS key,
  CASE WHEN orphan_status = 'true_root' THEN 10 ELSE 0 END + CASE WHEN message_id <> '' AND message_id IN (SELECT parent_id FROM {state} WHERE parent_id IS NOT NULL) THEN 5 ELSE 0 END + CASE WHEN parent_id IS NOT NULL THEN 3 ELSE 0 END AS base
  FROM {state} WHERE normalized_subject <> ''),
{p}sc AS MATERIALIZED (SELECT o.pos, c.message_id AS parent_id, c.key, c.pos AS cpos, o.ts - c.ts AS gap,
  c.base + CASE WHEN o.ts - c.ts < 86400 THEN 5 WHEN o.ts - c.ts < 604800 THEN 3 WHEN o.ts - c.ts < 2592000 THEN 1 ELSE 0 END AS score
  FROM {p}st o JOIN {p}st c ON o.s = c.s AND o.id <> c.id AND c.message_id <> '' AND (o.ts IS NULL OR c.ts IS NULL OR c.ts < o.ts) WHERE o.orphan_status = 'orphan_reply'),
{p}best AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY score DESC, key, cpos) AS r FROM {p}sc),
{p}hits AS (SELECT pos, parent_id, CAST(score AS INTEGER) AS match_score, gap AS gap_seconds FROM {p}best WHERE r = 1)"""


def _loops_sql(state: str, p: str, links: str) -> str:
    """CTE {p}bad: of the links on one loop that of the latest mail."""
    return f""", {p}can AS (SELECT pos, message_id, parent_id FROM {state} WHERE pos IN (SELECT max(pos) FROM emails WHERE message_id <> '' GROUP BY message_id)),
{p}g AS MATERIALIZED (SELECT c.pos AS node, t.pos AS up, b.pos IS NOT NULL AS fresh FROM {p}can c LEFT JOIN {links} b ON b.pos = c.pos LEFT JOIN {p}can t ON t.message_id = coalesce(b.parent_id, c.parent_id)),
{p}w AS (SELECT node AS s, up AS reach FROM {p}g WHERE fresh AND up IS NOT NULL UNION SELECT w.s, g.up FROM {p}w w JOIN {p}g g ON g.node = w.reach WHERE g.up IS NOT NULL),
{p}bad AS MATERIALIZED (SELECT DISTINCT m AS pos FROM (SELECT max(w.reach) AS m FROM {p}w w JOIN {p}g g ON g.node = w.reach AND g.fresh WHERE w.s IN (SELECT s FROM {p}w WHERE s = reach) GROUP BY w.s))"""


def _loop_free_sql(state: str, p: str) -> str:
    """CTEs {p}free: the links after all rounds; {p}rej: the rejected pairs."""
    out = f", {p}rej0 AS (SELECT CAST(NULL AS BIGINT) AS pos, CAST(NULL AS BIGINT) AS cpos WHERE false)"
    for k in range(_ROUNDS + 1):
        out += f""", {p}b{k} AS MATERIALIZED (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY pos ORDER BY score DESC, key, cpos) AS r FROM {p}sc c ANTI JOIN {p}rej{k} USING (pos, cpos)) WHERE r = 1)"""
        if k < _ROUNDS:
            out += _loops_sql(state, f"{p}{k}", f"{p}b{k}") + f""", {p}rej{k + 1} AS (SELECT pos, cpos FROM {p}rej{k} UNION ALL SELECT pos, cpos FROM {p}b{k} WHERE pos IN (SELECT pos FROM {p}{k}bad))"""
    return out + f", {p}rej AS (SELECT * FROM {p}rej{_ROUNDS}), {p}free AS (SELECT pos, parent_id, CAST(score AS INTEGER) AS match_score, gap AS gap_seconds FROM {p}b{_ROUNDS})"


def _put_sql(state: str, links: str, status: str, out: str) -> str:
    """CTE {out}: the state with links put in."""
    return f", {out} AS MATERIALIZED (SELECT s.* REPLACE (coalesce(l.parent_id, s.parent_id) AS parent_id, CASE WHEN l.pos IS NOT NULL THEN '{status}' ELSE s.orphan_status END AS orphan_status) FROM {state} s LEFT JOIN {links} l USING (pos))"


_STATES = _D2 + _subject_sql("d2", "s")
_FREE = _STATES + _loop_free_sql("d2", "s")


@query(_STATES + " SELECT * FROM shits")
def orphan_match_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return matching.match_by_subject(_linked(spark, folder))


@query(_STATES + " SELECT CASE WHEN gap_seconds < 86400 THEN 'same_day' WHEN gap_seconds < 604800 THEN 'within_week' WHEN gap_seconds < 2592000 THEN 'within_month' ELSE 'over_month' END AS gap, count(*) AS n FROM shits WHERE gap_seconds IS NOT NULL GROUP BY 1")
def match_gap_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return matching.gap_histogram(matching.match_by_subject(_linked(spark, folder)))


@query(_FREE + " SELECT * FROM sfree")
def orphan_match_loop_free(spark: SparkSession, folder: str) -> DataFrame:
    """The matches of which a link that closes a loop gave way to the mail's next candidate."""
    return matching.match_by_subject(cut(_linked(spark, folder)), loop_free=True)


@query(
    _FREE
    + """, kids AS (SELECT parent_id, count(*) AS n FROM d2 WHERE parent_id IS NOT NULL GROUP BY 1),
st AS (SELECT message_id, arg_max(orphan_status, pos) AS status FROM d2 WHERE message_id <> '' GROUP BY 1),
seen AS (SELECT st.status, coalesce(k.n, 0) + row_number() OVER (PARTITION BY l.parent_id ORDER BY l.pos) AS n_then FROM sfree l JOIN st ON st.message_id = l.parent_id LEFT JOIN kids k ON k.parent_id = l.parent_id)
SELECT CASE WHEN status = 'true_root' THEN 'to_root' WHEN n_then > 1 THEN 'to_parent' ELSE 'to_chain' END AS to_kind, count(*) AS n FROM seen GROUP BY 1"""
)
def match_kind_counts(spark: SparkSession, folder: str) -> DataFrame:
    state = cut(_linked(spark, folder))
    return matching.link_kinds(state, cut(matching.match_by_subject(state, loop_free=True)))


@query(
    _FREE
    + """ SELECT count(*) AS total_emails, count(*) FILTER (orphan_status = 'orphan_reply') AS orphans_before, (SELECT count(*) FROM sfree) AS orphans_matched, count(*) FILTER (orphan_status = 'orphan_reply') - (SELECT count(*) FROM sfree) AS orphans_unmatched,
  (SELECT count(*) FROM srej) AS cycles_prevented, count(*) FILTER (parent_id IS NULL) - (SELECT count(*) FROM sfree) AS root_messages_after, count(*) FILTER (parent_id IS NOT NULL) + (SELECT count(*) FROM sfree) AS child_messages_after FROM d2"""
)
def subject_match_stats(spark: SparkSession, folder: str) -> DataFrame:
    return matching.subject_match_stats(cut(_linked(spark, folder)))


@query()
def orphan_match_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """Subject matches made one after another, each seeing those before it."""
    return matching.match_in_order(_linked(spark, folder))


_QUOTED_LINES = r"""l AS MATERIALIZED (SELECT pos, regexp_replace(unnest(string_split(body, chr(10))), '^\s+|\s+$', '', 'g') AS line, unnest(range(len(string_split(body, chr(10))))) AS i FROM emails),
q AS (SELECT pos, i, regexp_replace(line, '^>+\s*', '') AS quote FROM l WHERE line LIKE '>%'),
quotes AS MATERIALIZED (SELECT pos, CAST(row_number() OVER (PARTITION BY pos ORDER BY i) - 1 AS INTEGER) AS ordinal, quote FROM q WHERE length(quote) > 20)"""


@query(f"WITH {_QUOTED_LINES} SELECT * FROM quotes")
def quote_lines(spark: SparkSession, folder: str) -> DataFrame:
    return matching.quoted_lines(_mails(spark, folder))


_KEY = r"regexp_replace(regexp_replace(regexp_replace(lower({}), '\s+', ' ', 'g'), '[^\pL\pN\pM_\s]', '', 'g'), '^\s+|\s+$', '', 'g')"


def _quote_sql(state: str, p: str) -> str:
    """CTE {p}hits: the best source of each root that quotes; ``l`` and ``quotes`` must be there."""
    return f""", {p}about AS (SELECT pos, id, message_id, normalized_subject AS s, {_SECONDS} AS ts, orphan_status FROM {state}),
{p}probes AS (SELECT a.*, ordinal, {_KEY.format('quote')} AS key FROM quotes JOIN {p}about a USING (pos) WHERE ordinal < 5 AND a.orphan_status = 'true_root' AND a.s <> ''),
{p}src AS (SELECT DISTINCT a.*, {_KEY.format('l.line')} AS key FROM l JOIN {p}about a USING (pos) JOIN emails e USING (pos) WHERE length(e.body) >= 50 AND length(l.line) > 30 AND a.message_id <> ''),
{p}sc AS (SELECT p.pos, p.ordinal, c.pos AS cpos, c.ts AS cts, c.message_id AS parent_id, 1 + CASE WHEN p.s = c.s THEN 10 WHEN contains(p.s, c.s) OR contains(c.s, p.s) THEN 5 ELSE 0 END
    + CASE WHEN p.ts - c.ts < 86400 THEN 5 WHEN p.ts - c.ts < 604800 THEN 3 WHEN p.ts - c.ts < 2592000 THEN 1 ELSE 0 END AS score
  FROM {p}probes p JOIN {p}src c ON p.key = c.key AND p.id <> c.id AND (p.ts IS NULL OR c.ts IS NULL OR c.ts < p.ts) WHERE length(p.key) >= 20 AND length(c.key) > 20),
{p}best AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY score DESC, ordinal, cts IS NULL, cts, cpos) AS r FROM {p}sc),
{p}hits AS MATERIALIZED (SELECT pos, parent_id, CAST(score AS INTEGER) AS quote_match_score FROM {p}best WHERE r = 1)"""


def _time_sql(state: str, p: str) -> str:
    """CTEs {p}all: roots under subjects; {p}fold: dated ones with their anchors; {p}hits: the links."""
    return f""", {p}all AS (SELECT pos, message_id, normalized_subject AS s, {_SECONDS} AS ts FROM {state} WHERE orphan_status = 'true_root' AND length(normalized_subject) > 3),
{p}roots AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY s ORDER BY ts, pos) AS rn FROM {p}all WHERE ts IS NOT NULL),
{p}fold AS (SELECT s, rn, pos, ts, pos AS a_pos, message_id AS a_id, ts AS a_ts FROM {p}roots WHERE rn = 1
  UNION ALL SELECT r.s, r.rn, r.pos, r.ts, CASE WHEN r.ts - f.a_ts >= 345600 THEN r.pos ELSE f.a_pos END, CASE WHEN r.ts - f.a_ts >= 345600 THEN r.message_id ELSE f.a_id END, CASE WHEN r.ts - f.a_ts >= 345600 THEN r.ts ELSE f.a_ts END
  FROM {p}fold f JOIN {p}roots r ON r.s = f.s AND r.rn = f.rn + 1),
{p}hits AS MATERIALIZED (SELECT pos, a_id AS parent_id, CAST((ts - a_ts) // 86400 AS INTEGER) AS time_proximity_days FROM {p}fold WHERE pos <> a_pos AND a_id <> '')"""


_QUOTE = f"{_D2}, {_QUOTED_LINES}{_quote_sql('d2', 'q')}"


@query(_QUOTE + " SELECT * FROM qhits")
def quote_best_match(spark: SparkSession, folder: str) -> DataFrame:
    return matching.match_by_quotes(_linked(spark, folder))


@query(
    _QUOTE
    + _loops_sql("d2", "q", "qhits")
    + """ SELECT count(*) AS true_roots_checked, count(*) FILTER (pos IN (SELECT pos FROM quotes)) AS roots_with_quotes, (SELECT count(*) FROM qhits) - (SELECT count(*) FROM qbad) AS matches_found, (SELECT count(*) FROM qbad) AS cycles_prevented,
  count(*) FILTER (normalized_subject <> '' AND pos IN (SELECT pos FROM quotes)) - (SELECT count(*) FROM qhits) AS no_match_found FROM d2 WHERE orphan_status = 'true_root'"""
)
def quote_match_stats(spark: SparkSession, folder: str) -> DataFrame:
    return matching.quote_match_stats(_linked(spark, folder))


_TIME = _D2 + _time_sql("d2", "t")


@query(_TIME + " SELECT * FROM thits")
def anchored_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return matching.match_by_time(_linked(spark, folder))


@query(_TIME + " SELECT s AS normalized_subject, count(*) AS n_roots, count(ts) AS n_dated FROM tall GROUP BY 1 HAVING count(*) > 1")
def root_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Subjects under which several conversations begin."""
    return matching.root_groups(_linked(spark, folder))


@query(
    _TIME
    + _loops_sql("d2", "t", "thits")
    + """, many AS (SELECT s, count(*) AS n FROM tall GROUP BY 1 HAVING count(*) > 1)
SELECT (SELECT count(*) FROM many) AS subjects_with_multi_roots, (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM many) AS total_true_roots_in_groups, (SELECT count(*) FROM thits) - (SELECT count(*) FROM tbad) AS matches_found, (SELECT count(*) FROM tbad) AS cycles_prevented,
  (SELECT count(*) FROM tfold WHERE rn > 1 AND pos = a_pos) AS too_far_apart"""
)
def time_match_stats(spark: SparkSession, folder: str) -> DataFrame:
    return matching.time_match_stats(_linked(spark, folder))


_LINKED = (
    f"{_D2}, {_QUOTED_LINES}"
    + _subject_sql("d2", "s") + _loop_free_sql("d2", "s") + _put_sql("d2", "sfree", "matched_by_subject", "d3")
    + _quote_sql("d3", "q") + _loops_sql("d3", "q", "qhits") + ", qkept AS (SELECT * FROM qhits ANTI JOIN qbad USING (pos))" + _put_sql("d3", "qkept", "matched_by_quote", "d3b")
    + _time_sql("d3b", "t") + _loops_sql("d3b", "t", "thits") + ", tkept AS (SELECT * FROM thits ANTI JOIN tbad USING (pos))" + _put_sql("d3b", "tkept", "matched_by_time_proximity", "d3c")
)


@query(_LINKED + " SELECT orphan_status, count(*) AS n FROM d3c GROUP BY 1")
def linked_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    """States after all kinds of matches were put in."""
    return linked_mails(_mails(spark, folder)).groupBy("orphan_status").agg(F.count("*").alias("n"))


@query(_LINKED + _threads_sql("d3c") + " SELECT * FROM threads")
def archive_threads_full(spark: SparkSession, folder: str) -> DataFrame:
    """Threads over header, subject, quote and time links."""
    return archive_threads(linked_mails(_mails(spark, folder)))[1]


# --- threads


@query(_E + ", m AS (SELECT i.*, t.thread_id FROM inside i JOIN threads t ON t.root_pos = i.root) SELECT thread_id, CAST(row_number() OVER (PARTITION BY root ORDER BY coalesce(local, ''), depth, pos) AS INTEGER) AS ordinal, id FROM m")
def thread_messages(spark: SparkSession, folder: str) -> DataFrame:
    return threads.thread_messages(_threads(spark, folder)[0])


@query(_E + " SELECT DISTINCT root AS root_pos, author AS participant FROM inside WHERE author <> ''")
def thread_participants(spark: SparkSession, folder: str) -> DataFrame:
    return threads.thread_participants(_threads(spark, folder)[0])


@query(
    _E
    + """ SELECT count(*) AS total_threads, count(*) FILTER (message_count = 1) AS single_message_threads, count(*) FILTER (message_count > 1) AS multi_message_threads, avg(message_count) AS avg_messages_per_thread, max(message_count) AS max_messages_in_thread,
  avg(participant_count) AS avg_participants, max(participant_count) AS max_participants, avg(depth) AS avg_depth, max(depth) AS max_depth, count(*) FILTER (has_pgp) AS threads_with_pgp FROM threads"""
)
def thread_stats(spark: SparkSession, folder: str) -> DataFrame:
    return threads.thread_stats(_threads(spark, folder)[1])


@query(_E + " SELECT CASE WHEN message_count <= 1 THEN '1' WHEN message_count <= 2 THEN '2' WHEN message_count <= 5 THEN '3-5' WHEN message_count <= 10 THEN '6-10' WHEN message_count <= 25 THEN '11-25' WHEN message_count <= 50 THEN '26-50' ELSE '51+' END AS size, count(*) AS n FROM threads GROUP BY 1")
def thread_size_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return threads.size_histogram(_threads(spark, folder)[1])


@query(_E + " SELECT count(*) FILTER (message_count = 1) AS single_message, count(*) FILTER (message_count BETWEEN 2 AND 5) AS small_2_5, count(*) FILTER (message_count BETWEEN 6 AND 25) AS medium_6_25, count(*) FILTER (message_count BETWEEN 26 AND 100) AS large_26_100, count(*) FILTER (message_count > 100) AS very_large_100plus FROM threads")
def thread_size_summary(spark: SparkSession, folder: str) -> DataFrame:
    return threads.size_summary(_threads(spark, folder)[1])


@query(_E + " SELECT thread_id, subject, message_count, participant_count, root_author FROM threads ORDER BY message_count DESC, root_pos LIMIT 20")
def top_threads(spark: SparkSession, folder: str) -> DataFrame:
    return threads.largest_threads(_threads(spark, folder)[1]).select("thread_id", "subject", "message_count", "participant_count", "root_author")


@query(_E + " SELECT thread_id, date_start, row_number() OVER (ORDER BY coalesce(date_start, '0000') DESC, root_pos) AS rank FROM threads")
def thread_rank(spark: SparkSession, folder: str) -> DataFrame:
    return threads.rank_by_recency(_threads(spark, folder)[1]).select("thread_id", "date_start", "rank")


@query(_E + " SELECT year_start, thread_id FROM threads WHERE year_start IS NOT NULL")
def index_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return threads.index_by_year(_threads(spark, folder)[1])


@query(_E + ", a AS (SELECT lower(root_author) AS author, thread_id FROM threads WHERE root_author <> '') SELECT author, thread_id FROM a WHERE author IN (SELECT author FROM a GROUP BY 1 HAVING count(*) >= 5)")
def index_by_author_having(spark: SparkSession, folder: str) -> DataFrame:
    return threads.index_by_author(_threads(spark, folder)[1])


@query(_E + " SELECT author, thread_count FROM (SELECT lower(root_author) AS author, count(*) AS thread_count, min(root_pos) AS f FROM threads WHERE root_author <> '' GROUP BY 1 ORDER BY 2 DESC, 3 LIMIT 50)")
def top_authors(spark: SparkSession, folder: str) -> DataFrame:
    return threads.top_authors(_threads(spark, folder)[1])


@query(_E + " SELECT year_start AS year, count(*) AS n FROM threads WHERE year_start IS NOT NULL GROUP BY 1")
def threads_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return threads.count_by_year(_threads(spark, folder)[1], "year_start")


@query("SELECT file_year AS year, count(*) AS n FROM emails WHERE file_year <> 0 GROUP BY 1")
def emails_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return threads.count_by_year(_mails(spark, folder), "file_year")


@query(_E + " SELECT normalized_subject, count(*) AS n_threads FROM threads WHERE length(normalized_subject) > 3 GROUP BY 1")
def subject_index(spark: SparkSession, folder: str) -> DataFrame:
    return threads.subject_index(_threads(spark, folder)[1])


@query("SELECT DISTINCT file_year AS year FROM emails WHERE file_year IS NOT NULL")
def year_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return archive.year_manifest(_mails(spark, folder))


# --- people

_PEOPLE = """, people AS (SELECT row_number() OVER (ORDER BY from_key) AS ord, from_key AS person, lower(trim(split_part(email, '@', 1))) AS pattern FROM known_entities),
senders AS (SELECT DISTINCT from_email, lower(trim(from_email)) AS a FROM emails WHERE from_email IS NOT NULL),
attributed AS (SELECT s.from_email, arg_min(person, CASE WHEN a = pattern THEN ord - 1000000 ELSE ord END) AS person FROM senders s JOIN people p ON contains(a, pattern) GROUP BY 1),
posts AS (SELECT i.*, t.person FROM inside i LEFT JOIN attributed t USING (from_email))"""
_SUBTREE = (
    _PEOPLE
    + """, anc AS (SELECT node AS of, node AS a FROM up JOIN walk USING (node) UNION ALL SELECT anc.of, u.parent FROM anc JOIN up u ON u.node = anc.a WHERE u.parent IS NOT NULL),
mine AS (SELECT pos FROM posts WHERE person IS NOT NULL),
keep AS (SELECT a AS pos FROM anc WHERE of IN (FROM mine) UNION SELECT of AS pos FROM anc WHERE a IN (FROM mine))"""
)


@query(_E + _PEOPLE + " SELECT person, count(*) AS n_posts, count(DISTINCT root) AS n_threads FROM posts WHERE person IS NOT NULL GROUP BY 1")
def people_stats(spark: SparkSession, folder: str) -> DataFrame:
    return people.people_stats(_threads(spark, folder)[0], _people(spark, folder))


@query(_E + _SUBTREE + " SELECT root, pos FROM inside WHERE pos IN (FROM keep)")
def people_subtree(spark: SparkSession, folder: str) -> DataFrame:
    return people.people_closure(_threads(spark, folder)[0], _people(spark, folder))


@query(
    _E
    + _SUBTREE
    + """ SELECT t.thread_id, t.subject, k.*EXCLUDE (root), t.message_count AS original_message_count, TRY_CAST(substr(k.date_start, 1, 4) AS INTEGER) AS year_start, t.depth, t.root_author
FROM (SELECT root, count(*) AS message_count, count(DISTINCT nullif(author, '')) AS participant_count, min(nullif(date_parsed, '')) AS date_start, max(nullif(date_parsed, '')) AS date_end, coalesce(bool_or(has_pgp), false) AS has_pgp, count(person) AS notable_count FROM posts WHERE pos IN (FROM keep) GROUP BY 1) k JOIN threads t ON t.root_pos = k.root"""
)
def people_threads(spark: SparkSession, folder: str) -> DataFrame:
    members, found = _threads(spark, folder)
    return people.people_threads(members, _people(spark, folder), found)


# --- spam


# The fixed rules of the spam operator, written out once more for the SQL.
_SUBJECTS = r"""make_money (make|earn)\s*(big\s*)?(money|cash|\$|bucks)
work_from_home work\s*(from\s*)?home.*\$
financial_opportunity financial\s*(freedom|opportunity)
adult_content (xxx|adult|sexy)\s*(image|pic|video|site)
cable_scrambler cable\s*(tv\s*)?(de)?scrambler
stock_pump (stock|buy|sell)\s*alert
get_rich_quick get\s*rich\s*(quick|fast|now)
weight_loss lose\s*(weight|pounds|lbs)
pharma_spam viagra|cialis|penis\s*enlarge
bulk_email bulk\s*e?-?mail\s*(list|address|software)
email_list_sale (\d+,?\d*,?\d*)\s*(fresh\s*)?(e?-?mail|address)
free_money free\s*(money|cash|offer|gift|trial)
limited_time limited\s*time\s*(only|offer)
cc_processing credit\s*card\s*(machine|terminal|processing)
biz_opp internet\s*business\s*opportunity
mlm mlm|multi.?level\s*market
home_business home\s*based\s*business
amazing_offer amazing\s*(new\s*)?(product|offer|opportunity)
double_money double\s*your\s*(money|income)"""
_BODIES = r"""not_spam_disclaimer this\s*is\s*not\s*spam
receiving_disclaimer you\s*(are\s*)?receiving\s*this\s*(because|as)
removal_instructions to\s*(be\s*)?removed?\s*from\s*(this|our|the)\s*(list|mailing)
unsubscribe_spam unsubscribe\s*(instructions|link|here|below)
order_now order\s*(now|today)\s*(and\s*)?(receive|get)
call_now call\s*(now|today|toll.?free)\s*(to\s*order)?
act_now act\s*(now|fast|today)
price_pitch only\s*\$\d+
satisfaction_guarantee satisfaction\s*guarante
risk_free risk.?free
discount (huge|big|massive)\s*discount"""


def _rules_sql(rules: str, column: str, scope: str) -> str:
    pairs = [line.split(" ", 1) for line in rules.split("\n")]
    cases = ", ".join(f"CASE WHEN regexp_matches({column}, '{p}') THEN '{scope}:{n}' END" for n, p in pairs)
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


_SIGNALS = r"CAST(regexp_matches(b, 'click\s*here') AS INTEGER) + CAST(regexp_matches(b, '<a\s*href') AS INTEGER) + CAST(contains(b, 'bgcolor') AS INTEGER) + CAST(regexp_matches(b, 'font\s*color') AS INTEGER)"
_SPAM = f"""
WITH n AS (SELECT from_email, count(*) AS n FROM emails GROUP BY 1),
t AS (SELECT e.*, n.n, lower(coalesce(subject, '')) AS s, lower(coalesce(body, '')) AS b, lower(coalesce(e.from_email, '')) AS f, coalesce(subject, '') AS p FROM emails e LEFT JOIN n ON e.from_email IS NOT DISTINCT FROM n.from_email),
r AS (SELECT *, {_rules_sql(_SUBJECTS, 's', 'spam_subject')} AS rs, {_rules_sql(_BODIES, 'b', 'spam_body')} AS rb,
  (contains(b, '<html') OR contains(b, '<body')) AND length(b) < 5000 AND {_SIGNALS} >= 2 AS h,
  NOT (suffix(f, '@mcimail.com') OR suffix(f, '@compuserve.com') OR suffix(f, '@aol.com') OR suffix(f, '@prodigy.com') OR suffix(f, '@prodigy.net')) AS odd,
  upper(p) = p AND lower(p) <> p AND length(p) > 20 AND regexp_matches(p, '[!$]{{2,}}') AND coalesce(n, 0) <= 1 AS caps FROM t),
o AS (SELECT *, list_filter([CASE WHEN odd AND regexp_matches(f, '^\\d{{7,}}@') THEN 'suspicious_numeric_sender' END, CASE WHEN odd AND regexp_matches(f, '@\\d+\\.(com|net|org)$') THEN 'numeric_domain' END], lambda x: x IS NOT NULL) AS ro FROM r),
w AS (SELECT *, rs || rb[1:3] || CASE WHEN h THEN ['html_commercial'] ELSE [] END || ro || CASE WHEN caps THEN ['caps_punct_commercial'] ELSE [] END AS reasons FROM o),
c AS (SELECT * EXCLUDE (reasons), NOT (from_email IS NOT NULL AND n > 5) AND (len(rs) >= 1 OR len(rb) >= 3 OR (h AND len(rb) >= 1) OR (len(ro) > 0 AND (len(rb) >= 1 OR caps)) OR len(reasons) >= 3) AS is_spam, reasons FROM w)"""


def _classified(spark: SparkSession, folder: str) -> DataFrame:
    return spam.classify(_mails(spark, folder))


@query("SELECT from_email, count(*) AS n FROM emails GROUP BY 1")
def sender_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return spam.sender_frequency(_mails(spark, folder))


@query(_SPAM + " SELECT pos, is_spam, CASE WHEN is_spam THEN array_to_string(reasons, ';') ELSE '' END AS reasons FROM c")
def spam_classify(spark: SparkSession, folder: str) -> DataFrame:
    return _classified(spark, folder).select("pos", "is_spam", F.array_join("reasons", ";").alias("reasons"))


@query(_SPAM + " SELECT split_part(x, ':', 1) AS reason, count(*) AS n FROM (SELECT unnest(reasons) AS x FROM c WHERE is_spam) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def spam_reason_counts(spark: SparkSession, folder: str) -> DataFrame:
    return spam.reason_counts(_classified(spark, folder))


@query(_SPAM + " SELECT file_year, count(*) FILTER (is_spam) AS n_spam, count(*) AS n_mails, count(*) FILTER (is_spam) * 100.0 / count(*) AS spam_percent FROM c GROUP BY 1 HAVING count(*) FILTER (is_spam) > 0")
def spam_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return spam.spam_by_year(_classified(spark, folder)).withColumn("spam_percent", F.col("spam_percent").cast("double"))


@query(_SPAM + " SELECT pos, id, file_year, subject, coalesce(nullif(from_email, ''), from_raw) AS sender, array_to_string(reasons, ';') AS reasons, substr(coalesce(body, ''), 1, 200) AS body_preview FROM c WHERE is_spam")
def spam_review(spark: SparkSession, folder: str) -> DataFrame:
    return spam.spam_review(_classified(spark, folder))


@query(_SPAM + " SELECT pos, CASE WHEN contains(b, '<html') OR contains(b, '<body') THEN " + _SIGNALS + " ELSE 0 END AS n_signals, rs[1] AS first_subject_rule FROM c")
def html_signals(spark: SparkSession, folder: str) -> DataFrame:
    lower = F.lower(F.coalesce(F.col("subject"), F.lit("")))
    first = F.try_element_at(spam._hits(lower, spam.SUBJECT_RULES, "spam_subject"), F.lit(1))
    return _mails(spark, folder).select("pos", spam.html_signals(F.lower(F.coalesce(F.col("body"), F.lit("")))).alias("n_signals"), first.alias("first_subject_rule"))


# --- cleaning

_FLAG = "split_part({}, ':', 1)"
_ANON = "regexp_matches(lower(coalesce(from_raw, '')), '^anonymous|^nobody@|^<>$|@nowhere|use-author-address-header|^0x[0-9a-f]+@|^[0-9a-f]{8}@|damien lucifer|root@hellspawn')"
_SPAM_WORDS = "regexp_matches(lower(coalesce(subject, '')), 'financial information|urgent buy|buy alert|sizzler|immediate cash|cable descrambler|save your life|online business|make money|work from home|mlm|adult|xxx')"
_CLEAN = f"""
WITH k AS (SELECT lower(trim(from_key)) AS key, max(email) AS address FROM known_entities GROUP BY 1),
c AS (SELECT e.*, coalesce(list_contains(list_transform(flags, lambda x: {_FLAG.format('x')}), 'NO_EMAIL_FOUND'), false) AS missing,
  coalesce(list_contains(list_transform(flags, lambda x: contains(x, 'MISSING_HEADER: Message-ID')), true), false) OR {_SPAM_WORDS} OR regexp_matches(coalesce(from_email, ''), '^\\d{{8}}@') AS spam, {_ANON} AS anon FROM emails e),
j AS (SELECT c.*, k.address FROM c LEFT JOIN k ON c.missing AND k.key = lower(trim(coalesce(from_raw, '')))),
r AS (SELECT * EXCLUDE (flags, from_email), coalesce(address, from_email) AS from_email, list_transform(list_filter(flags, lambda x: {_FLAG.format('x')} <> 'OBFUSCATED_EMAIL' AND NOT ({_FLAG.format('x')} = 'NO_EMAIL_FOUND' AND address IS NOT NULL)), lambda x: CASE WHEN {_FLAG.format('x')} = 'NO_EMAIL_FOUND' AND anon THEN 'ANONYMOUS_SENDER: ''' || coalesce(from_raw, '') || '''' ELSE x END) AS flags,
  len(list_filter(flags, lambda x: {_FLAG.format('x')} = 'OBFUSCATED_EMAIL')) AS n_hidden, len(list_filter(flags, lambda x: {_FLAG.format('x')} = 'NO_EMAIL_FOUND')) AS n_missing FROM j)"""


def _known(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "known_entities")


@query(_CLEAN + " SELECT pos, from_email, array_to_string(flags, chr(10)) AS flags FROM r WHERE NOT spam")
def entity_resolution(spark: SparkSession, folder: str) -> DataFrame:
    out = cleaning.clean(_mails(spark, folder), _known(spark, folder))
    return out.select("pos", "from_email", F.array_join("flags", "\n").alias("flags"))


@query(
    _CLEAN
    + """ SELECT count(*) AS original_count, count(*) FILTER (spam) AS spam_removed, count(*) FILTER (NOT spam AND (n_hidden > 0 OR (address IS NOT NULL AND n_missing > 0))) AS emails_fixed,
  CAST(coalesce(sum(n_missing) FILTER (NOT spam AND address IS NOT NULL), 0) AS BIGINT) AS known_entity_lookups, CAST(coalesce(sum(n_hidden) FILTER (NOT spam), 0) AS BIGINT) AS obfuscation_fixes,
  CAST(coalesce(sum(n_missing) FILTER (NOT spam AND address IS NULL AND anon), 0) AS BIGINT) AS anonymous_kept, CAST(coalesce(sum(n_missing) FILTER (NOT spam AND address IS NULL AND NOT anon), 0) AS BIGINT) AS still_no_email,
  count(*) FILTER (NOT spam) AS final_count, count(*) FILTER (NOT spam AND len(flags) > 0) AS final_flagged FROM r"""
)
def cleanup_stats(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.cleanup_stats(_mails(spark, folder), _known(spark, folder))


@query(_CLEAN + f" SELECT {_FLAG.format('x')} AS flag_type, count(*) AS n FROM (SELECT unnest(flags) AS x FROM r WHERE NOT spam) GROUP BY 1")
def remaining_flags(spark: SparkSession, folder: str) -> DataFrame:
    return parsing.flag_histogram(cleaning.clean(_mails(spark, folder), _known(spark, folder)))


@query(f"SELECT pos, {_ANON} AS anonymous FROM emails")
def anonymous_senders(spark: SparkSession, folder: str) -> DataFrame:
    return _mails(spark, folder).select("pos", cleaning.is_anonymous().alias("anonymous"))


@query(r"SELECT pos, regexp_replace(from_raw, '([a-zA-Z0-9._-]+)N([a-zA-Z0-9.-]+\.[a-zA-Z]{2,})', '\1@\2', 'g') AS undone FROM emails")
def capital_n_undone(spark: SparkSession, folder: str) -> DataFrame:
    return _mails(spark, folder).select("pos", cleaning.undo_capital_n(F.col("from_raw")).alias("undone"))


# --- parsing


@query(f"SELECT {_FLAG.format('x')} AS flag_type, count(*) AS n FROM (SELECT unnest(flags) AS x FROM emails) GROUP BY 1")
def flag_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return parsing.flag_histogram(_mails(spark, folder))


@query("SELECT count(*) AS total_parsed, count(*) FILTER (len(flags) > 0) AS total_flagged, count(*) FILTER (len(flags) > 0) * 100.0 / count(*) AS flagged_percent FROM emails")
def parse_stats(spark: SparkSession, folder: str) -> DataFrame:
    return parsing.parse_stats(_mails(spark, folder)).withColumn("flagged_percent", F.col("flagged_percent").cast("double"))


@query("SELECT pos, id, file_year AS year, source_file AS file, line_number AS line, subject, from_raw, array_to_string(flags, chr(10)) AS flags FROM emails WHERE len(flags) > 0")
def flag_review(spark: SparkSession, folder: str) -> DataFrame:
    return archive.flag_review(_mails(spark, folder))


@query("SELECT pos, array_to_string(flags, chr(10)) AS flags FROM emails")
def quality_flags(spark: SparkSession, folder: str) -> DataFrame:
    """All flags of a record computed anew; the SQL takes those that the archive carries."""
    mails = _mails(spark, folder).withColumn("_d", parsing.parsed_date(F.col("date_raw")))
    flags = parsing.quality_flags(parsing.sender(F.col("from_raw"))[2], F.col("_d.flags"), F.col("body"), F.col("message_id"), F.col("subject"))
    return mails.select("pos", F.array_join(flags, "\n").alias("flags"))


@query("SELECT pos, from_name, from_email FROM emails")
def sender_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Name and address computed anew; the SQL takes those that the archive carries."""
    name, address, _ = parsing.sender(F.col("from_raw"))
    return _mails(spark, folder).select("pos", name.alias("from_name"), address.alias("from_email"))


@query("SELECT pos, date_parsed FROM emails")
def date_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Dates parsed anew; the SQL takes those that the archive carries."""
    return _mails(spark, folder).select("pos", parsing.parsed_date(F.col("date_raw"))["iso"].alias("date_parsed"))


@query("SELECT pos, substr(sha256(CASE WHEN coalesce(message_id, '') <> '' THEN message_id ELSE file_year || ':' || coalesce(date_raw, '') || ':' || coalesce(from_raw, '') || ':' || coalesce(subject, '') || ':' || substr(coalesce(body, ''), 1, 100) END), 1, 16) AS mail_id FROM emails")
def surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    return _mails(spark, folder).select("pos", parsing.mail_id(F.col("message_id"), F.col("file_year"), F.col("date_raw"), F.col("from_raw"), F.col("subject"), F.col("body")).alias("mail_id"))


def _rendered(spark: SparkSession, folder: str) -> DataFrame:
    """The archive written as raw text into the shared folder and read back as messages."""
    path = f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"
    archive.write_archive(_mails(spark, folder), path)
    return archive.read_messages(spark, path)


_TRIPS = ("file_year", "from_raw", "from_name", "from_email", "date_raw", "date_parsed", "subject", "message_id", "in_reply_to", "to_addr", "cc", "content_type", "body", "body_length", "has_pgp", "id")


@query(f"SELECT {', '.join(_TRIPS)}, array_to_string(refs, ' ') AS refs, array_to_string(flags, chr(10)) AS flags FROM emails")
def archive_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parsing.parse_messages(_rendered(spark, folder))
    return parsed.select(*_TRIPS, F.array_join("refs", " ").alias("refs"), F.array_join("flags", "\n").alias("flags"))


@query(
    "SELECT message_id, "
    + " + ".join(f"CAST({c} AS INTEGER)" for c in ("coalesce(from_raw, '') <> ''", "coalesce(date_raw, '') <> ''", "coalesce(subject, '') <> ''", "coalesce(message_id, '') <> ''", "coalesce(in_reply_to, '') <> ''", "len(refs) > 0", "coalesce(to_addr, '') <> ''", "coalesce(cc, '') <> ''", "coalesce(content_type, '') <> ''"))
    + " AS n_headers, coalesce(subject, '') AS subject FROM emails"
)
def header_map(spark: SparkSession, folder: str) -> DataFrame:
    head, _ = parsing.split_message(F.col("raw"))
    rows = _rendered(spark, folder).select(parsing.header_map(head).alias("h"))
    return rows.select(F.btrim(parsing.header(F.col("h"), "message-id"), F.lit("<>")).alias("message_id"), F.size("h").alias("n_headers"), parsing.header(F.col("h"), "subject").alias("subject"))


def _head_sql(name: str, value: str) -> str:
    return f"CASE WHEN coalesce({value}, '') <> '' THEN '{name}: ' || {value} || chr(10) ELSE '' END"


_TEXT = " || ".join(
    [_head_sql(n, c) for n, c in (("From", "from_raw"), ("Date", "date_raw"), ("Subject", "subject"), ("Message-ID", "message_id"), ("In-Reply-To", "in_reply_to"), ("References", "nullif(array_to_string(refs, chr(10) || ' '), '')"), ("To", "to_addr"), ("Cc", "cc"), ("Content-Type", "content_type"))]
    + ["chr(10)", "coalesce(body, '')"]
)


@query(
    f"""WITH x AS (SELECT pos, file_year, message_id, regexp_replace({_TEXT}, '\\r\\n?', chr(10), 'g') AS t FROM emails),
n AS (SELECT *, length(t) - length(replace(t, chr(10), '')) + 1 AS lines, row_number() OVER (PARTITION BY file_year ORDER BY pos) AS ordinal, coalesce(sum(length(t) - length(replace(t, chr(10), '')) + 2) OVER (PARTITION BY file_year ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM x)
SELECT file_year, ordinal, coalesce(message_id, '') AS message_id, CAST(above + ordinal AS BIGINT) AS line_number, CAST(above + 2 AS BIGINT) AS true_line_number FROM n"""
)
def archive_line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Both line counts of every message of the archive, written as one text for each year."""
    path = f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"
    archive.write_archive(_mails(spark, folder), path, one_file=True)
    rows = archive.read_messages(spark, path)
    head, _ = parsing.split_message(F.col("raw"))
    return rows.select("file_year", "ordinal", F.btrim(parsing.header(parsing.header_map(head), "message-id"), F.lit("<>")).alias("message_id"), "line_number", "true_line_number")

"""Parents for mails that headers leave without one: by subject, by quoted lines, by nearness in time.

All three choose from the state before they run (a snapshot), so that the choice is a function of the data and
not of the order of processing. Candidates are looked for by place in the sorted sequence of a subject or a line
(``ordered.next_after``): for each orphan and each range of gaps the earliest one, and where that one is ruled
out, the next behind it. No pairs inside a group are ever formed, and a subject or a line that a third of all
mails share is spread over many tasks.

Loops: of the links that lie on one loop, the one of the latest mail is taken out. ``match_by_subject`` with
``loop_free`` then tries that mail's next candidate, round by round, until no loop is left; the other two leave
the mail without a link (``drop_loops``).

Defined results: mails with an empty normalized subject are not matched by subject; mails without a message id
are no candidates, as nothing can refer to them; where one of two dates is unknown the candidate is admitted and
time gives no points; of equal scores the earliest candidate wins, by (date string, pos) for subjects, by (place
of the quoted line, date, pos) for quotations, unknown dates last; copies of a mail are never its own parent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import local_seconds, normalize_for_matching, strip
from postloom.operators import replies
from postloom.operators.components import connected_components
from postloom.operators.hierarchy import NOWHERE, _ring, loops, resolve_forest, sums_below
from postloom.operators.ordered import next_after, place
from postloom.runtime import broadcast_if_small, cut, filled, spread

DAY = 86_400
SLICE = 30 * DAY
#: Points for a gap below so many seconds.
GAPS = ((DAY, 5), (7 * DAY, 3), (SLICE, 1))


def _date_key() -> Column:
    return F.coalesce(F.nullif(F.col("date_parsed"), F.lit("")), F.nullif(F.col("date_raw"), F.lit("")), F.lit(""))


def gap_points(gap: Column) -> Column:
    points = F.lit(0)
    for limit, p in reversed(GAPS):
        points = F.when(gap < limit, p).otherwise(points)
    return F.when(gap.isNotNull(), points).otherwise(0)


def candidates(probes: DataFrame, sources: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """(candidates, cells): for each probe, group and range of gaps the earliest source of another id.

    probes: (*by, probe struct with pos, id and ts); sources: (*by, ts, key, pos, value struct with id). A dated
    probe asks the ranges of GAPS, the sources before them and the undated ones; a probe without a date asks all.
    candidates has ``probe`` and ``cell`` and, for ``behind``, the ``group`` and the range's end in ``upto``.
    """
    cell = F.struct("ts", "key", "pos", "value").alias("cell")
    ts, last = F.col("probe.ts"), F.lit(2**62)
    kind = lambda k: F.struct(*by, F.lit(k).alias("_kind")).alias("group")
    ranges, upper = [], 1
    for limit, _ in GAPS:
        ranges.append(F.struct(place(ts - (limit - 1)).alias("at"), (ts - upper).cast("bigint").alias("upto")))
        upper = limit
    dated = sources.filter("ts is not null").select(*by, place(F.col("ts"), F.col("key"), F.col("pos")).alias("at"), cell)
    asks = probes.filter("probe.ts is not null").select(*by, "probe", F.explode(F.array(*ranges)).alias("w")).select(kind("dated"), F.col("w.at").alias("at"), F.col("w.upto").alias("upto"), "probe")
    near = _ask(asks, dated.withColumn("_kind", F.lit("dated")), by)
    # Older, undated and blind look-ups always ask for the first of a group, or the first of another id: an aggregate.
    order = F.struct(F.when(F.col("_kind") == "dated", F.col("ts")).alias("t"), "key", "pos")
    kinds = F.when(F.col("ts").isNotNull(), F.array(F.lit("dated"), F.lit("any"))).otherwise(F.array(F.lit("undated"), F.lit("any")))
    every = cut(sources.select(*by, "ts", "key", "pos", "value", F.explode(kinds).alias("_kind")))
    one = every.groupBy(*by, "_kind").agg(F.min_by(cell, order).alias("_first"))
    rest = every.join(one, [*by, "_kind"]).filter(F.col("value.id") != F.col("_first.value.id")).groupBy(*by, "_kind").agg(F.min_by(cell, order).alias("_second"))
    firsts = one.join(rest, [*by, "_kind"], "left")
    wanted = F.when(ts.isNotNull(), F.array(F.lit("dated"), F.lit("undated"))).otherwise(F.array(F.lit("any")))
    asked = probes.select(*by, "probe", F.explode(wanted).alias("_kind")).join(firsts, [*by, "_kind"])
    upto = F.when(F.col("_kind") == "dated", ts - SLICE).otherwise(last).cast("bigint").alias("upto")
    pick = F.when(F.col("_first.value.id") == F.col("probe.id"), F.col("_second")).otherwise(F.col("_first")).alias("cell")
    far = asked.select("probe", F.struct(*by, "_kind").alias("group"), upto, pick).filter("cell is not null")
    far = far.filter((F.col("group._kind") != "dated") | (F.col("cell.ts") <= F.col("upto")))
    found = near.unionByName(far.select(*near.columns))
    cells = every.select(*by, "_kind", place(F.when(F.col("_kind") == "dated", F.col("ts")).otherwise(0), F.col("key"), F.col("pos")).alias("at"), cell)
    return _without_self(cut(found), cells, by), cells


def _without_self(found: DataFrame, cells: DataFrame, by: list[str]) -> DataFrame:
    """A copy of the mail itself under another date makes way for the source behind it."""
    self_ = F.col("cell.value.id") == F.col("probe.id")
    while found.filter(self_).take(1):
        found = cut(found.filter(~self_).unionByName(behind(found.filter(self_), cells, by)))
    return found


def _ask(asks: DataFrame, cells: DataFrame, by: list[str]) -> DataFrame:
    probes = asks.select("group.*", "at", F.struct("probe", "group", "upto").alias("probe"))
    near = next_after(probes, cells, [*by, "_kind"])
    return near.filter((F.col("probe.group._kind") != "dated") | (F.col("cell.ts") <= F.col("probe.upto"))).select("probe.*", "cell")


def behind(taken: DataFrame, cells: DataFrame, by: list[str]) -> DataFrame:
    """The candidates that follow those in ``taken`` within their ranges."""
    ts = F.when(F.col("group._kind") == "dated", F.col("cell.ts")).otherwise(0)
    return _ask(taken.select("group", place(ts, F.col("cell.key"), F.col("cell.pos")).alias("at"), "upto", "probe"), cells, by)


def _states(classified: DataFrame) -> DataFrame:
    """Thin rows of the mails that have a subject: time, order key and the points of their state."""
    parents = classified.filter("parent_id is not null").select(F.col("parent_id").alias("message_id")).distinct().withColumn("_parent", F.lit(True))
    thin = classified.filter("normalized_subject <> ''").select("pos", "id", "message_id", "parent_id", "normalized_subject", "orphan_status", local_seconds(F.col("date_parsed")).alias("ts"), _date_key().alias("key"))
    thin = thin.join(parents, "message_id", "left")
    base = F.when(F.col("orphan_status") == "true_root", 10).otherwise(0) + F.when(F.col("_parent") & filled("message_id"), 5).otherwise(0) + F.when(F.col("parent_id").isNotNull(), 3).otherwise(0)
    return thin.withColumn("base", base).drop("_parent", "parent_id")


_GROUP = ["normalized_subject", "base"]


def _best(found: DataFrame) -> DataFrame:
    """The candidate of most points of each probe, with its columns ``probe``, ``cell`` and the rest as ``m``."""
    score = F.col("cell.value.base") + gap_points(F.col("probe.ts") - F.col("cell.ts"))
    order = F.struct((-score).alias("s"), F.col("cell.key").alias("k"), F.col("cell.pos").alias("p"))
    best = found.groupBy(F.col("probe.pos").alias("pos")).agg(F.min_by(F.struct("probe", "group", "upto", "cell", score.cast("int").alias("score")), order).alias("m"))
    return best.select("pos", F.col("m.cell.value.message_id").alias("parent_id"), F.col("m.score").alias("match_score"), (F.col("m.probe.ts") - F.col("m.cell.ts")).alias("gap_seconds"), "m")


def _subject_candidates(states: DataFrame) -> tuple[DataFrame, DataFrame]:
    sources = states.filter(filled("message_id")).select(*_GROUP, "ts", "key", "pos", F.struct("id", "message_id", "base", F.col("orphan_status").alias("status")).alias("value"))
    orphans = states.filter("orphan_status = 'orphan_reply'").select("normalized_subject", F.struct("pos", "id", "ts").alias("probe"))
    classes = sources.select(*_GROUP).distinct()  # a subject has at most a handful of point classes
    return candidates(orphans.join(classes, "normalized_subject"), sources, _GROUP)


_LINK = ("pos", "parent_id", "match_score", "gap_seconds")


def match_by_subject(classified: DataFrame, loop_free: bool = False) -> DataFrame:
    """(pos, parent_id, match_score, gap_seconds) of every orphan reply that finds a parent under its subject.

    loop_free: a link that closes a loop gives way to the mail's next candidate.
    """
    return match_with_rejections(classified)[0] if loop_free else _best(_subject_candidates(cut(_states(classified)))[0]).select(*_LINK)


#: Sources that one task may hold while it settles the loops, about 100 bytes each with their copies.
MOST_SOURCES = 4_000_000
#: Further candidates looked up at a time for a mail that gives its link up.
AHEAD = 256
_SETTLE = ("kind", "group", "pos", "id", "ts", "base", "key", "top", "cell")
_SETTLED = "pos bigint, cell bigint, match_score int, gap_seconds bigint, rejected boolean"


def match_with_rejections(classified: DataFrame, one_task: int = MOST_SOURCES) -> tuple[DataFrame, DataFrame]:
    """(links without loops, (pos, parent_id) of the candidates rejected on the way).

    Loops share no link, and taking a link out of one leaves the others as they are; so what comes out does not
    depend on the order in which loops are broken, and one task may follow them to the end, whatever the number of
    rounds. It holds the sources under the subjects of links that may ever lie on a loop. Of more than one_task
    of them the rounds are made by joins.
    """
    states = cut(_states(classified))
    found, cells = _subject_candidates(states)
    forest = _forest(classified)
    best = cut(_best(found))
    steps = cut(_steps(forest, best.select("pos", "parent_id")))
    if not loops(steps).take(1):
        return best.select(*_LINK), best.filter(F.lit(False)).select("pos", "parent_id")
    # A mail gives its first link up only on a loop, so a link that ends at a mail without one stays.
    risky = steps.join(steps.select(F.col("node").alias("parent")), "parent", "left_semi").select(F.col("node").alias("pos"), F.col("parent").alias("top"))
    risky = cut(states.select("pos", "id", "ts", "normalized_subject").join(risky, "pos").join(best.select("pos", F.col("m.cell.pos").alias("cell")), "pos"))
    subjects = broadcast_if_small(cut(risky.groupBy("normalized_subject").agg(F.min("pos").alias("group"))), written=True)
    nothing = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
    tops = forest.select("message_id", "top")
    sources = states.filter(filled("message_id")).join(subjects, "normalized_subject").join(tops, "message_id")
    sources = cut(sources.select(F.lit(1).alias("kind"), "group", "pos", "id", "ts", F.col("base").cast("bigint").alias("base"), "key", "top", *nothing("bigint", "cell")).select(*_SETTLE))
    if sources.count() > one_task:
        return _rounds(found, cells, forest)
    asking = risky.join(subjects, "normalized_subject").select(F.lit(0).alias("kind"), "group", "pos", "id", "ts", *nothing("bigint", "base"), *nothing("string", "key"), "top", "cell")
    moved = cut(cut(asking.select(*_SETTLE)).unionByName(sources).coalesce(1).mapInArrow(_settle, _SETTLED))
    gone = broadcast_if_small(cut(moved.select("pos").distinct()), written=True)
    named = moved.join(states.select(F.col("pos").alias("cell"), F.col("message_id").alias("parent_id")), "cell")
    links = best.join(gone, "pos", "left_anti").select(*_LINK).unionByName(named.filter("not rejected").select(*_LINK))
    return links, named.filter("rejected").select("pos", "parent_id")


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Breaks the loops one after another: the last candidate of each mail that gave a link up, and the rejected ones."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    rows = {c: pa.concat_arrays([b.column(c) for b in got]) for c in _SETTLE}
    numbers = lambda c: pc.fill_null(rows[c], -1 if c == "kind" else NOWHERE).to_numpy(zero_copy_only=False)
    kind, group, pos, base, top, cell = (numbers(c) for c in ("kind", "group", "pos", "base", "top", "cell"))
    ts = pc.cast(rows["ts"], pa.float64()).to_numpy(zero_copy_only=False)
    codes = lambda c: rows[c].dictionary_encode()
    id_ = pc.fill_null(codes("id").indices, -1).to_numpy(zero_copy_only=False)
    keys = codes("key")
    rank = np.empty(len(keys.dictionary) + 1, np.int64)
    rank[pc.sort_indices(keys.dictionary).to_numpy()] = np.arange(len(keys.dictionary))
    key = rank[pc.fill_null(keys.indices, len(keys.dictionary)).to_numpy(zero_copy_only=False)]
    mine, at = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    mine = mine[np.argsort(pos[mine])]
    at = at[np.lexsort((pos[at], key[at], group[at]))]
    node, up = pos[mine], _index(pos[mine], top[mine])
    s_pos, s_up, s_ts, s_id, s_base = pos[at], _index(node, top[at]), ts[at], id_[at], base[at]
    starts = np.flatnonzero(np.diff(group[at], prepend=NOWHERE))
    span = dict(zip(group[at][starts].tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(at)])))
    by_pos = np.argsort(s_pos)
    now = by_pos[np.searchsorted(s_pos[by_pos], cell[mine])].tolist()  # the source each mail is linked to
    ahead: dict[int, list[int]] = {}

    def ranked(i: int) -> tuple[int, np.ndarray, np.ndarray]:
        """Where the sources of mail i begin, the place of each in its order of preference (in units of their number by score), and their gaps."""
        lo, hi = span[group[mine[i]]]
        gap = ts[mine[i]] - s_ts[lo:hi]
        near = np.zeros(hi - lo, np.int64)
        for limit, points in reversed(GAPS):
            near[gap < limit] = points
        return lo, (100 - s_base[lo:hi] - near) * (hi - lo) + np.arange(hi - lo), gap

    def next_ones(i: int) -> list[int]:
        lo, order, gap = ranked(i)
        own = id_[mine[i]]
        n = len(order)
        open_ = order[~(gap <= 0) & (s_id[lo : lo + n] != own) & (s_id[lo : lo + n] >= 0) & (order > order[now[i] - lo]) & (own >= 0)]
        if len(open_) > AHEAD:
            open_ = np.partition(open_, AHEAD - 1)[:AHEAD]
        return (lo + np.sort(open_)[::-1] % n).tolist()

    links, into, gone = up.tolist(), s_up.tolist(), []

    def give_up(i: int) -> None:
        gone.append((i, now[i]))
        if not ahead.get(i):
            ahead[i] = next_ones(i)
        now[i] = ahead[i].pop() if ahead[i] else -1
        links[i] = into[now[i]] if now[i] >= 0 else -1

    seen, walk = [0] * len(node), 0
    ring, loop = _ring(node, np.where(up < 0, NOWHERE, node[up])) if len(node) else (node, node)
    last: dict[int, int] = {}
    for i, of in zip(np.searchsorted(node, ring).tolist(), loop.tolist()):
        last[of] = max(i, last.get(of, -1))
    for i in last.values():
        # A new loop holds the mail whose link changed, so only its chain is followed; other loops have their turn.
        while True:
            give_up(i)
            walk += 1
            latest, to = i, links[i]
            while to >= 0 and to != i and seen[to] != walk:
                seen[to] = walk
                latest, to = max(latest, to), links[to]
            if to != i:
                break
            i = latest

    out = [(i, x, True) for i, x in gone] + [(i, now[i], False) for i in sorted({i for i, _ in gone}) if now[i] >= 0]
    score, gaps = [], []
    for i, x, rejected in out:
        gap = ts[mine[i]] - s_ts[x]
        gaps.append(None if np.isnan(gap) else int(gap))
        score.append(int(s_base[x]) + next((p for limit, p in GAPS if gap < limit), 0))
    columns = [pa.array([int(node[i]) for i, _, _ in out], pa.int64()), pa.array([int(s_pos[x]) for _, x, _ in out], pa.int64()), pa.array(score, pa.int32()), pa.array(gaps, pa.int64()), pa.array([r for _, _, r in out], pa.bool_())]
    yield pa.RecordBatch.from_arrays(columns, ["pos", "cell", "match_score", "gap_seconds", "rejected"])


def _index(node: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in the sorted node, -1 for what is not there."""
    if not len(node):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(node, wanted), len(node) - 1)
    return np.where(node[at] == wanted, at, -1)


def _rounds(found: DataFrame, cells: DataFrame, forest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``match_with_rejections`` by joins, each round taking one link out of every loop."""
    rejected = None
    while True:
        best = cut(_best(found))
        closing = cut(closing_links(forest, best.select("pos", "parent_id")))
        if not closing.take(1):
            none = best.filter(F.lit(False)).select("pos", "parent_id")
            return best.select(*_LINK), none if rejected is None else rejected
        out = best.join(broadcast_if_small(closing, written=True), "pos", "left_semi")
        rejected = out.select("pos", "parent_id") if rejected is None else rejected.unionByName(out.select("pos", "parent_id"))
        taken = cut(out.select("m.probe", "m.group", "m.upto", "m.cell"))
        gone = taken.select(F.col("probe.pos").alias("_pos"), F.col("group").alias("_group"), F.col("upto").alias("_upto"))
        same = (F.col("probe.pos") == F.col("_pos")) & (F.col("group") == F.col("_group")) & (F.col("upto") == F.col("_upto"))
        next_ = _without_self(cut(behind(taken, cells, _GROUP)), cells, _GROUP)
        found = cut(found.join(broadcast_if_small(gone, written=True), same, "left_anti").unionByName(next_))


def link_kinds(classified: DataFrame, links: DataFrame) -> DataFrame:
    """(to_kind, n) of links: to a root, to a mail that then has several children, or to one link of a chain.

    Links count one after another by pos: a mail has several children from the second link to it on, those that
    headers gave it included. Only counts of each parent are compared, its first two links told from the rest.
    """
    by_header = replies.children_of(classified).select(F.col("message_id").alias("parent_id"), F.col("n_children").alias("_had"))
    last = classified.filter(filled("message_id")).groupBy("message_id").agg(F.max_by("orphan_status", "pos").alias("_status"))
    to = links.groupBy("parent_id").agg(F.count("*").alias("_n")).join(by_header, "parent_id", "left")
    to = to.join(last.withColumnRenamed("message_id", "parent_id"), "parent_id").withColumn("_had", F.coalesce("_had", F.lit(0)))
    root = F.col("_status") == "true_root"
    first = F.when(root | (F.col("_had") > 0), 0).otherwise(1)  # the first link to a mail without children
    kinds = to.select(F.explode(F.array(F.struct(F.lit("to_root").alias("k"), F.when(root, F.col("_n")).otherwise(0).alias("n")), F.struct(F.lit("to_parent").alias("k"), F.when(root, 0).otherwise(F.col("_n") - first).alias("n")), F.struct(F.lit("to_chain").alias("k"), F.when(root, 0).otherwise(first).alias("n")))).alias("x"))
    return kinds.groupBy(F.col("x.k").alias("to_kind")).agg(F.sum("x.n").alias("n")).filter("n > 0")


def subject_match_stats(classified: DataFrame) -> DataFrame:
    """One row: orphans before, matched and unmatched, candidates rejected because they close a loop, roots and children after."""
    links, rejected = match_with_rejections(classified)
    return _one_row(
        classified.agg(F.count("*").alias("total_emails"), F.count_if(F.col("orphan_status") == "orphan_reply").alias("orphans_before"), F.count_if(F.col("parent_id").isNull()).alias("_roots")),
        links.agg(F.count("*").alias("orphans_matched")),
        rejected.agg(F.count("*").alias("cycles_prevented")),
    ).select("total_emails", "orphans_before", "orphans_matched", (F.col("orphans_before") - F.col("orphans_matched")).alias("orphans_unmatched"), "cycles_prevented", (F.col("_roots") - F.col("orphans_matched")).alias("root_messages_after"), (F.col("total_emails") - F.col("_roots") + F.col("orphans_matched")).alias("child_messages_after"))


def _one_row(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Single rows side by side."""
    out = first.withColumn("_one", F.lit(1))
    for df in rest:
        out = out.join(F.broadcast(df.withColumn("_one", F.lit(1))), "_one")  # a single row
    return out.drop("_one")


# --- subjects in archive order

_ROWS = ("pos", "mid", "parent", "subject", "mail", "status", "ts", "key", "n_children")
_ORDERED = "pos bigint, cell bigint, match_score int, gap_seconds bigint, to_kind string"
_NO_CANDIDATE = -100
_ROOT, _ORPHAN = 0, 1


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Orphans of whole components in archive order; each sees the links made before it."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    rows = {c: pa.concat_arrays([b.column(c) for b in got]) for c in _ROWS}
    del got
    order = np.argsort(rows["pos"].to_numpy(), kind="stable")
    pos, mid, parent, subject, mail, status, children = (pc.fill_null(rows[c], NOWHERE).to_numpy(zero_copy_only=False)[order] for c in ("pos", "mid", "parent", "subject", "mail", "status", "n_children"))
    ts = pc.cast(rows["ts"], pa.float64()).to_numpy(zero_copy_only=False)[order]
    keys = rows["key"].dictionary_encode()
    rank = np.empty(len(keys.dictionary), np.int64)
    rank[pc.sort_indices(keys.dictionary).to_numpy()] = np.arange(len(rank))
    key = rank[keys.indices.to_numpy()][order]
    del rows, keys
    # Messages by number; of several copies the last one's parent counts.
    names = np.unique(mid[mid != NOWHERE])
    message = _index(names, mid)
    above = np.full(len(names), -1)
    above[message[message >= 0]] = _index(names, parent)[message >= 0]
    above = above.tolist()
    # Mails with a subject side by side by subject, date and place; scores without nearness, kept up to date.
    there = np.flatnonzero(subject != NOWHERE)
    there = there[np.lexsort((there, key[there], subject[there]))]
    place_ = np.full(len(pos), -1)
    place_[there] = np.arange(len(there))
    first = np.flatnonzero(np.diff(subject[there], prepend=NOWHERE))
    span = dict(zip(subject[there][first].tolist(), zip(first.tolist(), [*first[1:].tolist(), len(there)])))
    when = ts[there]
    base = ((status[there] == _ROOT) * 10 + (children[there] > 0) * 5 + (parent[there] != NOWHERE) * 3).astype(np.int8)
    base[message[there] < 0] = _NO_CANDIDATE
    by_mail = there[np.argsort(mail[there], kind="stable")]
    of_mail = mail[by_mail]

    def closes_loop(child: int, at: int) -> bool:
        seen = set()
        while at >= 0:
            if at == child or at in seen:
                return True
            seen.add(at)
            at = above[at]
        return False

    out = []
    for i in np.flatnonzero((status == _ORPHAN) & (subject != NOWHERE)).tolist():
        lo, hi = span[int(subject[i])]
        if hi - lo < 2:
            continue
        gap = ts[i] - when[lo:hi]
        score = base[lo:hi].copy()
        for (limit, points), (_, less) in zip(GAPS, (*GAPS[1:], (None, 0))):
            score += (gap < limit) * np.int8(points - less)
        score[gap <= 0] = _NO_CANDIDATE
        l, r = np.searchsorted(of_mail, mail[i]), np.searchsorted(of_mail, mail[i], "right")
        copies = place_[by_mail[l:r]] - lo
        score[copies[(copies >= 0) & (copies < hi - lo)]] = _NO_CANDIDATE
        while (k := int(score.argmax())) >= 0 and score[k] >= 0:
            j = int(there[lo + k])
            if closes_loop(int(message[i]), int(message[j])):
                score[k] = _NO_CANDIDATE
                continue
            kind = "to_root" if status[j] == _ROOT else "to_parent" if children[j] > 0 else "to_chain"
            out.append((int(pos[i]), int(pos[j]), int(score[k]), None if np.isnan(gap[k]) else int(gap[k]), kind))
            if message[i] >= 0:
                base[place_[i]] += 3
                above[message[i]] = int(message[j])
            base[lo + k] += 5 * (children[j] == 0)
            children[j] += 1
            break
    yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()))], ["pos", "cell", "match_score", "gap_seconds", "to_kind"])


def match_in_order(classified: DataFrame, most: int | None = None) -> DataFrame:
    """(pos, parent_id, match_score, gap_seconds, to_kind): subject matches made one after another in archive order.

    The same scores as ``match_by_subject``, but each match sees the ones before it, and a candidate that would
    close a loop is passed over for the next best. This is sequential by nature: mails that hang together through
    subjects, links or copies are settled by one task over rows of numbers, about 100 bytes a mail, and time grows
    with the orphans of a subject times its mails. With ``most``, larger groups are refused.
    """
    counts = replies.children_of(classified).select("message_id", "n_children")
    status = F.when(F.col("orphan_status") == "true_root", _ROOT).when(F.col("orphan_status") == "orphan_reply", _ORPHAN).otherwise(2).cast("bigint").alias("status")
    thin = classified.select("pos", "id", F.coalesce("message_id", F.lit("")).alias("message_id"), "parent_id", "normalized_subject", status, local_seconds(F.col("date_parsed")).cast("bigint").alias("ts"), _date_key().alias("key"))
    thin = cut(thin.join(counts, "message_id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))))
    least = lambda c, name: thin.filter(filled(c)).groupBy(c).agg(F.min("pos").alias(name))
    named = thin.join(least("message_id", "mid"), "message_id", "left").join(least("message_id", "parent").withColumnRenamed("message_id", "parent_id"), "parent_id", "left")
    named = named.join(least("normalized_subject", "subject"), "normalized_subject", "left").join(least("id", "mail"), "id", "left")
    rows = cut(named.select(*_ROWS))
    to = lambda c: rows.filter(F.col(c).isNotNull()).select(F.col("pos").alias("a"), F.col(c).alias("b"))
    parts = cut(connected_components(rows.select(F.col("pos").alias("node")), to("subject").unionByName(to("mid")).unionByName(to("parent"))))
    if most is not None and (largest := parts.groupBy("component").count().agg(F.max("count")).first()[0] or 0) > most:
        raise ValueError(f"{largest} mails hang together, more than the {most} asked for")
    together = rows.join(parts, F.col("pos") == F.col("node")).repartition("component").select(*_ROWS)
    found = cut(together.mapInArrow(_in_order, _ORDERED))
    names = thin.select(F.col("pos").alias("cell"), F.col("message_id").alias("parent_id"))
    return found.join(names, "cell").select("pos", "parent_id", "match_score", "gap_seconds", "to_kind")


def match_kinds(matches: DataFrame) -> DataFrame:
    """(to_kind, n) of matches made in order: to a root, to a mail that then has several children, or to one link of a chain."""
    return matches.groupBy("to_kind").agg(F.count("*").alias("n"))


def gap_histogram(matches: DataFrame) -> DataFrame:
    g = F.col("gap_seconds")
    bucket = F.when(g < DAY, "same_day").when(g < 7 * DAY, "within_week").when(g < SLICE, "within_month").otherwise("over_month")
    return matches.filter("gap_seconds is not null").groupBy(bucket.alias("gap")).agg(F.count("*").alias("n"))


# --- quoted lines

LEAST_QUOTE, LEAST_LINE, LEAST_KEY, LEAST_BODY, PROBES = 20, 30, 20, 50, 5


def quoted_lines(mails: DataFrame) -> DataFrame:
    """(pos, ordinal, quote): quoted lines longer than LEAST_QUOTE without their marks, counted from 0."""
    lines = F.transform(F.split(F.coalesce(F.col("body"), F.lit("")), "\n"), strip)
    marked = F.transform(F.filter(lines, lambda x: x.startswith(">")), lambda x: F.regexp_replace(x, r"\A>+(?U:\s*)", ""))
    kept = F.filter(marked, lambda x: F.length(x) > LEAST_QUOTE)
    return mails.select("pos", F.posexplode(kept).alias("ordinal", "quote"))


def body_lines(mails: DataFrame) -> DataFrame:
    """(pos, line_key): comparable forms of the substantial lines of substantial bodies."""
    long = mails.filter(F.length("body") >= LEAST_BODY)
    kept = F.filter(F.transform(F.split("body", "\n"), strip), lambda x: F.length(x) > LEAST_LINE)
    return long.select("pos", F.explode(kept).alias("line")).select("pos", normalize_for_matching(F.col("line")).alias("line_key")).filter(F.length("line_key") > LEAST_KEY)


_ANYWHERE = "\x00"  # no normalized subject; stands for all of them


def related_subjects(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """(mine, theirs): each subject with the others that hold it or that it holds; empty subjects aside.

    Subjects are not compared with one another: the longer one is cut into its pieces of the lengths that occur,
    and pieces meet subjects in an equi-join. What comes out are true containments only.
    """
    def held(long: DataFrame, short: DataFrame) -> DataFrame:
        """(long, short) of single-column tables of distinct texts."""
        short = short.filter("short <> ''")
        sizes = short.agg(F.array_sort(F.collect_set(F.length("short"))).alias("_sizes")).withColumn("_one", F.lit(1))  # no longer than the longest subject
        n = F.length("long")
        pieces = F.flatten(F.transform(F.filter("_sizes", lambda k: k < n), lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(F.col("long"), i, k))))
        cut_up = long.withColumn("_one", F.lit(1)).join(F.broadcast(sizes), "_one").select("long", F.explode(F.array_distinct(pieces)).alias("short"))
        return cut_up.join(short, "short")

    down = held(mine.select(F.col("mine").alias("long")), theirs.select(F.col("theirs").alias("short"))).select(F.col("long").alias("mine"), F.col("short").alias("theirs"))
    up = held(theirs.select(F.col("theirs").alias("long")), mine.select(F.col("mine").alias("short"))).select(F.col("short").alias("mine"), F.col("long").alias("theirs"))
    return down.unionByName(up).distinct()


def match_by_quotes(classified: DataFrame, bodies: DataFrame | None = None) -> DataFrame:
    """(pos, parent_id, quote_match_score) of every root that quotes an earlier mail.

    Bodies, which stand in classified or by pos in ``bodies``, are reduced to quoted lines and to keys of those lines
    that some root quotes where they are read; only keys, never bodies, are joined. A source scores 1, 10 more under
    the same subject, 5 more if one subject holds the other, and points for nearness.
    """
    roots = classified.filter("orphan_status = 'true_root' and normalized_subject <> ''")
    quotes = quoted_lines(roots) if bodies is None else quoted_lines(bodies).join(roots.select("pos"), "pos", "left_semi")
    quotes = quotes.filter(F.col("ordinal") < PROBES).withColumn("line_key", normalize_for_matching(F.col("quote"))).filter(F.length("line_key") >= LEAST_KEY)
    bodies = spread((classified if bodies is None else bodies).select("pos", "body"))
    about = classified.select("pos", "id", "message_id", "normalized_subject", local_seconds(F.col("date_parsed")).alias("ts"))
    asking = cut(quotes.select("pos", "ordinal", "line_key"))
    probes = about.drop("message_id").join(asking, "pos").withColumnRenamed("normalized_subject", "subject")
    probes = cut(probes.select("line_key", "subject", F.struct("pos", "ordinal", "id", "ts", F.col("subject")).alias("probe")))
    keys = cut(asking.select("line_key").distinct())
    lines = cut(body_lines(bodies).join(broadcast_if_small(keys, written=True), "line_key", "left_semi").distinct())
    sources = about.filter(filled("message_id")).join(lines, "pos")
    value = F.struct("id", "message_id", F.col("normalized_subject").alias("subject")).alias("value")
    by_date = F.coalesce(F.lpad((F.col("ts") + 10**12).cast("string"), 15, "0"), F.lit("~")).alias("key")  # sorts as the date does, unknown ones last
    sources = cut(sources.select("line_key", F.col("normalized_subject").alias("subject"), "ts", by_date, "pos", value))
    # Under the same subject, under the empty subject (which every subject holds), under subjects that hold one another, and anywhere.
    groups = cut(sources.select("line_key", "subject").distinct())
    related = related_subjects(probes.select(F.col("subject").alias("mine")).distinct(), groups.select(F.col("subject").alias("theirs")).distinct())
    held = probes.withColumnRenamed("subject", "mine").join(related, "mine").select("line_key", F.col("theirs").alias("subject"), "probe")
    near = probes.unionByName(probes.withColumn("subject", F.lit(""))).unionByName(held).join(groups, ["line_key", "subject"], "left_semi")
    everywhere = lambda df: df.withColumn("subject", F.lit(_ANYWHERE))
    found, _ = candidates(cut(near.unionByName(everywhere(probes))), sources.unionByName(everywhere(sources)), ["line_key", "subject"])
    mine, theirs = F.col("probe.subject"), F.col("cell.value.subject")
    relation = F.when(mine == theirs, 10).when(F.contains(mine, theirs) | F.contains(theirs, mine), 5).otherwise(0)
    score = (1 + relation + gap_points(F.col("probe.ts") - F.col("cell.ts"))).cast("int")
    order = F.struct((-score).alias("s"), F.col("probe.ordinal").alias("o"), F.col("cell.key").alias("k"), F.col("cell.pos").alias("p"))
    best = found.groupBy(F.col("probe.pos").alias("pos")).agg(F.min_by(F.struct(F.col("cell.value.message_id").alias("message_id"), score.alias("score")), order).alias("b"))
    return best.select("pos", F.col("b.message_id").alias("parent_id"), F.col("b.score").alias("quote_match_score"))


def quote_match_stats(classified: DataFrame) -> DataFrame:
    """One row: roots, roots with quoted lines, links found, links rejected because they close a loop, and roots without a source.

    Roots without a subject and rejected links count in neither outcome.
    """
    roots = classified.filter("orphan_status = 'true_root'")
    quoting = cut(quoted_lines(roots).select("pos").distinct())
    able = roots.filter("normalized_subject <> ''").select("pos").join(quoting, "pos", "left_semi")
    found = cut(match_by_quotes(classified))
    kept = drop_loops(classified, found)
    counts = _one_row(roots.agg(F.count("*").alias("true_roots_checked")), quoting.agg(F.count("*").alias("roots_with_quotes")), able.agg(F.count("*").alias("_able")), found.agg(F.count("*").alias("_found")), kept.agg(F.count("*").alias("matches_found")))
    return counts.select("true_roots_checked", "roots_with_quotes", "matches_found", (F.col("_found") - F.col("matches_found")).alias("cycles_prevented"), (F.col("_able") - F.col("_found")).alias("no_match_found"))


# --- nearness in time

MAX_DAYS, LEAST_SUBJECT = 3, 3


def _time_roots(classified: DataFrame) -> DataFrame:
    subject = F.col("normalized_subject")
    return classified.filter((F.col("orphan_status") == "true_root") & (F.length(subject) > LEAST_SUBJECT)).select("pos", "message_id", subject.alias("subject"), local_seconds(F.col("date_parsed")).alias("ts"))


def _anchored(roots: DataFrame, max_days: int) -> DataFrame:
    """(pos, ts, cell) of dated roots, cell being the anchor (-ts, -pos, message_id) of each, its own for an anchor."""
    window = (max_days + 1) * DAY
    me = F.struct("ts", "pos").alias("probe")
    here = place(F.col("ts"), F.lit(""), F.col("pos")).alias("at")
    cells = roots.select("subject", here, F.struct("ts", "pos", "message_id").alias("cell"))
    # One look-up answers two questions: the first root in the window before a root, the root itself included (if it
    # is itself, it opens a stretch), and the first root at least one window later.
    at = lambda ahead, ts: F.struct(place(ts).alias("at"), F.lit(ahead).alias("ahead"))
    asked = roots.select("subject", "ts", "pos", F.explode(F.array(at(False, F.col("ts") - window + 1), at(True, F.col("ts") + window))).alias("w"))
    near = next_after(asked.select("subject", F.col("w.at").alias("at"), F.struct("pos", F.col("w.ahead").alias("ahead")).alias("probe")), cells, ["subject"])
    steps = near.groupBy(F.col("probe.pos").alias("node")).agg(F.max(F.when(F.col("probe.ahead"), F.col("cell.pos"))).alias("parent"), F.max((~F.col("probe.ahead") & (F.col("cell.pos") == F.col("probe.pos"))).cast("int")).alias("weight"))
    # Anchors are the openers and what is reached from them: nodes with an opener at or below them, links leading later.
    reached = sums_below(cut(steps)).filter("total > 0").select("node")
    anchors = roots.join(reached, F.col("pos") == F.col("node"), "left_semi")
    # The last anchor not after a root, looked for backwards in time.
    back = anchors.select("subject", place(-F.col("ts"), F.lit(""), -F.col("pos")).alias("at"), F.struct((-F.col("ts")).alias("ts"), (-F.col("pos")).alias("pos"), "message_id").alias("cell"))
    found = next_after(roots.select("subject", me, place(-F.col("ts"), F.lit(""), -F.col("pos") - 1).alias("at")), back, ["subject"])
    return found.select(F.col("probe.pos").alias("pos"), F.col("probe.ts").alias("ts"), "cell")


def match_by_time(classified: DataFrame, max_days: int = MAX_DAYS) -> DataFrame:
    """(pos, parent_id, time_proximity_days) of roots that follow an anchor root of their subject within the window.

    Anchored, not gap-based: a root later than the window becomes the next anchor. A root without another root
    in the window before it is an anchor in any case; from there "the first root at least one window later" leads
    from anchor to anchor.
    """
    found = _anchored(cut(_time_roots(classified).filter("ts is not null")), max_days)
    linked = found.filter(F.col("cell.pos") != -F.col("pos"))
    return linked.select("pos", F.col("cell.message_id").alias("parent_id"), F.floor((F.col("ts") + F.col("cell.ts")) / DAY).cast("int").alias("time_proximity_days")).filter(filled("parent_id"))


def time_match_stats(classified: DataFrame, max_days: int = MAX_DAYS) -> DataFrame:
    """One row: subjects with several roots, roots in them (undated ones too), links, links rejected because they close a loop, and roots too far from the anchor before them."""
    every = cut(_time_roots(classified))
    groups = every.groupBy("subject").agg(F.count("*").alias("n"), F.count("ts").alias("dated")).filter("n > 1")
    own = _anchored(every.filter("ts is not null"), max_days).filter(F.col("cell.pos") == -F.col("pos"))
    links = cut(match_by_time(classified, max_days))
    kept = drop_loops(classified, links)
    # Every anchor but the first of its subject was too far from the one before.
    counts = _one_row(groups.agg(F.count("*").alias("subjects_with_multi_roots"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_true_roots_in_groups")), every.filter("ts is not null").agg(F.count_distinct("subject").alias("_subjects")), own.agg(F.count("*").alias("_anchors")), links.agg(F.count("*").alias("_links")), kept.agg(F.count("*").alias("matches_found")))
    return counts.select("subjects_with_multi_roots", "total_true_roots_in_groups", "matches_found", (F.col("_links") - F.col("matches_found")).alias("cycles_prevented"), (F.col("_anchors") - F.col("_subjects")).alias("too_far_apart"))


def root_groups(classified: DataFrame) -> DataFrame:
    """(normalized_subject, n_roots, n_dated) of the subjects with several roots."""
    return _time_roots(classified).groupBy(F.col("subject").alias("normalized_subject")).agg(F.count("*").alias("n_roots"), F.count("ts").alias("n_dated")).filter("n_roots > 1")


# --- putting links in


def apply_links(classified: DataFrame, links: DataFrame, status: str) -> DataFrame:
    """classified with the parents of the links put in and the status of those mails set."""
    new = links.select(F.col("pos").alias("_pos"), F.col("parent_id").alias("_new"))
    out = classified.join(new, F.col("pos") == F.col("_pos"), "left")
    hit = F.col("_new").isNotNull()
    return out.withColumn("parent_id", F.coalesce("_new", "parent_id")).withColumn("orphan_status", F.when(hit, status).otherwise(F.col("orphan_status"))).drop("_pos", "_new")


def _forest(before: DataFrame) -> DataFrame:
    """(pos, message_id, top) of the records that stand for their messages: top is the message its chain ends at, NULL on or below a loop."""
    nodes = before.filter(filled("message_id")).groupBy("message_id").agg(F.max("pos").alias("pos"))
    own = cut(before.select("pos", "message_id", "parent_id").join(nodes, ["message_id", "pos"]))
    above = own.select(F.col("message_id").alias("parent_id"), F.col("pos").alias("parent"))
    solved = resolve_forest(cut(own.join(above, "parent_id", "left").select(F.col("pos").alias("node"), "parent")))
    return cut(own.select("pos", "message_id").join(solved.select(F.col("node").alias("pos"), F.col("root").alias("top")), "pos"))


def closing_links(forest: DataFrame, links: DataFrame) -> DataFrame:
    """(pos) of the links to take out: of those on one loop the link of the latest mail. A loop of earlier links stays.

    forest: as of ``_forest``; links: (pos, parent_id) of messages that have no parent yet. Such a message is the
    top of its tree, so a link leads from tree to tree and only the links are followed. A link of a record that
    does not stand for its message closes nothing.
    """
    return loops(_steps(forest, links)).groupBy("loop").agg(F.max("node").alias("pos")).select("pos")


def _steps(forest: DataFrame, links: DataFrame) -> DataFrame:
    """(node, parent): from the top of a tree to the top of the tree that its link leads to."""
    to = forest.select(F.col("message_id").alias("parent_id"), F.col("top").alias("parent"))
    return links.join(forest.select("pos"), "pos", "left_semi").join(to, "parent_id").filter("parent is not null").select(F.col("pos").alias("node"), "parent")


def drop_loops(before: DataFrame, links: DataFrame) -> DataFrame:
    """The links without the one of the latest mail on each loop that they close; a link below a loop stays."""
    links = cut(links)
    return links.join(broadcast_if_small(cut(closing_links(_forest(before), links)), written=True), "pos", "left_anti")

"""Parent-child links to full hierarchies: root, depth, path and descendants of every node, cycles found.

Nodes carry a number that follows their place in the archive, so replies mostly stand near their parents. The
number line is cut into fragments of a fixed span; each fragment follows its own parent chains in memory to
their exits (a root, a loop, or the first node outside). Only nodes that are exits of other fragments remain:
they form a smaller quotient forest, which is solved the same way with wider fragments, and its answer is put
back behind the fragment-local steps. When a round hardly shrinks the forest (links without any locality), the
rest is solved by pointer doubling with joins, so no shape of input needs one large task.

Defined results: NULL and empty ids are no nodes; links to ids outside the table are dropped; of several
parents of one node the least id counts; a node on a loop or below one has root NULL and depth -1; repeated
rows and links count once; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.runtime import broadcast_if_small, cut, filled

#: Width of a fragment on the number line; as numbers are unique, also the most nodes a fragment can have.
SPAN = 1 << 15
#: How much wider the fragments of the next quotient are.
WIDEN = 32
#: Nodes of a quotient forest that one task may solve.
ONE_TASK = 1 << 20

ROOT, OPEN, LOOP = 0, 1, 2
_STEP = "node bigint, exit bigint, hops bigint, state int"
NOWHERE = np.iinfo(np.int64).min  # no node has this number


def contract(node: np.ndarray, exit_: np.ndarray, hops: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Follows chains inside one fragment by pointer doubling: exit, hops and state of each node (node must be sorted)."""
    exit_, hops, state = exit_.copy(), hops.copy(), state.copy()
    for _ in range(max(2, int(len(node)).bit_length() + 1)):
        open_ = np.flatnonzero(state == OPEN)
        at = np.searchsorted(node, exit_[open_])
        at[at == len(node)] = 0
        here = node[at] == exit_[open_]
        at, open_ = at[here], open_[here]
        if not len(open_):
            return exit_, hops, state
        new = exit_[at], hops[open_] + hops[at], state[at]
        exit_[open_], hops[open_], state[open_] = new
    # What still points inside after doubling past the fragment's size goes round in circles.
    open_ = np.flatnonzero(state == OPEN)
    at = np.searchsorted(node, exit_[open_])
    at[at == len(node)] = 0
    state[open_[node[at] == exit_[open_]]] = LOOP
    return exit_, hops, state


def _contract_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    columns = {c: np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in got]) for i, c in enumerate(("frag", "node", "exit", "hops", "state"))}
    order = np.lexsort((columns["node"], columns["frag"]))
    columns = {c: a[order] for c, a in columns.items()}
    for part in np.split(np.arange(len(order)), np.flatnonzero(np.diff(columns["frag"])) + 1):
        node, exit_, hops, state = (columns[c][part] for c in ("node", "exit", "hops", "state"))
        exit_, hops, state = contract(node, exit_, hops, state)
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(exit_), pa.array(hops), pa.array(state.astype(np.int32))], ["node", "exit", "hops", "state"])


def _contracted(steps: DataFrame, fragment) -> DataFrame:
    parted = steps.select(fragment.cast("bigint").alias("frag"), "node", "exit", "hops", F.col("state").cast("int").alias("state"))
    return cut(parted.repartition("frag").mapInArrow(_contract_partition, _STEP))


def _behind(steps: DataFrame, solved: DataFrame) -> DataFrame:
    """Puts the solution of the exits, which is written, behind the open steps."""
    s = solved.select(F.col("node").alias("_n"), F.col("exit").alias("_e"), F.col("hops").alias("_h"), F.col("state").alias("_s"))
    joined = steps.join(broadcast_if_small(s, written=True), (F.col("exit") == F.col("_n")) & (F.col("state") == OPEN), "left")
    open_ = F.col("_n").isNotNull()
    return joined.select(
        "node",
        F.when(open_, F.col("_e")).otherwise(F.col("exit")).alias("exit"),
        F.when(open_, F.col("hops") + F.col("_h")).otherwise(F.col("hops")).alias("hops"),
        F.when(open_, F.col("_s")).otherwise(F.col("state")).alias("state"),
    )


def _doubled(steps: DataFrame, n: int) -> DataFrame:
    """Pointer doubling by joins; for forests without locality."""
    for _ in range(n.bit_length() + 1):
        if not steps.filter(F.col("state") == OPEN).take(1):
            return steps
        steps = cut(_behind(steps, steps))
    return steps.withColumn("state", F.when(F.col("state") == OPEN, LOOP).otherwise(F.col("state")))


def _solve(steps: DataFrame, span: int, n: int | None, one_task: int) -> DataFrame:
    whole = n is not None and n <= one_task
    local = _contracted(steps, F.lit(0) if whole else F.floor(F.col("node") / F.lit(span)))
    if whole or not local.filter(F.col("state") == OPEN).take(1):
        return local
    exits = cut(local.filter(F.col("state") == OPEN).select(F.col("exit").alias("node")).distinct())
    quotient = cut(local.join(broadcast_if_small(exits, written=True), "node", "left_semi"))
    left = quotient.count()
    before = n if n is not None else local.count()
    if left > one_task and left > 0.7 * before:
        solved = _doubled(quotient, left)
    else:
        solved = _solve(quotient, span * WIDEN, left, one_task)
        solved = cut(solved) if left > one_task else solved
    return _behind(local, solved)


def resolve_forest(links: DataFrame, span: int = SPAN, one_task: int = ONE_TASK) -> DataFrame:
    """(node, root, depth) of links (node BIGINT unique, parent BIGINT or NULL, itself a node); root NULL and depth -1 at and below loops."""
    start = links.select(
        "node",
        F.coalesce("parent", "node").alias("exit"),
        F.when(F.col("parent").isNull(), 0).otherwise(1).cast("bigint").alias("hops"),
        F.when(F.col("parent").isNull(), ROOT).otherwise(OPEN).alias("state"),
    )
    done = _solve(start, span, None, one_task)
    rooted = F.col("state") == ROOT
    return done.select("node", F.when(rooted, F.col("exit")).alias("root"), F.when(rooted, F.col("hops")).otherwise(-1).cast("bigint").alias("depth"))


def _ring(node: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, loop) of the nodes on loops; a chain whose parent is no node ends there."""
    order = np.argsort(node)
    node, parent = node[order], parent[order]
    n = len(node)
    up = np.searchsorted(node, parent)
    up[(up == n) | (node[np.minimum(up, n - 1)] != parent)] = n
    up = np.append(up, n)  # the place where chains end
    at = up
    for _ in range(n.bit_length()):
        at = at[at]
    on = np.unique(at)  # where chains are after more steps than there are nodes
    on = on[on < n]
    least, at = np.append(node, NOWHERE), up
    for _ in range(len(on).bit_length()):
        least, at = np.minimum(least, least[at]), at[at]
    return node[on], least[on]


def _rings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = [b for b in batches if b.num_rows]
    if got:
        node, parent = (np.concatenate([b.column(i).to_numpy() for b in got]) for i in range(2))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _ring(node, parent)], ["node", "loop"])


def loops(steps: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, loop) of the nodes that lie on a loop, loop being its least node.

    steps: (node BIGINT unique, parent BIGINT); a chain ends at a parent that is no node. Up to one_task of them
    are settled by one task, more by pointer doubling with joins.
    """
    steps = cut(steps)
    n = steps.count()
    if n <= one_task:
        return cut(steps.coalesce(1).mapInArrow(_rings, "node bigint, loop bigint"))
    above = lambda df, *more: df.select(F.col("node").alias("up"), F.col("up").alias("_up"), *more)
    at = steps.select("node", F.col("parent").alias("up"))
    for _ in range(n.bit_length()):  # chains that end drop out
        at = cut(at.join(above(at), "up").select("node", F.col("_up").alias("up")))
    on = at.select(F.col("up").alias("node")).distinct()
    ring = cut(steps.join(on, "node", "left_semi").select("node", F.col("parent").alias("up"), F.col("node").alias("loop")))
    for _ in range(n.bit_length()):
        ring = cut(ring.join(above(ring, F.col("loop").alias("_loop")), "up").select("node", F.col("_up").alias("up"), F.least("loop", "_loop").alias("loop")))
    return ring.select("node", "loop")


# --- sums along the forest


def sums_above(links: DataFrame, span: int = SPAN, one_task: int = ONE_TASK) -> DataFrame:
    """(node, total): the weights of each node and all nodes above it, of a forest (node, parent, weight) without loops."""
    top = F.col("parent").isNull()
    start = links.select("node", F.coalesce("parent", "node").alias("exit"), F.col("weight").cast("bigint").alias("hops"), F.when(top, ROOT).otherwise(OPEN).alias("state"))
    return _solve(start, span, None, one_task).select("node", F.col("hops").alias("total"))


_SUMS = "node bigint, parent bigint, weight bigint, exit bigint, total bigint, top boolean"


def _sum_fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each node the sum of its fragment's nodes at and below it, and the node through which its chain leaves the fragment."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    frag, node, parent, weight = (np.concatenate([pc.fill_null(b.column(i), NOWHERE).to_numpy(zero_copy_only=False) for b in got]) for i in range(4))
    order = np.lexsort((node, frag))
    frag, node, parent, weight = frag[order], node[order], parent[order], weight[order]
    for part in np.split(np.arange(len(node)), np.flatnonzero(np.diff(frag)) + 1):
        own, up = node[part], parent[part]
        root = up == NOWHERE
        state = np.where(root, ROOT, OPEN)
        exit_, hops, state = contract(own, np.where(root, own, up), np.where(root, 0, 1), state)
        at = np.searchsorted(own, up)
        at[at == len(own)] = 0
        inside = ~root & (own[at] == up)
        total = weight[part].tolist()
        above = np.where(inside, at, -1).tolist()
        for i in np.argsort(-hops, kind="stable").tolist():  # the farthest from the top first
            if above[i] >= 0:
                total[above[i]] += total[i]
        left = state == OPEN
        yield pa.RecordBatch.from_arrays(
            [pa.array(own), pa.array(up, mask=root), pa.array(weight[part]), pa.array(exit_, mask=~left), pa.array(total, pa.int64()), pa.array(left & ~inside)],
            ["node", "parent", "weight", "exit", "total", "top"],
        )


def _doubled_sums(links: DataFrame, n: int) -> DataFrame:
    """Sums below by pointer doubling with joins: each round adds the nodes twice as far below."""
    at = links.select("node", F.col("parent").alias("up"), F.col("weight").alias("total"))
    for _ in range(n.bit_length()):
        if not at.filter("up is not null").take(1):
            break
        lower = at.filter("up is not null").groupBy(F.col("up").alias("node")).agg(F.sum("total").alias("_more"))
        above = at.select(F.col("node").alias("up"), F.col("up").alias("_up"))
        at = cut(at.join(lower, "node", "left").join(above, "up", "left").select("node", F.col("_up").alias("up"), (F.col("total") + F.coalesce("_more", F.lit(0))).alias("total")))
    return at.select("node", "total")


def sums_below(links: DataFrame, span: int = SPAN, one_task: int = ONE_TASK, n: int | None = None) -> DataFrame:
    """(node, total): the weights of each node and all nodes below it, of a forest (node, parent, weight) without loops.

    Fragments sum what they hold; what leaves a fragment is one number for each node it leaves through, and these
    nodes form the quotient forest, solved the same way. Linear in the nodes, whatever the depth.
    """
    whole = n is not None and n <= one_task
    frag = (F.lit(0) if whole else F.floor(F.col("node") / F.lit(span))).cast("bigint").alias("frag")
    summed = lambda df: df.select(frag, "node", "parent", F.col("weight").cast("bigint").alias("weight")).repartition("frag").mapInArrow(_sum_fragments, _SUMS)
    local = cut(summed(links))
    if whole or not local.filter("top").take(1):
        return local.select("node", "total")
    direct = cut(local.filter("top").groupBy(F.col("exit").alias("node")).agg(F.sum("total").alias("weight")))
    left = direct.count()
    quotient = cut(local.drop("weight").join(broadcast_if_small(direct, written=True), "node").select("node", F.col("exit").alias("parent"), "weight"))
    before = n if n is not None else local.count()
    into = _doubled_sums(quotient, left) if left > one_task and left > 0.7 * before else sums_below(quotient, span * WIDEN, one_task, left)
    into = cut(into.select("node", F.col("total").alias("_into")))
    again = local.select("node", "parent", "weight").join(broadcast_if_small(into, written=True), "node", "left")
    return cut(summed(again.select("node", "parent", (F.col("weight") + F.coalesce("_into", F.lit(0))).alias("weight")))).select("node", "total")


def message_nodes(emails: DataFrame) -> DataFrame:
    """(message_id, node): each distinct non-empty message id with the least pos of its rows, which is unique.

    A message none of whose rows has a pos gets a negative number from its id.
    """
    unplaced = -F.shiftrightunsigned(F.xxhash64("message_id"), 1) - 1
    return emails.filter(filled("message_id")).groupBy("message_id").agg(F.min("pos").alias("_pos")).select("message_id", F.coalesce("_pos", unplaced).alias("node"))


def message_links(emails: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, parent) over both ends of the links; parent NULL at roots."""
    up = emails.filter(filled("message_id") & filled("parent_id")).select(F.col("message_id").alias("child"), F.col("parent_id").alias("above"))
    down = emails.filter(filled("message_id")).select(F.explode("children_ids").alias("child"), F.col("message_id").alias("above")).filter(filled("child"))
    claims = up.unionByName(down).distinct()
    above = nodes.select(F.col("message_id").alias("above"), F.col("node").alias("parent"))
    known = claims.join(above, "above").groupBy("child").agg(F.min_by("parent", "above").alias("parent"))
    return nodes.join(known, F.col("message_id") == F.col("child"), "left").select("node", "parent")


def message_hierarchy(emails: DataFrame, span: int = SPAN, one_task: int = ONE_TASK) -> DataFrame:
    """(message_id, root_id, node_depth) of each distinct non-empty message id; root_id '' and node_depth -1 at and below loops."""
    nodes = cut(message_nodes(emails.select("pos", "message_id")))
    solved = resolve_forest(message_links(emails.select("message_id", "parent_id", "children_ids"), nodes), span, one_task)
    roots = nodes.select(F.col("node").alias("root"), F.col("message_id").alias("root_id"))
    named = solved.join(nodes, "node").join(roots, "root", "left")
    return named.select("message_id", F.coalesce("root_id", F.lit("")).alias("root_id"), F.col("depth").alias("node_depth"))


# --- paths and descendants


#: Path elements in one Arrow batch that a task hands on.
PATH_BATCH = 200_000
_PATH = "node bigint, exit bigint, path array<string>"


def _local_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each node the names of its chain inside the fragment (topmost first) and the parent outside, NULL if the chain ends at a root. Nodes on loops are not in the input."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    frag, node, parent = (np.concatenate([pc.fill_null(b.column(i), NOWHERE).to_numpy(zero_copy_only=False) for b in got]) for i in range(3))
    name = np.concatenate([b.column(3).to_numpy(zero_copy_only=False) for b in got])
    order = np.lexsort((node, frag))
    frag, node, parent, name = frag[order], node[order], parent[order], name[order]
    nodes, exits, paths, held = [], [], [], 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(exits, pa.int64()), pa.array(paths, pa.list_(pa.string()))], ["node", "exit", "path"])

    for part in np.split(np.arange(len(node)), np.flatnonzero(np.diff(frag)) + 1):
        up = dict(zip(node[part].tolist(), zip(parent[part].tolist(), name[part].tolist())))
        for x in up:
            path, at = [], x
            while at in up:
                at, word = up[at]
                path.append(word)
            nodes.append(x)
            exits.append(at if at != NOWHERE else None)
            paths.append(path[::-1])
            held += len(path)
            if held > PATH_BATCH:
                yield flush()
                nodes, exits, paths, held = [], [], [], 0
    if nodes:
        yield flush()


def expand_paths(forest: DataFrame, span: int = SPAN) -> DataFrame:
    """(node, path): the names from the root down to the node, of a forest (node, parent, name) without loops.

    The output is as large as the sum of all depths. Fragment-local chains are joined to the paths of the nodes
    they leave through; these grow as well, so the part of a chain that is known doubles with each round.
    """
    frag = F.floor(F.col("node") / F.lit(span)).cast("bigint").alias("frag")
    local = cut(forest.select(frag, "node", "parent", "name").repartition("frag").mapInArrow(_local_paths, _PATH))
    while local.filter("exit is not null").take(1):
        up = local.select(F.col("node").alias("exit"), F.col("exit").alias("_exit"), F.col("path").alias("_path"))
        # Only paths that others leave through travel in the join.
        needed = up.join(local.filter("exit is not null").select("exit").distinct(), "exit", "left_semi")
        joined = local.join(needed, "exit", "left")
        local = cut(joined.select("node", F.col("_exit").alias("exit"), F.when(F.col("_path").isNull(), F.col("path")).otherwise(F.concat("_path", "path")).alias("path")))
    return local.select("node", "path")


def _message_forest(emails: DataFrame, span: int) -> tuple[DataFrame, DataFrame]:
    """(nodes with root and depth, the forest (node, parent, name) of those that have a root)."""
    nodes = cut(message_nodes(emails.select("pos", "message_id")))
    links = cut(message_links(emails.select("message_id", "parent_id", "children_ids"), nodes))
    solved = cut(nodes.join(resolve_forest(links, span), "node"))
    forest = links.join(solved.filter("root is not null").select("node", F.col("message_id").alias("name")), "node")
    return solved, cut(forest)


def message_paths(emails: DataFrame, span: int = SPAN) -> DataFrame:
    """(message_id, root_id, node_depth, path, n_descendants): path holds the message ids from the root down, joined by spaces."""
    solved, forest = _message_forest(emails, span)
    paths = expand_paths(forest, span).select("node", F.element_at("path", 1).alias("root_id"), F.array_join("path", " ").alias("path"))
    below = sums_below(forest.select("node", "parent", F.lit(1).alias("weight")), span).select("node", (F.col("total") - 1).alias("n_descendants"))
    out = solved.join(paths, "node", "left").join(below, "node", "left")
    return out.select("message_id", F.coalesce("root_id", F.lit("")).alias("root_id"), F.col("depth").alias("node_depth"), F.coalesce("path", F.lit("")).alias("path"), F.coalesce("n_descendants", F.lit(0).cast("bigint")).alias("n_descendants"))


def message_descendants(emails: DataFrame, span: int = SPAN) -> DataFrame:
    """(ancestor_id, message_id, distance) for every pair of a message and one of its ancestors, distance 1 and more."""
    paths = expand_paths(_message_forest(emails, span)[1], span)
    steps = paths.select(F.element_at("path", -1).alias("message_id"), F.size("path").alias("_n"), F.posexplode("path").alias("_at", "ancestor_id"))
    return steps.select("ancestor_id", "message_id", (F.col("_n") - 1 - F.col("_at")).cast("bigint").alias("distance")).filter("distance > 0")

"""Sequences inside groups without a task for each group: running sums and "the next one at or after".

Rows are range-sorted over all partitions, so a group of any size is spread over many of them and a hot group is
no larger a task than any other. Each partition is then read once, in order, by an Arrow pass that needs no
exchange; what crosses a border between partitions is one row for each partition and is joined back.

Defined results: NULLs form a group of their own; ties are settled by the order columns the caller gives; an
empty table gives no rows. Groups are told apart by the 64-bit hash of their columns next to one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.runtime import cut


def _range_sorted(df: DataFrame, *order: Column | str) -> DataFrame:
    """df in the given order over all partitions, with the partition's number in ``_part``. df is read twice, the ranges are drawn from a sample."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())


def _starts(keys: np.ndarray, last: int | None) -> np.ndarray:
    """Where a group begins in a batch, the one the batch before ended in aside."""
    new = np.empty(len(keys), bool)
    new[0] = last is None or keys[0] != last
    new[1:] = keys[1:] != keys[:-1]
    return new


def _running(values: list[str], out: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried, part, types = None, [0] * len(values), None, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column("_k").to_numpy()
            new = _starts(keys, last)
            start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            columns = []
            for i, name in enumerate(values):
                v = batch.column(name).to_numpy()
                before = np.cumsum(v) - v
                before = before - before[start]
                if not new[0]:
                    before[: int(np.argmax(new)) if new.any() else n] += carried[i]
                carried[i] = int(before[-1] + v[-1])
                columns.append(pa.array(before, pa.int64()))
            last, part, types = keys[-1], batch.column("_part")[0].as_py(), batch.column("_row").type
            yield pa.RecordBatch.from_arrays([batch.column("_row"), *columns, batch.column("_k"), batch.column("_part"), pa.array(np.zeros(n, bool))], ["_row", *out, "_k", "_part", "_tail"])
        if last is not None:  # what the last group of the partition hands on
            yield pa.RecordBatch.from_arrays([pa.nulls(1, types), *(pa.array([c], pa.int64()) for c in carried), pa.array([last], pa.int64()), pa.array([part], pa.int32()), pa.array([True])], ["_row", *out, "_k", "_part", "_tail"])

    return run


def running_inside(df: DataFrame, by: list[str], sums: dict[str, Column]) -> DataFrame:
    """As ``running_sums`` in the order the rows have, for groups whose rows are neighbours in one partition; no exchange."""
    seen = _summed(df, by, sums).filter("not _tail")
    return seen.select(*[F.col(f"_row.`{c}`") for c in df.columns], *sums)


def _summed(df: DataFrame, by: list[str], sums: dict[str, Column], *order: Column | str) -> DataFrame:
    values = {f"_v{i}": F.coalesce(c.cast("bigint"), F.lit(0)) for i, c in enumerate(sums.values())}
    key = F.xxhash64(*by) if by else F.lit(0).cast("bigint")
    keyed = df.withColumns({"_row": F.struct(*[F.col(f"`{c}`") for c in df.columns]), "_k": key, **values})
    placed = _range_sorted(keyed, *by, *order) if order else keyed.withColumn("_part", F.spark_partition_id())
    placed = placed.select("_row", "_k", "_part", *values)
    schema = T.StructType([T.StructField("_row", placed.schema["_row"].dataType), *[T.StructField(name, T.LongType()) for name in sums], T.StructField("_k", T.LongType()), T.StructField("_part", T.IntegerType()), T.StructField("_tail", T.BooleanType())])
    return placed.mapInArrow(_running(list(values), list(sums)), schema)


def running_sums(df: DataFrame, by: list[str], order: list[Column | str], sums: dict[str, Column]) -> DataFrame:
    """df with, for each entry of ``sums``, the sum of its BIGINT column over the rows of the group before this one."""
    seen = cut(_summed(df, by, sums, *order))
    upto = Window.partitionBy("_k").orderBy("_part")
    tails = seen.filter("_tail").select("_k", F.col("_part").alias("_from"), F.lead("_part").over(upto).alias("_until"), *[F.sum(name).over(upto).alias(f"_o{i}") for i, name in enumerate(sums)])
    crosses = (F.col("s._k") == F.col("t._k")) & (F.col("_part") > F.col("_from")) & (F.col("_until").isNull() | (F.col("_part") <= F.col("_until")))
    out = seen.filter("not _tail").alias("s").join(F.broadcast(tails).alias("t"), crosses, "left")  # one row for each partition
    return out.select(*[F.col(f"_row.`{c}`") for c in df.columns], *[(F.col(f"s.`{name}`") + F.coalesce(f"_o{i}", F.lit(0))).alias(name) for i, name in enumerate(sums)])


def _last_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each probe the last cell above it in its group; at the end of the partition a row with the last cell of the last group."""
    last = carry = part = None
    names = ["probe", "cell", "_k", "_part"]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys, cells, probes = batch.column("_k").to_numpy(), batch.column("cell"), batch.column("probe")
        new = _starts(keys, last)
        if carry is None:
            carry = pa.nulls(1, cells.type)
        group = np.maximum.accumulate(np.where(new, np.arange(n), -1))  # -1: the group of the batch before
        seen = np.maximum.accumulate(np.where(cells.is_valid().to_numpy(zero_copy_only=False), np.arange(n), -1))
        inside = seen >= np.maximum(group, 0)
        place = np.where(inside, seen + 1, np.where(group < 0, 0, -1))  # 0: what the batch before carries
        pool = pa.concat_arrays([carry, cells])
        at = np.flatnonzero(probes.is_valid().to_numpy(zero_copy_only=False))
        where = place[at]
        found = pool.take(pa.array(np.where(where < 0, 0, where), mask=where < 0))
        last, part = keys[-1], batch.column("_part")[0].as_py()
        carry = pool.take(pa.array([place[-1]])) if place[-1] >= 0 else pa.nulls(1, cells.type)
        if len(at):
            yield pa.RecordBatch.from_arrays([probes.take(pa.array(at)), found, pa.array(keys[at]), batch.column("_part").take(pa.array(at))], names)
    if carry is not None and carry[0].is_valid:
        yield pa.RecordBatch.from_arrays([pa.nulls(1, probes.type), carry, pa.array([last], pa.int64()), pa.array([part], pa.int32())], names)


AT = "struct<ts:bigint,key:string,pos:bigint>"


def place(ts: Column, key: Column | None = None, pos: Column | None = None) -> Column:
    """A place in the order of a group. Without key and pos: before everything of that ``ts``."""
    key = F.lit("") if key is None else key
    pos = F.lit(-(2**63)).cast("bigint") if pos is None else pos
    return F.struct(ts.cast("bigint").alias("ts"), key.alias("key"), pos.cast("bigint").alias("pos"))


def next_after(probes: DataFrame, cells: DataFrame, by: list[str]) -> DataFrame:
    """(probe, cell): for each probe (*by, at, probe) the cell (*by, at, cell) of its group with the least place behind the probe's.

    ``at`` is a ``place``; a cell at the very place of the probe does not count. Probes without a cell are left out.
    """
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    rows = cells.select(*by, "at", "cell", none(probes, "probe")).unionByName(probes.select(*by, "at", none(cells, "cell"), "probe"))
    rows = rows.withColumn("_k", F.xxhash64(*by))
    # Latest first, so that the last cell above a probe is the next one behind it.
    ranged = _range_sorted(rows, *by, F.desc("at"), F.col("cell").isNotNull()).select("probe", "cell", "_k", "_part")
    schema = T.StructType([ranged.schema["probe"], ranged.schema["cell"], T.StructField("_k", T.LongType()), T.StructField("_part", T.IntegerType())])
    seen = cut(ranged.mapInArrow(_last_seen, schema))
    upto = Window.partitionBy("_k").orderBy("_part")
    tails = seen.filter("probe is null").select("_k", F.col("cell").alias("_cell"), F.col("_part").alias("_from"), F.lead("_part").over(upto).alias("_until"))
    crosses = (F.col("s._k") == F.col("t._k")) & (F.col("_part") > F.col("_from")) & (F.col("_until").isNull() | (F.col("_part") <= F.col("_until")))
    probed = seen.filter("probe is not null").alias("s").join(F.broadcast(tails).alias("t"), F.col("cell").isNull() & crosses, "left")  # at most one row for each partition
    return probed.select("probe", F.coalesce("cell", "_cell").alias("cell")).filter("cell is not null")

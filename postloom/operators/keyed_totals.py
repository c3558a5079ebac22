"""Per-key totals that do not wait for a few hot keys.

Each input split encodes its keys into a local dictionary and adds its rows into dense accumulator arrays
(``numpy.bincount`` and scatter-reduce). What leaves a split is one array block for each key range, in which a
hot key is one slot, however many rows it has. Blocks are added up in two rounds of a distributed reduction; the
number of key ranges follows the number of distinct keys, so a range holds about KEYS_IN_BLOCK keys at any size,
and its totals are handed on in slices. No row of the input is ever shuffled. Splits are those of the files, equal
in bytes.

Defined results: NULL and empty keys are not keys (they still count as rows of the input); an empty table gives
no rows; NULL measures count as 0 in sums and are skipped by least and greatest; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.runtime import partitions

#: Distinct keys a split holds before it hands its blocks on and starts anew; bounds the memory of a task, loses nothing.
KEYS_HELD = 200_000
#: Keys of one key range, as estimated from the distinct keys of the largest field.
KEYS_IN_BLOCK = 50_000
#: Keys in one row that a task hands on.
SLICE = 5_000
#: Blocks of one key range that a task of the first round adds up.
FAN_IN = 64

_BLOCKS = "field string, block int, split int, keys array<string>, totals array<array<bigint>>"
_LEAST, _GREATEST = np.iinfo(np.int64).max, np.iinfo(np.int64).min
_START = {"sum": 0, "min": _LEAST, "max": _GREATEST}
_INTO = {"sum": np.add, "min": np.minimum, "max": np.maximum}


class _Accumulators:
    """A growing dictionary of keys with one dense array per measure."""

    def __init__(self, kinds: list[str]) -> None:
        self.kinds, self.slots = kinds, {}
        self.arrays = [np.full(1024, _START[k], np.int64) for k in kinds]

    def places(self, keys: list[str]) -> np.ndarray:
        slots = self.slots
        out = np.fromiter((slots.setdefault(k, len(slots)) for k in keys), np.int64, len(keys))
        while len(slots) > len(self.arrays[0]):
            self.arrays = [np.concatenate([a, np.full(len(a), _START[k], np.int64)]) for a, k in zip(self.arrays, self.kinds)]
        return out

    def add(self, keys: list[str], blocks: list[np.ndarray]) -> None:
        at = self.places(keys)
        for array, block, kind in zip(self.arrays, blocks, self.kinds):
            _INTO[kind].at(array, at, block)


def _dense(codes: np.ndarray, size: int, kind: str, values: np.ndarray | None) -> np.ndarray:
    """The accumulator array of one batch."""
    if values is None:
        return np.bincount(codes, minlength=size).astype(np.int64)
    out = np.full(size, _START[kind], np.int64)
    _INTO[kind].at(out, codes, values)
    return out


def _block_of(keys: list[str], blocks: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(k.encode("utf-8", "surrogatepass")) % blocks for k in keys), np.int64, len(keys))


def _slices(field: str, block: int, split: int, keys: list[str], arrays: list[np.ndarray]) -> Iterator[dict]:
    for low in range(0, len(keys), SLICE):
        high = min(low + SLICE, len(keys))  # arrays are longer than the keys they hold
        yield {"field": field, "block": block, "split": split, "keys": keys[low:high], "totals": [a[low:high].tolist() for a in arrays]}


_SCHEMA = pa.schema([("field", pa.string()), ("block", pa.int32()), ("split", pa.int32()), ("keys", pa.list_(pa.string())), ("totals", pa.list_(pa.list_(pa.int64())))])


def _emit(field: str, acc: _Accumulators, blocks: int, split: int) -> Iterator[pa.RecordBatch]:
    keys = np.array(list(acc.slots), dtype=object)
    if not len(keys):
        return
    of = _block_of(list(keys), blocks)
    order = np.argsort(of, kind="stable")
    rows = []
    for part in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
        rows += _slices(field, int(of[part[0]]), split, list(keys[part]), [a[part] for a in acc.arrays])
    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)


def _encode(fields: list[str], measures: list[tuple[str, str]], blocks: int, held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        split = TaskContext.get().partitionId()
        kinds = [k for _, k in measures]
        accs = {f: _Accumulators(kinds) for f in fields}
        for batch in batches:
            for f in fields:
                column = batch.column(batch.schema.get_field_index(f))
                keep = pc.fill_null(pc.not_equal(column, ""), False)
                if not pc.any(keep).as_py():
                    continue
                coded = column.filter(keep).dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False)
                size, parts = len(coded.dictionary), []
                for name, kind in measures:
                    if name == "":
                        parts.append(_dense(codes, size, kind, None))
                    else:
                        values = pc.cast(batch.column(batch.schema.get_field_index(name)).filter(keep), pa.int64())
                        parts.append(_dense(codes, size, kind, pc.fill_null(values, int(_START[kind])).to_numpy(zero_copy_only=False)))
                accs[f].add(coded.dictionary.to_pylist(), parts)
                if len(accs[f].slots) >= held:
                    yield from _emit(f, accs[f], blocks, split)
                    accs[f] = _Accumulators(kinds)
        for f in fields:
            yield from _emit(f, accs[f], blocks, split)

    return run


def _reduce(kinds: list[str]):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        acc = _Accumulators(kinds)
        for keys, totals in zip(table.column("keys").to_pylist(), table.column("totals").to_pylist()):
            acc.add(keys, [np.asarray(t, np.int64) for t in totals])
        split = key[2].as_py() if len(key) > 2 else 0
        return pa.Table.from_pylist(list(_slices(key[0].as_py(), key[1].as_py(), split, list(acc.slots), acc.arrays)), _SCHEMA)

    return run


def key_counts(df: DataFrame, fields: list[str]) -> tuple[int, int]:
    """(rows, distinct keys of the field with most of them, estimated to 5 percent) in one pass."""
    row = df.agg(F.count("*").alias("n"), *[F.approx_count_distinct(F.col(f"`{f}`"), 0.05).alias(f"d{i}") for i, f in enumerate(fields)]).first()
    return row[0], max(row[1:], default=0)


def keyed_totals(df: DataFrame, fields: list[str], measures: dict[str, tuple[str, str]] | None = None, distinct: int | None = None, blocks: int | None = None, held: int = KEYS_HELD, fan_in: int = FAN_IN) -> DataFrame:
    """(field_name, key_value, n, one column for each measure) for each key of each of the string columns ``fields``.

    measures: output name to (integer input column, sum|min|max). Rows of the input are read once for all fields,
    after a pass over the keys alone that estimates their number (``distinct``, if it is not given).
    """
    measures = measures or {}
    plan = [("", "sum"), *((f"_m{i}", kind) for i, (_, kind) in enumerate(measures.values()))]
    kinds = [k for _, k in plan]
    if not blocks:
        distinct = key_counts(df, fields)[1] if distinct is None else distinct
        blocks = max(8, partitions(df.sparkSession), -(-distinct // KEYS_IN_BLOCK))
    inner = [f"_f{i}" for i in range(len(fields))]
    source = df.select(*[F.col(f"`{f}`").cast("string").alias(a) for f, a in zip(fields, inner)], *[F.col(f"`{c}`").cast("bigint").alias(f"_m{i}") for i, (c, _) in enumerate(measures.values())])
    encoded = source.mapInArrow(_encode(inner, plan, blocks, held), _BLOCKS)
    # Round one adds blocks of up to fan_in splits; round two what is left of each key range.
    first = encoded.withColumn("split", F.floor(F.col("split") / fan_in).cast("int")).groupBy("field", "block", "split").applyInArrow(_reduce(kinds), _BLOCKS)
    whole = first.groupBy("field", "block").applyInArrow(_reduce(kinds), _BLOCKS)
    slots = F.arrays_zip(F.col("keys").alias("k"), *[F.element_at("totals", i + 1).alias(f"t{i}") for i in range(len(kinds))])
    rows = whole.select("field", F.explode(slots).alias("slot"))
    value = lambda i, kind: F.when(F.col(f"slot.t{i}") != int(_START[kind]), F.col(f"slot.t{i}")) if kind != "sum" else F.col(f"slot.t{i}")
    return rows.select(F.create_map(*[x for f, a in zip(fields, inner) for x in (F.lit(a), F.lit(f))])[F.col("field")].alias("field_name"), F.col("slot.k").alias("key_value"), F.col("slot.t0").alias("n"), *[value(i + 1, kind).alias(name) for i, (name, (_, kind)) in enumerate(measures.items())])


def heavy_keys(df: DataFrame, fields: list[str], share: float) -> DataFrame:
    """(field_name, key_value, n) of the keys with at least the given share of all rows, rows without a key included."""
    total, distinct = key_counts(df, fields)
    return keyed_totals(df, fields, distinct=distinct).filter(F.col("n") >= F.lit(share) * F.lit(total))

"""Running sums and running maxima over a whole table in one global order.

Rows are dealt out by ranges of the order and sorted in their partitions, so one hot key is cut
like any other. A task scans its partition batch by batch and hands on what it
carries; each partition's totals (one row a partition, so their number is a setting and not the data's) are added
afterwards. The scanned rows are written before the totals are read: a lost executor can't
change an order that is already in use.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.runtime import materialize


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64)


def _with(df: DataFrame, **more: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, *(T.StructField(k, v) for k, v in more.items())])


def _extended(batch: pa.RecordBatch, arrays: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, arrays)], names=[*batch.schema.names, *names])


def _ordered(df: DataFrame, order: list[str]) -> DataFrame:
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def prefix_sums(df: DataFrame, order: list[str], sums: dict[str, str], keep: str, tag: str) -> DataFrame:
    """The rows of df whose column `keep` (boolean) is true, with for each `name: column` of sums the sum of that
    column (longs, none negative, not null) over all rows before it in the order, kept or not.

    Rows that are equal in the order have some order among them, one and the same for all sums. An empty table gives none.
    """
    names = list(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_no = TaskContext.get().partitionId()
        have = dict.fromkeys(names, 0)
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            out = []
            for name, column in sums.items():
                x = _longs(batch, column)
                to = np.cumsum(x)
                out.append(to - x + have[name])
                have[name] += int(to[-1])
            full = _extended(batch, [*out, np.full(batch.num_rows, range_no, np.int64)], [*names, "range_no"])
            kept = full.filter(full.column(full.schema.get_field_index(keep)))
            last = None if batch.column(batch.schema.get_field_index(keep))[-1].as_py() else full.slice(batch.num_rows - 1)
            if kept.num_rows:
                yield kept
        if last is not None:
            yield last

    longs = dict.fromkeys([*names, "range_no"], T.LongType())
    scanned = materialize(_ordered(df, order).mapInArrow(run, _with(df, **longs)), tag)
    totals = scanned.groupBy("range_no").agg(*(F.max(F.col(n) + F.col(c)).alias(n) for n, c in sums.items())).orderBy("range_no").collect()
    before = [dict.fromkeys(names, 0), *accumulate(({n: r[n] for n in names} for r in totals), lambda a, b: {n: a[n] + b[n] for n in names})]
    kinds = T.StructType([T.StructField("range_no", T.LongType()), *(T.StructField(f"before_{n}", T.LongType()) for n in names)])
    starts = df.sparkSession.createDataFrame([(r["range_no"], *(b[n] for n in names)) for r, b in zip(totals, before, strict=False)], kinds)
    joined = scanned.where(F.col(keep)).join(F.broadcast(starts), "range_no")
    return joined.select(*df.columns, *((F.col(n) + F.col(f"before_{n}")).alias(n) for n in names))


def running_max(df: DataFrame, keys: list[str], order: str, value: str, out: str, tag: str) -> DataFrame:
    """df with `out`: the largest value among the rows of the same keys (longs) before this one in the order, or null if there is none.

    All columns named are longs and not null, values are not negative.
    """
    kind = _with(df, **{out: T.LongType()}, range_no=T.LongType(), note=T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_no = TaskContext.get().partitionId()
        first: tuple | None = None
        key: tuple | None = None
        top = -1
        row = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            k = np.stack([_longs(batch, c) for c in keys])
            v = _longs(batch, value)
            new = np.ones(n, bool)
            new[1:] = (k[:, 1:] != k[:, :-1]).any(axis=0)
            now = tuple(k[:, 0].tolist())
            if now != key:
                top = -1
            first = now if first is None else first
            group = np.cumsum(new) - 1
            step = max(int(v.max()), top) + 2
            run = np.maximum.accumulate(np.maximum(v, np.where(group == 0, top, -1)) + group * step) - group * step
            before = np.empty(n, np.int64)
            before[0] = top
            before[1:] = np.where(new[1:], -1, run[:-1])
            in_first = (k == np.array(first, np.int64)[:, None]).all(axis=0)
            key, top = tuple(k[:, -1].tolist()), int(run[-1])
            row = batch.slice(n - 1)
            yield _extended(batch, [before, np.full(n, range_no, np.int64), np.where(in_first, 1, 0)], [out, "range_no", "note"])
        if row is not None:
            # Two notes: what this partition ends with, and whether all of it is one group.
            yield _extended(row, [np.array([top]), np.array([range_no]), np.array([3 if key == first else 2])], [out, "range_no", "note"])

    scanned = materialize(_ordered(df, [*keys, order, value]).mapInArrow(run, kind), tag)
    ends = scanned.where("note >= 2").select("range_no", "note", *keys, out).orderBy("range_no").collect()
    # What the groups that go on from the partitions before have reached.
    rows, key, top = [], None, -1
    for r in ends:
        rows.append((r["range_no"], *(key or [None] * len(keys)), top))
        now = tuple(r[k] for k in keys)
        top = max(r[out], top) if r["note"] == 3 and now == key else r[out]
        key = now
    fields = [T.StructField("range_no", T.LongType()), *(T.StructField(f"at_{k}", T.LongType()) for k in keys), T.StructField("at_top", T.LongType())]
    starts = df.sparkSession.createDataFrame(rows, T.StructType(fields))
    goes_on = F.col("note") == 1
    for k in keys:
        goes_on = goes_on & (F.col(k) == F.col(f"at_{k}"))
    joined = scanned.where("note < 2").join(F.broadcast(starts), "range_no")
    reached = F.when(goes_on, F.greatest(out, "at_top")).otherwise(F.col(out))
    return joined.select(*df.columns, F.when(reached >= 0, reached).alias(out))

"""Connected components by alternating large-star and small-star steps.

After "Connected Components in MapReduce and Beyond" (Kiveris et al., 2014). Only
links move, by aggregations with partial sums and equi-joins; nothing is
collected, and each round's links are written to the shared folder. Where a round reads them,
each task first puts a star in place of what its own links join, so that fewer rounds are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.runtime import materialize


class Groups:
    """Sets that links join; the top of a set is its least number."""

    def __init__(self, n: int):
        self.top = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins the sets of a and b: tops take the least top among their neighbours' until nothing changes."""
        while True:
            x, y = self.top[a], self.top[b]
            on = x != y
            if not on.any():
                return
            a, b, x, y = a[on], b[on], x[on], y[on]
            np.minimum.at(self.top, np.maximum(x, y), np.minimum(x, y))
            while (up := self.top[self.top] != self.top).any():
                self.top[up] = self.top[self.top[up]]


def stars(links: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """hi, lo (longs): links that join the same nodes, each to the least that it reaches within `chunk` links of its task."""
    schema = pa.schema([("hi", pa.int64()), ("lo", pa.int64())])

    def star(have: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(have)
        nodes, at = np.unique(rows, return_inverse=True)
        at = at.reshape(rows.shape)
        groups = Groups(len(nodes))
        groups.link(at[:, 0], at[:, 1])
        on = np.flatnonzero(groups.top != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[on]), pa.array(nodes[groups.top[on]])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: list[np.ndarray] = []
        for batch in batches:
            if batch.num_rows:
                have.append(np.stack([batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("hi", "lo")], axis=1))
            if sum(map(len, have)) >= chunk:
                yield star(have)
                have = []
        if have:
            yield star(have)

    return links.select("hi", "lo").mapInArrow(run, "hi long, lo long")


def connected_components(links: DataFrame, max_rounds: int = 40) -> DataFrame:
    """links: columns a, b (longs, not null). Returns node, component (the least
    node reachable) for each node that isn't its component's least."""
    e = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    for _ in range(max_rounds):
        e = materialize(stars(materialize(e, "links")).distinct(), "stars")
        # Done when no lower end is also an upper end and each upper end has one link.
        ends = e.select(F.col("hi").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("low")).union(e.select("lo", F.lit(0), F.lit(1)))
        if ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("low").alias("low")).where("up > 1 or (up = 1 and low = 1)").isEmpty():
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        met = large.join(low, "hi")
        e = met.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(low.select("hi", "m"))
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")

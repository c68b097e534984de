"""Which of very many keys occur more than once: a table of a fixed number of slots.

Each task sends which slots its keys hit once and more than once, as compressed blocks of
bits; blocks are merged by their number; the table of slots hit at least twice
(`slots` / 8 bytes) comes back. A key whose slot isn't in it is alone in the whole input; a
few lone keys share a slot by chance and are taken for shared.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 16
FLUSH = 4_000_000
KIND = "block long, once binary, twice binary"
_ODD = np.uint64(0xD1342543DE82EF95)


def slot_of(keys: np.ndarray, slots: int) -> np.ndarray:
    """The slot of uint64 keys by multiplication; slots is a power of two."""
    return (keys * _ODD >> np.uint64(64 - (slots.bit_length() - 1))).astype(np.int64)


def slots_for(n: int, most: int = 1 << 28) -> int:
    """About eight slots for each of n keys, up to `most`."""
    return min(most, 1 << max(20, int(8 * n - 1).bit_length()))


def _batch(have: dict[int, tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"block": pa.array(list(have), pa.int64()), "once": pa.array([x[0] for x in have.values()], pa.binary()), "twice": pa.array([x[1] for x in have.values()], pa.binary())})


def _packed(slots: np.ndarray) -> pa.RecordBatch:
    """Blocks of the slots of some keys."""
    x, counts = np.unique(slots, return_counts=True)
    two = x[counts > 1]
    out = {}
    for b in np.unique(x // BLOCK).tolist():
        bits = []
        for y in (x, two):
            lo, hi = np.searchsorted(y, [b * BLOCK, (b + 1) * BLOCK])
            z = np.zeros(BLOCK, bool)
            z[y[lo:hi] - b * BLOCK] = True
            bits.append(zlib.compress(np.packbits(z).tobytes(), 1))
        out[b] = bits[0], bits[1]
    return _batch(out)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    have: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for b, *raw in zip(*(batch[c].to_pylist() for c in ("block", "once", "twice")), strict=True):
            o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in raw)
            if b in have:
                have_o, have_t = have[b]
                have[b] = have_o | o, have_t | t | (have_o & o)
            else:
                have[b] = o, t
    yield _batch({b: (b"", zlib.compress(t.tobytes(), 1)) for b, (_, t) in have.items()})


def shared_table(df: DataFrame, keys: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], slots: int) -> bytes:
    """The compressed table. `keys` turns a task's batches of df into arrays of uint64 keys."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        n = 0
        for k in keys(batches):
            found.append(slot_of(k, slots))
            n += len(k)
            if n > FLUSH:
                yield _packed(np.concatenate(found))
                found.clear()
                n = 0
        if found:
            yield _packed(np.concatenate(found))

    table, size = np.zeros(slots // 8, np.uint8), BLOCK // 8
    merged = df.mapInArrow(build, KIND).repartition(F.col("block")).mapInArrow(_merge, KIND).select("block", "twice")
    for r in merged.toLocalIterator():
        table[r["block"] * size : (r["block"] + 1) * size] = np.frombuffer(zlib.decompress(r["twice"]), np.uint8)
    return zlib.compress(table.tobytes(), 1)


class Shared:
    """The table in a task."""

    def __init__(self, table: bytes, slots: int):
        self.bits, self.slots = np.frombuffer(zlib.decompress(table), np.uint8), slots

    def of(self, keys: np.ndarray) -> np.ndarray:
        """True where a key's slot is shared."""
        s = slot_of(keys, self.slots)
        return (self.bits[s >> 3] >> (7 - (s & 7)).astype(np.uint8) & 1).astype(bool)

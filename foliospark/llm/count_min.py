"""Count-min sketches of how many documents hold a term, counted up to a small cap.

Each task counts its own terms and sends cells in compressed blocks; blocks of one number are added in one task,
and the sum (two rows of `width` cells of one byte, cut to the cap) comes back packed into two bits a cell. An estimate is
the smaller of a term's two cells: never under min(count, cap), so a term whose estimate
is under the cap is proven to be rarer. `width` follows the input up to a bound; past it fewer terms are ruled out, none wrongly.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 16
CAP = 3
KIND = "block long, cells binary"


def cells(keys: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each key in either row; width is a power of two, at most 2**31."""
    h = pd.util.hash_array(np.array(keys, dtype=object), categorize=False)
    return (h & np.uint64(width - 1)).astype(np.int64), (h >> np.uint64(32) & np.uint64(width - 1)).astype(np.int64)


def width_for(n: int, most: int = 1 << 26) -> int:
    """About one cell a row for each of n terms, up to `most`."""
    return min(most, 1 << max(16, int(n - 1).bit_length()))


def _send(have: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"block": pa.array(list(have), pa.int64()), "cells": pa.array([zlib.compress(x.tobytes(), 1) for x in have.values()], pa.binary())})


def _blocks(keys: list[bytes], counts: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    at = cells(keys, width)
    for row in (0, 1):
        order = np.argsort(at[row], kind="stable")
        cell, n = at[row][order], counts[order]
        starts = np.flatnonzero(np.r_[True, cell[1:] // BLOCK != cell[:-1] // BLOCK])
        for a, b in zip(starts, [*starts[1:], len(cell)], strict=True):
            out = np.bincount(cell[a:b] % BLOCK, weights=n[a:b], minlength=BLOCK)
            yield _send({row * (width // BLOCK) + int(cell[a] // BLOCK): np.minimum(out, CAP).astype(np.uint8)})


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    have: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, raw in zip(batch["block"].to_pylist(), batch["cells"].to_pylist(), strict=True):
            x = np.frombuffer(zlib.decompress(raw), np.uint8)
            have[b] = np.minimum(have[b] + x, CAP).astype(np.uint8) if b in have else x
    yield _send(have)


class Sketch:
    """The merged sketch as tasks hold it."""

    def __init__(self, width: int, packed: bytes):
        self.width, self.packed, self._cells = width, packed, None

    def __getstate__(self) -> tuple[int, bytes]:
        return self.width, self.packed

    def __setstate__(self, state: tuple[int, bytes]) -> None:
        self.__init__(*state)

    def may_reach(self, keys: list[bytes]) -> np.ndarray:
        """False for keys that are proven to be counted less than CAP times."""
        if self._cells is None:
            self._cells = np.frombuffer(zlib.decompress(self.packed), np.uint8)
        out = np.ones(len(keys), bool)
        for row, at in enumerate(cells(keys, self.width)):
            i = at + row * self.width
            out &= (self._cells[i >> 2] >> (2 * (i & 3)).astype(np.uint8) & 3) >= CAP
        return out


def sketch(df: DataFrame, counted: Callable[[Iterator[pa.RecordBatch]], Iterable[tuple[list[bytes], np.ndarray]]], width: int) -> Sketch:
    """`counted` turns a task's batches of df into lists of keys with their counts; a key may come again."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in counted(batches):
            if keys:
                yield from _blocks(keys, counts, width)

    table = np.zeros(2 * width // 4, np.uint8)
    merged = df.mapInArrow(build, KIND).repartition(F.col("block")).mapInArrow(_merged, KIND)
    for r in merged.toLocalIterator():
        four = np.frombuffer(zlib.decompress(r["cells"]), np.uint8).reshape(-1, 4)
        at = r["block"] * (BLOCK // 4)
        table[at : at + BLOCK // 4] = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return Sketch(width, zlib.compress(table.tobytes(), 1))

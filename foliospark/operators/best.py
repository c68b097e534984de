"""The best k rows of each query, kept while a task goes through its rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CELLS = 1 << 19  # scores (rows x queries) that a task holds at once, however many rows a batch has
PENDING = 1 << 12
EDGE = 1e-6  # what rounding moves a score by, and more


def rounded(score: np.ndarray) -> np.ndarray:
    return np.floor(score * 1e6 + 0.5) / 1e6


class Best:
    """What a task keeps follows k x queries and not its rows. Scores count to 6 places, ties go to the least id."""

    def __init__(self, n_queries: int, k: int, least: float = -np.inf):
        self.k, self.least = k, np.full(n_queries, least)
        self.qn, self.score, self.ids, self.waiting = [], [], [], 0

    @property
    def rows(self) -> int:
        """Rows to be scored at once."""
        return max(1, CELLS // max(1, len(self.least)))

    def may_count(self, score: np.ndarray, slack: float = 0.0, least: float = -np.inf, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(rows, queries) of the cells of score (rows x queries) that may be among the best, where a score may be off by `slack`;
        those below `least` can't. `floor`: what the floors are in the terms of score, if that is not what is kept. Of one piece no more than its k best and their ties can stay, which is only looked for if many pass."""
        floor = np.maximum((self.least if floor is None else floor) - slack - EDGE, least)
        found = np.flatnonzero(score >= floor.astype(score.dtype))
        if len(score) > self.k and len(found) > 2 * self.k * len(self.least):
            kth = np.partition(score, len(score) - self.k, axis=0)[len(score) - self.k]
            found = np.flatnonzero(score >= np.maximum(floor, kth - 2 * (slack + EDGE)).astype(score.dtype))
        return np.divmod(found, len(self.least))

    def add(self, ids: pa.Array, score: np.ndarray) -> None:
        """score: rows x queries of the rows `ids`."""
        at, qn = self.may_count(score)
        self.put(ids, at, qn, score[at, qn])

    def put(self, ids: pa.Array, at: np.ndarray, qn: np.ndarray, score: np.ndarray) -> None:
        """The scores of some rows (`at` in ids) for some queries; no row comes twice for a query."""
        live = rounded(score) >= self.least[qn]
        at, qn, score = at[live], qn[live], score[live]
        if not len(at):
            return
        self.qn.append(qn)
        self.score.append(score)
        self.ids.append(ids.take(pa.array(at)))
        self.waiting += len(at)
        # Often, since the floors rise only here and all that passes them is worked out in full.
        if self.waiting > PENDING + self.k * len(self.least) * 5 // 4:
            self.shrink()

    def shrink(self) -> None:
        if not self.qn:
            return
        qn, score = np.concatenate(self.qn), np.concatenate(self.score)
        ids = pa.chunked_array(self.ids).combine_chunks()
        order = pc.rank(ids, tiebreaker="dense").to_numpy().astype(np.int64)
        by = np.lexsort((order, -rounded(score), qn))
        qn, score, ids = qn[by], score[by], ids.take(pa.array(by))
        place = np.arange(len(qn)) - np.searchsorted(qn, qn)
        last = place == self.k - 1
        self.least[qn[last]] = np.maximum(self.least[qn[last]], rounded(score[last]))
        stay = place < self.k
        self.qn, self.score, self.ids, self.waiting = [qn[stay]], [score[stay]], [ids.filter(pa.array(stay))], int(stay.sum())

    def batch(self) -> pa.RecordBatch | None:
        """qn, id, score of what was kept."""
        self.shrink()
        if not self.qn:
            return None
        return pa.RecordBatch.from_arrays([pa.array(self.qn[0], pa.int64()), self.ids[0], pa.array(self.score[0], pa.float64())], names=["qn", "id", "score"])

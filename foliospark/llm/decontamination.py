"""Benchmark decontamination by pigeonhole edit matching.

A test item of m words may differ by k = floor((1 - similarity) * m) word edits
(insert, delete, replace). Cut into k + 1 pieces, one piece at least is untouched
wherever the item occurs within that budget. So exact piece hits (by rolling hash
of word ids, for each piece length) give all places to look at, and Myers'
bit-parallel distance over the words around a hit decides.

Words are runs of word characters, lower-cased (characters of Chinese and Japanese are words of their
own); what lies between them doesn't count. Items of under five words have no budget: they are found where
all their words stand in order. The items go to the executors as a broadcast of at most `block_bytes`; a
larger set of items is worked through in blocks of that size, each against all rows.

Cases: null and empty texts match nothing; items that are null or
without a word, or have fewer than `min_words`, are never looked for; repeated items and rows give
repeated results; ties between places go to the earliest end; an empty table on
either side gives an empty result (or, for `decontaminate`, the rows as they are).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.columns import id_text, keep_rows
from foliospark.llm.worker import held

#: A word, or one character of a script that is written without spaces.
WORD = re.compile("[\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]|[^\\W\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]+")
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
SCHEMA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("n_words", pa.int32()), ("similarity", pa.float64()), ("start_word", pa.int64()), ("end_word", pa.int64())])


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def budget(m: int, similarity: float) -> int:
    return int((1 - similarity) * m + 1e-9)


def pieces(m: int, k: int) -> list[tuple[int, int]]:
    """k + 1 ranges that cover m words, of nearly equal length."""
    cut = [m * i // (k + 1) for i in range(k + 2)]
    return list(zip(cut, cut[1:], strict=False))


def myers(pattern: list[int], text: list[int], anchored: bool = False) -> Iterator[int]:
    """After each word of text: the least distance of the pattern to a stretch that
    ends there (anchored: to the text from its beginning)."""
    m = len(pattern)
    peq: dict[int, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1 | anchored) & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        yield score


class ItemIndex:
    """Pieces of all items of a block by their length and hash."""

    def __init__(self, items: list[tuple[int, str]], similarity: float, min_words: int):
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, list[int], int]] = []
        self.pieces: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for item_id, text in items:
            words = words_of(text)
            if len(words) < max(1, min_words):
                continue
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            k = budget(len(ids), similarity)
            for a, b in pieces(len(ids), k):
                h = 0
                for x in ids[a:b]:
                    h = (h * BASE + x) & MASK
                self.pieces.setdefault(b - a, {}).setdefault(h, []).append((len(self.items), a))
            self.items.append((item_id, ids, k))
        self.sieve = {}
        for n, found in self.pieces.items():
            sieve = np.zeros(1 << 16, bool)
            sieve[self._slot(np.array(list(found), np.uint64))] = True
            self.sieve[n] = sieve

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(48)).astype(np.int64)

    def hits(self, ids: np.ndarray) -> dict[int, list[int]]:
        """For each item, where it would begin in the text if a piece that is there is untouched."""
        out: dict[int, list[int]] = {}
        if not len(ids):
            return out
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        h, n = np.zeros(len(ids), np.uint64), 0
        for size in range(1, max(self.pieces, default=0) + 1):
            n = len(ids) - size + 1
            if n <= 0:
                break
            h = h[:n] * np.uint64(BASE) + ids[size - 1 :].astype(np.uint64)
            if size in self.pieces:
                ok = self.sieve[size][self._slot(h)] & (known[size:] - known[:-size] == size)
                for p in np.flatnonzero(ok).tolist():
                    for item, offset in self.pieces[size].get(int(h[p]), ()):
                        out.setdefault(item, []).append(p - offset)
        return out

    def find(self, text: str | None, first: bool = False) -> list[tuple[int, int, int, int, int]]:
        """(item, distance, words of the item, start, end) of the best place of each item that
        is within its budget; first: of one item, if any."""
        if not self.items or not text:
            return []
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in words_of(text)], np.int64)
        out = []
        for item, starts in sorted(self.hits(ids).items()):
            item_id, pattern, k = self.items[item]
            m, best = len(pattern), None
            windows: list[list[int]] = []
            for s in sorted(set(starts)):
                a, b = max(0, s - k), min(len(ids), s + m + k)
                if windows and a <= windows[-1][1]:
                    windows[-1][1] = max(b, windows[-1][1])
                else:
                    windows.append([a, b])
            for a, b in windows:
                for i, d in enumerate(myers(pattern, ids[a:b].tolist())):
                    if d <= k and (best is None or d < best[0]):
                        best = d, a + i + 1, a
            if best:
                d, end, low = best
                back = ids[low:end][::-1].tolist()
                start = next((end - 1 - i for i, x in enumerate(myers(pattern[::-1], back, True)) if x == d), end)
                out.append((item_id, d, m, start, end))
                if first:
                    break
        return out


def item_blocks(benchmark: DataFrame, block_bytes: int, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks; a block's expected size is block_bytes at most."""
    items = id_text(benchmark, id_col, text_col).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    n = max(1, -(-int(total) // block_bytes))
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)) == i).orderBy("doc_id", "text") if n > 1 else items.orderBy("doc_id", "text")
        yield [(r["doc_id"], r["text"]) for r in part.toLocalIterator()]


def _index(items: list[tuple[int, str]], similarity: float, min_words: int) -> ItemIndex:
    return held(("items", hash(tuple(items)), similarity, min_words), lambda: ItemIndex(items, similarity, min_words))


def matches(df: DataFrame, benchmark: DataFrame, similarity: float = 0.8, min_words: int = 1, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, item_id, distance, n_words, similarity, start_word, end_word (exclusive) of each
    item that occurs in a text within its budget, at its best place."""
    docs, out = id_text(df, id_col, text_col), None
    for items in item_blocks(benchmark, block_bytes, item_id_col, item_text_col):
        shared = df.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = _index(shared.value, similarity, min_words)
            for batch in batches:
                rows = [(doc, item, d, m, 1 - d / m, a, b) for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True) for item, d, m, a, b in index.find(text)]
                yield pa.RecordBatch.from_pylist([dict(zip(SCHEMA.names, r, strict=True)) for r in rows], schema=SCHEMA)

        found = docs.mapInArrow(run, "doc_id long, item_id long, distance int, n_words int, similarity double, start_word long, end_word long")
        out = found if out is None else out.union(found)
    return out


def decontaminate(df: DataFrame, benchmark: DataFrame, similarity: float = 0.8, min_words: int = 1, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 32 << 20) -> DataFrame:
    """The rows of df, all columns as they are, whose text holds no item."""
    for items in item_blocks(benchmark, block_bytes, item_id_col, item_text_col):
        shared = df.sparkSession.sparkContext.broadcast(items)

        def clean(texts: list[str | None], shared=shared) -> list[bool]:
            index = _index(shared.value, similarity, min_words)
            return [not index.find(t, first=True) for t in texts]

        df = keep_rows(df, clean, text_col)
    return df

"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

Encoding follows the library for a BPE model with byte fallback, identity
normalisation and a dummy prefix: merges are taken from an agenda, best score
first, then leftmost. With `dropout` > 0 each candidate that leaves the agenda is
skipped with that probability (in steps of 2^-16), decided by a keyed hash of (key, how many
candidates came before). The key of a word is a keyed hash of (seed, text, ordinal of the word), so
each occurrence is segmented on its own, always the same way for the same text and seed.
With `variants` above 0 there are only so many keys.

The agendas of thousands of words are worked through side by side: one column a word, each step
takes the best candidate of every column, skips or merges it, and scores the new neighbours.
`encode` is the same for one word after the other.

No piece has a space after another character, so words (spaces, then other
characters) are independent of each other: the result is that of the whole text.
A U+2581 of the text itself would decode as a space; it is written as bytes.

Decoding joins pieces and bytes and takes off the dummy prefix. It gives the text
back whatever the dropout, seed and variants.

Cases: null and empty texts have no pieces (null stays null in `encode`, decoding gives
null); repeated rows give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

import array
import heapq
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame

from foliospark.llm.columns import id_text, portions
from foliospark.llm.worker import held

MARK = "▁"
WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
MASK = (1 << 64) - 1
M1, M2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(M1)
    x = (x ^ x >> np.uint64(27)) * np.uint64(M2)
    return x ^ x >> np.uint64(31)


class PieceCodec:
    #: Length of the words taken side by side, how many at once, skips drawn at once.
    LONG, ABREAST, DRAWN = 48, 1 << 13, 32
    NONE = (1 << 31) - 1

    def __init__(self, model: bytes, dropout: float = 0.1, seed: int = 0, variants: int = 0):
        p = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = p.get_piece_size()
        self.ids = {p.id_to_piece(i): i for i in range(n) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))}
        self.byte_ids = [0] * 256
        for i in range(n):
            if p.is_byte(i):
                self.byte_ids[int(p.id_to_piece(i)[1:-1], 16)] = i
        self.unknown = p.unk_id()
        if not all(self.byte_ids) or any(re.search(f"[^{MARK}]{MARK}", x) for x in self.ids) or p.encode("a  ﬁ  b", out_type=str) != p.encode("a  ﬁ  b".replace(" ", MARK), out_type=str):
            raise ValueError("a BPE model with byte fallback, spaces first in pieces and no normalisation is needed")
        self.score = {x: -p.get_score(i) for x, i in self.ids.items()}
        self.bytes = [b""] * n
        for x, i in self.ids.items():
            self.bytes[i] = x.replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])
        self.table = np.array(self.bytes, dtype=object)
        self.limit = round(dropout * (1 << 16))
        self.code = "H" if n <= 1 << 16 else "I"
        self.kind = np.dtype(self.code)
        self.seed, self.variants = seed & MASK, max(0, variants)
        self._pairs(n)

    def _pairs(self, n: int) -> None:
        """What two symbols merge to, as a hash table. A symbol is a piece's id or n + the code point of a character that is no piece."""
        self.symbols, self.span = n, n + 0x110000
        self.of_char = np.arange(n, self.span, dtype=np.int32)
        for x, i in self.ids.items():
            if len(x) == 1:
                self.of_char[ord(x)] = i
        of = lambda x: self.ids.get(x, n + ord(x) if len(x) == 1 else None)
        found = [(a, b, i, self.score[x]) for x, i in self.ids.items() for k in range(1, len(x)) if (a := of(x[:k])) is not None and (b := of(x[k:])) is not None]
        key = np.array([a * self.span + b for a, b, _, _ in found], np.int64)
        slot = self._slot(key)
        order = np.argsort(slot, kind="stable")
        self.slots = np.searchsorted(slot[order], np.arange((1 << 18) + 1)).astype(np.int32)
        # One more entry, for no merge, with the key of no pair.
        self.pair = np.append(key[order], np.iinfo(np.int64).min)
        rank = np.unique(np.array([s for *_, s in found]), return_inverse=True)[1] if found else np.empty(0, np.int64)
        self.rank = np.append(rank[order] << 6, self.NONE).astype(np.int32)
        self.merged = np.append(np.array([i for _, _, i, _ in found], np.int32)[order], -1).astype(np.int32)

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)).astype(np.int32)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The entry of each pair of symbols; the last one if they don't merge, or one is -1."""
        key = a.astype(np.int64) * self.span + b
        slot = self._slot(key)
        at, end = self.slots[slot], self.slots[slot + 1]
        last = len(self.pair) - 1
        hit = (self.pair[at] == key) & (at < end)
        out = np.where(hit, at, last)
        left = np.flatnonzero(~hit & (end - at > 1))
        while len(left):
            at[left] += 1
            hit = self.pair[at[left]] == key[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            left = left[at[left] + 1 < end[left]]
        return out

    def drawn(self, keys: np.ndarray, block: int = 0) -> np.ndarray:
        """The first DRAWN skips of each key as bits; those after them as blocks 1, 2, ..."""
        n = self.DRAWN // 4
        x = mixed(keys[:, None] + np.arange(block * n + 1, block * n + n + 1, dtype=np.uint64) * np.uint64(M1)).astype("<u8", copy=False)
        return np.packbits(x.view("<u2") < self.limit, axis=1, bitorder="little").view("<u4")[:, 0]

    def skips(self, key: int) -> Iterator[bool]:
        """Whether the first, second, ... candidate that leaves the agenda is skipped: 16 bits of a keyed hash each."""
        block = 1
        while True:
            h = int(mixed(np.array([(key + block * M1) & MASK], np.uint64))[0])
            for _ in range(4):
                yield (h & 0xFFFF) < self.limit
                h >>= 16
            block += 1

    def packed(self, parts: list[str]) -> bytes:
        ids: list[int] = []
        for piece in parts:
            if (x := self.ids.get(piece)) is not None:
                ids.append(x)
            else:
                ids += [self.byte_ids[b] for b in piece.encode()]
        return array.array(self.code, ids).tobytes()

    def word(self, word: str, key: int) -> bytes:
        """The pieces of one word by the agenda, as packed ids."""
        return self.packed(self.scan(word, key) if len(word) <= self.LONG else self.agenda(word, key))

    def scan(self, word: str, key: int) -> list[str]:
        """The agenda of a short word: the scores of neighbours in a list."""
        get, none = self.score.get, math.inf
        parts = list(word)
        scores = [get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        skip = self.skips(key)
        while scores and (best := min(scores)) < none:
            i = scores.index(best)
            if self.limit and next(skip):
                scores[i] = none
                continue
            parts[i] += parts.pop(i + 1)
            del scores[i]
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], none)
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], none)
        return parts

    def agenda(self, word: str, key: int) -> list[str]:
        """The same with a heap, for words of any length."""
        n, score = len(word), self.score
        skip = self.skips(key)
        end = list(range(1, n + 1))  # of the symbol that begins here; 0: none begins
        before = list(range(-1, n - 1))
        heap = [(s, i, i + 1, i + 2) for i in range(n - 1) if (s := score.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, mid, to = heapq.heappop(heap)
            if end[i] != mid or end[mid] != to or (self.limit and next(skip)):
                continue
            end[i], end[mid] = to, 0
            if to < n:
                before[to] = i
                if (s := score.get(word[i : end[to]])) is not None:
                    heapq.heappush(heap, (s, i, to, end[to]))
            if (p := before[i]) >= 0 and (s := score.get(word[p:to])) is not None:
                heapq.heappush(heap, (s, p, i, to))
        out, i = [], 0
        while i < n:
            out.append(word[i : end[i]])
            i = end[i]
        return out

    def keys(self, bases: np.ndarray, ordinals: np.ndarray) -> np.ndarray:
        """The keys of words from the hashes of (seed, text) and their ordinals."""
        keys = mixed(ordinals.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + bases)
        return mixed(keys % np.uint64(self.variants) + np.uint64(self.seed)) if self.variants else keys

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text's pieces, word by word."""
        if not text:
            return np.empty(0, self.kind)
        out: list[bytes] = []
        ordinal = 0
        base = np.uint64(xxhash.xxh64_intdigest(text.encode(), self.seed))
        # A mark of the text's own is three bytes, and no word reaches over it.
        for k, part in enumerate(text.split(MARK)):
            if k:
                out.append(np.array([self.byte_ids[b] for b in MARK.encode()], self.kind).tobytes())
            line = part.replace(" ", MARK)
            words = WORDS.findall(MARK + line if not k else line)
            keys = self.keys(base, np.arange(ordinal, ordinal + len(words)))
            ordinal += len(words)
            out += [self.word(w, key) for w, key in zip(words, keys.tolist(), strict=True)]
        return np.frombuffer(b"".join(out), self.kind)

    def abreast(self, chars: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of short words (chars[start : start + size]) one after the other, and how many each has."""
        high, wide = int(sizes.max()) + 2, len(starts)
        # A column a word, between two borders; flat views of the same memory are indexed by row * wide + column.
        symbol = np.full((high, wide), -1, np.int32)
        column = np.repeat(np.arange(wide), sizes)
        row = np.arange(len(column)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        symbol[row + 1, column] = chars[np.repeat(starts, sizes) + row]
        entry = self.lookup(symbol[:-1].ravel(), symbol[1:].ravel())
        rows = np.arange(high, dtype=np.int32)[:, None]
        best = np.full((high, wide), self.NONE, np.int32)
        best[:-1] = self.rank[entry].reshape(high - 1, wide) | rows[:-1]
        merges = np.full((high, wide), -1, np.int32)
        merges[:-1] = self.merged[entry].reshape(high - 1, wide)
        after = np.repeat(rows + 1, wide, axis=1).astype(np.uint8)
        before = np.repeat(np.maximum(rows - 1, 0), wide, axis=1).astype(np.uint8)
        symbols, scores, to, nexts, lasts = (x.reshape(-1) for x in (symbol, best, merges, after, before))
        step, bits = 0, np.empty(0, np.uint32)
        while True:
            first = best.min(axis=0)
            at = np.flatnonzero(first < self.NONE)
            if not len(at):
                break
            pos = first[at] & 63
            if self.limit:
                if step % self.DRAWN == 0:
                    bits = self.drawn(keys, step // self.DRAWN)
                skip = (bits[at] >> np.uint32(step % self.DRAWN) & np.uint32(1)).astype(bool)
                scores[pos[skip] * wide + at[skip]] = self.NONE
                at, pos = at[~skip], pos[~skip]
            step += 1
            here = pos * wide + at
            gone = nexts[here].astype(np.int64) * wide + at
            new = to[here]
            symbols[here], symbols[gone], scores[gone] = new, -1, self.NONE
            right, left = nexts[gone], lasts[here]
            nexts[here] = right
            right, prior = right.astype(np.int64) * wide + at, left.astype(np.int64) * wide + at
            lasts[right] = pos
            entry = self.lookup(np.concatenate([new, symbols[prior]]), np.concatenate([symbols[right], new]))
            cells = np.concatenate([here, prior])
            scores[cells] = self.rank[entry] | np.concatenate([pos, left.astype(np.int32)])
            to[cells] = self.merged[entry]
        found = symbol.T
        have = found >= 0
        return found[have], have.sum(axis=1)

    def spelled(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same with the bytes of characters that are no piece."""
        if not (other := symbols >= self.symbols).any():
            return symbols, counts
        code = np.where(other, symbols - self.symbols, 0)
        size = 1 + sum((code >= least).astype(np.int64) for least in (0x80, 0x800, 0x10000))
        out = np.repeat(symbols, size)
        kinds, which = np.unique(symbols[other], return_inverse=True)
        spelling = [[self.byte_ids[b] for b in chr(c - self.symbols).encode()] for c in kinds.tolist()]
        out[np.repeat(other, size)] = list(itertools.chain.from_iterable(spelling[i] for i in which.tolist()))
        ends = np.cumsum(size)[np.cumsum(counts) - 1]
        return out, np.diff(ends, prepend=0)

    def encode_many(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """The same as `encode` of each text: words are taken side by side."""
        out: list[np.ndarray | None] = [None if t is None else np.empty(0, self.kind) for t in texts]
        some = [i for i, t in enumerate(texts) if t]
        if not some:
            return out
        chars = np.frombuffer("".join(MARK + texts[i] for i in some).encode("utf-32-le"), np.uint32)  # type: ignore[operator]
        lengths = np.array([len(texts[i]) + 1 for i in some])  # type: ignore[arg-type]
        begin = np.cumsum(lengths) - lengths
        # A mark of the text's own is a word, and a character that is no piece.
        own = chars == ord(MARK)
        own[begin] = False
        mark = chars == ord(" ")
        mark[begin] = True
        symbols = self.of_char[np.where(mark, ord(MARK), chars)]
        symbols[own] = self.symbols + ord(MARK)
        start = mark | own
        start[1:] &= ~mark[:-1] | own[1:]
        start[1:] |= own[:-1]
        start[begin] = True
        starts = np.flatnonzero(start)
        sizes = np.diff(starts, append=len(chars))
        # The ordinal of a word among those of its text that aren't marks of its own.
        before = np.cumsum(~own[starts]) - 1
        first = np.searchsorted(starts, begin)
        per = np.diff(first, append=len(starts))
        bases = np.array([xxhash.xxh64_intdigest(texts[i].encode(), self.seed) for i in some], np.uint64)  # type: ignore[union-attr]
        keys = self.keys(np.repeat(bases, per), np.maximum(before - np.repeat(before[first], per), 0))

        order = np.argsort(np.minimum(sizes, self.LONG + 1).astype(np.uint8), kind="stable")
        short = int((sizes <= self.LONG).sum())
        parts: list[np.ndarray] = []
        counts = np.zeros(len(starts), np.int64)
        for a in range(0, short, self.ABREAST):
            which = order[a : min(a + self.ABREAST, short)]
            got, n = self.spelled(*self.abreast(symbols, starts[which], sizes[which], keys[which]))
            parts.append(got.astype(self.kind))
            counts[which] = n
        for w in order[short:].tolist():
            word = chars[starts[w] : starts[w] + sizes[w]].tobytes().decode("utf-32-le").replace(" ", MARK)
            parts.append(np.frombuffer(self.word(word, int(keys[w])), self.kind))
            counts[w] = len(parts[-1])
        flat = np.concatenate(parts)
        ends = np.cumsum(counts)
        n = counts[order]
        ids = np.empty(len(flat), self.kind)
        ids[np.repeat((ends - counts)[order] - (np.cumsum(n) - n), n) + np.arange(len(flat))] = flat
        for i, part in zip(some, np.split(ids, ends[(first + per - 1)[:-1]]), strict=True):
            out[i] = part
        return out

    def decode(self, ids: np.ndarray | list[int] | None) -> str | None:
        if ids is None:
            return None
        return b"".join(self.table[np.asarray(ids, np.int64)].tolist()).decode()[1:]


def codec(model: bytes, dropout: float, seed: int, variants: int) -> PieceCodec:
    return held(("pieces", hash(model), dropout, seed, variants), lambda: PieceCodec(model, dropout, seed, variants))


def encode(df: DataFrame, model: bytes, dropout: float = 0.1, seed: int = 0, variants: int = 0, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """doc_id, text, pieces (array of int; null for a null text) of every row; no shuffle.

    decoded: adds a column of that name, what `decode` makes of the pieces, in the same pass.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("pieces", pa.list_(pa.int32())), *([("decoded", pa.string())] if decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value, dropout, seed, variants)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in portions(texts):
                got = c.encode_many(texts[a:b])
                back = [pa.array([c.decode(x) for x in got], pa.string())] if decoded else []
                ends = np.cumsum([0, *(0 if x is None else len(x) for x in got)]).astype(np.int32)
                flat = np.concatenate([x for x in got if x is not None] or [np.empty(0, c.kind)]).astype(np.int32)
                pieces = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=pa.array([x is None for x in got], pa.bool_()))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), batch["text"].slice(a, b - a), pieces, *back], schema=schema)

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, text string, pieces array<int>" + ", decoded string" * decoded)


def decode(df: DataFrame, model: bytes, pieces_col: str = "pieces") -> DataFrame:
    """All columns of df and `decoded` (in place of a column of that name), the text of the pieces; null for null pieces; no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    from pyspark.sql.types import StringType, StructField, StructType

    to = StructType([*(f for f in df.schema if f.name != "decoded"), StructField("decoded", StringType())])
    names = [f.name for f in to][:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value, 0.0, 0, 1)
        for batch in (whole.slice(i, 500) for whole in batches for i in range(0, whole.num_rows, 500)):
            lists = batch[pieces_col]
            values, offsets = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            valid = lists.is_valid().to_pylist()
            out = [c.decode(values[a:b]) if ok else None for ok, a, b in zip(valid, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(out, pa.string())], names=[*names, "decoded"])

    return df.select(*(f"`{n}`" for n in names)).mapInArrow(run, to)

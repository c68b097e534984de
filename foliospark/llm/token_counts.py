"""Token counts by finite-state tokenizer compilation.

Two deterministic transducers are compiled from a byte-level BPE vocabulary:

* The *splitter* reads code points and has a handful of states. It finds where
  pre-tokens begin. Long input is cut into equal chunks; for every chunk the map
  "state before -> state after" is computed for all states at once, the maps are
  composed by a parallel prefix scan, and then all chunks run in lock-step from
  their true start states. One long document is so spread over many chunks.
* The *counter* reads the bytes of one pre-token. Each transition carries how
  many tokens the greedy-merge result of the prefix gains or loses (the count of
  emitted tokens, as a weight). It is determinised lazily: a state holds the
  vocabulary prefixes that still may become the last token, the last token before
  each, and counts relative to the current one. A new last token is right if and
  only if it and its left neighbour merge back to just these two tokens.

Only counts leave the operator; token ids are never built.

Cases: a null or empty text has 0 tokens and 0 bytes. A special string in a text
counts as one token unless `special_as_text`. Repeated rows give repeated rows;
an empty table gives an empty result; other columns are neither read nor kept.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from foliospark.llm.columns import id_text
from foliospark.llm.worker import held

# Classes of code points, as the splitter reads them.
LETTER, STMD, R, E, V, L, NUMBER, OTHER, APOS, SPACE, WS, RESET = range(12)
# Its states. After RESET nothing has been read; A.. follow an apostrophe that begins a pre-token.
S_START, S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_WS, S_APOS, S_R, S_V, S_L, S_DONE = range(11)
N_STATES = 11
SENTINEL = 0x110000

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


@functools.cache
def class_table() -> np.ndarray:
    """The splitter's class of each code point; surrogates don't occur."""
    out = np.full(SENTINEL + 1, OTHER, np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            out[i] = LETTER
        elif kind == "N":
            out[i] = NUMBER
    for i in [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]:
        out[i] = WS
    for c in "stmd":
        out[ord(c)] = STMD
    for c, k in (("r", R), ("e", E), ("v", V), ("l", L), ("'", APOS), (" ", SPACE)):
        out[ord(c)] = k
    out[SENTINEL] = RESET
    return out


@functools.cache
def transitions() -> np.ndarray:
    t = np.empty((N_STATES, 12), np.int16)
    for s in range(N_STATES):
        for k in range(12):
            if k in (LETTER, STMD, R, E, V, L):
                to = S_LETTER
                if s == S_APOS:
                    to = {STMD: S_DONE, R: S_R, V: S_V, L: S_L}.get(k, S_LETTER)
                elif (s, k) in ((S_R, E), (S_V, E), (S_L, L)):
                    to = S_DONE
            elif k == APOS:
                # It begins a pre-token unless it goes on a run of others or takes the space before it.
                to = S_OTHER if s in (S_OTHER, S_SPACE, S_APOS) else S_APOS
            else:
                to = {NUMBER: S_NUMBER, OTHER: S_OTHER, SPACE: S_SPACE, WS: S_WS, RESET: S_START}[k]
            t[s, k] = to
    return t


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """maps[i, s]: the state after chunk i if s is the state before it. Returns
    the composition of maps 0..i for each i, in log2(n) vectorised rounds."""
    out, step = maps.copy(), 1
    while step < len(out):
        later = np.take_along_axis(out[step:], out[:-step].astype(np.intp), axis=1)
        out = np.concatenate([out[:step], later])
        step *= 2
    return out


def states(classes: np.ndarray, chunk: int = 1024) -> np.ndarray:
    """The splitter's state after each code point, from S_START."""
    n, t = len(classes), transitions().ravel()
    chunk = max(16, min(chunk, int(n**0.5) + 1))
    rows = -(-n // chunk)
    grid = np.full(rows * chunk, RESET, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(rows, chunk).T)
    # State maps of all chunks: most become constant after a few symbols.
    maps = np.tile(np.arange(N_STATES, dtype=np.int16), (rows, 1))
    live = np.arange(rows)
    last = maps
    const = np.full(rows, -1, np.int64)
    for i in range(chunk):
        last = t[last * 12 + grid[i, live][:, None]]
        done = (last == last[:, :1]).all(axis=1)
        if done.any():
            const[live[done]] = i
            maps[live[done]] = last[done]
            live, last = live[~done], last[~done]
            if not len(live):
                break
    maps[live] = last
    # Constant maps are run to the chunk's end with one state each.
    end = maps[:, 0].copy()
    for i in range(int(const.min(initial=chunk)) + 1 if (const >= 0).any() else chunk, chunk):
        on = (const >= 0) & (const < i)
        end = np.where(on, t[end * 12 + grid[i]], end)
    maps = np.where((const >= 0)[:, None], end[:, None], maps)
    before = np.concatenate([[S_START], prefix_scan(maps)[:-1, S_START]]).astype(np.int16)
    out = np.empty((chunk, rows), np.int8)
    for i in range(chunk):
        before = t[before * 12 + grid[i]]
        out[i] = before
    return out.T.ravel()[:n]


def begins(classes: np.ndarray) -> np.ndarray:
    """For each code point, whether a pre-token begins there. RESET symbols are 'begins' too."""
    s = states(classes)
    n = len(classes)
    prev = np.concatenate([[S_START], s[:-1]])
    nxt = np.concatenate([classes[1:], [RESET]])
    white, was_white = (classes == SPACE) | (classes == WS), (prev == S_SPACE) | (prev == S_WS)
    out = np.zeros(n, bool)
    out |= classes == RESET
    next_solid = (nxt != SPACE) & (nxt != WS) & (nxt != RESET)
    out |= white & (~was_white | next_solid)
    solid = ~white & (classes != RESET)
    kind = np.array([0, 1, 2, 3, 4, 5, 3, 1, 1, 1, 6])
    letters = classes <= L
    own = np.where(letters, 1, np.where(classes == NUMBER, 2, 3))
    change = own != kind[prev]
    # A contraction's letters go on from its apostrophe; 'r 'v 'l only if the next letter completes it.
    after = np.concatenate([s[1:], [S_START]])
    two = ((s == S_R) | (s == S_V) | (s == S_L)) & (after == S_DONE)
    change &= ~((s == S_DONE) | two)
    out |= solid & (prev != S_SPACE) & change
    return out


class BpeCounter:
    """Counts tokens of single pre-tokens with the lazily determinised transducer."""

    #: Bounds of its caches; a full cache is emptied.
    WORDS, STEPS, LONG = 1_000_000, 400_000, 64

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        self.rank = {m: i for i, m in enumerate(merges)}
        self.tokens = {bytes([b]) for b in range(256)} | {a + b for a, b in merges}
        self.prefixes = {t[:i] for t in self.tokens for i in range(len(t))}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.words: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.ids: dict[tuple, int] = {((b"", b"", 0),): 0}
        self.states: list[tuple] = [((b"", b"", 0),)]
        self.steps: dict[int, tuple[int, int]] = {}

    def merged(self, piece: bytes) -> list[bytes]:
        """The plain greedy merge of a short string, for pairs of tokens only."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranks = [self.rank.get(p, 1 << 30) for p in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == 1 << 30:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def fits(self, left: bytes, token: bytes) -> bool:
        key = (left, token)
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) > self.WORDS:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(left + token) == ([left, token] if left else [token])
        return known

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """(next state, tokens gained). An item is (open prefix, last token before it, count before it less the current count)."""
        b, gained, items, token = bytes([byte]), None, [], b""
        for open_, left, rel in self.states[state]:  # longest first
            grown = open_ + b
            if gained is None and grown in self.tokens and self.fits(left, grown):
                gained, token = rel + 1, grown
            if grown in self.prefixes:
                items.append((grown, left, rel))
        new = (*((g, left, rel - gained) for g, left, rel in items), (b"", token, 0))
        if (to := self.ids.get(new)) is None:
            to = self.ids[new] = len(self.states)
            self.states.append(new)
        return to, gained

    def count(self, word: str) -> int:
        total = state = 0
        for byte in word.encode():
            key = state << 8 | byte
            if (known := self.steps.get(key)) is None:
                if len(self.steps) > self.STEPS:
                    keep = self.states[state]
                    self._clear()
                    if keep not in self.ids:
                        self.ids[keep] = len(self.states)
                        self.states.append(keep)
                    state = self.ids[keep]
                    key = state << 8 | byte
                known = self.steps[key] = self.step(state, byte)
            state, gained = known
            total += gained
        return total

    def counts(self, words: list[str]) -> np.ndarray:
        known, count = self.words, self.count
        out = np.empty(len(words), np.int64)
        if len(known) > self.WORDS:
            known.clear()
        found = list(map(known.get, words))
        for i, x in enumerate(found):
            if x is None:
                w = words[i]
                if (x := known.get(w)) is None:
                    x = count(w)
                    if len(w) <= self.LONG:
                        known[w] = x
                found[i] = x
        out[:] = found
        return out


def bpe_parts(tokenizer_json: str) -> tuple[list[tuple[bytes, bytes]], list[str]]:
    """Merges as bytes and the special strings of a byte-level BPE file."""
    j = json.loads(tokenizer_json)
    if j["model"]["type"] != "BPE" or j["pre_tokenizer"]["type"] != "ByteLevel" or j["normalizer"] is not None or j["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError("a byte-level BPE without normalizer and prefix space is needed")
    # The printable stand-ins of bytes: printable Latin-1 stands for itself, the rest from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    raw = lambda s: bytes(chars[c] for c in s)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in j["model"]["merges"]]
    return [(raw(a), raw(b)) for a, b in merges], [x["content"] for x in j["added_tokens"]]


def count_batch(texts: list[str | None], counter: BpeCounter, specials: list[str]) -> np.ndarray:
    """Tokens of each text; the texts of a batch are one input, parted by RESET symbols."""
    extra = np.zeros(len(texts), np.int64)
    parts: list[str] = []
    owner: list[int] = []
    for i, text in enumerate(texts):
        pieces = [text] if text else []
        for s in specials:
            if text and s in text:
                cut = [p.split(s) for p in pieces]
                extra[i] += sum(len(c) - 1 for c in cut)
                pieces = [x for c in cut for x in c]
        pieces = [p for p in pieces if p]
        parts += pieces
        owner += [i] * len(pieces)
    if not parts:
        return extra
    # U+0000 parts the pieces in the string; the class array has RESET there.
    whole = "\0".join(parts) + "\0"
    classes = class_table()[np.frombuffer(whole.encode("utf-32-le"), np.uint32)]
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    classes[ends] = RESET
    starts = np.flatnonzero(begins(classes))
    stops = np.append(starts[1:], len(whole))
    real = classes[starts] != RESET
    starts, stops = starts[real], stops[real]
    words = [whole[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
    counts = counter.counts(words)
    of = np.searchsorted(ends, starts)
    per_part = np.bincount(of, weights=counts, minlength=len(parts)).astype(np.int64)
    np.add.at(extra, np.array(owner), per_part)
    return extra


def token_counts(df: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text", special_as_text: bool = False, batch_chars: int = 2_000_000) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens of every whole text; tokenizer_json is the file's content.

    The file goes to the executors as a broadcast of its own, fixed size. Rows are
    worked on where they are: no shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> tuple[BpeCounter, list[str]]:
            merges, specials = bpe_parts(shared.value)
            return BpeCounter(merges), specials

        counter, specials = held(("tokens", hash(shared.value)), made)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            tokens = np.zeros(len(texts), np.int64)
            at = 0
            while at < len(texts):
                to, chars = at, 0
                while to < len(texts) and (to == at or chars + len(texts[to] or "") <= batch_chars):
                    chars += len(texts[to] or "")
                    to += 1
                tokens[at:to] = count_batch(texts[at:to], counter, [] if special_as_text else specials)
                at = to
            size = [len(t.encode()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(tokens)], schema=SCHEMA)

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")

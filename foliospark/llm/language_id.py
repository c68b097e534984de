"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a sample of labelled text. A
text is parsed against it from left to right into the longest phrases that occur
in that sample; a language that knows the text needs few phrases. Phrases per
letter group are normalised by the text's length and the language with the
fewest wins.

Text is folded to lower case; every run of characters that are not letters is
one space. The whole text is parsed. Blocks of `block` symbols run in lock-step as NumPy gathers, so
a long document is no long task: each is parsed as if a phrase began with it, then again
from the state in which the block before it ends, until the state is that of the first parse (what
follows is then the same), until no block ends in another state (after some rounds one after the other). So phrases reach over the ends of blocks.

The fit takes a bounded sample of labelled rows: for each label at most `rows` whole texts (those with
the least hash), of `symbols` symbols together at most, whatever the table's size; the sample is
what is broadcast, and each Python worker builds the automata once.

Cases: a null text or one without a letter gives `und` with score 0. A tie goes to
the language first in alphabetical order. Without any labelled text every
prediction is `und`. Repeated rows give repeated rows, an empty table an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.columns import id_text, keep_rows, portions
from foliospark.llm.worker import held

SCHEMA = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("phrases", pa.int64()), ("n_symbols", pa.int64())])
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")
TOGETHER = 3  # rounds in which blocks are parsed again together


def folded(text: str | None) -> str:
    """Lower-case letters, with one space for all that lies between them; '' if there is no letter."""
    if not text or not _LETTER.search(text):
        return ""
    return _NOT_LETTERS.sub(" ", text.lower()).strip()


class SuffixAutomaton:
    """Transitions of the automaton of all substrings, as one dense table.

    Column 0 is for symbols that the sample lacks. next[s, c] is -1 where the phrase ends.
    """

    def __init__(self, text: str, alphabet: dict[str, int]):
        links, lengths, out = [-1], [0], [{}]
        last = 0
        for ch in text:
            c = alphabet[ch]
            cur = len(out)
            out.append({})
            links.append(0)
            lengths.append(lengths[last] + 1)
            p = last
            while p != -1 and c not in out[p]:
                out[p][c] = cur
                p = links[p]
            if p == -1:
                links[cur] = 0
            else:
                q = out[p][c]
                if lengths[p] + 1 == lengths[q]:
                    links[cur] = q
                else:
                    clone = len(out)
                    out.append(dict(out[q]))
                    links.append(links[q])
                    lengths.append(lengths[p] + 1)
                    while p != -1 and out[p].get(c) == q:
                        out[p][c] = clone
                        p = links[p]
                    links[q] = links[cur] = clone
            last = cur
        # The last row has no way out: there one is after a symbol that the sample lacks.
        self.next = np.full((len(out) + 1, len(alphabet) + 1), -1, np.int32)
        for s, o in enumerate(out):
            for c, to in o.items():
                self.next[s, c] = to


class CrossParser:
    """The automata of all languages over one alphabet."""

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        chars = sorted({c for t in samples.values() for c in t})
        self.alphabet = {c: i + 1 for i, c in enumerate(chars)}
        self.lookup = np.zeros(0x110000, np.int16 if len(chars) < 30_000 else np.int32)
        for c, i in self.alphabet.items():
            self.lookup[ord(c)] = i
        self.tables = [SuffixAutomaton(samples[x], self.alphabet).next for x in self.langs]

    def phrases(self, texts: list[str], block: int) -> np.ndarray:
        """[text, language]: phrases of the folded texts, which aren't empty; the same for any size of the blocks."""
        symbols = [self.lookup[np.frombuffer(t.encode("utf-32-le"), np.uint32)] for t in texts]
        blocks = [-(-len(s) // block) for s in symbols]
        grid = np.full((sum(blocks), block), -1, np.int32)
        owner = np.repeat(np.arange(len(texts)), blocks)
        at = 0
        for s, n in zip(symbols, blocks, strict=True):
            grid[at : at + n].reshape(-1)[: len(s)] = s
            at += n
        sizes = (grid >= 0).sum(axis=1)
        order = np.argsort(-sizes, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        later = np.flatnonzero(owner[1:] == owner[:-1]) + 1
        before, after = np.full(len(order), -1), np.full(len(order), -1)
        before[place[later]], after[place[later - 1]] = place[later - 1], place[later]
        grid, owner, sizes = np.ascontiguousarray(grid[order].T), owner[order], sizes[order]
        active = np.searchsorted(-sizes, -np.arange(block), side="left")  # blocks longer than i
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        for k, table in enumerate(self.tables):
            flat, width = table.ravel(), table.shape[1]
            first = np.where(table[0] < 0, len(table) - 1, table[0]).astype(np.int32)
            state = np.zeros(len(owner), np.int32)
            # After each symbol: the state, and whether it began a phrase.
            states, began = np.zeros(grid.shape, np.int32), np.zeros(grid.shape, bool)
            for i in range(block):
                n = active[i]
                if not n:
                    break
                c = grid[i, :n]
                to = flat[state[:n].astype(np.int64) * width + c]
                miss = to < 0
                began[i, :n] = miss if i else True
                states[i, :n] = state[:n] = np.where(miss, first[c], to)
            again = np.flatnonzero(before >= 0)
            for _ in range(TOGETHER):
                ended = after[self._entered(again, before, grid, sizes, flat, width, first, states, began)]
                again = ended[ended >= 0]
            self._chained(again, before, after, grid, sizes, flat, width, first, states, began)
            np.add.at(out[:, k], owner, began.sum(axis=0))
        return out

    @staticmethod
    def _entered(blocks, before, grid, sizes, flat, width, first, states, began) -> np.ndarray:
        """Parses blocks again from the state in which the one before ends, until it is that of the last parse. Returns the blocks that now end in another."""
        state = states[-1, before[blocks]]
        for i in range(len(grid)):
            there = sizes[blocks] > i
            blocks, state = blocks[there], state[there]
            if not len(blocks):
                break
            c = grid[i, blocks]
            to = flat[state.astype(np.int64) * width + c]
            began[i, blocks] = miss = to < 0
            state = np.where(miss, first[c], to)
            other = states[i, blocks] != state
            states[i, blocks] = state
            blocks, state = blocks[other], state[other]
        return blocks

    @staticmethod
    def _chained(blocks, before, after, grid, sizes, flat, width, first, states, began) -> None:
        """The same for the few that are left, in the order of the text, one symbol after the other and on through those that follow."""
        for b in np.sort(blocks).tolist():
            while b >= 0:
                state, other = int(states[-1, before[b]]), True
                was, starts = states[:, b].tolist(), began[:, b].copy()
                now = []
                for i, c in enumerate(grid[: sizes[b], b].tolist()):
                    to = flat.item(state * width + c)
                    starts[i] = to < 0
                    state = first.item(c) if to < 0 else to
                    if state == was[i]:
                        other = False
                        break
                    now.append(state)
                states[: len(now), b], began[:, b] = now, starts
                b = int(after[b]) if other else -1


def sample(labelled: DataFrame, rows: int, symbols: int) -> dict[str, str]:
    """The bounded sample: from columns text and lang (not null), the text to learn for each language. Texts of over `symbols`
    characters aren't drawn; of the others, in the order of their hash, whole ones as long as they fit.

    The window's limit is applied in each task before the shuffle, so a language
    that holds most rows sends no more than the others.
    """
    w = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
    some = (
        labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= symbols))
        .select("lang", "text")
        .withColumn("n", F.row_number().over(w))
        .where(F.col("n") <= rows)
        .orderBy("lang", "n")
    )
    out: dict[str, list[str]] = {}
    size: dict[str, int] = {}
    for r in some.toLocalIterator():
        t, lang = folded(r["text"]), r["lang"]
        if t and size.get(lang, 0) + len(t) + 1 <= symbols:
            out.setdefault(lang, []).append(t)
            size[lang] = size.get(lang, 0) + len(t) + 1
    return {lang: " ".join(parts) for lang, parts in out.items()}


def predict(samples: dict[str, str], texts: list[str | None], block: int = 256) -> tuple[list[str], list[float], list[int], list[int]]:
    """Language, score, phrases and symbols of each text. The score is the share of
    phrases that the best language saves against the second best (1 if there is no second)."""
    p = held(("language", hash(tuple(sorted(samples.items())))), lambda: CrossParser(samples))
    fold = [folded(t) for t in texts]
    some = [i for i, t in enumerate(fold) if t] if p.langs else []
    lang, score, phrases, n = ["und"] * len(texts), [0.0] * len(texts), [0] * len(texts), [len(t) for t in fold]
    if some:
        got = p.phrases([fold[i] for i in some], block)
        best = got.argmin(axis=1)
        least = got[np.arange(len(some)), best]
        rest = got.copy()
        rest[np.arange(len(some)), best] = np.iinfo(np.int64).max
        second = rest.min(axis=1)
        for i, b, x, y in zip(some, best.tolist(), least.tolist(), second.tolist(), strict=True):
            lang[i], phrases[i] = p.langs[b], x
            score[i] = 1.0 if len(p.langs) == 1 else (y - x) / y
    return lang, score, phrases, n


def language_id(df: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = 100, symbols: int = 80_000, block: int = 256, batch_chars: int = 1_000_000) -> DataFrame:
    """doc_id, lang_pred, score, phrases, n_symbols for every row of df; labelled has text and lang."""
    shared = df.sparkSession.sparkContext.broadcast(sample(labelled, rows, symbols))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out: tuple[list, ...] = ([], [], [], [])
            for a, b in portions(texts, batch_chars):
                for have, new in zip(out, predict(samples, texts[a:b], block), strict=True):
                    have += new
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, f.type) for x, f in zip(out, list(SCHEMA)[1:], strict=True))], schema=SCHEMA)

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double, phrases long, n_symbols long")


def known_language(df: DataFrame, labelled: DataFrame, text_col: str = "text", rows: int = 100, symbols: int = 80_000, block: int = 256, max_rate: float = 0.4, judged: int = 60) -> DataFrame:
    """The rows of df, all columns as they are, whose text is in a learned language: it has a letter, and if it has `judged` symbols or
    more, the best language needs at most `max_rate` phrases a symbol. Shorter texts tell too little to be judged by that.
    (Texts of the learned languages need about 0.15, with keys and addresses in them up to 0.35; a script that no sample has needs 1.)"""
    shared = df.sparkSession.sparkContext.broadcast(sample(labelled, rows, symbols))

    def keep(texts: list[str | None]) -> list[bool]:
        lang, _, phrases, n = predict(shared.value, texts, block)
        return [x != "und" and (m < judged or p <= max_rate * m) for x, p, m in zip(lang, phrases, n, strict=True)]

    return keep_rows(df, keep, text_col)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3: 1 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))

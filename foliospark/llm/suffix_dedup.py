"""Exact substring deduplication by bucket-pointer refinement.

Every byte covered by a `length`-byte string that also starts earlier in the corpus
(lesser doc_id, or same document and lesser start) is removed.

Suffixes are not all sorted: of the q-grams of each document those are taken that
have the least hash in some window of length - q + 1 of them, so any string of
`length` bytes has such an *anchor*, at the same place wherever it occurs.

1. Initial buckets are the anchors' q-grams. Tasks send which slots of a fixed
   table they hit, compressed; anchors whose slot was hit once in the whole corpus
   are alone in their bucket, all their strings are first, and they go no further.
2. Within its bucket an anchor points to the bucket of its whole context, that is of
   all bytes of the strings around it (at most length - q to either side). Strings
   around an anchor whose context occurs earlier all occur earlier: settled.
3. A bucket with several contexts is refined: its members are sorted on (identifier, identifier of the gram at the
   next later offset), and the new identifiers are what the next round sorts on, to the right of the
   anchor and to its left. A string is told by the pair of identifiers of its two parts; ranges of offsets are settled
   together where the widest parts were seen before (repeats) or the narrowest are alone (first); the
   others go on byte by byte, which makes the result exact.
4. A bucket with over `hot` contexts isn't brought together in one task: its members' strings are dealt out by
   identifiers that are equal in all tasks (two 64-bit hashes), and each task's are summed before they move.

What moves: 36 bytes for a suspected anchor, and documents with suspected anchors
twice. Buckets are compared by 64-bit hashes of two kinds (contexts by 128 bits).

Cases: a null or empty text has no byte and nothing is removed; texts shorter than
`length` keep all; rows with one doc_id count as one place (strings at the same
start of the same doc_id aren't earlier than each other); a null doc_id comes
before all others; what is left of bytes may cut a character in two, and `kept` is
binary therefore; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.columns import id_text
from foliospark.llm.shared_slots import Shared, shared_table, slots_for
from foliospark.runtime import materialize

Q = 40
B1, B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
NULL_ID = -1 << 62
RANGES = pa.schema([("doc_id", pa.int64()), ("ranges", pa.list_(pa.int64()))])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


_SYMBOLS = _mix(np.arange(1, 257, dtype=np.uint64) * B1)


def _powers(base: int, n: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, from a table that grows as longer texts come."""
    have = known.get(base)
    if have is None or len(have) < n:
        have = np.full(max(1 << 16, 1 << (n - 1).bit_length()), np.uint64(base))
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        known[base] = have
    return have[:n]


_KNOWN: dict[int, np.ndarray] = {}
_BASES = [(int(b) | 1, pow(int(b) | 1, -1, 1 << 64)) for b in (B1, B2)]


class Rolling:
    """Hashes of any stretch of a byte array by two bases (the second when first asked for)."""

    def __init__(self, data: np.ndarray):
        self.symbols = _SYMBOLS[data]
        self.sums: list[np.ndarray | None] = [None, None]

    def sum(self, kind: int) -> np.ndarray:
        if (s := self.sums[kind]) is None:
            n = len(self.symbols)
            s = self.sums[kind] = np.zeros(n + 1, np.uint64)
            np.cumsum(self.symbols * _powers(_BASES[kind][0], n, _KNOWN), out=s[1:])
        return s

    def inverse(self, kind: int) -> np.ndarray:
        return _powers(_BASES[kind][1], len(self.symbols) + 1, _KNOWN)

    def of(self, start: np.ndarray, stop: np.ndarray, kind: int) -> np.ndarray:
        s = self.sum(kind)
        return _mix((s[stop] - s[start]) * self.inverse(kind)[start])

    def grams(self, q: int) -> np.ndarray:
        s = self.sum(0)
        return _mix((s[q:] - s[:-q]) * self.inverse(0)[: len(s) - q])


def _slide(v: np.ndarray, w: int, f) -> np.ndarray:
    """f over each window of w."""
    out, size = v, 1
    while 2 * size <= w:
        out = f(out[:-size], out[size:])
        size *= 2
    return out if size == w else f(out[: len(out) - (w - size)], out[w - size :])


def anchors(grams: np.ndarray, w: int) -> np.ndarray:
    """Positions whose hash is the least in some window of w grams."""
    if len(grams) < w:
        return np.empty(0, np.int64)
    least = _slide(grams, w, np.minimum)
    pad = np.zeros(w - 1, np.uint64)
    most = _slide(np.concatenate([pad, least, pad]), w, np.maximum)
    return np.flatnonzero(most == grams)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            t = text.as_py()
            yield (NULL_ID if doc is None else doc), (t.encode() if t else b"")


def buckets(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]:
    """The buckets of all anchors, document by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, data in _texts(batches):
            if len(data) >= length:
                g = Rolling(np.frombuffer(data, np.uint8)).grams(Q)
                yield g[anchors(g, length - Q + 1)]

    return run


def suspects(docs: DataFrame, table: bytes, slots: int, length: int) -> DataFrame:
    """bucket, context, doc, pos, lo, hi of anchors whose slot is shared; context lies at [lo, hi)."""
    w, side = length - Q + 1, length - Q
    shared = docs.sparkSession.sparkContext.broadcast(table)
    names = ["bucket", "context", "doc", "pos", "lo", "hi"]
    types = [pa.int64()] * 3 + [pa.int32()] * 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Shared(shared.value, slots)
        out: list[list[np.ndarray]] = [[] for _ in names]
        n = 0

        def flush() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.empty(0, np.int64), t) for x, t in zip(out, types, strict=True)], names=names)
            for x in out:
                x.clear()
            return got

        for doc, data in _texts(batches):
            if len(data) < length:
                continue
            r = Rolling(np.frombuffer(data, np.uint8))
            g = r.grams(Q)
            at = anchors(g, w)
            at = at[known.of(g[at])]
            if not len(at):
                continue
            lo, hi = np.maximum(at - side, 0), np.minimum(at + length, len(data))
            context = r.of(lo, hi, 1) ^ _mix(((at - lo) * 1024 + (hi - at)).astype(np.uint64))
            for x, v in zip(out, (g[at].view(np.int64), context.view(np.int64), np.full(len(at), doc), at.astype(np.int32), lo.astype(np.int32), hi.astype(np.int32)), strict=True):
                x.append(v)
            n += len(at)
            if n > 200_000:
                yield flush()
                n = 0
        yield flush()

    return docs.mapInArrow(run, "bucket long, context long, doc long, pos int, lo int, hi int")


STEP = 8  # bytes of a gram at a later offset


def named(*keys: np.ndarray) -> np.ndarray:
    """Dense identifiers of the tuples of some identifiers, by sorting them."""
    x = keys[0]
    for k in keys[1:]:
        x = x * (int(k.max(initial=0)) + 1) + k
    return np.unique(x, return_inverse=True)[1]


def _grams(contexts: np.ndarray, a: int, b: int) -> np.ndarray:
    """Identifiers of the bytes [a, b), of which there are at most eight."""
    x = np.zeros(len(contexts), np.uint64)
    for i in range(a, b):
        x = x << np.uint64(8) | contexts[:, i].astype(np.uint64)
    return np.unique(x, return_inverse=True)[1]


def _not_first(names: np.ndarray) -> np.ndarray:
    out = np.ones(len(names), bool)
    out[np.unique(names, return_index=True)[1]] = False
    return out


def _shared(names: np.ndarray) -> np.ndarray:
    return np.bincount(names, minlength=1)[names] > 1


def refine(bucket: np.ndarray, contexts: np.ndarray, left: np.ndarray, right: np.ndarray, length: int) -> np.ndarray:
    """[member, offset]: whether the member's string at that offset also is an earlier member's of its bucket.

    Members of a bucket stand in order. A context has length - Q bytes, the anchor's Q, and length - Q again, of
    which the text has `left` and `right`; the string at offset o begins o bytes before the anchor.

    Buckets are refined by sorting members on (identifier, identifier of the gram at the next offset), to the right and to
    the left; what comes out is the identifier that the next round sorts on. A string's identifier is that of the pair of
    what lies left and right of the anchor. Offsets come in ranges of a gram: members whose pair of the widest parts was seen
    before are settled as repeats, those whose pair of the narrowest parts is alone as first, only the others go on byte by byte.
    """
    side, n = length - Q, len(contexts)
    cuts = [*range(0, side, STEP), side]
    bucket = named(bucket)
    out = np.zeros((n, side + 1), bool)

    def refined(first: np.ndarray, stretches: list[tuple[int, int]], have: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        """Identifiers after each stretch of bytes; a member that the text ends before is alone."""
        names, width = [first], 0
        for a, b in stretches:
            width += b - a
            new = named(names[-1], _grams(contexts[rows], a, b))
            names.append(named(np.where(have[rows] < width, len(rows) + np.arange(len(rows)), new)))
        return names

    every = np.arange(n)
    ends = [side - c for c in reversed(cuts)]
    lefts = refined(bucket, [(side - b, side - a) for a, b in zip(cuts, cuts[1:], strict=False)], left, every)
    rights = refined(bucket, [(side + Q + a, side + Q + b) for a, b in zip(ends, ends[1:], strict=False)], right, every)[::-1]
    for i, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        again = _not_first(named(lefts[i + 1], rights[i])) & (left >= high) & (right >= side - low)
        out[again, low : high + 1] = True
        core = named(lefts[i], rights[i + 1])
        rest = np.flatnonzero(~again)
        rest = rest[_shared(named(core[rest]))] if len(rest) else rest
        if not len(rest):
            continue
        a = _stretch(refined, core[rest], [(side - low - t - 1, side - low - t) for t in range(high - low)], left - low, rest)
        b = _stretch(refined, core[rest], [(side + Q + side - high + t, side + Q + side - high + t + 1) for t in range(high - low)], right - (side - high), rest)
        for t in range(high - low + 1):
            fits = (left[rest] >= low + t) & (right[rest] >= side - low - t)
            out[rest, low + t] |= _not_first(named(a[t], b[high - low - t])) & fits
    return out


def _stretch(refined: Callable, core: np.ndarray, stretches: list[tuple[int, int]], have: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    return refined(named(core), stretches, have, rows)


def _refined(open_: DataFrame, length: int, chunk: int = 50_000) -> DataFrame:
    """doc, lo, hi ranges from members (bucket, doc, pos, lo, hi, bytes); a bucket's rows come together, in order, and
    whole buckets are refined together, about `chunk` members at a time."""
    schema = pa.schema([("doc", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
    side = length - Q

    def settled(rows: pa.Table) -> pa.RecordBatch:
        n = rows.num_rows
        bucket, doc, pos, lo, hi = (rows[c].to_numpy().astype(np.int64) for c in ("bucket", "doc", "pos", "lo", "hi"))
        contexts = np.zeros((n, length + side), np.uint8)
        data = rows["bytes"].combine_chunks()
        flat, ends = np.frombuffer(data.buffers()[2], np.uint8), np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + n + 1].astype(np.int64)
        size = ends[1:] - ends[:-1]
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        contexts[np.repeat(np.arange(n), size), np.repeat(side - (pos - lo), size) + place] = flat[np.repeat(ends[:-1], size) + place]
        got = refine(bucket, contexts, pos - lo, hi - pos - Q, length)
        # A run of offsets is one range of bytes.
        edge = np.diff(np.pad(got, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        m, first = np.nonzero(edge == 1)
        last = np.nonzero(edge == -1)[1] - 1
        return pa.RecordBatch.from_arrays([pa.array(doc[m]), pa.array((pos[m] - last).astype(np.int32)), pa.array((pos[m] - first + length).astype(np.int32))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                have.append(batch)
            if sum(b.num_rows for b in have) >= chunk:
                rows = pa.Table.from_batches(have)
                bucket = rows["bucket"].to_numpy()
                whole = np.flatnonzero(bucket[1:] != bucket[:-1])
                if len(whole):
                    yield settled(rows.slice(0, int(whole[-1]) + 1))
                    rows = rows.slice(int(whole[-1]) + 1)
                have = rows.to_batches()
        if have:
            yield settled(pa.Table.from_batches(have))

    return open_.repartition("bucket").sortWithinPartitions("bucket", "doc", "pos").mapInArrow(run, "doc long, lo int, hi int")


def _strings(hot: DataFrame, length: int) -> DataFrame:
    """The same from members of large buckets, which no task holds as a whole: a string's identifier is two 64-bit hashes here,
    equal in all tasks, and each string meets its first place by it."""
    names, types = ["h1", "h2", "doc", "start"], [pa.int64()] * 3 + [pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[] for _ in names]
            for doc, lo, data in zip(*(batch[c].to_pylist() for c in ("doc", "lo", "bytes")), strict=True):
                r = Rolling(np.frombuffer(data, np.uint8))
                at = np.arange(max(0, len(data) - length + 1))
                for x, v in zip(out, (r.of(at, at + length, 0).view(np.int64), r.of(at, at + length, 1).view(np.int64), np.full(len(at), doc), at + lo), strict=True):
                    x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.empty(0, np.int64), t) for x, t in zip(out, types, strict=True)], names=names)

    s = hot.select("doc", "lo", "bytes").mapInArrow(run, "h1 long, h2 long, doc long, start int")
    first = s.groupBy("h1", "h2").agg(F.min(F.struct("doc", "start")).alias("first"), F.count("doc").alias("n")).where("n > 1").select("h1", "h2", "first")
    again = s.join(first, ["h1", "h2"]).where((F.col("doc") != F.col("first.doc")) | (F.col("start") != F.col("first.start")))
    return again.select("doc", F.col("start").alias("lo"), (F.col("start") + length).alias("hi"))


def repeated_ranges(df: DataFrame, length: int = 100, slots: int | None = None, max_slots: int = 1 << 28, hot: int = 500) -> DataFrame:
    """doc_id, ranges (flattened [start, stop) byte ranges, sorted and merged) of documents with
    something to remove; df has doc_id and text."""
    if length <= Q or hot > 50_000:
        raise ValueError(f"length must be over {Q}, hot at most 50000")
    if slots is None:
        size = df.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        slots = slots_for(size // 30, max_slots)
    a = materialize(suspects(df, shared_table(df, buckets(length), slots), slots, length), "anchors")

    firsts = a.groupBy("bucket", "context").agg(F.min(F.struct("doc", "pos", "lo", "hi")).alias("first"), F.count("doc").alias("n"))
    firsts = materialize(firsts, "contexts")
    again = a.join(firsts.where("n > 1").select("bucket", "context", "first"), ["bucket", "context"])
    settled = again.where((F.col("doc") != F.col("first.doc")) | (F.col("pos") != F.col("first.pos"))).select("doc", "lo", "hi")

    many = firsts.groupBy("bucket").agg(F.count("context").alias("members")).where("members > 1")
    members = materialize(firsts.join(many, "bucket").select("bucket", "members", "first.doc", "first.pos", "first.lo", "first.hi"), "members")
    wanted = members.groupBy("doc").agg(F.collect_list(F.struct("bucket", "members", "pos", "lo", "hi")).alias("wanted"))
    texts = df.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"))
    met = texts.join(wanted, "doc").select("doc", "data", F.explode("wanted").alias("x"))
    met = met.select("x.bucket", "x.members", "doc", "x.pos", "x.lo", "x.hi", F.expr("substring(data, x.lo + 1, x.hi - x.lo)").alias("bytes"))
    # Rows of one doc_id with other texts would be other members at one place; the anchor tells them apart no more, so both stay.
    met = materialize(met, "open-anchors")
    found = settled.union(_refined(met.where(F.col("members") <= hot), length)).union(_strings(met.where(F.col("members") > hot), length))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch["parts"].to_pylist():
                ranges: list[int] = []
                for x in sorted((p["lo"], p["hi"]) for p in parts):
                    if ranges and x[0] <= ranges[-1]:
                        ranges[-1] = max(ranges[-1], x[1])
                    else:
                        ranges += x
                out.append(ranges)
            yield pa.RecordBatch.from_arrays([batch["doc"], pa.array(out, pa.list_(pa.int64()))], schema=RANGES)

    by_doc = found.groupBy("doc").agg(F.collect_set(F.struct("lo", "hi")).alias("parts"))
    return materialize(by_doc.mapInArrow(merge, "doc_id long, ranges array<long>"), "ranges")


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, slots: int | None = None, hot: int = 500) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, ranges, kept (binary) of every row of df."""
    docs = id_text(df, id_col, text_col)
    ranges = repeated_ranges(docs, length, slots, hot=hot).withColumnRenamed("doc_id", "doc")
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("ranges", pa.list_(pa.int64())), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text, r in zip(batch["text"], batch["ranges"].to_pylist(), strict=True):
                data, r = (text.as_py() or "").encode(), r or []
                kept = b"".join(data[a:b] for a, b in zip([0, *r[1::2]], [*r[::2], len(data)], strict=True))
                for x, v in zip(out, (len(data), len(data) - len(kept), len(r) // 2, r, kept), strict=True):
                    x.append(v)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(x, f.type) for x, f in zip(out, list(schema)[1:], strict=True))], schema=schema)

    both = docs.join(ranges, F.coalesce("doc_id", F.lit(NULL_ID)) == F.col("doc"), "left").select("doc_id", "text", "ranges")
    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, ranges array<long>, kept binary")

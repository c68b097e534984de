"""SimHash near-duplicates with Golay-code fuzzy hashing.

A fingerprint's 64 bits are cut into three segments of 22, 21 and 21 bits. A segment is
read as a word of the perfect binary Golay code (23 bits, radius 3): c(x) is the index of
the codeword that x decodes to, and K(x) those of all words within one bit of x (one or
six). Words within two bits share an index in K; of words that differ in one bit one has
an even number of ones, and its c is in the other's K. Four differing bits or fewer
(pigeonhole) leave either a segment without any and another with two at most, or
one in each of two segments and two at most in the third. So the keys are

1. x as it is, and each index in K(y), for each ordered pair of segments (33 or 34 bits);
2. an index of x and of y (c for even, all of K for odd words) and each index in K(z),
   for each choice of z (36 bits, and whether x and y are of one parity).

Two fingerprints within four bits always share one, others hardly ever do. Equal
fingerprints are first made one. Fingerprints are dealt out by x, or by the indices of x
and y; where they meet the rest of the key is looked up, candidates are verified by their differing
bits, and what leaves the task are links that join what belongs together, never
all pairs of a bucket: members gather around representatives, and members of two only
meet if these are within reach and still in different components. That loses no link between components.
A group too large for one task is cut into shards, each two of which meet.

Cases: a null text or one without a word has fingerprint zero and is linked like
any other; a text with fewer words than the shingle is one shingle; repeated rows
give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.columns import id_text, private
from foliospark.llm.components import Groups, connected_components
from foliospark.llm.shared_slots import Shared, shared_table, slots_for
from foliospark.runtime import materialize

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (lowest bit, width)
RADIUS = 4
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SEED = 42


@functools.cache
def golay_index() -> np.ndarray:
    """The 12-bit index of the codeword nearest to each of the 2^23 words."""
    def syndrome(v: np.ndarray) -> np.ndarray:
        v = v.copy()
        for i in range(22, 10, -1):
            v ^= np.where(v >> i & 1, GENERATOR << (i - 11), 0)
        return v

    errors = np.array([0, *(sum(1 << i for i in c) for n in (1, 2, 3) for c in combinations(range(23), n))], np.int64)
    of = np.zeros(2048, np.int32)
    of[syndrome(errors)] = errors
    high = syndrome(np.arange(1 << 12, dtype=np.int64) << 11).astype(np.int32)
    words = np.arange(1 << 23, dtype=np.int32)
    return ((words ^ of[high[words >> 11] ^ (words & 2047)]) >> 11).astype(np.int16)


def segment(fingerprints: np.ndarray, i: int) -> np.ndarray:
    low, width = SEGMENTS[i]
    return (fingerprints >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64)


def near_indices(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) of the distinct codeword indices of all words within one bit of each x."""
    flips = np.array([0, *(1 << i for i in range(width))], np.int64)
    k = np.sort(golay_index()[x[:, None] ^ flips], axis=1)
    row, at = np.nonzero(np.concatenate([np.ones((len(k), 1), bool), k[:, 1:] != k[:, :-1]], axis=1))
    return row, k[row, at].astype(np.int64)


def one_off(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, index): words that differ in exactly one bit always share one, since one of them has an even
    number of ones and gives its own index, the other all those near it."""
    even = np.bitwise_count(x) & 1 == 0
    odd = np.flatnonzero(~even)
    row, index = near_indices(x[odd], width)
    return np.concatenate([np.flatnonzero(even), odd[row]]), np.concatenate([golay_index()[x[even]].astype(np.int64), index])


def deals_of(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, deal): the first part of the keys of uint64 fingerprints, by which they are dealt out."""
    seg = [segment(fingerprints, i) for i in range(3)]
    rows = [np.arange(len(fingerprints))] * 3
    deals = [i << 26 | seg[i] for i in range(3)]
    for z in range(3):
        a, b = (i for i in range(3) if i != z)
        # Both differ in parity, so both sums of parities are the same.
        same = (np.bitwise_count(seg[a] ^ seg[b]) & 1).astype(np.int64)
        r, ka = one_off(seg[a], SEGMENTS[a][1])
        s, kb = one_off(seg[b][r], SEGMENTS[b][1])
        r, ka = r[s], ka[s]
        rows.append(r)
        deals.append(3 + z << 26 | same[r] << 24 | ka << 12 | kb)
    return np.concatenate(rows), np.concatenate(deals)


def rests_of(deals: np.ndarray, fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, rest): the last part of the keys of dealt fingerprints."""
    rows, rests = [], []
    for kind in range(6):
        at = np.flatnonzero(deals >> 26 == kind)
        for j, i in enumerate([i for i in range(3) if i != kind] if kind < 3 else [kind - 3]):
            r, k = near_indices(segment(fingerprints[at], i), SEGMENTS[i][1])
            rows.append(at[r])
            rests.append(j << 12 | k)
    return np.concatenate(rows), np.concatenate(rests)


def keys_of(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of the fingerprint, key) for all keys of uint64 fingerprints."""
    rows, deals = deals_of(fingerprints)
    at, rests = rests_of(deals, fingerprints[rows])
    return rows[at], deals[at] << 13 | rests


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of the shingles of one text, repeats included."""
    words = (text or "").encode().lower().split()  # of bytes: ASCII only
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)], np.uint64)


def simhash(hashes: np.ndarray, block: int = 1 << 16) -> int:
    """A bit is 1 if it is set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), block):
        part = hashes[i : i + block]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist()))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.array([simhash(shingle_hashes(t.as_py(), shingle)) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out.view(np.int64))], schema=schema)

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def link_bucket(members: np.ndarray, words: np.ndarray, groups: Groups, radius: int) -> None:
    """Joins the sets of a bucket's members whose words differ in at most `radius` bits. Members gather around
    representatives; those of two only meet if these are close enough for a link and their sets still differ."""
    around: list[np.ndarray] = []
    rest = members
    while len(rest):
        close = np.bitwise_count(words[rest] ^ words[rest[0]]) <= radius
        around.append(rest[close])
        groups.link(rest[close], np.full(close.sum(), rest[0]))
        rest = rest[~close]
    tops = words[np.array([x[0] for x in around], np.int64)]
    for i, x in enumerate(around):
        for j in (np.flatnonzero(np.bitwise_count(tops[i + 1 :] ^ tops[i]) <= 3 * radius) + i + 1).tolist():
            if groups.top[x[0]] == groups.top[around[j][0]]:
                continue
            for m in x.tolist():
                close = around[j][np.bitwise_count(words[around[j]] ^ words[m]) <= radius]
                if len(close):
                    groups.link(close[:1], np.array([m]))
                    break


def links_within(group: np.ndarray, deals: np.ndarray, words: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that join all words (uint64) of one group (numbers from 0) and key that are within radius, by way of others if need be."""
    own, at = np.unique(words, return_inverse=True)
    rows, rests = rests_of(deals, words)
    keys = group[rows] << 13 | rests
    order = np.argsort(keys, kind="stable")
    keys, member = keys[order], at[rows[order]]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(start, len(keys)))
    start, size = start[size > 1], size[size > 1]
    groups = Groups(len(own))
    if len(start):
        offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        each = np.repeat(start, size) + offset
        a, b = member[each], member[np.repeat(start, size)]
        close = np.bitwise_count(own[a] ^ own[b]) <= radius
        groups.link(a[close], b[close])
        # Buckets of three or more whose members are in several sets.
        tops = groups.top[member[each]]
        ends = np.cumsum(size) - size
        for s, n in zip(*(x[(size > 2) & (np.minimum.reduceat(tops, ends) != np.maximum.reduceat(tops, ends))].tolist() for x in (start, size)), strict=True):
            link_bucket(np.unique(member[s : s + n]), own, groups, radius)
    joined = np.flatnonzero(groups.top != np.arange(len(own)))
    return own[joined], own[groups.top[joined]]


def golay_links(nodes: DataFrame, radius: int = RADIUS, most: int = 1 << 20, chunk: int = 1 << 17) -> DataFrame:
    """a, b: links that join all fingerprints (column fp, each once) within `radius` bits, by way of others if need be.

    Fingerprints are dealt out by the first part of their keys, the last part is looked up where they
    meet. A group of over `most` is cut into shards by hash, and each two shards meet in a task of their own.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"these keys are complete for up to {RADIUS} differing bits")
    schema, link_schema = (pa.schema([(c, pa.int64()) for c in names]) for names in (("deal", "fp"), ("a", "b")))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 10_000):
                fp = batch["fp"][i : i + 10_000].to_numpy(zero_copy_only=False).astype(np.int64)
                rows, deals = deals_of(fp.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(deals), pa.array(fp[rows])], schema=schema)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: np.ndarray) -> pa.RecordBatch:
            new = np.concatenate([[False], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
            a, b = links_within(np.cumsum(new), rows[:, 0], np.ascontiguousarray(rows[:, 2]).view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], schema=link_schema)

        have: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            have.append(np.stack([batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("deal", "cell", "fp")], axis=1))
            if sum(map(len, have)) >= chunk:
                rows = np.concatenate(have)
                whole = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1))
                if len(whole):
                    yield found(rows[: whole[-1] + 1])
                    rows = rows[whole[-1] + 1 :]
                have = [rows]
        if have:
            yield found(np.concatenate(have))

    deals = nodes.select("fp").mapInArrow(deal, "deal long, fp long")
    large = materialize(deals.groupBy("deal").agg(F.count("fp").alias("n")).where(F.col("n") > most), "golay-large")
    cells = deals.withColumn("cell", F.lit(0).cast("long"))
    if not large.isEmpty():
        shards = F.ceil(F.col("n") / most)
        own = F.pmod(F.xxhash64("fp"), shards)
        met = deals.join(large, "deal").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), shards - 1)))
        met = met.select("deal", "fp", (F.least(own, "other") * shards + F.greatest(own, "other")).alias("cell"))
        cells = deals.join(large, "deal", "left_anti").select("deal", "fp", F.lit(0).cast("long").alias("cell")).union(met)
    return cells.repartition("deal", "cell").sortWithinPartitions("deal", "cell").mapInArrow(link, "a long, b long").distinct()


def representative_pairs(keys: DataFrame, rounds: int, near: Column | None = None) -> DataFrame:
    """a > b: members of a bucket and its representative, chosen anew by hash in each round."""
    kept = [c for c in keys.columns if c != "key"]
    found = None
    for r in range(rounds):
        one = keys.groupBy("key").agg(F.min_by(F.struct(*kept), F.struct(F.xxhash64("node", F.lit(r)), "node")).alias("rep"), F.count("node").alias("n")).where("n > 1")
        one = one.select("key", *(F.col(f"rep.{c}").alias("rep" if c == "node" else f"rep_{c}") for c in kept))
        pairs = keys.join(one, "key").where((F.col("node") != F.col("rep")) & (F.lit(True) if near is None else near)).select(F.greatest("node", "rep").alias("a"), F.least("node", "rep").alias("b"))
        found = pairs if found is None else found.union(pairs)
    return found.distinct()


def open_buckets(keys: DataFrame, parts: DataFrame) -> DataFrame:
    """keys with `part`, of buckets of three or more whose members aren't in one component; buckets of two are settled."""
    own = keys.join(parts, "node", "left").select(*keys.columns, F.coalesce("component", "node").alias("part"))
    own = materialize(own, "golay-parts")
    open_ = own.groupBy("key").agg(F.count("node").alias("n"), F.min("part").alias("p"), F.max("part").alias("q")).where("n > 2 and p <> q").select("key")
    return materialize(own.join(open_, "key", "left_semi"), "golay-open")


def of_components(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """pairs with ca, cb, the components of a and b."""
    tops = parts.select(F.col("node").alias("a"), F.col("component").alias("ca")), parts.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return pairs.join(tops[0], "a", "left").join(tops[1], "b", "left").withColumns({"ca": F.coalesce("ca", "a"), "cb": F.coalesce("cb", "b")})


def extended(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links (a, b)."""
    joined = connected_components(of_components(links.select("a", "b"), parts).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    deep = parts.join(joined.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return deep.union(joined).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = RADIUS, most: int = 1 << 20) -> DataFrame:
    """doc_id, fp, component_id (the least doc_id that links reach) of every row of df."""
    docs = materialize(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    own = materialize(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    links = materialize(golay_links(own, radius, most), "golay-links")
    parts = connected_components(links).withColumnRenamed("node", "fp")
    own = materialize(own.join(parts, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("part")), "parts")
    top = own.groupBy("part").agg(F.min("least").alias("component_id"))
    label = own.join(top, "part").select("fp", "component_id")
    return docs.join(label, "fp").select("doc_id", "fp", "component_id")


# Near copies by similarity of word shingles. SimHash comes first: texts whose fingerprints (of their sets of shingles)
# are within RADIUS bits meet by Golay keys, and those that are alike are joined. Fingerprints of 64 bits miss
# many pairs that are `similarity` alike, so an exact way finds the rest. Put all shingles in one order: of two sets that are
# `similarity` alike the first common shingle is among the first n - ceil(similarity * n) + 1 of either
# set of n (the prefix filter). So texts that share none of these aren't alike, whatever the edit,
# and each such shingle is a key. In the order those that no other text has come first (by a table
# of slots: a slot hit once; where one is taken for shared, only the order changes, for all texts
# alike), then by hash; so a text with a fifth of shingles of its own has no keys at all. Members of a bucket
# meet only if the places of the shared shingle allow the overlap, and if their sketches do: a bit of
# a sketch is the parity of the shingles that fall on it, so two sets differ in as many shingles
# at least as their sketches in bits. Of the rest the shingles themselves are compared.

SKETCH = 8  # 64-bit parts of a sketch


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles of one text, from those of its words."""
    words = (text or "").encode().lower().split()  # of bytes: ASCII only
    if not words:
        return np.empty(0, np.uint64)
    own = {w: xxhash.xxh64_intdigest(w, SEED) for w in set(words)}
    h = np.fromiter(map(own.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = _salted(out * np.uint64(0xD1342543DE82EF95) + h[i : i + n], range(1))[:, 0]
    return np.unique(out)


def prefix_length(n: int, similarity: float) -> int:
    """How many of n shingles, the first in the order, hold the first one in common with any set that is alike."""
    return n - math.ceil(similarity * n - 1e-9) + 1


def _salted(hashes: np.ndarray, salts: range) -> np.ndarray:
    """[hash, salt]: independent 64-bit hashes from one."""
    x = hashes[:, None] + np.array([(s + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1 for s in salts], np.uint64)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def parity_sketch(hashes: np.ndarray) -> np.ndarray:
    """Bit i: whether an odd number of the hashes are i modulo the number of bits."""
    n = 64 * SKETCH
    ones = np.bincount((hashes % np.uint64(n)).astype(np.int64), minlength=n)
    return np.packbits(ones & 1 == 1, bitorder="little").view("<u8").astype(np.uint64)


def may_be_alike(bits: Column, m: Column, n: Column, similarity: float) -> Column:
    """Whether sets of m and n shingles whose sketches differ in so many bits can be `similarity` alike; true of all that are."""
    return bits <= F.lit((1 - similarity) / (1 + similarity)) * (m + n) + 1e-6


def sketches(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """doc_id, same (128 bits of the words in order), m (number of distinct shingles), fp (SimHash of these), sketch of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("same", pa.binary()), ("m", pa.int64()), ("fp", pa.int64()), ("sketch", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, m, fp, sketch = [], [], [], []
            for text in batch.column("text"):
                t = text.as_py()
                same.append(xxhash.xxh3_128_digest(b" ".join((t or "").encode().lower().split())))
                parts = shingle_set(t, shingle)
                m.append(len(parts))
                fp.append(simhash(parts))
                sketch.append(parity_sketch(parts).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(same, pa.binary()), pa.array(m, pa.int64()), pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(sketch, pa.list_(pa.int64()))], schema=schema)

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, same binary, m long, fp long, sketch array<long>")


MOST_SLOTS = 1 << 28  # of a table that goes to all tasks


def looked_up(hashes: np.ndarray, share: float) -> np.ndarray:
    """Which of the hashes are among the share that a table is for. More of them than it has slots would only fill it: by then each slot is hit twice."""
    return _salted(hashes, range(7, 8))[:, 0] >> np.uint64(11) < np.uint64(int(share * (1 << 53)))


def prefix_keys(texts: DataFrame, n: int, shingle: int, similarity: float, ids: DataFrame | None = None) -> DataFrame:
    """key (a shingle), same, m, pos (its place in the order) of the shingles by which a text (column text; those of ids at least, if given, see among)
    can meet others; n: of all shingles. Copies give their rows once. Keys that no other text has are left out, however many shingles there are."""
    slots = slots_for(n, MOST_SLOTS)
    share = min(1.0, slots / max(1, n))
    # Chosen by the step that needs them: a step of its own would be a second Python process a task.
    live = (lambda: lambda batch: batch) if ids is None else chosen(ids)
    texts = texts.select("text") if ids is None else texts.select("node", "text")

    def some(text: str | None) -> np.ndarray:
        parts = shingle_set(text, shingle)
        return parts[looked_up(parts, share)] if share < 1 else parts

    table = texts.sparkSession.sparkContext.broadcast(shared_table(texts, lambda batches: (some(t.as_py()) for of in [live()] for b in batches for t in of(b)["text"]), slots))
    schema = pa.schema([("key", pa.int64()), ("same", pa.binary()), ("m", pa.int64()), ("pos", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, of = Shared(table.value, slots), live()
        for batch in batches:
            keys, same, m, pos = [], [], [], []
            for text in of(batch)["text"]:
                t = text.as_py()
                parts = shingle_set(t, shingle)
                on = parts[known.of(parts) | ~looked_up(parts, share)] if share < 1 else parts[known.of(parts)]
                lone = len(parts) - len(on)
                on = on[: max(0, prefix_length(len(parts), similarity) - lone)]
                if len(on):
                    keys.append(on.view(np.int64))
                    same += [xxhash.xxh3_128_digest(b" ".join(t.encode().lower().split()))] * len(on)
                    m.append(np.full(len(on), len(parts)))
                    pos.append(np.arange(lone, lone + len(on)))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(same, pa.binary()), pa.array(np.concatenate(m)), pa.array(np.concatenate(pos))], schema=schema)

    return met_twice(materialize(texts.mapInArrow(run, "key long, same binary, m long, pos long"), "prefix-written")).distinct()


def met_twice(keys: DataFrame, rounds: int = 4) -> DataFrame:
    """keys (a written table with the column key) without most of those whose key is in one row only, by tables of slots where the rows lie. A table
    is for as many keys as it has slots at most, so more keys take several; where slots are still short, others by chance in
    a slot of their own go in the next round."""
    spark = keys.sparkSession
    n = keys.count()
    for r in range(rounds):
        if not n:
            break
        slots, parts = slots_for(n, MOST_SLOTS), max(1, -(-n // MOST_SLOTS))
        for p in range(parts):

            def own(batch: pa.RecordBatch, r: int = r, p: int = p, parts: int = parts) -> tuple[np.ndarray, np.ndarray]:
                """The keys mixed anew for the round, and which of them the table is for."""
                mixed = _salted(batch["key"].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), range(20 + r, 21 + r))[:, 0]
                return mixed, mixed % np.uint64(parts) == p

            def entries(batches: Iterator[pa.RecordBatch], own: Callable = own) -> Iterator[np.ndarray]:
                for batch in batches:
                    mixed, ours = own(batch)
                    yield mixed[ours]

            table = spark.sparkContext.broadcast(shared_table(keys.select("key"), entries, slots))

            def run(batches: Iterator[pa.RecordBatch], own: Callable = own, table=table, slots: int = slots) -> Iterator[pa.RecordBatch]:
                known = Shared(table.value, slots)
                for batch in batches:
                    mixed, ours = own(batch)
                    yield batch.filter(pa.array(~ours | known.of(mixed)))

            keys = materialize(keys.mapInArrow(run, keys.schema), "prefix-met")
        before, n = n, keys.count()
        if slots >= 8 * before or n > 0.9 * before:
            break
    return keys


def may_overlap(other: str, similarity: float) -> Column:
    """Whether two sets of m and {other}m shingles, with one in common at pos and {other}pos, can be alike: no more
    are in common than it, those before and those after it."""
    m, n, p, q = F.col("m"), F.col(f"{other}m"), F.col("pos"), F.col(f"{other}pos")
    return F.least(p, q) + F.least(m - p, n - q) >= F.lit(similarity / (1 + similarity)) * (m + n) - 1e-6


def named(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The texts (node, text) of the nodes that pairs (a, b) name, and few others (see among)."""
    return among(texts, materialize(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "named"))


def among(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts (node, text) of ids (node, each once; a written table). Where they lie, a table of slots leaves out nearly
    all others, which a join would shuffle."""
    live = chosen(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(live(), batches)

    return texts.select("node", "text").mapInArrow(run, "node long, text string")


def chosen(ids: DataFrame) -> Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]:
    """For a task: what leaves out nearly all rows of a batch whose node isn't one of ids."""
    slots = slots_for(ids.count())
    longs = lambda batch: batch["node"].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    # The table has the slots hit more than once, so each id is given twice.
    table = ids.sparkSession.sparkContext.broadcast(shared_table(ids, lambda batches: (np.repeat(longs(b), 2) for b in batches), slots))

    def begin() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        known = Shared(table.value, slots)
        return lambda batch: batch.filter(pa.array(known.of(longs(batch)), pa.bool_()))

    return begin


def alike(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets of shingles are `similarity` alike, from whole texts (node, text)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, np.ndarray] = None, np.empty(0, np.uint64)
        for batch in batches:
            on = []
            for a, ta, tb in zip(batch["a"].to_pylist(), batch["text_a"], batch["text_b"], strict=True):
                if last[0] != a:
                    last = a, shingle_set(ta.as_py(), shingle)
                x, y = last[1], shingle_set(tb.as_py(), shingle)
                both = len(np.intersect1d(x, y, assume_unique=True))
                on.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch["a"].filter(pa.array(on, pa.bool_())), batch["b"].filter(pa.array(on, pa.bool_()))], schema=schema)

    side = lambda n: texts.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}"))
    return pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def simhash_pairs(classes: DataFrame) -> DataFrame:
    """a > b: classes (node, fp) whose fingerprints are equal or within RADIUS bits, as many pairs as join them, by way of others if need be."""
    own = materialize(classes.groupBy("fp").agg(F.min("node").alias("node")), "distinct-fingerprints")
    side = lambda n: own.select(F.col("fp").alias(n), F.col("node").alias(f"node_{n}"))
    near = materialize(golay_links(own), "golay-links").join(side("a"), "a").join(side("b"), "b").select("node_a", "node_b")
    equal = classes.select("fp", F.col("node").alias("node_a")).join(own.withColumnRenamed("node", "node_b"), "fp").select("node_a", "node_b")
    return near.union(equal).where("node_a <> node_b").select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b")).distinct()


def confirmed(parts: DataFrame, pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The components after those of the pairs (a, b, bits) that are alike. Of the pairs between two components the
    likeliest is compared first, the others only if their components are still two."""
    for best in (True, False):
        left = of_components(pairs, parts).where("ca <> cb")
        if best:
            left = left.groupBy(F.least("ca", "cb").alias("x"), F.greatest("ca", "cb").alias("y")).agg(F.min(F.struct("bits", "a", "b")).alias("p")).select("p.a", "p.b")
        left = materialize(left.select("a", "b"), "doubtful")
        if left.isEmpty():
            return parts
        if best:
            texts = materialize(named(texts, pairs), "named-texts")
        parts = materialize(extended(parts, materialize(alike(left, texts, shingle, similarity), "alike")), "parts")
    return parts


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, component_id (the least doc_id that links reach) of every row; a link: sets of word
    shingles with a Jaccard similarity of `similarity` or more. Rows without a doc_id link nothing
    but have the component of equal texts; null if there is none."""
    docs = materialize(sketches(df, id_col, text_col, shingle), "sketches")
    classes = docs.where("doc_id is not null").groupBy("same").agg(F.min("doc_id").alias("node"), F.first("m").alias("m"), F.first("fp").alias("fp"), F.first("sketch").alias("sketch"))
    classes = materialize(classes, "classes")
    texts = id_text(df, id_col, text_col).where("doc_id is not null").withColumnRenamed("doc_id", "node")
    side = lambda n: classes.select(F.col("node").alias(n), F.col("sketch").alias(f"sketch_{n}"), F.col("m").alias(f"m_{n}"))
    bits = sum((F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(SKETCH)), F.lit(0))

    near = may_be_alike(bits, F.col("m_a"), F.col("m_b"), similarity)
    sketched = lambda pairs: materialize(pairs.join(side("a"), "a").join(side("b"), "b").where(near).select("a", "b", bits.alias("bits")).distinct(), "pairs")

    # First those that SimHash finds by its Golay keys; what it can't is found by the prefix filter.
    pairs = sketched(simhash_pairs(classes))
    parts = pairs.limit(0).select(F.col("a").alias("node"), F.col("b").alias("component"))
    parts = confirmed(parts, pairs, texts, shingle, similarity)
    n = docs.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]
    # Of copies one is enough: their shingles are then their own.
    keys = prefix_keys(texts, n, shingle, similarity, classes.select("node")).join(classes.select("same", "node"), "same").select("key", "node", "m", "pos")
    keys = materialize(keys, "prefix-keys")
    pairs = sketched(representative_pairs(keys, 2, may_overlap("rep_", similarity)))
    parts = confirmed(parts, pairs, texts, shingle, similarity)
    # Members of different components meet within a bucket; the join itself lets only near sketches through.
    left = open_buckets(keys, parts)
    x = materialize(left.withColumnRenamed("node", "a").join(side("a"), "a"), "prefix-sketch")
    y = x.select(F.col("key").alias("key_"), F.col("a").alias("b"), F.col("part").alias("part_"), F.col("m").alias("y_m"), F.col("pos").alias("y_pos"), F.col("m_a").alias("m_b"), F.col("sketch_a").alias("sketch_b"))
    pairs = x.join(y, (F.col("key") == F.col("key_")) & (F.col("part") < F.col("part_")) & may_overlap("y_", similarity) & near).select("a", "b", bits.alias("bits")).distinct()
    pairs = materialize(pairs, "pairs")
    parts = confirmed(parts, pairs, texts, shingle, similarity)
    label = classes.select("same", "node").join(parts, "node", "left").select("same", F.coalesce("component", "node").alias("component_id"))
    return docs.select("doc_id", "same").join(label, "same", "left").select("doc_id", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of df, all columns as they are, without those of a near-duplicate group that aren't its least doc_id.

    Rows of one doc_id are one document: it goes with any of its texts. Of rows equal in doc_id and text that with the
    least other columns (as JSON) stays. Rows without a doc_id stay, all of them."""
    found = materialize(near_copies(df, id_col, text_col, shingle, similarity), "near-duplicates")
    # Written, so that its size is known before the join: a small one is broadcast and the rows of df stay where they are.
    gone = materialize(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_")).distinct(), "gone")
    out = df.join(gone, df[id_col] == gone["gone_"], "left_anti")
    twice = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("twice_"))
    if twice.isEmpty():
        return out
    twice = materialize(twice, "repeated")
    place, = private(out, "place")
    # A limit within groups, which Spark puts before the exchange too: a document repeated in a third of all rows moves one row a task.
    first = Window.partitionBy(id_col, text_col).orderBy(F.to_json(F.struct(*(f"`{c}`" for c in out.columns))))
    once = out.join(twice, out[id_col] == twice["twice_"], "left_semi").withColumn(place, F.row_number().over(first)).where(F.col(place) <= 1).drop(place)
    return out.join(twice, out[id_col] == twice["twice_"], "left_anti").unionByName(once)

"""Line deduplication with a once-seen and a twice-seen Bloom filter.

Pass 1: every task puts the hashes of its documents' line keys (once for each
document) into two filters of a fixed number of bits: `once` has all keys, `twice`
those that the task met again. Tasks send their filters as compressed blocks; a
block's filters are merged as once = or, twice = or of the twice and of what was
in the once before. No repeated key is missing from `twice`; a few others are in it.

Pass 2: only keys found in `twice` are suspects. Their counts of documents (and
first occurrences) are summed in each task before they shuffle, by the exact key,
so a key on a third of all lines is one row for each task. Keys in at least
`min_docs` documents are repeats.

Pass 3: repeats' lines go. The set of repeats is broadcast if its bytes are
within `broadcast_bytes` (measured first); else the suspects' positions are
joined with it and each document gets the list of its lines to drop.

The filters' size follows the number of lines, up to 2^max_bits; beyond that more
keys are suspects, and the result stays exact.

A line's key: spaces and \\t..\\r stripped at both ends, A-Z lower-cased. Cases: a
null or empty text is one empty line; keys shorter than `min_chars` code points never
count; each row counts as a document of its own, repeated rows too; with
keep="first" the first occurrence (least doc_id, then least line) stays.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.columns import id_text, portions, private
from foliospark.runtime import materialize

WHITE = b" \t\n\r\x0b\x0c"
BLOCK_BITS = 1 << 16
PROBES = 3
NULL_ID = -1 << 62


def key_of(line: bytes) -> bytes:
    return line.strip(WHITE).lower()


def long_enough(key: bytes, chars: int) -> bool:
    return len(key) >= chars and (chars <= 1 or len(key.decode()) >= chars)


def keys_of(text: str | None, min_chars: int) -> list[tuple[bytes, bytes | None]]:
    """Each line with its key, None where the key is too short."""
    out = []
    for line in (text or "").encode().split(b"\n"):
        key = key_of(line)
        out.append((line, key if long_enough(key, min_chars) else None))
    return out


def probes(keys: list[bytes], bits: int) -> np.ndarray:
    """[key, probe]: bit positions. All probes of a key lie in one block."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
    blocks = np.uint64(bits // BLOCK_BITS)
    base = (h % blocks) * np.uint64(BLOCK_BITS)
    rest = h >> np.uint64(16)
    return np.stack([base + ((rest >> np.uint64(16 * i)) & np.uint64(BLOCK_BITS - 1)) for i in range(PROBES)], axis=1).astype(np.int64)


def _filters(df: DataFrame, bits: int, min_chars: int) -> DataFrame:
    """Rows (block, once, twice), merged over all tasks."""
    size = BLOCK_BITS // 8

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits, bool), np.zeros(bits, bool)
        for batch in batches:
            for text in batch.column("text"):
                keys = list({k for _, k in keys_of(text.as_py(), min_chars) if k is not None})
                if not keys:
                    continue
                at = probes(keys, bits)
                seen = once[at].all(axis=1)
                twice[at[seen]] = True
                once[at] = True
        one, two = np.packbits(once).reshape(-1, size), np.packbits(twice).reshape(-1, size)
        some = np.flatnonzero(one.any(axis=1))
        yield pa.RecordBatch.from_pydict({"block": pa.array(some, pa.int64()), "once": [zlib.compress(one[b].tobytes(), 1) for b in some], "twice": [zlib.compress(two[b].tobytes(), 1) for b in some]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's rows of the same block are merged as they come: it holds one pair of filters for each block."""
        have: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for b, one, two in zip(batch["block"].to_pylist(), batch["once"].to_pylist(), batch["twice"].to_pylist(), strict=True):
                o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (one, two))
                if b in have:
                    have_o, have_t = have[b]
                    have[b] = have_o | o, have_t | t | (have_o & o)
                else:
                    have[b] = o, t
        ids = list(have)
        yield pa.RecordBatch.from_pydict({"block": pa.array(ids, pa.int64()), "once": [zlib.compress(have[b][0].tobytes(), 1) for b in ids], "twice": [zlib.compress(have[b][1].tobytes(), 1) for b in ids]})

    kind = "block long, once binary, twice binary"
    return df.select("text").mapInArrow(build, kind).repartition(F.col("block")).mapInArrow(merge, kind)


def repeated_lines(df: DataFrame, min_docs: int = 10, min_chars: int = 1, bits: int | None = None, max_bits: int = 27, lines_per_doc: int = 16) -> DataFrame:
    """key, n_docs, first_doc, first_line of every key in at least min_docs rows; df has doc_id and text."""
    if bits is None:
        want = df.count() * lines_per_doc * 8
        bits = 1 << min(max_bits, max(20, int(want).bit_length()))
    twice = np.zeros(bits // 8, np.uint8)
    size = BLOCK_BITS // 8
    for r in _filters(df, bits, min_chars).select("block", "twice").toLocalIterator():
        twice[r["block"] * size : (r["block"] + 1) * size] = np.frombuffer(zlib.decompress(r["twice"]), np.uint8)
    shared = df.sparkSession.sparkContext.broadcast(zlib.compress(twice.tobytes(), 1))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.unpackbits(np.frombuffer(zlib.decompress(shared.value), np.uint8)).view(bool)
        n: Counter[bytes] = Counter()
        first: dict[bytes, tuple[int, int]] = {}

        def out() -> pa.RecordBatch:
            keys = list(n)
            got = pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "n": pa.array([n[k] for k in keys], pa.int64()), "first_doc": pa.array([first[k][0] for k in keys], pa.int64()), "first_line": pa.array([first[k][1] for k in keys], pa.int64())})
            n.clear()
            first.clear()
            return got

        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                where: dict[bytes, int] = {}
                for i, (_, k) in enumerate(keys_of(text, min_chars)):
                    if k is not None:
                        where.setdefault(k, i)
                if not where:
                    continue
                keys = list(where)
                at = NULL_ID if doc is None else doc
                for j in np.flatnonzero(have[probes(keys, bits)].all(axis=1)):
                    k = keys[j]
                    n[k] += 1
                    if k not in first or first[k] > (at, where[k]):
                        first[k] = at, where[k]
            if len(n) > 200_000:
                yield out()
        yield out()

    counted = df.mapInArrow(suspects, "key binary, n long, first_doc long, first_line long")
    return (
        counted.groupBy("key")
        .agg(F.sum("n").alias("n_docs"), F.min(F.struct("first_doc", "first_line")).alias("at"))
        .where(F.col("n_docs") >= min_docs)
        .select("key", "n_docs", "at.first_doc", "at.first_line")
    )


def _known(df: DataFrame, repeats: DataFrame, broadcast_bytes: int):
    """The repeats as a broadcast dictionary key -> first place, or None if they are too many for one."""
    total = repeats.agg(F.coalesce(F.sum(F.length("key") + 128), F.lit(0))).first()[0]
    if total > broadcast_bytes:
        return None
    return df.sparkSession.sparkContext.broadcast({bytes(r["key"]): (r["first_doc"], r["first_line"]) for r in repeats.toLocalIterator()})


def without(doc: int | None, text: str | None, known: dict[bytes, tuple[int, int]], min_chars: int, keep: str) -> tuple[str, int, int]:
    """What stays of a text, its lines, and how many of them go."""
    at = NULL_ID if doc is None else doc
    lines = keys_of(text, min_chars)
    kept = [x for i, (x, k) in enumerate(lines) if k not in known or (keep == "first" and known[k] == (at, i))]
    return b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)


def joined(docs: DataFrame, repeats: DataFrame, keep: str, id_col: str, text_col: str, out: str) -> DataFrame:
    """docs with a column `out`, the numbers of the lines to drop: the lines meet a large set of
    repeats by a join. A row is known by its id and its text's hash. The names used in between are none of docs."""
    h, own, of = private(docs, "h_", "id_", "of_")
    text = F.col(f"`{text_col}`")
    docs = docs.withColumn(h, F.xxhash64(text))
    lines = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(h).alias("h"), F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("line_no", "line"))
    bare = F.regexp_replace(F.regexp_replace("line", "^[\\x20\\x09-\\x0D]+", ""), "[\\x20\\x09-\\x0D]+$", "")
    key = F.translate(bare, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hits = lines.withColumn("key", F.encode(key, "UTF-8")).join(repeats, "key")
    if keep == "first":
        hits = hits.where(~(F.coalesce("id", F.lit(NULL_ID)).eqNullSafe(F.col("first_doc")) & (F.col("line_no") == F.col("first_line"))))
    gone = hits.groupBy("id", "h").agg(F.collect_set("line_no").alias("gone")).select(F.col("id").alias(own), F.col("h").alias(of), F.col("gone").alias(out))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(own)) & (F.col(h) == F.col(of))
    return docs.join(gone, same, "left").drop(h, of, own).withColumn(out, F.coalesce(out, F.array().cast("array<int>")))


def _left(text: str, gone: str):
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    numbered = F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    return F.array_join(F.transform(F.filter(numbered, lambda s: ~F.array_contains(gone, s["i"])), lambda s: s["x"]), "\n"), F.size(lines).cast("long")


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1, keep: str = "none", bits: int | None = None, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, text (what stays), n_lines, n_dropped for every row of df."""
    if keep not in ("none", "first"):
        raise ValueError(keep)
    docs = id_text(df, id_col, text_col)
    repeats = materialize(repeated_lines(docs, min_docs, min_chars, bits), "repeated-lines")
    shared = _known(docs, repeats, broadcast_bytes)
    if shared is None:
        left, n = _left("text", "gone_")
        return joined(docs, repeats, keep, "doc_id", "text", "gone_").select("doc_id", left.alias("text"), n.alias("n_lines"), F.size("gone_").cast("long").alias("n_dropped"))
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch["doc_id"], batch["text"].to_pylist()
            for a, b in portions(texts):
                out = [without(d.as_py(), t, shared.value, min_chars, keep) for d, t in zip(ids.slice(a, b - a), texts[a:b], strict=True)]
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), *(pa.array([r[i] for r in out], schema.field(i + 1).type) for i in range(3))], schema=schema)

    return docs.mapInArrow(run, "doc_id long, text string, n_lines long, n_dropped long")


def drop_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1, keep: str = "none", bits: int | None = None, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """df, all columns, with repeated lines taken out of the text; a null text stays null."""
    repeats = materialize(repeated_lines(id_text(df, id_col, text_col), min_docs, min_chars, bits), "repeated-lines")
    shared = _known(df, repeats, broadcast_bytes)
    if shared is None:
        (gone,) = private(df, "gone_")
        left, _ = _left(text_col, gone)
        return joined(df, repeats, keep, id_col, text_col, gone).withColumn(text_col, F.when(F.col(text_col).isNotNull(), left)).select(*(f"`{c}`" for c in df.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, texts = batch.schema.get_field_index(text_col), batch[text_col].to_pylist()
            for a, b in portions(texts):
                part = batch.slice(a, b - a)
                new = [None if t is None else without(d, t, shared.value, min_chars, keep)[0] for d, t in zip(part[id_col].to_pylist(), texts[a:b], strict=True)]
                yield part.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return df.mapInArrow(run, df.schema)

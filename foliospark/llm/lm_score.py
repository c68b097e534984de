"""Language-model scoring by cross-entropy difference.

Two n-gram models of one order share one vocabulary, the characters of all documents: the
target model counts the n-grams of the documents that the caller marks as good, the background
model those of all documents. Both are smoothed alike (each order's estimate is
interpolated with the next lower one's, down to uniform). A document's score is the
mean over its tokens of target loss less background loss, in bits: below zero, it is
more like the target than like the corpus.

Tokens are characters as they are, none folded; all n-grams of all documents are counted, none
sampled. The counts are a table with a row for each n-gram that occurs, so it grows with the
input: tasks send partial sums, and totals, kinds and losses come of aggregations and
equi-joins. For scoring the losses go to the tasks if they are at most `broadcast_rows`, otherwise the
n-grams of each document are joined with them; the results are the same.

Cases: a null or empty text has no tokens, losses and score 0; without any target document
both models are the same (every score is 0); repeated rows count again and are scored
again; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.columns import id_text, portions
from foliospark.runtime import bounded, materialize

SIZE = 40  # symbols of a dense table for `losses`
BITS, HALF = 21, 3  # of a character; characters in each of the two numbers of an n-gram
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target_loss", pa.float64()), ("background_loss", pa.float64()), ("score", pa.float64())])


def ngrams(text: str, order: int) -> tuple[np.ndarray, np.ndarray]:
    """hi, lo (the last three characters) of the n-gram that ends at each token; before the text come line ends."""
    s = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    padded = np.concatenate([np.full(order - 1, ord("\n")), s])
    out = np.zeros((2, len(s)), np.int64)
    for i in range(order):
        half = out[int(i >= order - HALF)]
        half[:] = half << BITS | padded[i : i + len(s)]
    return out[0], out[1]


def _summed(parts: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(parts).group_by(["hi", "lo"], use_threads=False).aggregate([("t", "sum"), ("b", "sum")])
    return t.rename_columns([c.removesuffix("_sum") for c in t.column_names]).select(["hi", "lo", "t", "b"])


def counts(docs: DataFrame, order: int, most: int = 2_000_000) -> DataFrame:
    """hi, lo, t, b: how often each n-gram is in target (column good) and in all documents."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: list[pa.Table] = []
        for batch in batches:
            texts, good = batch["text"].to_pylist(), batch["good"].to_pylist()
            for a, b in portions(texts):
                part = [(*ngrams(t, order), bool(g)) for t, g in zip(texts[a:b], good[a:b], strict=True) if t]
                if part:
                    hi, lo = (np.concatenate([x[i] for x in part]) for i in range(2))
                    on = np.repeat(np.array([x[2] for x in part], np.int64), [len(x[0]) for x in part])
                    have.append(_summed([pa.table({"hi": hi, "lo": lo, "t": on, "b": np.ones(len(on), np.int64)})]))
                    if sum(x.num_rows for x in have) > most:
                        have = [_summed(have)]
                        if have[0].num_rows > most // 2:
                            yield from have.pop().to_batches()
        if have:
            yield from _summed(have).to_batches()

    return docs.select("text", "good").mapInArrow(build, "hi long, lo long, t long, b long").groupBy("hi", "lo").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))


def _ending(k: int) -> list:
    """hi, lo of the last k characters."""
    hi = F.col("hi").bitwiseAND(F.lit((1 << BITS * max(0, k - HALF)) - 1))
    lo = F.col("lo").bitwiseAND(F.lit((1 << BITS * min(k, HALF)) - 1))
    return [hi, lo]


def gram_losses(full: DataFrame, order: int) -> DataFrame:
    """hi, lo, target_loss, background_loss of the n-grams with counts t, b: as `losses`, over those that occur."""
    below = None
    for k in range(1, order + 1):
        hi, lo = _ending(k)
        here = full.groupBy(hi.alias("hi"), lo.alias("lo")).agg(F.sum("t").alias("t"), F.sum("b").alias("b"))
        here = here.withColumns({"x": F.col("hi"), "y": F.shiftright("lo", BITS)})
        kinds = lambda c: F.count_if(F.col(c) > 0)
        ahead = here.groupBy("x", "y").agg(*(f(c).alias(f"{n}{c}") for c in "tb" for n, f in (("all_", F.sum), ("kinds_", kinds))))
        here = here.join(ahead, ["x", "y"])
        if below is None:
            size = here.count()
            here = here.withColumns({f"low_{c}": F.lit(1 / max(1, size)) for c in "tb"})
        else:
            hi, lo = _ending(k - 1)
            here = here.withColumns({"u": hi, "v": lo}).join(below, ["u", "v"])
        est = lambda c: F.when(F.col(f"all_{c}") > 0, (F.col(c) + F.col(f"kinds_{c}") * F.col(f"low_{c}")) / (F.col(f"all_{c}") + F.col(f"kinds_{c}"))).otherwise(F.col(f"low_{c}"))
        here = materialize(here.select("hi", "lo", est("t").alias("pt"), est("b").alias("pb")), "lm-orders")
        below = here.select(F.col("hi").alias("u"), F.col("lo").alias("v"), F.col("pt").alias("low_t"), F.col("pb").alias("low_b"))
    return here.select("hi", "lo", (-F.log2("pt")).alias("target_loss"), (-F.log2("pb")).alias("background_loss"))


def losses(n: np.ndarray, order: int, size: int = SIZE) -> np.ndarray:
    """The same over a dense table of all n-grams of `size` symbols.

    Bits of each n-gram's last token after the ones before it. The weight of an order's
    own estimate grows with how often the context was seen: n / (n + kinds of next tokens)."""
    p = np.full(size, 1 / size)
    for k in range(1, order + 1):
        c = n.reshape(-1, size**k).sum(axis=0).reshape(-1, size).astype(np.float64)
        total, kinds = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
        lower = np.tile(p.reshape(-1, size), (size, 1))[: len(c)] if k > 1 else p.reshape(1, size)
        p = ((c + kinds * lower) / np.where(total > 0, total + kinds, 1) + np.where(total > 0, 0, 1) * lower).ravel()
    return -np.log2(p)


def _one(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """One number for both: pairs of them, to be compared exactly."""
    out = np.empty(len(lo), [("hi", np.int64), ("lo", np.int64)])
    out["hi"], out["lo"] = hi, lo
    return out


class Losses:
    """The broadcast table in a task: rows sorted by hi, lo."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray, loss: np.ndarray):
        self.lo, self.loss = lo, loss
        self.his, self.at = np.unique(hi, return_index=True)
        self.to = np.append(self.at[1:], len(hi))

    def of(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """[2, n]: the losses of n-grams that are all in the table."""
        order = np.argsort(hi, kind="stable")
        out = np.empty((2, len(lo)))
        kinds, at = np.unique(hi[order], return_index=True)
        for h, a, b in zip(np.searchsorted(self.his, kinds), at, np.append(at[1:], len(hi)), strict=True):
            rows = order[a:b]
            out[:, rows] = self.loss[:, self.at[h] + np.searchsorted(self.lo[self.at[h] : self.to[h]], lo[rows])]
        return out


def lm_score(df: DataFrame, target: DataFrame, order: int = 4, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 2_000_000) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score (their difference; bits a token) of every row.

    target: a column doc_id, of the documents to be like. It is sort-merged with df for the
    counts, whatever its size.
    """
    if not 1 <= order <= 2 * HALF:
        raise ValueError(f"an n-gram has 1 to {2 * HALF} characters")
    docs = id_text(df, id_col, text_col)
    marked = target.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("good")).distinct()
    full = materialize(counts(docs.join(marked.hint("merge"), "doc_id", "left"), order), "lm-counts")
    if not full.where("t > 0").limit(1).count():
        full = full.withColumn("t", F.col("b"))
    table = gram_losses(full, order)
    kind = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"
    if bounded(table, broadcast_rows):
        got = table.orderBy("hi", "lo").toArrow()
        loss = np.stack([got[c].to_numpy() for c in ("target_loss", "background_loss")])
        shared = df.sparkSession.sparkContext.broadcast((got["hi"].to_numpy(), got["lo"].to_numpy(), loss))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Losses(*shared.value)
            for batch in batches:
                texts = batch["text"].to_pylist()
                out, sizes = np.zeros((2, len(texts))), np.array([len(t or "") for t in texts], np.int64)
                for a, b in portions(texts):
                    part = [i for i in range(a, b) if sizes[i]]
                    if part:
                        grams = [ngrams(texts[i], order) for i in part]
                        each = known.of(*(np.concatenate([g[j] for g in grams]) for j in range(2)))
                        out[:, part] = np.add.reduceat(each, np.cumsum([0, *sizes[part[:-1]]]), axis=1) / sizes[part]
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes), pa.array(out[0]), pa.array(out[1]), pa.array(out[0] - out[1])], schema=SCHEMA)

        return docs.mapInArrow(run, kind)

    schema = pa.schema([(c, pa.int64()) for c in ("row", "doc_id", "n_tokens", "hi", "lo", "n")])

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                row += 1
                kinds, n = [(None, None)], [0]
                if text:
                    found, n = np.unique(_one(*ngrams(text, order)), return_counts=True)
                    kinds = found.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ([row] * len(n), [doc] * len(n), [len(text or "")] * len(n), [k[0] for k in kinds], [k[1] for k in kinds], n)], schema=schema)

    each = docs.mapInArrow(grams, "row long, doc_id long, n_tokens long, hi long, lo long, n long").join(table, ["hi", "lo"], "left")
    mean = lambda c: F.coalesce(F.sum(F.col("n") * F.col(c)) / F.first("n_tokens"), F.lit(0.0)).alias(c)
    out = each.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), mean("target_loss"), mean("background_loss"))
    return out.select("doc_id", "n_tokens", "target_loss", "background_loss", (F.col("target_loss") - F.col("background_loss")).alias("score"))

"""Approximate vector search: an inverted file with product-quantised residuals, kept as a table.

Vectors are scaled to length one and put into the list of the nearest of some centers; the table is partitioned by list, and each row holds the vector and a
code of a few bytes for what its center leaves. A search reads the codes of the lists nearest to each query (partitions of other lists are not read),
keeps the best by code, and scores these by their vectors. The centers are learned on a bounded sample (`sample` rows, by the hash of the id);
every row is indexed. An upsert writes only the lists that it touches.

Null or empty vectors aren't indexed; a zero vector is like nothing; of equal scores the least id is first; ids are unique, of repeated ones in an upsert
an arbitrary one stays. Searching with vectors of another model than the index's is an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from foliospark.operators.bm25 import top_k
from foliospark.operators.vectors import BLOCK, cosine
from foliospark.runtime import delete_folder, materialize

SAMPLE = 20_000
CODES = 256


@dataclass
class Quantiser:
    centers: np.ndarray  # lists x dim
    books: np.ndarray  # parts x codes x (dim / parts)
    probes: int = 1  # lists to read for a query, as the sample had it
    share: float = 0.0  # of all rows that are best by code, so many hold the nearest ones, as the sample had it

    def lists_of(self, x: np.ndarray) -> np.ndarray:
        return nearest(x, self.centers)

    def codes_of(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        rest = (x - self.centers[at]).reshape(len(x), len(self.books), -1)
        return np.stack([nearest(rest[:, m], b) for m, b in enumerate(self.books)], axis=1).astype(np.uint8)


@dataclass
class Index:
    spark: SparkSession
    path: str
    model: str
    quantiser: Quantiser
    kind: str = "long"

    def rows(self) -> DataFrame:
        """list, id, embedding (float array), code."""
        return self.spark.read.schema(f"id {self.kind}, embedding array<float>, code binary, list int").parquet(f"{self.path}/lists")


def unit(rows: list) -> np.ndarray:
    x = np.array(rows, np.float32)
    return x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-9)


def nearest(x: np.ndarray, centers: np.ndarray, step: int = 4096) -> np.ndarray:
    half = (centers * centers).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[a : a + step] @ centers.T - half, axis=1) for a in range(0, len(x), step)]) if len(x) else np.zeros(0, np.int64)


def centers_of(x: np.ndarray, n: int, seed: int, rounds: int = 12) -> np.ndarray:
    """n means of x (fewer if x has fewer rows); one that loses all its rows begins again at a row far from its own."""
    rnd = np.random.default_rng(seed)
    c = x[rnd.choice(len(x), min(n, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = nearest(x, c)
        count = np.bincount(at, minlength=len(c))
        total = np.zeros_like(c, dtype=np.float64)
        np.add.at(total, at, x)
        far = np.argsort(((x - c[at]) ** 2).sum(axis=1))[::-1]
        c = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], 0).astype(np.float32)
        empty = np.flatnonzero(count == 0)
        c[empty] = x[far[: len(empty)]]
    return c


def trained(rows: DataFrame, lists: int | None = None, parts: int = 32, sample: int = SAMPLE, seed: int = 0) -> Quantiser:
    """From at most `sample` rows; by default as many lists as the root of the number of rows, at most 4096, and codes of `parts` bytes (at most: a divisor of the dimensions)."""
    live = rows.where("size(embedding) > 0")
    n = live.count()
    some = live.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample).select("embedding").toPandas()["embedding"].tolist()
    if not some:
        return Quantiser(np.zeros((1, parts), np.float32), np.zeros((parts, 1, 1), np.float32))
    x = unit(some)
    parts = max(p for p in range(1, parts + 1) if x.shape[1] % p == 0)
    centers = centers_of(x, lists or min(4096, max(1, round(n**0.5))), seed)
    rest = (x - centers[nearest(x, centers)]).reshape(len(x), parts, -1)
    books = [centers_of(rest[:, m], CODES, seed + m) for m in range(parts)]
    quantiser = Quantiser(centers, np.stack(books), probes_for(x, centers))
    quantiser.share = share_for(x, quantiser)
    return quantiser


def probes_for(x: np.ndarray, centers: np.ndarray, k: int = 10, target: float = 0.95, asked: int = 500) -> int:
    """How many of a query's nearest lists hold `target` of its k nearest rows: measured with rows of the sample as queries. In all rows neighbours
    are nearer than in a sample of them, so that this is rather too many than too few."""
    q = x[:: max(1, len(x) // asked)]
    near = np.argsort(-(q @ x.T), axis=1)[:, : k + 1]
    place = np.argsort(np.argsort(-(q @ centers.T), axis=1), axis=1)
    return int(np.quantile(np.take_along_axis(place, nearest(x, centers)[near], 1), target, method="higher")) + 1


def share_for(x: np.ndarray, quantiser: Quantiser, k: int = 10, target: float = 0.98, asked: int = 500, step: int = 50) -> float:
    """Which share of all rows, the best by code, holds `target` of a query's k nearest: measured with rows of the sample as queries. A code is off by as
    much in a large table as in a small one, so that the number of rows between grows with the table."""
    at = quantiser.lists_of(x)
    codes = quantiser.codes_of(x, at)
    own = quantiser.centers[at] + np.concatenate([b[codes[:, m]] for m, b in enumerate(quantiser.books)], axis=1)  # what list and code say of a row
    q = x[:: max(1, len(x) // asked)]
    places = []
    for a in range(0, len(q), step):
        near = np.argsort(-(q[a : a + step] @ x.T), axis=1)[:, 1 : k + 1]  # the first is the row itself
        score = q[a : a + step] @ own.T
        places.append(len(x) - np.array([np.searchsorted(np.sort(s), s[n]) for s, n in zip(score, near, strict=True)]))
    return float(np.quantile(np.concatenate(places), target, method="higher")) / len(x) if near.size else 1.0


def listed(rows: DataFrame, quantiser: Quantiser) -> DataFrame:
    """id, embedding, list, code of each row with a vector."""
    shared = rows.sparkSession.sparkContext.broadcast(quantiser)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = unit(batch["embedding"].to_pylist())
                at = shared.value.lists_of(x)
                codes = shared.value.codes_of(x, at)
                yield pa.RecordBatch.from_arrays([batch["id"], batch["embedding"], pa.array(at, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary())], names=["id", "embedding", "list", "code"])

    live = rows.where("size(embedding) > 0").select("id", F.col("embedding").cast("array<float>").alias("embedding"))
    return live.mapInArrow(run, f"id {kind}, embedding array<float>, list int, code binary")


def build(rows: DataFrame, path: str, model: str = "", **training: int) -> Index:
    """rows: id, embedding. A list with a third of all rows is written by several tasks (rebalance splits it)."""
    spark = rows.sparkSession
    quantiser = trained(rows, **training)
    listed(rows, quantiser).hint("rebalance", "list").write.partitionBy("list").parquet(f"{path}/lists")
    c, b, kind = quantiser.centers, quantiser.books, rows.schema["id"].dataType.simpleString()
    spark.createDataFrame([(model, list(c.shape), bytearray(c.tobytes()), list(b.shape), bytearray(b.tobytes()), quantiser.probes, quantiser.share, kind)], "model string, shape array<int>, centers binary, book_shape array<int>, books binary, probes int, share double, kind string").write.parquet(f"{path}/quantiser")
    return Index(spark, path, model, quantiser, kind)


def opened(spark: SparkSession, path: str, model: str = "") -> Index:
    r = spark.read.parquet(f"{path}/quantiser").first()
    if r["model"] != model:
        raise ValueError(f"the index holds vectors of {r['model']!r}, not of {model!r}")
    array = lambda raw, shape: np.frombuffer(bytes(raw), np.float32).reshape(shape)
    return Index(spark, path, model, Quantiser(array(r["centers"], r["shape"]), array(r["books"], r["book_shape"]), r["probes"], r["share"]), r["kind"])


def upsert(index: Index, rows: DataFrame) -> list[int]:
    """Puts rows (id, embedding) in, in place of those of the same id. Returns the lists that were written again; all others keep their files."""
    new = materialize(listed(rows, index.quantiser).dropDuplicates(["id"]), "upsert")
    old = index.rows()
    touched = new.select("list").union(old.select("list", "id").join(new.select("id"), "id", "left_semi").select("list")).distinct()
    lists = sorted(r["list"] for r in touched.collect())  # at most as many as there are lists
    kept = old.where(F.col("list").isin(lists)).join(new.select("id"), "id", "left_anti")
    result = materialize(kept.select(*new.columns).unionByName(new), "upsert")
    result.hint("rebalance", "list").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("list").parquet(f"{index.path}/lists")
    left = {r["list"] for r in result.select("list").distinct().collect()}
    for gone in set(lists) - left:
        delete_folder(index.spark, f"{index.path}/lists/list={gone}")
    return lists


def by_codes(codes: DataFrame, quantiser: Quantiser, queries: np.ndarray, near: np.ndarray, depth: int) -> DataFrame:
    """qn, list, id, score: of each Arrow batch of codes the `depth` best of each query that asks the row's list."""
    context = codes.sparkSession.sparkContext
    parts = queries.reshape(len(queries), len(quantiser.books), -1)
    tables = np.einsum("qmd,mcd->qmc", parts, quantiser.books)  # what a code adds, for each query
    asks = [np.flatnonzero((near == n).any(axis=1)) for n in range(len(quantiser.centers))]
    shared = context.broadcast((tables.astype(np.float32), (queries @ quantiser.centers.T).astype(np.float32), asks))
    kind = codes.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, to_center, asks = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.sort_by("id")  # so that of equal scores the least ids stay
            at = batch["list"].to_numpy(zero_copy_only=False)
            code = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            for n in np.unique(at).tolist():
                rows, qs = np.flatnonzero(at == n), asks[n]
                score = to_center[qs, n][:, None] + sum(tables[qs, m][:, code[rows, m]] for m in range(code.shape[1]))
                few = min(depth, len(rows))
                best = np.argsort(-score, axis=1, kind="stable")[:, :few]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qs, few)), pa.array(np.full(best.size, n), pa.int32()), batch["id"].take(pa.array(rows[best.ravel()])), pa.array(np.take_along_axis(score, best, 1).ravel().astype(np.float64))], names=["qn", "list", "id", "score"])

    return codes.select("list", "id", "code").mapInArrow(run, f"qn long, list int, id {kind}, score double")


def search(index: Index, queries: DataFrame, k: int, probes: int | None = None, depth: int | None = None, block: int = BLOCK) -> DataFrame:
    """query_id, id, score (cosine), rank: near the k best of each query (query_id, embedding). Of the `probes` nearest lists (by default as many as the training found) the
    `depth` best by code (by default the share of all rows that the training found, 20 k at least) are scored exactly. A block of queries and its candidates
    are broadcast; of candidates that go deeper than 20 k a block has as many in all, so fewer queries."""
    spark = index.spark
    depth = depth or max(20 * k, math.ceil(index.quantiser.share * index.rows().count() * max(1, k / 10)))
    block = max(1, min(block, block * 20 * k // depth))
    live = queries.where("size(embedding) > 0").select("query_id", "embedding")
    n = max(1, -(-live.count() // block))
    out = None
    for i in range(n):
        asked = (live.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == i) if n > 1 else live).collect()
        if not asked:
            continue
        q = unit([r["embedding"] for r in asked])
        near = np.argsort(-(q @ index.quantiser.centers.T), axis=1)[:, : probes or index.quantiser.probes]
        rows = index.rows().where(F.col("list").isin(np.unique(near).tolist()))
        first = by_codes(rows, index.quantiser, q, near, depth)
        place = F.row_number().over(Window.partitionBy("qn").orderBy(F.desc("score"), "id"))
        some = first.withColumn("place", place).where(F.col("place") <= depth).select("qn", "list", "id")
        kinds = StructType([StructField("qn", LongType()), queries.schema["query_id"], StructField("asked", queries.schema["embedding"].dataType)])
        names = spark.createDataFrame([(j, r["query_id"], r["embedding"]) for j, r in enumerate(asked)], kinds)
        met = rows.select("list", "id", "embedding").join(F.broadcast(some), ["list", "id"]).join(F.broadcast(names), "qn")
        best = top_k(met.select("query_id", "id", cosine(F.col("asked"), F.col("embedding")).alias("score")), k, keep_zero=True)
        out = best if out is None else out.unionByName(best)
    if out is None:
        return top_k(queries.select("query_id").crossJoin(index.rows().limit(0).select("id")).withColumn("score", F.lit(0.0)), k)
    return out


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: n (queries), recall (the share of the exact rows that were found)."""
    hits = exact.select("query_id", "id").join(found.select("query_id", "id").withColumn("hit", F.lit(1)), ["query_id", "id"], "left")
    return hits.agg(F.countDistinct("query_id").alias("n"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))

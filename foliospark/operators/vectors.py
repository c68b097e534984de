"""Exact vector search and score fusion for tables of queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from foliospark.functions.text import normalize_code
from foliospark.operators.best import Best
from foliospark.operators.bm25 import top_k


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / ((F.sqrt(dot(a, a)) + 1e-9) * (F.sqrt(dot(b, b)) + 1e-9))


BLOCK = 4096  # queries broadcast at once


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of a column as rows, without a Python object for each number."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


SLACK = 2e-5  # what a cosine in single precision and a rounded score may be off by
#: A score of a cosine, and the cosine of a score.
SCALES = {
    "cosine": (lambda c: c, lambda s: s),
    "shifted": (lambda c: (c + 1) / 2, lambda s: 2 * s - 1),
    "inverse_distance": (lambda c: 1 / (1 + (1 - c)), lambda s: 2 - 1 / s),
}


def unit(x: np.ndarray) -> np.ndarray:
    return x / (np.sqrt((x * x).sum(axis=1)) + 1e-9)[:, None]


def scored(batches: Iterator[pa.RecordBatch], queries: np.ndarray, k: int, scale: str) -> Iterator[pa.RecordBatch]:
    """qn, id, score of the k best rows of each query. All cosines are taken roughly, in single precision; only those that may be among the best in full."""
    to_score, to_cosine = SCALES[scale]
    q, best = unit(queries), Best(len(queries), k)
    rough = np.ascontiguousarray(q.T, np.float32)
    for whole in batches:
        x = unit(matrix(whole["embedding"]))
        for begin in range(0, whole.num_rows, best.rows):
            part = x[begin : begin + best.rows]
            set_ = np.isfinite(best.least)
            floor = np.where(set_, to_cosine(np.where(set_, best.least, 1.0)), -np.inf)
            at, qn = best.may_count(part.astype(np.float32) @ rough, SLACK, floor=floor)
            c = np.einsum("ij,ij->i", part[at], q[qn])
            best.put(whole["id"], at + begin, qn, np.round(to_score(c), 6))
    found = best.batch()
    if found is not None:
        yield found


def best_of_rows(rows: DataFrame, queries: DataFrame, k: int, scale: str = "cosine") -> DataFrame:
    """qn, id, score: of each task's rows the k best of each query of a block (of which there are at most BLOCK),
    by products of few rows at a time; ties by id, scores rounded to 6 places. qn is a query's number in the block."""
    shared = rows.sparkSession.sparkContext.broadcast(np.array([r["embedding"] for r in queries], np.float64).reshape(len(queries), -1))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from scored(batches, shared.value, k, scale)

    return rows.select("id", "embedding").where("embedding is not null").mapInArrow(run, f"qn long, id {kind}, score double")


def vector_search(rows: DataFrame, queries: DataFrame, k: int, scale: str = "cosine", block: int = BLOCK) -> DataFrame:
    """The k best rows of each query, exactly. The stated queries are worked through in
    blocks, dealt out by hash, of about `block` each; only a block is broadcast."""
    spark = rows.sparkSession
    n = max(1, -(-queries.count() // block))
    out = None
    for i in range(n):
        part = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == i) if n > 1 else queries
        asked = part.select("query_id", "embedding").collect()
        if not asked:
            continue
        names = spark.createDataFrame([(j, r["query_id"]) for j, r in enumerate(asked)], StructType([StructField("qn", LongType()), StructField("query_id", queries.schema["query_id"].dataType)]))
        best = top_k(best_of_rows(rows, asked, k, scale).join(F.broadcast(names), "qn").drop("qn"), k, keep_zero=True)
        out = best if out is None else out.union(best)
    if out is None:
        return top_k(queries.select("query_id").crossJoin(rows.limit(0).select("id")).withColumn("score", F.lit(0.0)), k)
    return out.select("query_id", "id", "score", "rank")


def min_max(scored: DataFrame, score: str = "score") -> DataFrame:
    """Scores of a query between 0 and 1; 1 where all are equal."""
    w = Window.partitionBy("query_id")
    low, high = F.min(score).over(w), F.max(score).over(w)
    return scored.withColumn(score, F.when(high - low < 1e-9, 1.0).otherwise((F.col(score) - low) / (high - low)))


def flat(df: DataFrame, columns: list[str]) -> DataFrame:
    """Metadata as a vector store keeps it: lists joined with " | ", structures as JSON, null as ''."""
    out = df
    for c in columns:
        kind = df.schema[c].dataType.typeName()
        text = F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), " | ") if kind == "array" else F.to_json(c) if kind in ("struct", "map") else F.col(c)
        out = out.withColumn(c, F.coalesce(text, F.lit("")) if kind in ("array", "struct", "map", "string") else text)
    return out


def store_search(rows: DataFrame, queries: DataFrame, k: int, literals: dict[str, str] | None = None, metadata: tuple[str, ...] = ()) -> DataFrame:
    """1 / (1 + distance) over the rows whose flat metadata equals all literals; rows: id, embedding and the metadata."""
    live = flat(rows, list(metadata))
    for key, value in (literals or {}).items():
        live = live.where(F.col(key) == F.lit(value))
    return vector_search(live, queries, k, "inverse_distance")


def multi_query(rows: DataFrame, variants: DataFrame, k: int, scale: str = "inverse_distance") -> DataFrame:
    """variants: query_id, variant, embedding; each finds its best k, the best score of any counts."""
    keyed = variants.select(F.struct("query_id", "variant").alias("query_id"), "embedding")
    best = vector_search(rows, keyed, k, scale).groupBy(F.col("query_id.query_id").alias("query_id"), "id").agg(F.max("score").alias("score"))
    return top_k(best, k, keep_zero=True)


def hybrid(lexical: DataFrame, vector: DataFrame, rows: DataFrame, queries: DataFrame, k: int, exact_weight: float = 0.15, priority_weight: float = 0.05) -> DataFrame:
    """0.45 x lexical + 0.35 x vector (both min-max) + exact code + priority, over the
    max(4k, 20) best of either; rows: id, codes, source_priority; queries: query_id, codes."""
    n = max(4 * k, 20)
    a = min_max(top_k(lexical, n)).select("query_id", "id", F.col("score").alias("lexical"))
    b = min_max(top_k(vector, n, keep_zero=True)).select("query_id", "id", F.col("score").alias("vector"))
    both = a.join(b, ["query_id", "id"], "full_outer").join(queries.select("query_id", F.col("codes").alias("query_codes")), "query_id").join(rows, "id")
    exact = F.arrays_overlap("codes", "query_codes").cast("double")
    score = 0.45 * F.coalesce("lexical", F.lit(0.0)) + 0.35 * F.coalesce("vector", F.lit(0.0)) + exact_weight * exact + priority_weight * F.col("source_priority")
    return top_k(both.withColumn("score", score), k, keep_zero=True).select("query_id", "id", "score", "rank")


def hybrid_rows(lexical: DataFrame, vector: DataFrame, kb: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The same for knowledge rows (id, codes, entities): 0.20 for a code, also one among the entities with a digit; no priority."""
    named = F.transform(F.filter("entities", lambda e: e.rlike("[0-9]")), normalize_code)
    rows = kb.select("id", F.array_union("codes", named).alias("codes"), F.lit(0.0).alias("source_priority"))
    return hybrid(lexical, vector, rows, queries, k, 0.20, 0.0)


def reranked(found: DataFrame, relevance: DataFrame, k: int) -> DataFrame:
    """found (query_id, id) in the order of a scorer's relevance (query_id, id, relevance); ties by id."""
    rows = found.select("query_id", "id").join(relevance, ["query_id", "id"]).withColumnRenamed("relevance", "score")
    return top_k(rows, k, keep_zero=True).select("query_id", "id", "score", "rank")


class Retrievers:
    """Retrieval functions (queries, k) -> query_id, id, score, rank by name."""

    def __init__(self, **named: Callable[[DataFrame, int], DataFrame]):
        self.named = named

    def search(self, queries: DataFrame, retriever: str, k: int) -> DataFrame:
        if retriever not in self.named:
            raise ValueError(f"retriever must be one of: {', '.join(sorted(self.named))}")
        return self.named[retriever](queries, k)

"""Rows are scored where they lie: only the best of each task are shuffled, in pieces of few rows, with the results of all pairs."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from foliospark.operators import best, bm25, vectors


def test_search_shuffles_no_pairs_and_equals_all_pairs(spark):
    rnd = random.Random(7)
    word = lambda: f"w{min(int(rnd.expovariate(0.1)), 60)}"
    docs = spark.createDataFrame([(f"d{i}", [word() for _ in range(rnd.randrange(20))] if i % 50 else None) for i in range(4000)], "id string, tokens array<string>").coalesce(2)
    asked = spark.createDataFrame([((q, q % 2), [word() for _ in range(6)]) for q in range(300)], "query_id struct<a:long,b:long>, tokens array<string>")
    index = bm25.build(docs)
    found = bm25.search(index, asked, 7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
    rows = lambda df: sorted((*r["query_id"], r["rank"], r["id"], r["score"]) for r in df.collect())
    want = rows(bm25.top_k(bm25.scores(index, asked), 7))
    assert rows(found) == want == rows(bm25.one_pass(index, bm25.priced(index, asked), 7, block=64))


def test_terms_are_counted_without_a_shuffle(spark):
    docs = spark.createDataFrame([(1, ["b", "a", "b", None]), (2, None), (3, []), (4, ["ß"] * 3)], "id long, tokens array<string>").coalesce(1)
    out = bm25.counted(docs)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString().replace("Coalesce", "")
    got = {r["id"]: (r["dl"], dict(zip(r["terms"], r["tfs"]))) for r in out.collect()}
    assert got == {1: (3.0, {"a": 1, "b": 2}), 2: (0.0, {}), 3: (0.0, {}), 4: (3.0, {"ß": 3})}


def test_best_of_many_pieces(monkeypatch):
    monkeypatch.setattr(best, "PENDING", 50)
    rnd = np.random.default_rng(3)
    score, ids = rnd.integers(0, 40, (900, 5)) / 8, [f"{i:x}" for i in rnd.permutation(900)]
    kept = best.Best(5, 6)
    for i in range(0, 900, 37):
        kept.add(pa.array(ids[i : i + 37]), score[i : i + 37])
        assert kept.waiting <= 50 + 2 * 6 * 5 + 37 * 5
    got = kept.batch().to_pydict()
    want = [(q, ids[i], score[i, q]) for q in range(5) for i in sorted(range(900), key=lambda i: (-score[i, q], ids[i]))[:6]]
    assert list(zip(got["qn"], got["id"], got["score"])) == want
    assert best.Best(4096, 10).rows * 4096 <= best.CELLS


def test_vectors_in_pieces_equal_all_pairs(spark):
    rnd = np.random.default_rng(5)
    rows = spark.createDataFrame([(i, [float(v) for v in rnd.integers(-3, 4, 4)]) for i in range(3000)], "id long, embedding array<float>").coalesce(1)
    asked = rows.where("id % 10 = 0").select(F.col("id").alias("query_id"), "embedding")
    pairs = rows.crossJoin(asked.withColumnRenamed("embedding", "y")).select("query_id", "id", vectors.cosine(F.col("embedding"), F.col("y")).alias("score"))
    sort = lambda df: sorted((r["query_id"], r["rank"], r["id"]) for r in df.collect())
    assert sort(vectors.vector_search(rows, asked, 5)) == sort(bm25.top_k(pairs, 5, keep_zero=True))

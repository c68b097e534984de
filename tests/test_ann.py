"""The approximate vector index: recall, partitions read, upserts."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.operators import ann, vectors


def cloud(spark, n=1500, dim=16, seed=0):
    rnd = np.random.default_rng(seed)
    middle = rnd.normal(size=(12, dim)) * 2
    x = middle[rnd.integers(0, 4, n) * rnd.integers(1, 4, n)] + rnd.normal(size=(n, dim))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(n + i, x[0].tolist()) for i in range(300)] + [(n + 900, None), (n + 901, []), (n + 902, [0.0] * dim)]
    return spark.createDataFrame(rows, "id long, embedding array<double>")


def test_recall_and_partitions(spark, tmp_path):
    rows = cloud(spark)
    asked = rows.where("id % 20 = 1 and size(embedding) > 0").select(F.col("id").alias("query_id"), "embedding")
    index = ann.build(rows, str(tmp_path / "v"), "m")
    assert index.rows().count() == rows.where("size(embedding) > 0").count()
    again = ann.opened(spark, index.path, "m")
    found = ann.search(again, asked, 10, block=32)
    exact = vectors.vector_search(rows.where("size(embedding) > 0"), asked, 10)
    r = ann.recall(found, exact).first()
    assert r["n"] == asked.count() and r["recall"] >= 0.9
    both = {(r["query_id"], r["id"]): r["score"] for r in exact.collect()}
    assert all(abs(both.get((r["query_id"], r["id"]), r["score"]) - r["score"]) < 1e-5 for r in found.collect())
    one = ann.search(again, asked.limit(1), 3, probes=2)
    assert len(one.inputFiles()) and "list IN" in one._jdf.queryExecution().toString().replace("list#", "list IN") and one.count() == 3
    with pytest.raises(ValueError, match="vectors of 'm'"):
        ann.opened(spark, index.path, "other")


def test_an_upsert_touches_few_lists_and_equals_a_rebuild(spark, tmp_path):
    rows = cloud(spark, seed=1)
    index = ann.build(rows.where("id < 1700"), str(tmp_path / "v"))
    files = lambda: {f"{d}/{f}" for d, _, names in os.walk(f"{index.path}/lists") for f in names if f.endswith(".parquet")}
    before = files()
    moved = spark.createDataFrame([(5, [9.0] * 16), (100_000, [-9.0] * 16)], "id long, embedding array<double>")
    lists = ann.upsert(index, moved)
    kept = {f for f in before if int(f.split("list=")[1].split("/")[0]) not in lists}
    assert 1 <= len(lists) <= 3 and kept <= files() and not (before - kept) & files()
    want = rows.where("id < 1700 and id <> 5 and size(embedding) > 0").union(moved)
    anew = ann.listed(want, index.quantiser)
    see = lambda df: sorted((r["id"], r["list"], bytes(r["code"])) for r in df.collect())
    assert see(index.rows()) == see(anew)
    # All rows of a list go elsewhere: its folder goes too.
    at = index.rows().where("id = 5").first()["list"]
    gone = index.rows().where(F.col("list") == at).select("id").withColumn("embedding", F.array(*(F.lit(-9.0) for _ in range(16))))
    ann.upsert(index, ann.materialize(gone, "t"))
    assert not os.path.exists(f"{index.path}/lists/list={at}") and see(index.rows())[0][0] == 0


def test_nothing_to_index(spark, tmp_path):
    rows = cloud(spark).limit(0)
    index = ann.build(rows, str(tmp_path / "v"))
    assert ann.opened(spark, index.path).quantiser.centers.shape[0] == 1
    asked = cloud(spark).limit(2).select(F.col("id").alias("query_id"), "embedding")
    assert ann.search(index, asked.limit(0), 3).collect() == []


def test_recall_of_vectors_without_clusters(spark, tmp_path):
    """What 8-byte codes and 200 candidates by code lose, all lists being read."""
    x = np.random.default_rng(5).standard_normal((20_000, 64)).astype(np.float32)
    rows = ann.materialize(spark.createDataFrame(list(enumerate(x.tolist())), "id long, embedding array<float>"), "vectors")
    asked = rows.where("id % 400 = 0").select(F.col("id").alias("query_id"), "embedding")
    index = ann.build(rows, str(tmp_path / "v"), lists=20, sample=5000)
    assert 0 < ann.opened(spark, index.path).quantiser.share < 0.02
    r = ann.recall(ann.search(index, asked, 10, probes=20), vectors.vector_search(rows, asked, 10)).first()
    assert r["n"] == 50 and r["recall"] >= 0.95
    # Coarser codes are met by a deeper search.
    coarse = ann.build(rows, str(tmp_path / "w"), lists=20, sample=5000, parts=8)
    assert coarse.quantiser.share > 2 * index.quantiser.share
    r = ann.recall(ann.search(coarse, asked, 10, probes=20), vectors.vector_search(rows, asked, 10)).first()
    assert r["recall"] >= 0.9

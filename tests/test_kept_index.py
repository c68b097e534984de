"""The kept BM25 index: an upsert gives what a rebuild gives and writes only the buckets that it touches."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from foliospark.operators import bm25, kept_index

SCHEMA = "id long, tokens array<string>, bucket int"
ASKED = [(1, ["w1", "w2", "w2"]), (2, ["w0", "w19"]), (3, ["none"]), (4, ["w5"])]


def texts(n: int, seed: int) -> list[tuple]:
    rnd = random.Random(seed)
    return [(i, [f"w{min(int(rnd.expovariate(0.2)), 19)}" for _ in range(rnd.randrange(0, 30))], i % 8) for i in range(n)]


def answers(spark, index, plain=None):
    asked = spark.createDataFrame(ASKED, "query_id long, tokens array<string>")
    return sorted(map(tuple, bm25.search(index, asked, 5, plain=plain).select("query_id", "id", "score", "rank").collect()))


def files(path: str) -> dict[str, float]:
    return {os.path.join(top, f): os.stat(os.path.join(top, f)).st_mtime_ns for top, _, fs in os.walk(path) for f in fs if f.startswith("part-") or f.endswith(".parquet")}


@pytest.mark.parametrize("plain", [None, 0])
def test_upsert_equals_rebuild(spark, tmp_path, plain):
    path = str(tmp_path / "index")
    rows = texts(120, 1)
    kept = kept_index.build(spark.createDataFrame(rows, SCHEMA), path)
    assert answers(spark, kept_index.opened(kept), plain) == answers(spark, bm25.build(spark.createDataFrame(rows, SCHEMA)), plain)
    before = files(path)
    # Row 10 changes, 18 moves from bucket 2 to 5, 200 comes (twice, equal), 202 comes without tokens, 26 goes; 10 is also removed, but stays.
    new = [(10, ["w1"] * 9, 2), (18, ["w5", "w1"], 5), (200, ["w19", "w19", "new"], 2), (200, ["w19", "w19", "new"], 2), (202, None, 2), (None, ["w1"], 7)]
    gone = spark.createDataFrame([(26,), (10,), (999,)], "id long")
    for _ in range(2):  # doing it again changes nothing
        assert kept_index.upsert(kept, spark.createDataFrame(new, SCHEMA), gone) == [2, 5]
        now = {r[0]: r for r in rows if r[0] != 26} | {r[0]: (r[0], r[1] or [], r[2]) for r in new if r[0] is not None}
        rebuilt = bm25.build(spark.createDataFrame(list(now.values()), SCHEMA))
        assert answers(spark, kept_index.opened(kept), plain) == answers(spark, rebuilt, plain)
        assert sorted(map(tuple, kept_index.opened(kept).terms.select("term", "df", F.round("idf", 9)).collect())) == sorted(map(tuple, rebuilt.terms.select("term", "df", F.round("idf", 9)).collect()))
        after = files(path)
        quiet = lambda fs: {f: t for f, t in fs.items() if "bucket=2/" not in f and "bucket=5/" not in f}
        assert quiet(after) == quiet(before)
        assert set(after) != set(before)


def test_bound_is_no_less_than_any_posting(spark, tmp_path):
    index = kept_index.opened(kept_index.build(spark.createDataFrame(texts(60, 2), SCHEMA), str(tmp_path / "index")))
    most = index.postings.crossJoin(index.avgdl).groupBy("term").agg(F.max(bm25.saturated()).alias("real"))
    assert most.join(index.terms, "term").where("real > top + 1e-12").count() == 0


def test_bucket_that_loses_all_rows(spark, tmp_path):
    path = str(tmp_path / "index")
    kept = kept_index.build(spark.createDataFrame([(1, ["a"], 0), (2, ["a", "b"], 1), (3, [], 2)], SCHEMA), path)
    nothing = spark.createDataFrame([], SCHEMA)
    assert kept_index.upsert(kept, nothing, spark.createDataFrame([(2,), (3,)], "id long")) == [1, 2]
    assert [tuple(r) for r in kept.rows().collect()] == [(1, 1.0, 0)]
    assert [(r["term"], r["df"]) for r in kept_index.opened(kept).terms.collect()] == [("a", 1)]
    assert kept_index.upsert(kept, nothing) == []
    # A row that loses its tokens keeps counting, and its bucket has no postings left.
    assert kept_index.upsert(kept, spark.createDataFrame([(1, [], 0)], SCHEMA)) == [0]
    assert kept.rows().count() == 1 and kept_index.opened(kept).postings.count() == 0


def test_empty_table_and_default_buckets(spark, tmp_path):
    kept = kept_index.build(spark.createDataFrame([], SCHEMA).drop("bucket"), str(tmp_path / "index"))
    assert answers(spark, kept_index.opened(kept)) == []
    assert len(kept_index.upsert(kept, spark.createDataFrame(texts(40, 3), SCHEMA).drop("bucket"))) > 10
    assert answers(spark, kept_index.opened(kept)) == answers(spark, bm25.build(spark.createDataFrame(texts(40, 3), SCHEMA)))

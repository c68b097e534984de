"""Tokens found by bytes are those of the pattern; blocks and links that searches rest on are those of the whole tables."""

import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators import bm25, build, evidence, kb
from foliospark.plans import manual

D = "/root/testdata/sf0.001"


def test_tokens_by_bytes_are_those_of_the_pattern():
    rnd = random.Random(5)
    texts = ["", "A", "12AB", "A1B2", "ÉA1", "一二A1鿿9", "㐀龥鿿X", "SP9001\n5", None, "é", "𠀀B", "A䷿1ꀀ"]
    texts += ["".join(rnd.choice("AZB019 -.É一鿿䷿ß\n𠀀") for _ in range(rnd.randrange(30))) for _ in range(3000)]
    want = [re.findall(T.TOKEN, t or "") for t in texts]
    assert bm25.token_lists(pa.array(texts, pa.string())).to_pylist() == want
    assert bm25.token_lists(pa.array(texts, pa.string()).slice(4, 900)).to_pylist() == want[4:904]
    assert bm25.token_lists(pa.array([], pa.string())).to_pylist() == []
    assert bm25.token_lists(pa.array([None, ""], pa.string())).to_pylist() == [[], []]


def test_texts_are_counted_as_their_tokens(spark):
    rows = spark.createDataFrame([(1, "B A1 B 一"), (2, ""), (3, None)], "id long, text string")
    sort = lambda df: sorted((r["id"], r["dl"], sorted(zip(r["terms"], r["tfs"]))) for r in df.collect())
    assert sort(bm25.counted_texts(rows)) == sort(bm25.counted(rows.select("id", T.tokens(F.coalesce("text", F.lit(""))).alias("tokens"))))


def test_blocks_without_contexts_are_those_with_them(spark):
    own = manual.own_blocks(spark, D)
    every = manual.built(spark, D).where("block_type <> 'page_context'").select(*own.columns)
    assert own.count() == every.count() and own.exceptAll(every).count() == 0
    assert "collect_list(struct(pos" not in build.build_blocks(manual.items(spark, D), manual.LEX, False, contexts=False).drop("context_prev", "context_next")._jdf.queryExecution().optimizedPlan().toString()


def test_links_around_seeds_are_enough(spark, monkeypatch):
    rows = manual.manual_kb(spark, D)
    seeds = rows.where("doc_id % 40 = 7 and pos % 5 = 0").select(F.lit(1).alias("query_id"), F.col("kb_id").alias("id"), F.lit(1.0).alias("score"))
    seeds = evidence.materialize(seeds, "seeds")
    near = kb.around(rows, seeds, manual.LEX)
    whole = kb.ranked(kb.adjacency(kb.edges(rows, manual.LEX)))
    sort = lambda links: sorted(map(tuple, kb.expand(links, seeds, 2, 64).drop("rank").withColumn("score", F.round("score", 9)).collect()), key=str)
    assert 0 < near.rows.count() < whole.rows.count() / 10
    assert sort(near) == sort(whole)

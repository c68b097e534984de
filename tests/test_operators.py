"""The library's own operators: formulas on small rows, and queries against their SQL."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators import blocks, bm25, evidence, kb, pages, reasoning, session, vectors

SF = "/root/testdata/sf0.001"


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "codes"), [("SP9137", ["SP9137"]), ("S P 9 1 3 7", ["SP9137"]), ("sp-9137 SP_12", ["SP12", "SP9137"]), ("XSP9137", []), ("报警SP9137", []), ("SP1", [])])
def test_codes(spark, text, codes):
    assert one(spark, T.codes(F.lit(text))) == codes


def test_canonical(spark):
    assert one(spark, T.canonical(F.lit("  ｓp-91 37\t x\n\n\n\ny "))) == "SP9137 X\n\nY"
    assert one(spark, T.canonical(F.lit(None).cast("string"))) == ""


@pytest.mark.parametrize(("text", "limit", "want"), [("", 10, []), ("a" * 10, 10, ["a" * 10]), ("a" * 11, 10, ["a" * 10, "a"]), ("aaa\n\nbbbbb\n\nc", 10, ["aaa\n\nbbbbb", "c"]), ("aa\n\n" + "b" * 25 + "\n\ncc", 10, ["aa", "b" * 10, "b" * 10, "b" * 5, "cc"])])
def test_chunks(spark, text, limit, want):
    assert one(spark, blocks.chunks(F.lit(text), limit)) == want


def test_steps_and_short_parts(spark):
    assert one(spark, blocks.steps(F.lit("1. a\nb\nSTEP 2 c"))) == ["1. a\nb", "STEP 2 c"]
    assert one(spark, blocks.merged_short(F.array(F.lit("a"), F.lit("b" * 90), F.lit("c")))) == ["a\n" + "b" * 90, "c"]


def test_fusion_golden(spark):
    cand = spark.createDataFrame([(1, 1, "entity", 1.0, None), (1, 1, "bm25", 18.754667432199046, None), (1, 1, "graph", 18.754667432199046, 0)], "query_id int, id int, source string, score double, distance int")
    rows = spark.createDataFrame([(1, "alarm", "", ["SP9137"])], "id int, kb_type string, section_path string, alarm_codes array<string>")
    asks = spark.createDataFrame([(1, ["SP9137"], False)], "query_id int, alarm_codes array<string>, need_safety boolean")
    assert math.isclose(evidence.merge(cand, rows, asks).first()["score"], 33.58293463473838, abs_tol=1e-8)


def test_garble_and_confidence_goldens(spark):
    score, reasons = pages.garble_score(F.lit("x" * 1356 + "????"))
    assert (one(spark, score), one(spark, reasons)) == (2.0, ["question_marks"])
    assert one(spark, reasoning.confidence(F.lit(1.4167), F.lit(2), F.lit(True))) == 0.9
    assert one(spark, reasoning.confidence(F.lit(1.4167), F.lit(2), F.lit(False))) == 0.45


def test_page_range(spark):
    assert one(spark, pages.page_range(F.lit("622,600-603, 602"))) == [600, 601, 602, 603, 622]


def test_session(spark):
    rows = spark.createDataFrame([(1, 0, "补充：x"), (1, 1, "q"), (1, 2, "补充：a"), (1, 3, "补充信息 b"), (1, 4, "r")], "conv_id int, turn int, text string")
    got = {r["turn"]: r["query"] for r in session.fold(rows).collect()}
    assert got == {1: "q\n\n补充信息：\n- a\n- b", 4: "r"}


def test_bm25_without_shared_term_and_min_max(spark):
    index = bm25.build(spark.createDataFrame([(1, ["A"]), (2, ["B", "B"])], "id int, tokens array<string>"))
    assert bm25.search(index, spark.createDataFrame([(1, ["C"])], "query_id int, tokens array<string>"), 5).count() == 0
    same = spark.createDataFrame([(1, 1, 2.0), (1, 2, 2.0)], "query_id int, id int, score double")
    assert {r["score"] for r in vectors.min_max(same).collect()} == {1.0}


def test_expand_keeps_best_parent(spark):
    adjacent = spark.createDataFrame([("a", "c", 0.4), ("b", "c", 0.5), ("c", "a", 0.4), ("c", "b", 0.5)], "node string, other string, weight double")
    seeds = spark.createDataFrame([(1, "a", 1.0), (1, "b", 1.0)], "query_id int, id string, score double")
    got = {r["id"]: (r["score"], r["distance"]) for r in kb.expand(kb.ranked(adjacent), seeds, 2).collect()}
    assert got == {"a": (1.0, 0), "b": (1.0, 0), "c": (0.5, 1)}
    # The link that a node was reached by; of equal ones the least parent and relation.
    named = adjacent.where("weight = 0.5").withColumn("relation", F.lit("y")).union(spark.createDataFrame([("a", "c", 0.5, "z"), ("a", "c", 0.5, "x")], "node string, other string, weight double, relation string"))
    by = {r["id"]: (r["parent"], r["relation"]) for r in kb.expand(kb.ranked(named), seeds, 1).collect()}
    assert by == {"a": (None, None), "b": (None, None), "c": ("a", "x")}


def test_merge_keeps_reasons_in_order_of_sources(spark):
    kind = "query_id int, id string, source string, score double, distance int, reasons array<string>, matched_entities array<string>, seed string"
    found = spark.createDataFrame([(1, "k", "graph", 0.5, 1, ["graph_neighbor", "mentions"], [], "s"), (1, "k", "bm25", 2.0, None, ["keyword_match"], [], None), (1, "k", "entity", 1.0, None, ["alarm_code_exact_match"], ["SP9001"], None), (1, "m", "graph", 0.5, 0, ["graph_neighbor", "graph_neighbor"], None, None)], kind)
    rows = spark.createDataFrame([(i, "text", "", []) for i in "km"], "id string, kb_type string, section_path string, alarm_codes array<string>")
    asks = spark.createDataFrame([(1, [], False)], "query_id int, alarm_codes array<string>, need_safety boolean")
    got = {r["id"]: (r["reasons"], r["matched_entities"], r["seed_kb_id"]) for r in evidence.merge(found, rows, asks).collect()}
    assert got == {"k": (["alarm_code_exact_match", "keyword_match", "graph_neighbor", "mentions"], ["SP9001"], "s"), "m": (["graph_neighbor"], [], None)}


def graph_by_hand(links, seeds, hops, most):
    """query, id -> (score, distance), by walking lists of links."""
    out = {}
    for q in {s[0] for s in seeds}:
        seen = {}
        for _, n, s in (x for x in seeds if x[0] == q):
            seen[n] = (max(s, seen.get(n, (s, 0))[0]), 0)
        front = dict(seen)
        for hop in range(1, hops + 1):
            new = {}
            for n, (s, _) in front.items():
                own = sorted((x for x in links if x[0] == n), key=lambda x: (-x[2], x[1]))[:most]
                for _, other, w in own:
                    if not other.startswith("entity::") and other not in seen:
                        new[other] = (max(s * w, new.get(other, (0, 0))[0]), hop)
            front = new
            seen |= new
        best = sorted(seen.items(), key=lambda x: (-round(x[1][0], 9), x[0]))[: max(most, sum(1 for x in seeds if x[0] == q))]
        out |= {(q, n): (round(s, 9), h) for n, (s, h) in best}
    return out


def test_ranked_links_with_a_hub(spark):
    """Stored links give what a walk over all links gives, with a hub of a third of them, links twice and entities; no exchange of the links."""
    rnd = random.Random(6)
    name = lambda: rnd.choice([f"n{rnd.randrange(40):02d}", f"entity::{rnd.randrange(5)}"])
    rows = [(rnd.choice(["hub", f"n{rnd.randrange(40):02d}", f"n{rnd.randrange(40):02d}"]), name(), rnd.choice((0.25, 0.4, 0.7))) for _ in range(400)]
    rows += [(f"n{i:02d}", "hub", 0.9) for i in range(0, 40, 3)] + rows[:30]
    seeds = [(1, "n00", 1.0), (1, "n00", 0.3), (1, "n07", 0.5), (2, "hub", 2.0), (3, "gone", 1.0), (4, "n03", 1.0)]
    adjacent, asked = spark.createDataFrame(rows, "node string, other string, weight double"), spark.createDataFrame(seeds, "query_id int, id string, score double")
    links = kb.stored(kb.ranked(adjacent, 12))
    for hops, most in ((1, 3), (2, 7), (2, 12)):
        got = {(r["query_id"], r["id"]): (round(r["score"], 9), r["distance"]) for r in kb.expand(links, asked, hops, most).collect()}
        assert got == graph_by_hand(rows, seeds, hops, most)
    with pytest.raises(Exception, match="above the 12 links"):
        kb.expand(links, asked, 1, 13).collect()
    assert kb.expand(links, asked.limit(0), 2, 3).count() == 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = kb.expand(links, asked, 1, 3)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(node" not in plan and "hashpartitioning(id" in plan
    limited = kb.ranked(adjacent, 12).rows._jdf.queryExecution().executedPlan().toString()
    assert limited.count("WindowGroupLimit") == 2  # before and after the exchange


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_queries_match_their_sql(spark):
    import duckdb

    from foliospark.plans import catalog

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    plain = lambda x: str(round(x, 6) + 0.0) if isinstance(x, float) else str(x)
    for name in ("bm25_search", "code_extraction", "chunk_text", "relink_blocks", "manual_blocks", "ocr_pages", "kb_rows", "graph_edges", "vector_search", "retrieve", "reasoning_summary", "rule_answers", "validate_answers", "session_fold"):
        got = catalog.QUERIES[name](spark, SF)
        names = sorted(got.columns)
        want = con.sql(f"select {', '.join(names)} from ({catalog.ORACLES[name]})").fetchall()
        have = [tuple(r) for r in got.select(*names).collect()]
        assert have, name
        assert sorted(tuple(map(plain, r)) for r in have) == sorted(tuple(map(plain, r)) for r in want), name

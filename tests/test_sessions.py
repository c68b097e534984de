"""Turns of conversations in a table and in a stream, and hits as they are shown."""

import pytest

from foliospark.lexicon import Lexicon
from foliospark.operators import evidence, session

LEX = Lexicon(supplements=("More:", "And"))
TURNS = [
    ("a", 1, "More: too early"), ("a", 2, " first? "), ("a", 3, "More: x"), ("a", 4, "  "), ("a", 5, "And: y"), ("a", 6, "More:"), ("a", 7, "/RESET"),
    ("a", 8, "More: lost"), ("a", 9, "second"), ("a", 10, "Quit"), ("a", 11, "never asked"), ("b", 1, "only"), ("b", 2, None), ("c", 5, "exit"),
]
WANT = [("a", 2, "first?", 0), ("a", 3, "first?\n\nH\n- x", 1), ("a", 5, "first?\n\nH\n- x\n- y", 2), ("a", 6, "first?\n\nH\n- x\n- y\n- More:", 3), ("a", 9, "second", 0), ("b", 1, "only", 0)]
KIND = "conv_id string, turn long, text string"


def test_each_turn_asks(spark):
    assert sorted(map(tuple, session.turn_queries(spark.createDataFrame(TURNS, KIND), LEX, "H").collect())) == WANT
    assert session.turn_queries(spark.createDataFrame([], KIND), LEX).collect() == []


@pytest.mark.parametrize("cuts", [(3, 8)])
def test_a_stream_goes_on_from_its_state(spark, tmp_path, cuts):
    for lo, hi in zip((0, *cuts), (*cuts, 99), strict=True):
        # The last turn of the portion before comes again.
        spark.createDataFrame([t for t in TURNS if lo - 1 <= t[1] < hi and t[1] >= lo - 1], KIND).repartition(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = session.stream_queries(spark.readStream.schema(KIND).parquet(str(tmp_path / "in")), LEX, "H")
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination(120)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == WANT


def test_hits_are_shown_with_the_first_image(spark):
    kind = "block_id string, doc_id int, page_no int, block_type string, text string, image_paths array<string>"
    blocks = spark.createDataFrame([
        ("own", 1, 1, "text", "t", ["i1", "i2"]), ("context", 1, 2, "text", "t", []), ("none", 1, 3, "text", "t", None), ("alone", 1, 4, "text", "t", []), ("no page", 1, -1, "text", "t", []),
        ("c1", 1, 1, "page_context", "C1", ["ci1"]), ("c2", 1, 2, "page_context", "C2", ["ci2"]), ("c3", 1, 3, "page_context", "C3", []), ("other", 2, 4, "page_context", "C4", ["ci4"]),
    ], kind)
    hits = spark.createDataFrame([(7, b) for b in ("own", "context", "none", "alone", "no page", "unknown")], "query_id int, id string")
    got = {r["id"]: (r["page_context"], r["page_image"]) for r in evidence.displayed(hits, blocks).collect()}
    assert got == {"own": ("C1", "i1"), "context": ("C2", "ci2"), "none": ("C3", ""), "alone": (None, ""), "no page": (None, "")}

"""Scans, sinks, layout trees, services and kept tables."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from foliospark.sources import collections, files, layout, services


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1, "t": "ü"}\n\n  \n{"x": 2}\n', encoding="utf-8")
    df = files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "x long, t string")
    assert sorted(map(tuple, df.collect())) == [(1, "ü"), (2, None)]
    files.write_jsonl(df, str(tmp_path / "out"))
    assert sorted(json.loads(x[0])["x"] for x in spark.read.text(str(tmp_path / "out")).collect()) == [1, 2]
    (tmp_path / "b.jsonl").write_text('{"x": 1}\n{"x": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_jsonl(spark, str(tmp_path / "b.jsonl"), "x long").collect()


def test_binaries(spark, tmp_path):
    data = bytes(range(256)) * 2
    (tmp_path / "p.JPG").write_bytes(data)
    r = files.binaries(spark, str(tmp_path)).select("suffix", files.data_url(F.col("content"), F.col("suffix")).alias("url"), files.sha256(F.col("content")).alias("h")).first()
    assert r["url"] == "data:image/jpeg;base64," + base64.b64encode(data).decode() and len(r["h"]) == 64
    names = spark.createDataFrame([("Ａ b--c.pdf",), ("手册",)], "n string").select(files.slug(F.col("n"))).collect()
    assert [x[0] for x in names] == ["A_b_c_pdf", "document"]


def test_layout(spark):
    tree = {"page_no": 3, "body": [{"text": " a ", "confidence": "0.5"}, {"label": "Picture", "prov": [{"page_no": 5, "bbox": {"l": 1, "t": 2, "r": 3, "b": 4}, "confid": 0.2}, {"confidence": 0.4}]}, {"orig": "b", "page_idx": 0, "bbox": [1, 2, 3], "kids": [{"content": "c"}]}, {"text": "  "}]}
    got = [tuple(r)[1:] for r in layout.layout_items(spark.createDataFrame([("d", json.dumps(tree)), ("e", None)], "doc_id string, layout string")).orderBy("item_no").collect()]
    assert [x[:5] for x in got] == [(0, "$.body[0]", "text", 3, "a"), (1, "$.body[1]", "Picture", 5, ""), (2, "$.body[2]", "text", 1, "b"), (3, "$.body[2].kids[0]", "text", 1, "c")]
    assert got[0][6] == 0.5 and got[1][5] == [1, 2, 3, 4] and got[1][6] == pytest.approx(0.3) and got[2][5] is None


def test_services(spark):
    class Fussy:
        def many(self, texts):
            if len(texts) > 2 or "bad" in texts:
                raise ValueError
            return [[len(t)] for t in texts]

        def one(self, text):
            return [-1]

        def read(self, url):
            return f" {url} "

    assert services.embedded(["a", "bb", "bad", "cccc", ""], Fussy()) == [[1], [2], [-1], [4], [0]]
    df = spark.createDataFrame([(i, "x" * i) for i in range(9)] + [(9, None)], "id long, text string")
    assert sorted(map(tuple, services.embed(df, Fussy, batch=4).collect())) == [(i, [float(i % 9)]) for i in range(9)] + [(9, [0.0])]
    pages = spark.createDataFrame([("d", 1, "u1"), ("d", 2, "u2")], "doc_id string, page_no int, image_url string")
    known = spark.createDataFrame([("d", 1, "old"), ("d", 7, "seven"), ("d", 0, "no page")], "doc_id string, page_no int, ocr_text string")
    for force, first in ((False, "old"), (True, "u1")):
        assert sorted(map(tuple, services.read_pages(pages, known, Fussy, force).collect())) == [("d", 1, first), ("d", 2, "u2"), ("d", 7, "seven")]


def test_kept_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, text string")
    make = lambda d: d.withColumn("n", F.length("text"))
    at = str(tmp_path / "v")
    assert [collections.synced(x, at, make, ["id", "text"], m)[1] for x, m in ((df, "m"), (df.orderBy(F.desc("id")), "m"), (df, "m2"), (df.limit(1), "m2"))] == [True, False, True, True]
    assert collections.synced(df.limit(1), at, make, ["id", "text"], "m2")[0].count() == 1

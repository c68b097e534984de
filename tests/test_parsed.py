"""The layout data source and the tokeniser of markup."""

import json

import pytest

from foliospark.operators import build
from foliospark.plans.manual import LEX
from foliospark.sources import layout_source, markup


def tree(*texts, **more):
    return {"page_no": 1, "body": [{"text": t, **more} for t in texts]}


@pytest.fixture
def folder(tmp_path):
    def put(path, what):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(what if isinstance(what, str) else json.dumps(what), encoding="utf-8")

    table = {"label": "table", "text": "T", "cells": [{"text": "cell"}]}
    put("m1/layout.json", {"body": [{"text": "a", "page_no": 1}, {"text": "é", "page_no": 2, "confidence": 0.5}, table, {"label": "picture", "page_no": 2}, {"text": "no page"}]})
    put("m1/page_0007/layout.json", tree("seven", "again"))
    put("m2/page_no=9/part.jsonl", "".join(json.dumps({"doc_id": d, "layout": t}) + "\n" for d, t in [("m2", tree("ünï")), ("m3", tree("x" * 300)), ("m4", None)]) + "\n  \n")
    put("lines.txt", "".join(json.dumps({"doc_id": f"l{i}", "layout": json.dumps(tree(f"t{i}"))}) + "\n" for i in range(40)))
    put("_hidden/layout.json", "not json")
    put("m1/notes.md", "not read")
    return str(tmp_path)


@pytest.mark.parametrize(("split", "scheme"), [(7, "file://"), (1 << 20, "")])
def test_every_tree_is_read_once(spark, folder, split, scheme):
    layout_source.register(spark)
    for path in (scheme + folder,):
        rows = spark.read.format("layout").option("split_bytes", split).load(path).collect()
        got = sorted((r["doc_id"], r["item_no"], r["page_no"], r["text"]) for r in rows if r["page_no"] is not None)
        want = [("m1", 0, 1, "a"), ("m1", 1, 2, "é"), ("m1", 4, 2, ""), ("m1", 0, 7, "seven"), ("m1", 1, 7, "again"), ("m2", 0, 9, "ünï"), ("m3", 0, 9, "x" * 300), *((f"l{i}", 0, 1, f"t{i}") for i in range(40))]
        assert got == sorted(want)
        assert sorted(r["text"] for r in rows if r["page_no"] is None) == ["T", "cell", "no page"]


def test_options_leave_tables_and_recognised_texts_out(spark, folder):
    layout_source.register(spark)
    rows = spark.read.format("layout").option("tables", "false").option("ocr", "false").load(f"{folder}/m1").collect()
    assert sorted(r["text"] for r in rows) == ["", "T", "a", "again", "no page", "seven"]


def test_filters_are_taken_over(spark, folder, tmp_path):
    layout_source.register(spark)
    read = spark.read.format("layout").load(folder)
    assert sorted(r["text"] for r in read.where("page_no = 7").collect()) == ["again", "seven"]
    assert {r["doc_id"] for r in read.where("page_no > 7 and doc_id in ('m2', 'l1')").collect()} == {"m2"}
    assert read.where("page_no is null").count() == 3 and read.where("length(text) > 100").count() == 1
    # Folders of other pages aren't opened: this one couldn't be read.
    (tmp_path / "m1/page_0008").mkdir()
    (tmp_path / "m1/page_0008/layout.json").write_text("broken")
    assert read.where("page_no = 7").count() == 2
    with pytest.raises(Exception, match="(?i)json|expecting"):
        spark.read.format("layout").load(folder).collect()


def test_only_the_asked_pages_are_planned(folder):
    from pyspark.sql.datasource import EqualTo, IsNotNull

    reader = layout_source.LayoutReader({"path": folder})
    odd = IsNotNull(("text",))
    assert list(reader.pushFilters([EqualTo(("page_no",), 7), IsNotNull(("page_no",)), odd])) == [odd]
    assert sorted(p.path.rpartition("/")[2] for s in reader.partitions() for p in s.pieces) == ["layout.json", "layout.json", "lines.txt"]
    with pytest.raises(FileNotFoundError):
        layout_source.LayoutReader({"path": folder + "/nothing"}).partitions()


PAGE = """<!doctype html><title>T &amp; t</title><style>p{}</style><script>var x = "<p>";</script>
<body><h1>Head <b>bold</b></h1><!-- <p>no</p> --><p>one<p>two <i>in</i>line<br>next</div><ul><li>a<ul><li>b</ul><li>c</ul>
<table><tr><td>x<td>y<tr><td>z</table><pre> k
  l</pre><img alt="pic"><div>tail <b>open"""


@pytest.mark.parametrize("piece", [1, 3, 10, 1 << 16])
def test_items_of_a_page(piece):
    got = [(p, k, t) for _, p, _, k, t in markup.html_items(PAGE, piece)]
    assert got == [
        ("title[1]", "section_header", "T & t"),
        ("body[1]/h1[1]", "section_header", "Head bold"),
        ("body[1]/p[1]", "text", "one"),
        ("body[1]/p[2]", "text", "two inline\nnext"),
        ("body[1]/ul[1]/li[1]", "list_item", "a"),
        ("body[1]/ul[1]/li[1]/ul[1]/li[1]", "list_item", "b"),
        ("body[1]/ul[1]/li[2]", "list_item", "c"),
        ("body[1]/table[1]/tr[1]/td[1]", "table_cell", "x"),
        ("body[1]/table[1]/tr[1]/td[2]", "table_cell", "y"),
        ("body[1]/table[1]/tr[2]/td[1]", "table_cell", "z"),
        ("body[1]/pre[1]", "code", " k\n  l"),
        ("body[1]/img[1]", "picture", "pic"),
        ("body[1]/div[1]", "text", "tail open"),
    ]


@pytest.mark.parametrize("html", ["", None, "<", "<p", "</p></p>", "&am", "plain", "<" * 500, "<div>" * 5000, "<script>a", "</script>x", "<!-- x", "<p/><li></ul>y", "\0<b>\x0b</b>"])
def test_any_string_has_items(html):
    items = list(markup.html_items(html))
    assert [x[0] for x in items] == list(range(len(items)))


def test_pages_become_blocks(spark):
    pages = spark.createDataFrame([(1, PAGE, "x"), (2, None, "x"), (3, "<p>WARNING shock</p>", "x")], "page_id int, html string, text string")
    items = markup.tokenised(pages)
    texts = {r["doc_id"]: r["text"] for r in markup.page_texts(items).collect()}
    assert texts["3"] == "WARNING shock" and texts["1"].startswith("T & t\nHead bold\none") and "2" not in texts
    blocks = build.build_blocks(markup.as_layout(items), LEX).where("block_type <> 'page_context'").orderBy("block_id").collect()
    assert [r["text"] for r in blocks if r["doc_id"] == "1"][:3] == ["T & t", "Head bold", "one"]
    assert [r["block_type"] for r in blocks if r["doc_id"] == "3"] == ["warning"]

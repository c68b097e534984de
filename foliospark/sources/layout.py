"""Items of layout trees: any JSON document, walked in document order.

A tree is one string of one row; the walk keeps its own stack, so depth is no limit, and
rows go through in Arrow batches without a shuffle.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PICTURES = frozenset(("picture", "image", "figure"))
BOXES = ("bbox", "bounding_box", "rect")
CORNERS = (("l", "t", "r", "b"), ("x0", "y0", "x1", "y1"))
CONFIDENCES = ("ocr_confidence", "confidence", "confid")
ITEM = pa.struct([("layout_ref", pa.string()), ("layout_type", pa.string()), ("page_no", pa.int64()), ("text", pa.string()), ("bbox", pa.list_(pa.float64())), ("ocr_confidence", pa.float64())])
ITEM_DDL = "layout_ref string, layout_type string, page_no long, text string, bbox array<double>, ocr_confidence double"


def _sources(node: dict[str, Any]) -> list[dict[str, Any]]:
    found = node.get("prov")
    return [x for x in found if isinstance(x, dict)] if isinstance(found, list) else []


def page_of(node: dict[str, Any]) -> int | None:
    """Its own page number (an index counts from zero), else the first of its sources that isn't zero."""
    own = [int(node[k]) + (k == "page_idx") for k in ("page_no", "page", "page_idx") if isinstance(node.get(k), int)]
    return own[0] if own else next(filter(None, map(page_of, _sources(node))), None)


def box_of(node: dict[str, Any]) -> list[float] | None:
    """The first well-formed box of the node or one of its sources."""
    for value in (x.get(k) for x in (node, *_sources(node)) for k in BOXES):
        shapes = [value] if isinstance(value, list) and len(value) == 4 else [[value.get(c) for c in names] for names in CORNERS] if isinstance(value, dict) else []
        for shape in shapes:
            if all(isinstance(v, int | float) for v in shape):
                return list(map(float, shape))
    return None


def _number(value: Any) -> float | None:
    try:
        out = float(value)
    except (TypeError, ValueError):
        return None
    return None if math.isnan(out) else out


def confidence_of(node: dict[str, Any]) -> float | None:
    """Its own confidence, else the mean of its sources'."""
    own = [v for v in (_number(node.get(k)) for k in CONFIDENCES) if v is not None]
    if own:
        return own[0]
    below = [v for v in map(confidence_of, _sources(node)) if v is not None]
    return sum(below) / len(below) if below else None


def items(tree: Any, tables: bool = True) -> Iterator[dict[str, Any]]:
    """Nodes with a text that isn't blank, and pictures; a node without a page has that of its ancestor. Without tables, what lies below one is left out."""
    stack: list[tuple[Any, str, int | None]] = [(tree, "$", None)]
    while stack:
        node, path, page = stack.pop()
        if isinstance(node, dict):
            page = page_of(node) or page
            label = next((node[k] for k in ("label", "type", "name") if node.get(k)), None)
            text = next((node[k] for k in ("text", "orig", "content") if node.get(k)), None)
            text = text.strip() if isinstance(text, str) else ""
            if text or str(label).lower() in PICTURES:
                yield {"layout_ref": path, "layout_type": str(label or "text"), "page_no": page, "text": text, "bbox": box_of(node), "ocr_confidence": confidence_of(node)}
            below = [(v, f"{path}.{k}", page) for k, v in node.items()] if tables or str(label).lower() != "table" else []
        else:
            below = [(v, f"{path}[{i}]", page) for i, v in enumerate(node)] if isinstance(node, list) else []
        stack.extend(x for x in reversed(below) if isinstance(x[0], dict | list))


def layout_items(df: DataFrame, id_col: str = "doc_id", layout_col: str = "layout") -> DataFrame:
    """doc_id, item_no (document order, from 0) and the item's columns. A null layout has none; malformed JSON is an error."""
    schema = pa.schema([("doc_id", pa.string()), ("items", pa.list_(ITEM))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch["layout"][i].as_py()
                found = [] if raw is None else list(items(json.loads(raw)))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, 1), pa.array([found], pa.list_(ITEM))], schema=schema)

    rows = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(layout_col).alias("layout")).mapInArrow(run, f"doc_id string, items array<struct<{ITEM_DDL.replace(' ', ':').replace(',:', ', ')}>>")
    return rows.select("doc_id", F.posexplode("items").alias("item_no", "x")).select("doc_id", "item_no", "x.*")

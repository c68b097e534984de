"""External services behind protocols: page reading, embedding.

A client is built once a task by a factory (so it needn't be pickled), gets Arrow batches,
and nothing passes through the driver. Offline, pass a deterministic one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class PageReader(Protocol):
    def read(self, image_url: str) -> str: ...


class Embedder(Protocol):
    def many(self, texts: list[str]) -> list[list[float]]: ...
    def one(self, text: str) -> list[float]: ...


def embedded(texts: list[str], client: Embedder) -> list[list[float]]:
    """Vectors in order. A batch that fails is halved until single texts are left; a single failing text is asked for
    alone, and its error is raised."""
    todo, out = [texts], []
    while todo:
        part = todo.pop()
        if not part:
            continue
        try:
            out.extend(list(map(float, v)) for v in client.many(part))
        except Exception:
            if len(part) == 1:
                out.append(list(map(float, client.one(part[0]))))
            else:
                half = len(part) // 2
                todo += [part[half:], part[:half]]
    return out


def embed(df: DataFrame, factory: Callable[[], Embedder], id_col: str = "id", text_col: str = "text", batch: int = 32) -> DataFrame:
    """id, embedding of every row; a null text is embedded as the empty one."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = factory()
        for rows in batches:
            for i in range(0, rows.num_rows, batch):
                part = rows.slice(i, batch)
                vectors = embedded([t or "" for t in part["text"].to_pylist()], client)
                yield pa.RecordBatch.from_arrays([part["id"], pa.array(vectors, pa.list_(pa.float64()))], names=["id", "embedding"])

    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, embedding array<double>")


def read_pages(pages: DataFrame, known: DataFrame, factory: Callable[[], PageReader], force: bool = False) -> DataFrame:
    """doc_id, page_no, ocr_text: pages (doc_id, page_no, image_url) are read unless they are known, or always with
    `force`; known rows with a page number stay unless read anew. One row a page."""
    keys = ["doc_id", "page_no"]
    known = known.select(*keys, "ocr_text").where("page_no > 0").dropDuplicates(keys)
    asked = pages.select(*keys, "image_url").dropDuplicates(keys)
    todo = asked if force else asked.join(known, keys, "left_anti")
    types = {f.name: f.dataType.simpleString() for f in asked.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = factory()
        for rows in batches:
            for i in range(rows.num_rows):
                text = (client.read(rows["image_url"][i].as_py()) or "").strip()
                yield pa.RecordBatch.from_arrays([rows["doc_id"].slice(i, 1), rows["page_no"].slice(i, 1), pa.array([text], pa.string())], names=[*keys, "ocr_text"])

    fresh = todo.mapInArrow(run, f"doc_id {types['doc_id']}, page_no {types['page_no']}, ocr_text string")
    kept = known.join(asked, keys, "left_anti") if force else known
    return kept.unionByName(fresh)

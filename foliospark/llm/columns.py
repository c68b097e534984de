"""What every corpus operator shares: it reads only the columns it is told to,
under private names, so other columns of the input (whatever their names) never
reach it and can't clash with what it returns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_CHARS = 2_000_000


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids are integers, also as text; a text that isn't one is an error of the cast under ANSI rules and null without them."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def portions(texts: list[str | None], chars: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of a batch with about so many characters each, one text at least."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to] or "") <= chars):
            size += len(texts[to] or "")
            to += 1
        yield at, to
        at = to


def keep_rows(df: DataFrame, keep: Callable[[list[str | None]], list[bool]], text_col: str = "text") -> DataFrame:
    """The rows of df, all columns as they are, whose text `keep` accepts; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            for a, b in portions(texts):
                yield batch.slice(a, b - a).filter(pa.array(keep(texts[a:b]), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def private(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has, whatever its case."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out

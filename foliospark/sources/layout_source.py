"""Layout files as a data source: spark.read.format("layout").load(folder).

A folder holds trees as `.json` (one tree a file, of the document that its folder names) and as lines of `.jsonl` or `.txt` files
({"doc_id": ..., "layout": tree}). A folder `page_0007` or `page_no=7` on the way means that all below it is that page, whatever the trees say,
as when single pages are parsed again. Files are read in whole or, by lines, in ranges of bytes; small files share a task.

Filters on page_no and doc_id are taken over: files and folders of other pages aren't opened, other items are not
handed to Spark. Options: `tables` (true: also what lies below a table), `ocr` (true: also texts with a recognition's confidence),
`split_bytes` (of a task's share, 32 MB). A path that Spark but not pyarrow can open is an error. Files whose names begin with . or _ are
passed over; an empty folder has no rows; a line that isn't JSON is an error; blank lines are none.
"""

from __future__ import annotations

import io
import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from foliospark.sources.layout import ITEM, ITEM_DDL, PICTURES, items

LINES = (".jsonl", ".txt")
SPLIT = 32 << 20
_PAGE = re.compile(r"(?:^|/)page_(?:no=)?(\d+)(?=/)")
SCHEMA = pa.schema([("doc_id", pa.string()), ("item_no", pa.int32()), *ITEM])


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URL, and the path in it."""
    return pafs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:", path) else (pafs.LocalFileSystem(), os.path.abspath(path))


@dataclass
class Piece:
    """A file, or the lines that begin in a range of its bytes."""

    path: str
    start: int
    end: int
    page: int | None


class Share(InputPartition):
    def __init__(self, pieces: list[Piece]):
        super().__init__(None)
        self.pieces = pieces


@dataclass
class Wanted:
    """What the filters that were taken over ask of a column: all tests are a conjunction."""

    tests: dict[str, list[tuple[str, Any]]] = field(default_factory=dict)

    OPS: dict[type, tuple[str, Callable[[Any, Any], bool]]] = field(default_factory=lambda: {
        EqualTo: ("=", lambda x, y: x == y),
        GreaterThan: (">", lambda x, y: x > y),
        GreaterThanOrEqual: (">=", lambda x, y: x >= y),
        LessThan: ("<", lambda x, y: x < y),
        LessThanOrEqual: ("<=", lambda x, y: x <= y),
        In: ("in", lambda x, y: x in y),
        IsNotNull: ("not null", lambda x, y: True),
    }, repr=False)

    def take(self, f: Filter) -> bool:
        column = getattr(f, "attribute", ())
        if column not in (("page_no",), ("doc_id",)) or type(f) not in self.OPS or isinstance(f, EqualNullSafe):
            return False
        self.tests.setdefault(column[0], []).append((self.OPS[type(f)][0], getattr(f, "value", None)))
        return True

    def holds(self, column: str, value: Any) -> bool:
        """As SQL has it: a null passes no test."""
        tests = self.tests.get(column, [])
        by = dict(self.OPS.values())
        return all(value is not None and (v is not None or op == "not null") and by[op](value, v) for op, v in tests)


class LayoutReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        if "path" not in options:
            raise ValueError("a layout source needs a path")
        self.path, self.tables, self.ocr = options["path"], options.get("tables", "true").lower() == "true", options.get("ocr", "true").lower() == "true"
        self.split = int(options.get("split_bytes", SPLIT))
        self.wanted = Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if not self.wanted.take(f):
                yield f

    def files(self) -> Iterator[tuple[str, int, int | None]]:
        """Path, size and page (by the folders) of the files that may hold what is asked for."""
        fs, top = opened(self.path)
        info = fs.get_file_info(top)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        folders, found = ([top], []) if info.type == pafs.FileType.Directory else ([], [info])
        while folders:
            # Folders of other pages aren't even listed.
            for x in fs.get_file_info(pafs.FileSelector(folders.pop())):
                if x.base_name[0] in "._":
                    continue
                if x.type != pafs.FileType.Directory:
                    found.append(x)
                elif (page := page_in(x.path[len(top) :] + "/")) is None or self.wanted.holds("page_no", page):
                    folders.append(x.path)
        for x in sorted(found, key=lambda x: x.path):
            if x.base_name.endswith((".json", *LINES)):
                yield x.path, x.size, page_in(x.path[len(top) :])

    def partitions(self) -> Sequence[InputPartition]:
        out: list[list[Piece]] = [[]]
        room = self.split
        for path, size, page in self.files():
            if path.endswith(LINES):
                pieces = [Piece(path, a, min(size, a + self.split), page) for a in range(0, size, self.split)]
            else:
                name = _document(path)
                pieces = [Piece(path, 0, size, page)] if self.wanted.holds("doc_id", name) else []
            for p in pieces:
                if p.end - p.start > room and out[-1]:
                    out.append([])
                    room = self.split
                out[-1].append(p)
                room -= p.end - p.start
        return [Share(p) for p in out]

    def trees(self, piece: Piece) -> Iterator[tuple[str, Any]]:
        fs, _ = opened(self.path)
        if not piece.path.endswith(LINES):
            with fs.open_input_stream(piece.path) as f:
                yield _document(piece.path), json.loads(f.read())
            return
        with io.BufferedReader(fs.open_input_file(piece.path), 1 << 20) as f:
            # A line belongs to the range in which it begins.
            at = piece.start
            if at:
                f.seek(at - 1)
                at += len(f.readline()) - 1
            else:
                f.seek(0)
            while at < piece.end:
                line = f.readline()
                if not line:
                    return
                at += len(line)
                if line.strip():
                    row = json.loads(line)
                    yield str(row["doc_id"]), row.get("layout")

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for piece in partition.pieces:
            for doc, tree in self.trees(piece):
                if tree is None or not self.wanted.holds("doc_id", doc):
                    continue
                tree = json.loads(tree) if isinstance(tree, str) else tree
                rows = [{"doc_id": doc, "item_no": n} | x | ({} if piece.page is None else {"page_no": piece.page}) for n, x in enumerate(items(tree, self.tables))]
                rows = [r for r in rows if self.wanted.holds("page_no", r["page_no"]) and (self.ocr or r["ocr_confidence"] is None or r["layout_type"].lower() in PICTURES)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, SCHEMA)


def page_in(path: str) -> int | None:
    found = _PAGE.findall(path)
    return int(found[-1]) if found else None


def _document(path: str) -> str:
    """The folder that names the document of a `.json` file: the last one that isn't a page's."""
    parts = [p for p in path.split("/")[:-1] if p and not _PAGE.match(f"/{p}/")]
    return parts[-1] if parts else ""


class LayoutSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "layout"

    def schema(self) -> str:
        return f"doc_id string, item_no int, {ITEM_DDL}"

    def reader(self, schema: Any) -> DataSourceReader:
        return LayoutReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Makes the format known to a session and lets filters reach it."""
    spark.dataSource.register(LayoutSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")

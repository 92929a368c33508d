"""Landed pages as a Spark data source, batch and stream, addressed by offset.

    register_page_source(spark)
    spark.read.format("ward_pages").option("max_rows", 5000).load(path)
    spark.readStream.format("ward_pages").load(path)

The source lists the folders `first=<offset>/end=<offset>` that
`sources.pages.land_pages` writes. A folder is a partition of the read; those
beyond the cap, or before the offset that a stream has committed, are not
opened. Pages are parsed by pyarrow and handed over as Arrow batches. The
stream's position is a page offset, so a run that starts again with its
checkpoint goes on where the last one ended.

Files are read through `pyarrow.fs`, which knows local paths, s3, gs and hdfs.
For other stores use `sources.pages.read_pages` or `streaming.ingest`, which
go through Spark's own readers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import pyarrow.fs as pafs
import pyarrow.json as pajson
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, GreaterThanOrEqual, InputPartition, LessThan,
)

from wardstat.schemas import RAW_FIELDS

NAME = "ward_pages"
#: rows of an Arrow batch; a page is 500
BATCH_ROWS = 10_000
_FOLDER = re.compile(r"first=(\d+)/end=(\d+)$")
_ROW = pa.struct([(c, pa.string()) for c in RAW_FIELDS])
_PAGE = pa.schema([("offset", pa.int64()), ("results", pa.list_(_ROW))])
_OUT = pa.schema([("offset", pa.int64()), *[(c, pa.string()) for c in RAW_FIELDS]])


class PageFolder(InputPartition):
    """The pages of one folder with `low <= offset < high`."""

    def __init__(self, path: str, low: int, high: int):
        self.path, self.low, self.high = path, low, high


def list_folders(path: str) -> list[tuple[int, int, str]]:
    """(first, end, folder) of the landed folders, by offset. Names only: no page is read."""
    fs, root = pafs.FileSystem.from_uri(path)
    firsts = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    out = []
    for parent in firsts:
        if parent.type == pafs.FileType.Directory and parent.base_name.startswith("first="):
            for child in fs.get_file_info(pafs.FileSelector(parent.path)):
                found = _FOLDER.search(child.path)
                if found:
                    out.append((int(found[1]), int(found[2]), child.path))
    return sorted(out)


def folders_between(path: str, low: int, high: int | None) -> list[PageFolder]:
    """One partition per folder that can hold a page of `low <= offset < high`."""
    return [PageFolder(f, low, end if high is None else min(high, end)) for first, end, f in list_folders(path)
            if end > low and (high is None or first < high)]


def _documents(lines) -> Iterator[pa.Table]:
    """Parse JSON lines in blocks of whole lines; a block that holds one long page grows with it."""
    block = 16 << 20
    held = b""
    while True:
        chunk = lines.read(block)
        held += chunk
        cut = held.rfind(b"\n") + 1 if chunk else len(held)
        if cut and held[:cut].strip():
            size = max(cut + 1, 1 << 16)
            yield pajson.read_json(pa.BufferReader(held[:cut]), pajson.ReadOptions(block_size=size),
                                   pajson.ParseOptions(explicit_schema=_PAGE, unexpected_field_behavior="ignore"))
        held = held[cut:]
        if not chunk:
            return


def read_folder(root: str, folder: PageFolder) -> Iterator[pa.RecordBatch]:
    """Rows of the folder's pages with their page's offset, as Arrow batches."""
    fs, _ = pafs.FileSystem.from_uri(root)
    for info in sorted(fs.get_file_info(pafs.FileSelector(folder.path)), key=lambda i: i.path):
        if info.type != pafs.FileType.File or info.base_name.startswith(("_", ".")):
            continue
        with fs.open_input_stream(info.path) as lines:
            for pages in _documents(lines):
                yield from _explode(pages, folder.low, folder.high)


def _explode(pages: pa.Table, low: int, high: int) -> Iterator[pa.RecordBatch]:
    for batch in pages.select(["offset", "results"]).to_batches():
        offset = batch.column("offset")
        batch = batch.filter(pa.compute.and_(pa.compute.greater_equal(offset, low), pa.compute.less(offset, high)))
        rows = batch.column("results").flatten()
        page = batch.column("offset").take(pa.compute.list_parent_indices(batch.column("results")))
        table = pa.Table.from_arrays([page, *rows.flatten()], schema=_OUT)
        yield from table.to_batches(max_chunksize=BATCH_ROWS)


class PageReader(DataSourceReader):
    """Batch read of the folders below the cap."""

    def __init__(self, path: str, max_rows: int | None):
        self.path, self.low, self.high = path, 0, max_rows

    def partitions(self):
        # a reader without partitions would be asked for one: an empty range stands for it
        return folders_between(self.path, self.low, self.high) or [PageFolder("", 0, 0)]

    def read(self, partition):
        return read_folder(self.path, partition) if partition.path else iter(())


class PushingPageReader(PageReader):
    """Batch read whose folders are also chosen by comparisons of `offset`."""

    def pushFilters(self, filters):
        """`offset < n` and `offset >= n` choose the folders; Spark applies the rest."""
        for f in filters:
            if isinstance(f, LessThan) and f.attribute == ("offset",):
                self.high = f.value if self.high is None else min(self.high, f.value)
            elif isinstance(f, GreaterThanOrEqual) and f.attribute == ("offset",):
                self.low = max(self.low, f.value)
            else:
                yield f


class PageStreamReader(DataSourceStreamReader):
    """Micro-batches between page offsets; a stream never goes back."""

    def __init__(self, path: str, max_rows: int | None):
        self.path, self.max_rows = path, max_rows

    def initialOffset(self):
        return {"offset": 0}

    def latestOffset(self):
        end = max([end for _, end, _ in list_folders(self.path)], default=0)
        return {"offset": end if self.max_rows is None else min(end, self.max_rows)}

    def partitions(self, start, end):
        return folders_between(self.path, int(start["offset"]), int(end["offset"]))

    def read(self, partition):
        return read_folder(self.path, partition)


class PageSource(DataSource):
    """Options: `path`; `max_rows` (whole pages whose offset is below it);
    `push_filters` (true: comparisons of `offset` choose the folders, which
    needs a session with spark.sql.python.filterPushdown.enabled)."""

    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return ", ".join(["offset long", *[f"{c} string" for c in RAW_FIELDS]])

    def _given(self) -> tuple[str, int | None]:
        if "path" not in self.options:
            raise ValueError("ward_pages needs a path")
        cap = self.options.get("max_rows")
        if cap is not None and int(cap) < 0:
            raise ValueError("max_rows must not be negative")
        return self.options["path"], None if cap is None else int(cap)

    def reader(self, schema):
        pushing = self.options.get("push_filters", "false").lower() == "true"
        return (PushingPageReader if pushing else PageReader)(*self._given())

    def streamReader(self, schema):
        return PageStreamReader(*self._given())


def register_page_source(spark: SparkSession) -> str:
    """Make the source known to the session; returns its name."""
    spark.dataSource.register(PageSource)
    return NAME

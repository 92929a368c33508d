"""Paged JSON landing: provider pages -> raw long rows.

A page payload is `{"offset": o, "count": total, "results": [row, ...]}`
with at most PAGE_SIZE rows. Pages are stored one JSON document per line
(splittable; `multi_line=True` reads one pretty-printed document per file
instead). Reading is a schema-declared JSON scan and an `explode`. Pages say
every field's name in every row, so a `codec` makes them many times smaller;
such a file is read by one task, and holds no more than its folder.

Landed pages lie in folders `first=<offset>/end=<offset>` of consecutive
pages, so a cap on the rows leaves out whole folders by their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.schemas import PAGE_SCHEMA, PAGE_SIZE, RAW_FIELDS, RAW_SCHEMA
from wardstat.session import delete_path, move_children, path_exists, replace_path, scratch_dir

#: rows of a folder of pages; beyond MAX_FOLDERS folders each holds more
FOLDER_ROWS, MAX_FOLDERS = 1_000_000, 10_000
RUN_SCHEMA = T.StructType([T.StructField("at", T.LongType()), T.StructField("results", T.ArrayType(RAW_SCHEMA))])


def ordered_rows(rows: DataFrame, order_by: list[str]) -> DataFrame:
    """Store the rows in `order_by` order; they come back with their ordinal `at`, from 0.

    One shuffle: rows are dealt by ranges of the order columns (ties, and so a
    hot key, by the row's hash), sorted in their partition and written with
    their place in it. The places of a partition start after all rows of the
    partitions before; that table has one row a partition and is broadcast.
    """
    # the hash is a column of its own: as a sort expression over many equal
    # literals (absent fields) Catalyst would try every alias of each
    order = [*order_by, "tie"]
    path = scratch_dir(rows.sparkSession, "ordered")
    (rows.withColumn("tie", F.xxhash64(*RAW_FIELDS)).repartitionByRange(*order).sortWithinPartitions(*order)
     .select(*RAW_FIELDS, F.spark_partition_id().alias("part"),
             F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
     .write.parquet(path))
    stored = rows.sparkSession.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (stored.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
              .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    return stored.join(F.broadcast(starts), "part").select((F.col("start") + F.col("place")).alias("at"), *RAW_FIELDS)


def _cut(page_size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in order -> one row (at, results) per run of rows of one page.

    A run ends where its page ends or the ordinals jump. The open run at the
    end of a batch is carried into the next, so a task holds one batch and
    less than a page besides.
    """
    def pack(batch: pa.RecordBatch, at: np.ndarray, edges: np.ndarray) -> pa.RecordBatch:
        rows = pa.StructArray.from_arrays([batch.column(c) for c in RAW_FIELDS], names=RAW_FIELDS)
        return pa.record_batch([pa.array(at[edges[:-1]]), pa.ListArray.from_arrays(edges.astype("int32"), rows)],
                               names=["at", "results"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if carry is not None:
                batch = pa.Table.from_batches([carry, batch]).combine_chunks().to_batches()[0]
            at = batch.column("at").to_numpy()
            turns = np.flatnonzero((np.diff(at) != 1) | (at[1:] % page_size == 0)) + 1
            edges = np.concatenate([[0], turns, [len(at)]])
            carry = None
            if (at[-1] + 1) % page_size:  # the last run may go on
                carry, edges = batch.slice(int(edges[-2])), edges[:-1]
            if len(edges) > 1:
                yield pack(batch, at, edges)
        if carry is not None:
            yield pack(carry, carry.column("at").to_numpy(), np.array([0, carry.num_rows]))

    return runs


def _mended(runs: DataFrame, page_size: int) -> DataFrame:
    """Runs (at, results) put together by page: offset, results."""
    offset = F.col("at") - F.pmod("at", F.lit(page_size))
    return (runs.groupBy(offset.alias("offset")).agg(F.collect_list(F.struct("at", "results")).alias("runs"))
            .select("offset", F.flatten(F.transform(F.array_sort("runs"), lambda r: r["results"])).alias("results")))


def land_pages(rows: DataFrame, out_dir: str, order_by: list[str], page_size: int = PAGE_SIZE,
               folder_rows: int = FOLDER_ROWS, start: int = 0, codec: str | None = None) -> str:
    """Write page payloads as JSON lines below `out_dir`, compressed by `codec`
    (as Spark's JSON writer names it, "gzip" say) if there is one. With `start` (a
    multiple of the page size) the pages are added after those that are there;
    without, they replace them.

    Whole pages go from the task that reads their rows straight to their file.
    Only pages that two tasks share are grouped: at most two a file of ordered
    rows. The pages become visible folder by folder, when all are written.
    """
    spark = rows.sparkSession
    ordered = ordered_rows(rows, order_by)
    total = ordered.count()
    folder_rows = max(folder_rows, -(-total // MAX_FOLDERS))
    folder_rows = -(-folder_rows // page_size) * page_size
    staged = f"{out_dir.rstrip('/')}-landing"

    def write(pages: DataFrame, whole, mode: str) -> None:
        first = F.col("offset") - F.pmod("offset", F.lit(folder_rows))
        end = F.least(first + folder_rows, F.lit(total))
        (pages.select((F.col("offset") + start).alias("offset"), F.lit(total + start).cast("long").alias("count"), "results",
                      F.when(whole, first + start).otherwise(-1).alias("first"),
                      F.when(whole, end + start).otherwise(-1).alias("end"))
         .write.mode(mode).partitionBy("first", "end").json(staged, compression=codec))

    runs = ordered.mapInArrow(_cut(page_size), RUN_SCHEMA).withColumnRenamed("at", "offset")
    size = F.size("results")
    write(runs, (F.pmod("offset", F.lit(page_size)) == 0) & ((size == page_size) | (F.col("offset") + size == total)),
          "overwrite")
    shared = f"{staged}/first=-1"
    if path_exists(spark, shared):
        parts = spark.read.schema(PAGE_SCHEMA).json(f"{shared}/end=-1")
        write(_mended(parts.select((F.col("offset") - start).alias("at"), "results"), page_size), F.lit(True), "append")
        delete_path(spark, shared)
    if start:
        move_children(spark, staged, out_dir, "first=")
        delete_path(spark, staged)
    else:
        replace_path(spark, staged, out_dir)
    return out_dir


def read_pages(spark: SparkSession, path: str, max_rows: int | None = None,
               multi_line: bool = False) -> DataFrame:
    """Page payloads -> raw rows (all strings).

    `max_rows` caps by whole page, as the provider loop does: every page
    whose offset is below the cap is kept, so up to a page more than the
    cap can come back. Folders of landed pages beyond the cap are not opened
    (a partition filter); within one, the cap is a filter on the page offset,
    evaluated before the explode.
    """
    pages = spark.read.schema(PAGE_SCHEMA).option("multiLine", multi_line).json(path)
    return page_rows(pages, max_rows)


def page_rows(pages: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Stream (or batch) of page payloads -> raw rows; the optional cap
    keeps whole pages whose offset is below it."""
    if max_rows is not None:
        pages = pages.filter(F.col("offset") < F.lit(int(max_rows)))
        if "first" in pages.columns:
            pages = pages.filter(F.col("first") < F.lit(int(max_rows)))
    return pages.select(F.explode("results").alias("r")).select(*[F.col(f"r.{c}") for c in RAW_FIELDS])


def append_rows(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side comes back as NULL."""
    if existing is None:
        return new
    return existing.unionByName(new, allowMissingColumns=True)

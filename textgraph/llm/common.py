"""Shared storage, Arrow plumbing and distributed connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgraph.functions.text import let

#: Rows and bytes of one Arrow batch: what a worker holds of it, index arrays included, is a fixed multiple of these bytes.
BATCH_ROWS, BATCH_BYTES = 8192, 2 << 20
#: Rows and bytes that may be broadcast.
SMALL_ROWS, SMALL_BYTES = 300_000, 24 << 20
#: Shuffled bytes of a partition, as they lie compressed, up to which a hash table of it is made for a join.
HASHED_BYTES = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.  Where that is unset, a folder of our own in local mode; on a
    cluster each executor would write to its own disk, so there it has to be set."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="textgraph-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/textgraph/{kind}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession, now: bool = True):
    """Within this, Spark deletes the shuffle files of a query when the query ends, and does not wait until the driver has
    collected what refers to them: that comes late, mostly by one more stored table."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    if now:
        spark.conf.set(key, "true")
    try:
        yield
    finally:
        if now:
            spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def stored(df: DataFrame, kind: str = "table", release: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors.
    release: delete the shuffle files behind it at once, and let the driver collect garbage, which frees those of counts."""
    spark = df.sparkSession
    path = new_folder(spark, kind)
    with shuffles_deleted(spark, release):
        df.write.parquet(path, compression="zstd")
    if release:
        gc.collect()
        spark._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Delete tables that stored() wrote and nothing needs any more."""
    for df in frames:
        if path := getattr(df, "_stored_at", None):
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


Store = Callable[..., DataFrame]


@contextlib.contextmanager
def hashed_joins(spark: SparkSession):
    """Within this, adaptive execution joins by hashes, without sorts, where each partition of one side turns out to be at most
    HASHED_BYTES; larger ones are sorted, as ever."""
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(HASHED_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


class Scratch:
    """stored(), without the shuffle files behind it, and with all tables remembered until they are dropped together."""

    def __init__(self):
        self.tables: list[DataFrame] = []

    def __call__(self, df: DataFrame, kind: str = "table", release: bool = False) -> DataFrame:
        with shuffles_deleted(df.sparkSession), hashed_joins(df.sparkSession):
            self.tables.append(stored(df, kind, release))
        return self.tables[-1]

    def drop(self) -> None:
        dropped(*self.tables)
        self.tables.clear()


def _bytes(column: str, kind: T.DataType):
    """About how many bytes a value takes in memory."""
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return F.aggregate(F.coalesce(column, F.array().cast(kind)), F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x) + 24) + 16
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.size(column), F.lit(0)) * 8 + 16
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    return F.lit(8)


def is_small(df: DataFrame, copies: int = 1) -> bool:
    """Whether the counted rows of a table, and their bytes, stay below the bounds of a broadcast.  Arrays hold plain numbers or strings."""
    size = sum((_bytes(f"`{f.name}`", f.dataType) for f in df.schema.fields), F.lit(0)).cast("long")
    rows, total = df.select(size.alias("size")).limit(SMALL_ROWS + 1).agg(F.count("*"), F.sum("size")).first()
    return rows <= SMALL_ROWS and (total or 0) * copies <= SMALL_BYTES


def small(df: DataFrame) -> DataFrame:
    """Marked for broadcast where its counted rows and bytes stay below the bounds."""
    return F.broadcast(df) if is_small(df) else df


def batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> None:
    """Keep the Arrow batches of this session at no more than so many rows and bytes (a single row may be longer)."""
    for key, value in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(key, None) != str(value):
            spark.conf.set(key, str(value))


def ship_file(spark: SparkSession, path: str) -> str:
    """Send a small file of the driver's (a vocabulary) to all workers; its name, by which they find it."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def local_file(name: str) -> str:
    """Where a worker has a file that was shipped."""
    return SparkFiles.get(name)


#: Of Spark's runtime filters: from how many bytes of the filtered side on they pay; the size of a filter is bounded by Spark.
FILTERED_BYTES = 64 << 20


@contextlib.contextmanager
def filtered_joins(spark: SparkSession):
    """Within this, a join whose one side holds few of the other's keys sends a Bloom filter of them (at most 8 MB, whatever the
    input) to the other side's scan, so that rows without a partner are not shuffled.  Spark does so by itself beyond 10 GB."""
    prefix, old = "spark.sql.optimizer.runtime.bloomFilter", {}
    for key, value in {"enabled": "true", "applicationSideScanSizeThreshold": str(FILTERED_BYTES), "creationSideThreshold": str(1 << 40)}.items():
        old[key] = spark.conf.get(f"{prefix}.{key}", None)
        spark.conf.set(f"{prefix}.{key}", value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(f"{prefix}.{key}") if value is None else spark.conf.set(f"{prefix}.{key}", value)


Batches = Iterator[pa.RecordBatch]


def tidy(f: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """f, which at the end of its task gives back to the system what memory it used: workers are kept for further tasks."""

    def run(rows: Batches) -> Batches:
        yield from f(rows)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another system's library
            pass

    return run


def map_arrow(df: DataFrame, f: Callable[[Batches], Batches], schema) -> DataFrame:
    batches(df.sparkSession)
    return df.mapInArrow(tidy(f), schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of a string column: all bytes, and each row's limits in them (null: no bytes)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    limits = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[limits[0] : limits[-1]], limits - limits[0]


def run_starts(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]]))


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def without(items: Column, places: Column) -> Column:
    """An array without the items at some places: what lies between two of them is taken by number, so the time is linear."""

    def between(own: Column, at: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(at) - 1), lambda j: F.struct((F.get(at, j - 1) + 1).alias("a"), (F.get(at, j) - 1).alias("z")))
        runs = F.filter(runs, lambda r: r["a"] <= r["z"])
        return F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(r["a"], r["z"]), lambda k: F.get(own, k))))

    limits = lambda own: F.concat(F.array(F.lit(-1)), F.array_sort(places), F.array(F.size(own)))
    return let(items, lambda own: let(limits(own), lambda at: between(own, at)))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, row): row holds the columns of docs, text no nulls, and ids are unique and in order.  Other ids than
    the table's own are made only where those are null or not unique; they follow id and text, nulls first."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"), row)
    counts = rows.groupBy("id").agg(F.count("*").alias("n"))
    if counts.where("n > 1 or id is null").limit(1).count() == 0:
        return rows
    ordered = rows.repartitionByRange(partitions(docs.sparkSession), "id", "text").sortWithinPartitions("id", "text")
    return stored(ordered.withColumn("id", F.monotonically_increasing_id()), "keyed")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over links (a, b) of integers: each node and the smallest node of its component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)].copy(), ends[len(a) :].copy()
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        high = np.maximum(root[left], root[right])
        if (open_ := low != high).sum() == 0:
            return nodes, nodes[root]
        np.minimum.at(root, high[open_], low[open_])
        while not np.array_equal(up := root[root], root):
            root = up


def contract(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace each run of links by stars on their local components' smallest nodes."""
    for batch in rows:
        if batch.num_rows:
            node, root = local_roots(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False))
            keep = node != root
            yield pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(root[keep])], ["a", "b"])


def contracted(edges: DataFrame) -> DataFrame:
    """Links as (a, b) with b < a: batches of links become spanning stars, in bounded memory."""
    return map_arrow(edges, contract, "a long, b long")


def components(edges: DataFrame, rounds: int = 60, forests: bool = False, store: Store = stored) -> DataFrame:
    """Distributed union-find.  edges: a long, b long, none null.  Gives (node, component): the smallest node
    that each node reaches; nodes without links don't appear.  forests: the links are contracted batch by batch already.

    Alternates large-star and small-star steps with local contraction of each batch.  Every step is a join and an
    aggregation on the node; sums and minima are pre-aggregated, and a hot node's rows can be split by adaptive
    skew handling.  Tables in the shared folder cut the lineage.  No links reach the driver, only counts.
    """
    edges = edges.select("a", "b").where("a <> b")
    edges = store((edges if forests else contracted(edges)).distinct(), "links", release=True)
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: larger neighbours go to the smallest known node
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: smaller neighbours, and the node itself, go to the smallest of them
        least_ = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least_, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b")
        after = store(small.distinct(), "links")
        # a forest of stars: no node is both an end and a centre, and every end has one centre
        ends = after.groupBy("a").agg(F.count("*").alias("n"))
        open_ = ends.where("n > 1").limit(1).count() or after.select("b").join(ends.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
        dropped(edges)
        edges = after
        if not open_:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
    raise RuntimeError("components did not settle")

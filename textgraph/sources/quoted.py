"""Quoted CSV by ranges: fields may hold line feeds, and still no task reads more than its part of a file.

Spark splits the file at line feeds, some of which lie in quoted fields.  Whether a line begins in one depends on the line before:
each line maps the state at its start to that at its end, and it does so in one of four ways (keep, swap, always outside, always
inside).  Such maps are composed by running sums, of the swaps since the last line that fixes the state; first over ranges, a row
each, then within them.  Lines that begin inside join the record before them, and records are parsed by themselves.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Keep = Callable[[DataFrame, str], DataFrame]


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends in a quoted field, if it begins in one or not.  Only a quote at a field's start opens one."""
    at, n = 0, len(line)
    while True:
        if inside:
            at = line.find('"', at)
            while at >= 0 and line.startswith('""', at):
                at = line.find('"', at + 2)
            if at < 0:
                return True
            inside, at = False, at + 1
        else:
            if line.startswith('"', at):
                inside, at = True, at + 1
                continue
        at = line.find(",", at)
        if at < 0 or at + 1 > n:
            return False
        at += 1


def _fields(record: str) -> list[str]:
    """One record's fields; its line feeds are in quotes."""
    return next(csv.reader(io.StringIO(record, newline="")), [])


def _mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = batch.column(2).to_pylist()
        pairs = [(ends_inside(x, False), ends_inside(x, True)) if '"' in x else (False, True) for x in lines]
        swap = pa.array([int(a and not b) for a, b in pairs], pa.int64())
        fixed = pa.array([int(a) if a == b else None for a, b in pairs], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, swap, fixed], [*batch.schema.names, "swap", "fixed"])


def _state(first: Column, swaps: Column, last: Column) -> Column:
    """The state after so many swaps: since the last line that fixed it, last (swaps, fixed), or since the beginning."""
    return F.when(last.isNull(), (first + swaps) % 2).otherwise((last["fixed"] + swaps - last["swaps"]) % 2)


def records(spark: SparkSession, path: str, keep: Keep) -> DataFrame:
    """(ord, record): a file's records in order, from 0, without empty ones."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("i"), F.col("value").alias("line"))
    lines = keep(lines.mapInArrow(_mapped, "at long, i long, line string, swap long, fixed long"), "lines")
    short = lines.select("at", "i", "swap", "fixed")
    inside = Window.partitionBy("at").orderBy("i")  # numbers alone, of one range
    upto, before = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(Window.unboundedPreceding, -1)
    short = short.withColumn("swaps", F.sum("swap").over(upto))
    mark = F.when(F.col("fixed").isNotNull(), F.struct("swaps", "fixed"))
    short = short.withColumns({"earlier": F.col("swaps") - F.col("swap"), "last": F.last(mark, ignorenulls=True).over(before)})
    ranges = short.groupBy("at").agg(F.sum("swap").alias("swaps"), F.max_by(mark, F.when(F.col("fixed").isNotNull(), F.col("i"))).alias("last"))
    order = Window.orderBy("at")  # a row for each range of the file
    whole = ranges.withColumn("total", F.sum("swaps").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    own = F.when(F.col("last").isNotNull(), F.struct((F.coalesce("total", F.lit(0)) + F.col("last.swaps")).alias("swaps"), F.col("last.fixed").alias("fixed")))
    whole = whole.withColumn("prior", F.last(own, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    whole = whole.select("at", _state(F.lit(0), F.coalesce("total", F.lit(0)), F.col("prior")).alias("entry"))
    opened = short.join(whole, "at").select("at", "i", (_state(F.col("entry"), F.col("earlier"), F.col("last")) == 0).cast("long").alias("begins"))
    opened = keep(opened, "begins")
    counts = opened.groupBy("at").agg(F.sum("begins").alias("n"))
    counts = counts.select("at", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    numbered = opened.join(counts, "at").select("at", "i", (F.col("ahead") + F.sum("begins").over(upto) - 1).alias("ord"))
    parts = F.array_sort(F.collect_list(F.struct("at", "i", "line")))
    found = lines.join(numbered, ["at", "i"]).groupBy("ord").agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("record"))
    record = F.regexp_replace(F.when(F.col("ord") == 0, F.ltrim("record", F.lit("﻿"))).otherwise(F.col("record")), "\r$", "")
    return found.select("ord", record.alias("record")).where("record <> ''")


def read_quoted(spark: SparkSession, path: str, keep: Keep) -> DataFrame:
    """A CSV file's rows, with its own columns as strings and ord; quotes are doubled, a byte order mark is skipped.  Missing
    fields are null, as in the first record's columns; further ones are dropped."""
    found = keep(records(spark, path, keep), "records")
    first = found.orderBy("ord").first()
    if first is None:
        return spark.createDataFrame([], "ord long")
    names = _fields(first.record)
    width = len(names)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_fields(x) for x in batch.column(1).to_pylist()]
            columns = [pa.array([r[k] if k < len(r) else None for r in rows], pa.string()) for k in range(width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["ord", *(f"c{k}" for k in range(width))])

    rows = found.where(F.col("ord") != first.ord).mapInArrow(parse, ", ".join(["ord long", *(f"c{k} string" for k in range(width))]))
    return rows.select(*[F.col(f"c{k}").alias(name) for k, name in enumerate(names)], "ord")

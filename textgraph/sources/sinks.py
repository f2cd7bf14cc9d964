"""Writers: triples, registries, results, audits, resumption state, run folders."""

from __future__ import annotations

import csv
import io
import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRIPLE_COLUMNS = ["subject", "predicate", "object", "evidence", "evidence_count"]


class _Stream(io.RawIOBase):
    """A file of any of Spark's file systems, written from the driver."""

    def __init__(self, out):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.out.write(bytes(data))
        return len(data)

    def close(self) -> None:
        if not self.closed:
            self.out.close()
        super().close()


def opened(spark: SparkSession, path: str, encoding: str = "utf-8", newline: str | None = "") -> io.TextIOWrapper:
    """A text file for writing, in the file system of its path, the default one without a scheme, where Spark's own tables go."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(at, True)
    return io.TextIOWrapper(io.BufferedWriter(_Stream(out), 1 << 20), encoding=encoding, newline=newline)


def run_folder(root: str) -> str:
    return f"{root}/{time.strftime('%Y%m%d_%H%M%S')}"


def write_csv(df: DataFrame, folder: str) -> None:
    """Distributed CSV with a header and doubled quotes."""
    df.write.mode("overwrite").csv(folder, header=True, quote='"', escape='"')


def write_triples_file(df: DataFrame, path: str, columns: list[str] | None = None) -> str | None:
    """One CSV file that begins with a byte order mark, streamed from the driver partition by partition; none if there are no rows."""
    columns = columns or TRIPLE_COLUMNS
    rows = df.select(*columns).toLocalIterator()
    first = next(rows, None)
    if first is None:
        return None
    with opened(df.sparkSession, path, "utf-8-sig") as f:
        out = csv.writer(f)
        out.writerow(columns)
        out.writerow(first)
        out.writerows(rows)
    return local(path)


def write_cleaned(df: DataFrame, path: str, order: str = "ord") -> None:
    """The rows that a cleaner kept, in their order, with their own columns and no byte order mark."""
    columns = [c for c in df.columns if c != order]
    with opened(df.sparkSession, path) as f:
        out = csv.writer(f)
        out.writerow(columns)
        out.writerows(df.orderBy(order).select(*columns).toLocalIterator())


def cleaned_path(path: str) -> str:
    base, end = os.path.splitext(path)
    return f"{base}_cleaned{end}"


def write_registry(sections: DataFrame, folder: str) -> None:
    from textgraph.operators.sections import registry_slim

    registry_slim(sections).write.mode("overwrite").json(folder)


def _item(items: DataFrame) -> DataFrame:
    """Items as JSON, in order; what an item lacks is left out."""
    return items.select("qa_idx", F.to_json(F.struct(*[c for c in items.columns if c != "qa_idx"])).alias("value"))


def write_items(items: DataFrame, folder: str) -> None:
    """An item a line, written by all tasks."""
    _item(items).select("value").write.mode("overwrite").text(folder)


def write_result(items: DataFrame, folder: str, label: str) -> str:
    """One JSON array of a run's items in order, streamed from the driver partition by partition."""
    path = f"{folder}/result_{label.replace(' ', '_')}.json"
    with opened(items.sparkSession, path) as f:
        f.write("[")
        for k, r in enumerate(_item(items).orderBy("qa_idx").toLocalIterator()):
            f.write(("," if k else "") + "\n" + json.dumps(json.loads(r.value), ensure_ascii=False, indent=2))
        f.write("\n]\n")
    return local(path)


def local(path: str) -> str:
    """A path as the driver's own tools have it, where it is on the local disk; any other stays as it is."""
    return path.removeprefix("file://")


def write_by_type(items: DataFrame, folder: str) -> None:
    """One folder for each type and book; those that are written anew replace what was there."""
    items.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("type", "source").json(folder)


def write_audit(low: DataFrame, folder: str) -> None:
    """A line for each piece of evidence of low confidence; nothing is written where there is none."""
    if low.limit(1).count():
        line = F.format_string("Q%d[%d]  conf=%.2f  Evidence: %s", "qa_idx", "ev_idx", "conf", "snippet")
        low.select(line.alias("value")).write.mode("overwrite").text(folder)


def _chunked(rows: DataFrame, path: str, each: int) -> None:
    at = F.monotonically_increasing_id()
    place = F.struct(F.shiftright(at, 33).alias("part"), F.floor(at.bitwiseAND((1 << 33) - 1) / each).alias("chunk"))  # a task's rows from 0
    rows.select("*", place.alias("_at")).select(*rows.columns, "_at.part", "_at.chunk").write.mode("overwrite").partitionBy("part", "chunk").parquet(path, compression="zstd")


def write_chunks(rows: DataFrame, path: str, each: int) -> list[str]:
    """Rows in chunks of at most ``each`` rows, where they lie: no row moves to another task.  The chunks' folders; each has one
    file, so that reading one touches no other."""
    _chunked(rows, path, each)
    found = rows.sparkSession.read.schema("part long, chunk long").parquet(path).distinct().orderBy("part", "chunk")
    return [f"{path}/part={r.part}/chunk={r.chunk}" for r in found.toLocalIterator()]


def write_slices(rows: DataFrame, path: str, each: int, most: int) -> list[list[str]]:
    """Rows in chunks, and these side by side in slices of at most ``most`` rows: a table in many small parts makes no more
    slices than its rows need."""
    _chunked(rows, path, each)
    found = rows.sparkSession.read.schema("part long, chunk long").parquet(path).groupBy("part", "chunk").agg(F.count("*").alias("n"))
    out, taken = [], most
    for r in found.orderBy("part", "chunk").toLocalIterator():
        if taken + r.n > most:
            out.append([])
            taken = 0
        out[-1].append(f"{path}/part={r.part}/chunk={r.chunk}")
        taken += r.n
    return out


def append_done(rows: DataFrame, folder: str, stage: str) -> None:
    """Finished tasks of a stage with their results; a later run leaves them out."""
    rows.write.mode("append").parquet(f"{folder}/stage={stage}", compression="zstd")


def write_report(spark: SparkSession, values: dict, path: str) -> str:
    """The log of a run, a line for each value."""
    with opened(spark, path) as f:
        f.write(report(values))
    return local(path)


def drop_done(spark: SparkSession, folder: str, stage: str) -> None:
    drop(spark, f"{folder}/stage={stage}")


def drop(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def report(values: dict) -> str:
    out = io.StringIO()
    for key, value in values.items():
        out.write(f"{key}: {value}\n")
    return out.getvalue()

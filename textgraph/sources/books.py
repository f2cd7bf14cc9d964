"""Readers: books, triples, resumption state, stdin guides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.functions.text import strip
from textgraph.operators.sections import catalog, title
from textgraph.sources.quoted import read_quoted
from textgraph.sources.workspace import kept, work_folder

SUFFIX = ".cleaned.txt"


def file_name() -> Column:
    """A row's file, decoded: paths come as URLs, in which a plus sign stands for itself."""
    return F.url_decode(F.replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), F.lit("+"), F.lit("%2B")))


def read_books(spark: SparkSession, folder: str) -> DataFrame:
    """(name, text, raw) of the folder's books with content; text is stripped."""
    raw = spark.read.option("pathGlobFilter", f"*{SUFFIX}").text(folder, wholetext=True)
    df = raw.select(file_name().alias("name"), F.col("value").alias("raw"))
    return df.select("name", strip(F.col("raw")).alias("text"), "raw").where(F.length("text") > 0)


def read_book(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_books(spark, folder).where(F.col("name") == name)


def book_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return catalog(read_books(spark, folder).select("name", "text")).orderBy("name")


def book_titles(spark: SparkSession, folder: str) -> DataFrame:
    return read_books(spark, folder).select("name", title(F.col("name"), F.col("raw")).alias("title"))


def read_triples(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    """A CSV of triples with its own columns, read by ranges; ordered: and ord, its records' order."""
    folder = work_folder(spark, "csv")
    rows = read_quoted(spark, path, lambda df, name: kept(df, folder, name))
    return rows if ordered else rows.select(rows.columns[:-1])


def read_done(spark: SparkSession, folder: str, stage: str, schema: str) -> DataFrame:
    """A stage's resumption table; empty where there is none yet."""
    path = f"{folder}/stage={stage}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def triples_guide(lines) -> str:
    """Lines up to the first blank one, as they are: a hint for prompts, not parsed."""
    out = []
    for line in lines:
        if not line.strip():
            break
        out.append(line.rstrip("\n"))
    return "\n".join(out)

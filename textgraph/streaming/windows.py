"""Books as a stream: the row-local window operators on files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.functions.text import strip
from textgraph.operators.sections import windows
from textgraph.sources.books import file_name


def stream_windows(spark: SparkSession, folder: str, aligned: bool = True, files_per_trigger: int = 100) -> DataFrame:
    """Windows of each new *.cleaned.txt file; stateless, so no watermark is needed."""
    raw = spark.readStream.option("wholetext", True).option("pathGlobFilter", "*.cleaned.txt").option("maxFilesPerTrigger", files_per_trigger).text(folder)
    books = raw.select(file_name().alias("book"), strip(F.col("value")).alias("text"))
    return windows(books.where(F.length("text") > 0), aligned)

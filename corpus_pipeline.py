"""The corpus pipeline: quality, fuzzy lines, near-duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.

Defined cases: a null text is scored as an empty one and, if kept, stays null; it has no lines, the fingerprint zero, no
benchmark words and one token, the end.  Of the documents without a word, or of equal texts, near_dedup keeps the one with the
smallest id.  Rows with null or equal ids are documents of their own; where an order of ids counts, they get one in the order
of id (nulls first) and text, and keep the id they came with.  Null lang, source and n_chars pass through; n_chars changes only
where lines were removed.  Extra columns, whatever their names, pass through all stages but the last, which ignores them.  An
empty table gives an empty one; so does each stage after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.llm import decontaminate, lines, quality_cnn, queries, simhash
from textgraph.llm.common import keyed, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network doesn't reject (operator 4)."""
    net = quality_cnn.fit(docs, queries.table(spark, sf_dir, "labels"))
    return quality_cnn.score(docs, net, docs.columns).where(F.col("score") >= 0.3).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that are similar to an earlier one (operator 5); n_chars follows the text."""
    found = lines.dedup_lines(docs)
    own = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)}
    return found.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id (operator 8)."""
    own = keyed(docs, "doc_id", "text")
    first = simhash.near_duplicates(own, id_col="id", text_col="text").where("id = component").select("id")
    return own.join(first, "id", "left_semi").select("row.*")


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule leaves (operator 1)."""
    found = decontaminate.find_passages(docs, queries.table(spark, sf_dir, "benchmark"), carry=docs.columns)
    return found.where(~decontaminate.contaminated(F.col("n_hit"), F.col("n_words"))).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences (operator 10)."""
    return queries.packed(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", without_passages), ("pack", pack)]

#: SQL can't express the network, the sketches or the tokenizer; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

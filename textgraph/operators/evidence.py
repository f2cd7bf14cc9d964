"""Answers, citations, evidence and the final question-and-answer items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.functions.text import answer_of, citations, each, in_part, normalize_citations, normalize_text, partial_confidences, repair_json, snippet, strip, strip_citations, strip_code_fence

MAX_SECTIONS, SEPARATOR, OMITTED = 30, "\n\n---\n\n", "... (余下 cited sections 省略)"
ITEM = "array<struct<book:string,question:string,answer:string,response:string>>"


def qa_items(replies: DataFrame, key: str = "reply_id", reply: str = "reply") -> DataFrame:
    """(key, qa_idx, book, question, answer, response, item): the array's items, or an object as the only one; replies that
    don't parse give none.  item keeps the whole of each as JSON."""
    text = repair_json(strip_code_fence(F.col(reply)))
    df = replies.select(key, text.alias("t")).withColumn("v", F.try_parse_json("t")).where("v is not null")
    items = F.when(F.schema_of_variant("v").startswith("ARRAY"), F.try_variant_get("v", "$", "array<variant>")).otherwise(F.array("v"))
    df = each(df, items, key, place="qa_idx", value="item")
    field = lambda name: F.try_variant_get("item", f"$.{name}", "string").alias(name)
    return df.select(key, "qa_idx", field("book"), field("question"), field("answer"), field("response"), F.to_json("item").alias("item"))


def cited(qa: DataFrame) -> DataFrame:
    """(qa_idx, section): each answer's citations."""
    text = normalize_citations(answer_of(F.col("answer"), F.col("response")))
    return qa.select("qa_idx", F.explode(citations(text)).alias("section"))


def cited_text(references: DataFrame, registry: DataFrame, most: int = MAX_SECTIONS, headed: bool = True, numbers: DataFrame | None = None) -> DataFrame:
    """(qa_idx, n_cited, text): the cited sections that exist, in order, at most so many and then a mark.  The cap is
    applied to the numbers; only the texts that remain are joined.  numbers: the registry's global_idx, where they can be had for less."""
    numbers = (registry if numbers is None else numbers).select(F.col("global_idx").alias("section"))
    known = references.distinct().join(numbers, "section").groupBy("qa_idx").agg(F.array_sort(F.collect_set("section")).alias("sections"))
    first = known.select("qa_idx", F.size("sections").alias("n_cited"), F.explode(F.slice("sections", 1, most)).alias("section"))
    body = F.concat(F.lit("["), F.col("section").cast("string"), F.lit("] ("), F.col("book"), F.lit(", chars "), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"), F.lit(")\n"), F.col("text")) if headed else F.col("text")
    joined = first.join(registry.withColumnRenamed("global_idx", "section"), "section").withColumn("body", body)
    texts = joined.groupBy("qa_idx").agg(F.first("n_cited").alias("n_cited"), F.array_sort(F.collect_list(F.struct("section", "body"))).alias("t"))
    parts = F.transform("t", lambda x: x["body"])
    parts = F.when(F.col("n_cited") > most, F.concat(parts, F.array(F.lit(OMITTED)))).otherwise(parts)
    return texts.select("qa_idx", "n_cited", F.array_join(parts, SEPARATOR if headed else "\n").alias("text"))


#: Questions with the same cited sections that go together in one row.
MEMBERS = 100


def by_sections(references: DataFrame, numbers: DataFrame) -> DataFrame:
    """(qa_idx, cited, part, sections): which cited sections that exist a question has.  Questions with the same ones share the
    number cited, their smallest qa_idx, so that texts are gathered once for all of them; part deals them MEMBERS or so to a row."""
    known = references.distinct().join(numbers.select(F.col("global_idx").alias("section")), "section").groupBy("qa_idx").agg(F.array_sort(F.collect_set("section")).alias("sections"))
    alike = known.groupBy("sections").agg(F.min("qa_idx").alias("cited"), F.count("*").alias("_n"))
    part = F.pmod(F.xxhash64("qa_idx"), F.ceil(F.col("_n") / MEMBERS)).alias("part")
    return known.join(alike, "sections").select("qa_idx", "cited", part, "sections")


def first_members(members: DataFrame) -> DataFrame:
    """(qa_idx, section): the references of one question for each set of sections."""
    return members.where("qa_idx = cited").select("qa_idx", F.explode("sections").alias("section"))


def evidence_lines(replies: DataFrame) -> DataFrame:
    """(qa_idx, ev_idx, evidence) of replies (qa_idx, reply): lines, trimmed, without empty ones."""
    lines = F.filter(F.transform(F.split(strip_code_fence(F.col("reply")), "\n"), strip), lambda x: F.length(x) > 0)
    return each(replies, lines, "qa_idx", place="ev_idx", value="evidence")


#: Lines of a question that are compared with its source in one row.
TOGETHER = 1000


def scored(evidence: DataFrame, sources: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Evidence with its confidence in the question's cited text.  Each text is normalised once, and a source goes with all
    lines of its question, not with each.  members: (qa_idx, cited, part), where sources are by cited and not by qa_idx."""
    plain = sources.select(F.col("qa_idx").alias("_key"), normalize_text(F.col("text")).alias("_src"))
    row = F.struct(*evidence.columns)
    lines = evidence.withColumn("_ev", normalize_text(F.col("evidence")))
    if members is None:
        lines = lines.withColumns({"_key": F.col("qa_idx"), "_some": F.lit(0)})
    else:
        lines = lines.join(members.select("qa_idx", F.col("cited").alias("_key"), F.col("part").alias("_some")), "qa_idx")
    lines = lines.groupBy("_key", "_some", F.floor(F.col("ev_idx") / TOGETHER).alias("_part"))
    lines = lines.agg(F.collect_list(F.struct(row.alias("row"), F.col("_ev").alias("ev"))).alias("_lines"))
    met = lines.join(plain, "_key").withColumn("_rest", partial_confidences(F.transform("_lines", lambda x: in_part(x["ev"], F.col("_src"))), F.col("_src")))
    conf = lambda x, k: F.when(F.contains(F.col("_src"), x["ev"]), 1.0).otherwise(F.coalesce(F.get("_rest", k), F.lit(0.0)))
    pairs = F.transform("_lines", lambda x, k: F.struct(x["row"].alias("row"), conf(x, k).alias("conf")))
    return met.select(F.explode(pairs).alias("x")).select("x.row.*", "x.conf")


def low_confidence(rows: DataFrame, least: float = 0.5) -> DataFrame:
    return rows.where(F.col("conf") < least).select("qa_idx", "ev_idx", snippet(F.col("evidence")).alias("snippet"), "conf")


def evidence_counts(rows: DataFrame, least: float = 0.5) -> DataFrame:
    low = F.count_if(F.col("conf") < least)
    return rows.agg(F.count("*").alias("total"), low.alias("low"), (F.count("*") - low).alias("good"))


def _grams(text: Column, size: Column) -> Column:
    """The distinct parts of so many characters."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(starts, lambda k: F.substring(text, k, size)))).otherwise(F.array().cast("array<string>"))


def repaired_titles(names: DataFrame, titles: DataFrame) -> DataFrame:
    """(raw, book): the first title, in selection order, that raw equals or whose file name contains it; else raw.
    titles (ord, file, title) is the selection of a run.

    File names that contain raw are sought by the rarest of its parts of three characters (or its one or two), so names
    and files meet by an equal key and only then are compared."""
    wanted = names.select("raw").where("raw is not null").distinct()
    files = titles.select("ord", "file", "title")
    parts = F.flatten(F.array(*[_grams(F.col("file"), F.lit(n)) for n in (1, 2, 3)]))
    parts = files.select("ord", "file", "title", F.explode(parts).alias("gram"))
    own = wanted.where("raw <> ''").select("raw", F.explode(_grams(F.col("raw"), F.least(F.length("raw"), F.lit(3)))).alias("gram"))
    counted = own.join(parts.groupBy("gram").agg(F.count("*").alias("n")), "gram", "left")
    rarest = counted.groupBy("raw").agg(F.min_by("gram", F.coalesce("n", F.lit(0))).alias("gram"))
    inside = rarest.join(parts, "gram").where(F.contains("file", F.col("raw"))).select("raw", "ord", "title")
    equal = wanted.join(files.select(F.col("title").alias("raw"), "ord", "title"), "raw").select("raw", "ord", "title")
    first = files.agg(F.min_by(F.struct("ord", "title"), "ord").alias("f")).select("f.*").where("ord is not null")
    every = wanted.where("raw = ''").join(F.broadcast(first)).select("raw", "ord", "title")  # one row: the first file
    found = inside.union(equal).union(every).groupBy("raw").agg(F.min_by("title", "ord").alias("t"))
    return names.select("raw").distinct().join(found, "raw", "left").select("raw", F.coalesce("t", "raw").alias("book"))


def assembled(qa: DataFrame, evidence: DataFrame, registry: DataFrame, titles: DataFrame) -> DataFrame:
    """Final items: citations stripped, evidence and cited texts attached, titles repaired.  Items without an answer
    keep their response and get no context."""
    ev = evidence.groupBy("qa_idx").agg(F.array_sort(F.collect_list(F.struct("ev_idx", "evidence"))).alias("e")).select("qa_idx", F.transform("e", lambda x: x["evidence"]).alias("evidence"))
    members = by_sections(cited(qa), registry)
    context = first_members(members).withColumnRenamed("section", "global_idx").join(registry.select("global_idx", "text"), "global_idx")
    context = context.groupBy("qa_idx").agg(F.array_sort(F.collect_list(F.struct("global_idx", "text"))).alias("c")).select(F.col("qa_idx").alias("cited"), F.transform("c", lambda x: x["text"]).alias("context"))
    names = repaired_titles(qa.select(F.col("book").alias("raw")), titles).withColumnRenamed("book", "title")
    # texts come last: they are moved once for all questions that cite the same, and copied only into the rows that are given
    df = qa.join(ev, "qa_idx", "left").join(names, F.col("book") == F.col("raw"), "left")
    df = df.join(members.select("qa_idx", "cited"), "qa_idx", "left").join(context, "cited", "left")
    empty = F.array().cast("array<string>")
    return df.select(
        "qa_idx", F.coalesce("title", "book").alias("book"), "question", strip_citations(F.col("answer")).alias("answer"), "response",
        F.coalesce("evidence", empty).alias("evidence"), F.when(F.col("answer").isNotNull(), F.coalesce("context", empty)).alias("context"),
    )



"""Books, their windows and numbers, ordered concatenation, resumption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textgraph.functions.chunking import aligned_spans, fixed_spans, window_texts
from textgraph.functions.text import each, let, strip
from textgraph.functions.vocabulary import QUESTION_TYPES, TITLED_BY_NAME
from textgraph.sources.workspace import kept, work_folder


def catalog(books: DataFrame) -> DataFrame:
    """name, size_kb, chars, est_tokens, windows of books (name, text) with content."""
    stats = let(
        strip(F.col("text")),
        lambda t: F.struct(
            F.floor(F.octet_length(t) / 1024).alias("size_kb"), F.length(t).cast("long").alias("chars"),
            F.floor(F.length(t) / 4).alias("est_tokens"), F.size(aligned_spans(t)).cast("long").alias("windows"),
        ),
    )
    return books.select("name", stats.alias("s")).where("s.chars > 0").select("name", "s.*")


def title(name: Column, raw: Column) -> Column:
    base = F.regexp_replace(name, r"\.cleaned\.txt$", "")
    return F.when(base.isin(*TITLED_BY_NAME), base).otherwise(strip(F.split_part(raw, F.lit("\n"), F.lit(1))))


def _spanned(books: DataFrame, aligned: bool) -> DataFrame:
    """Books with stripped texts and the limits of their windows."""
    df = books.withColumn("text", strip(F.col("text")))
    return df.withColumn("spans", (aligned_spans if aligned else fixed_spans)(F.col("text")))


def windows(books: DataFrame, aligned: bool = True, texts: bool = True) -> DataFrame:
    """(book, section_idx, section_total, start, end, text), sections from 1."""
    df = _spanned(books, aligned).withColumn("section_total", F.size("spans"))
    keep = [c for c in df.columns if c not in ("text", "spans")]
    df = each(df, window_texts(F.col("text"), F.col("spans")) if texts else F.col("spans"), *keep)
    return df.select(*keep, (F.col("k") + 1).alias("section_idx"), "c.*")


def bounds(books: DataFrame, order: str, parts: int = 200, sample: int = 20_000) -> list:
    """Values that cut the books' order into parts of about equal size, from a bounded sample of that column; none where
    the books are no more than that sample, which one task can put in order."""
    ids = books.select(order).where(F.col(order).isNotNull())
    if ids.limit(sample + 1).count() <= sample:
        return []
    values = sorted(r[0] for r in ids.orderBy(F.rand(7)).limit(sample).collect())
    return sorted(set(values[:: max(1, len(values) // parts)]))


def before(totals: DataFrame, book: str, order: str, cuts: list) -> DataFrame:
    """(book, before): how many windows stand before each book's, over (book, order, n), one short row a book: running sums
    in parts of the order that cuts gives and that add up; no sort of all windows, no task with all books where there are cuts."""
    part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(order))) if cuts else F.lit(0)
    totals = totals.withColumn("part", part)
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = totals.groupBy("part").agg(F.sum("n").alias("n")).select("part", earlier(Window.orderBy("part")).alias("ahead"))  # a row for each cut
    each_book = totals.withColumn("before", earlier(Window.partitionBy("part").orderBy(order))).join(F.broadcast(parts), "part")
    return each_book.select(book, (F.col("before") + F.col("ahead")).alias("before"))


#: Books, and bytes of their names and numbers, up to which these are broadcast; beyond, the windows are shuffled by book.
FEW_BOOKS, FEW_BYTES = 300_000, 24 << 20


def numbered(sections: DataFrame, totals: DataFrame, book: str = "book", order: str | None = None) -> DataFrame:
    """global_idx over books in selection order.  totals: (book, order, n), a row for each book with its number of sections."""
    order = order or book
    found = before(totals, book, order, bounds(totals, order))
    size = F.octet_length(F.col(book).cast("string")) + 24
    books, taken = totals.select(size.cast("long").alias("size")).limit(FEW_BOOKS + 1).agg(F.count("*"), F.sum("size")).first()
    if books <= FEW_BOOKS and (taken or 0) <= FEW_BYTES:
        found = F.broadcast(found)
    return sections.join(found, book).withColumn("global_idx", F.col("before") + F.col("section_idx")).drop("before")


def limits(books: DataFrame, order: str | None = None, aligned: bool = True, folder: str | None = None) -> DataFrame:
    """All windows of books (book, text) with their numbers, without texts.  The windows' limits are evaluated once and written,
    a row a book; numbers of windows, their sums and the windows themselves all come from that table."""
    df = _spanned(books, aligned).drop("text").where(F.size("spans") > 0)
    df = kept(df, folder or work_folder(books.sparkSession, "limits"), "limits")
    columns = [c for c in df.columns if c != "spans"]
    each_window = each(df.withColumn("section_total", F.size("spans")), F.col("spans"), *columns, "section_total")
    each_window = each_window.select(*columns, "section_total", (F.col("k") + 1).alias("section_idx"), "c.*")
    totals = df.select(*dict.fromkeys(["book", order or "book"]), F.size("spans").cast("long").alias("n"))
    return numbered(each_window, totals, "book", order)


def texts_of(sections: DataFrame, books: DataFrame) -> DataFrame:
    """Some sections (book, start, end) with their texts, cut from their books: for few sections of a book."""
    own = books.select("book", strip(F.col("text")).alias("whole"))
    text = F.substring("whole", F.col("start") + 1, F.col("end") - F.col("start"))
    return sections.join(own, "book").withColumn("text", strip(text)).drop("whole")


def tasks(books: DataFrame, order: str | None = None, aligned: bool = True, texts: bool = True, folder: str | None = None) -> DataFrame:
    """All windows of books (book, text) with their numbers.  With texts, each text is read once more, which no shuffle moves."""
    if not texts:
        return limits(books, order, aligned, folder)
    totals = _spanned(books, aligned).select(*dict.fromkeys(["book", order or "book"]), F.size("spans").cast("long").alias("n")).where("n > 0")
    totals = kept(totals, folder or work_folder(books.sparkSession, "limits"), "totals")
    return numbered(windows(books, aligned), totals, "book", order)


def registry_slim(sections: DataFrame) -> DataFrame:
    return sections.select("global_idx", "book", F.col("section_idx").alias("section_within_book"), "start", "end")


def ordered_concat(rows: DataFrame, by: list[str], order: str, text: Column, separator: str) -> DataFrame:
    """Each group's texts in order, joined."""
    texts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t"))))
    return rows.groupBy(*by).agg(F.array_join(F.transform(texts, lambda x: x["t"]), separator).alias("text"))


def labelled(order: str, text: str, line_feed: bool = True) -> Column:
    return F.concat(F.lit("[Section "), F.col(order).cast("string"), F.lit("]\n" if line_feed else "] "), F.col(text))


def pending(tasks: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return tasks.join(done.select(key).distinct(), key, "left_anti")


def overwritten(tasks: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Texts replaced by a stage's results where there are any."""
    new = results.select(key, F.col("text").alias("_new"))
    return tasks.join(new, key, "left").withColumn("text", F.coalesce("_new", "text")).drop("_new")


def question_types(spark) -> DataFrame:
    return spark.createDataFrame(list(QUESTION_TYPES), "type string, label string, books array<string>, temperature double, num_questions string")


def type_config(spark, wanted: DataFrame) -> DataFrame:
    """The registry's row for each wanted type; unknown types get the default's."""
    types = question_types(spark)
    default = types.where("type = 'default'").select(*[F.col(c).alias(f"d_{c}") for c in types.columns])
    df = wanted.select(F.col("type").alias("wanted")).join(types, F.col("wanted") == F.col("type"), "left").join(F.broadcast(default))
    known = F.col("type").isNotNull()
    return df.select("wanted", *[F.when(known, F.col(c)).otherwise(F.col(f"d_{c}")).alias(c) for c in types.columns])


def type_books(types: DataFrame, available: DataFrame) -> DataFrame:
    """(type, k, book): the books of each type that exist, in list order."""
    listed = types.select("type", F.posexplode("books").alias("k", "book"))
    return listed.join(available.select(F.col("name").alias("book")).distinct(), "book", "left_semi").select("type", "k", "book")


def estimate_main(windows_: Column, workers: int = 8) -> Column:
    return F.floor(F.floor(windows_ * 35 / workers) / 60)


def estimate_hier(windows_: Column, workers: int = 2) -> Column:
    return F.floor(F.floor((windows_ * 2 + 33) / workers) * 15 / 60)


def reduction(before: Column, after: Column) -> Column:
    return F.when(before == 0, 0.0).otherwise((1 - after / before) * 100)

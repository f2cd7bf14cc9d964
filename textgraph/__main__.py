"""python -m textgraph FOLDER [--books 0,2-4|all] [--type TYPE] [--question TEXT] [--hierarchical] [--guide FILE] [--out FOLDER] [--resume FOLDER]
                           [--no-triples] [--no-evidence] [--workers N] [--long] [--yes]
python -m textgraph --clean FILE.csv [OUT.csv]
python -m textgraph FOLDER --batch [TYPE ...]

The first shows the books and an estimate, asks before it runs, and writes result, triples, registry, audit and report."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textgraph.functions.replies import index_range
from textgraph.functions.vocabulary import QUESTION_TYPES
from textgraph.operators import longbooks as LB
from textgraph.operators import sections as S
from textgraph.operators import triples as T
from textgraph.plans import runs
from textgraph.sources import books as B
from textgraph.sources import sinks as K
from textgraph.sources.workspace import kept


def books_table(catalog: DataFrame) -> str:
    rows = [f"{'Idx':<5}{'Filename':<40}{'Size':>9}  {'Chars':>12}{'Windows':>9}"]
    rows += [f"{i:<5}{r['name']:<40}{r.size_kb:>6} KB  {r.chars:>12,}{r.windows:>9}" for i, r in enumerate(catalog.toLocalIterator())]
    return "\n".join(rows)


def picked(catalog: DataFrame, choice: str) -> DataFrame:
    """(ord, name, windows) of the chosen places of the catalog, which is sorted by name."""
    listed = catalog.select("name", "windows", (F.row_number().over(Window.orderBy("name")) - 1).alias("ord"))  # a short row a book
    chosen = catalog.agg(F.count("*").cast("int").alias("n")).select(F.explode(index_range(F.lit(choice), F.col("n"))).alias("ord"))
    return listed.join(chosen, "ord")


def of_type(catalog: DataFrame, spark: SparkSession, question_type: str) -> DataFrame | None:
    """The books that are set for a type and exist; none where there are none."""
    found = S.type_books(S.question_types(spark).where(F.col("type") == question_type), catalog).select(F.col("k").alias("ord"), F.col("book").alias("name"))
    found = found.join(catalog.select("name", "windows"), "name").select("ord", "name", "windows")
    return found if found.limit(1).count() else None


def clean(spark: SparkSession, path: str, out: str | None) -> str:
    """The cleaner: filters a CSV of triples and reports its counts."""
    rows = B.read_triples(spark, path, ordered=True)
    out = out or K.cleaned_path(path)
    K.write_cleaned(T.clean_filter(rows), out)
    return K.report({"Output": out, **T.clean_counts(rows).first().asDict()})


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("folder", nargs="?")
    parser.add_argument("--books", help="places in the table, such as 0,2-4; all")
    parser.add_argument("--type", default="default", choices=[t[0] for t in QUESTION_TYPES])
    parser.add_argument("--question")
    parser.add_argument("--hierarchical", action="store_true")
    parser.add_argument("--guide", help="a file of subject||predicate||object lines, up to the first blank one; - reads them here")
    parser.add_argument("--out", default="output")
    parser.add_argument("--resume", help="the folder of a run that broke off")
    parser.add_argument("--no-triples", action="store_true", help="no triples are asked for")
    parser.add_argument("--no-evidence", action="store_true", help="no evidence is asked for")
    parser.add_argument("--workers", type=int, help="calls in flight, at most")
    parser.add_argument("--long", action="store_true", help="read books by ranges, for files too long for a task")
    parser.add_argument("--batch", nargs="*", help="question types; none: all")
    parser.add_argument("--clean", nargs="+", metavar="CSV")
    parser.add_argument("--yes", action="store_true", help="don't ask")
    args = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("textgraph").getOrCreate()
    if args.clean:
        print(clean(spark, args.clean[0], args.clean[1] if len(args.clean) > 1 else None))
        return
    if not args.folder:
        parser.error("a folder of books is needed")
    catalog, titles = B.book_catalog(spark, args.folder), B.book_titles(spark, args.folder)
    out = args.resume or K.run_folder(args.out)
    if args.batch is not None:
        texts = B.read_books(spark, args.folder).select(F.col("name").alias("book"), "text")
        named = titles.select(F.col("name").alias("ord"), F.col("name").alias("file"), "title")
        for line in runs.batch(spark, texts, out, types=args.batch or None, titles=named):
            print(*line)
        return
    chosen = None if args.books or args.hierarchical else of_type(catalog, spark, args.type)
    if chosen is None:
        print(books_table(catalog))
        chosen = picked(catalog, args.books or "all")
    if args.hierarchical and not args.question:
        parser.error("a hierarchical run needs a question")
    n = chosen.agg(F.sum("windows").alias("n"))
    minutes = (S.estimate_hier if args.hierarchical else S.estimate_main)(F.coalesce("n", F.lit(0)))
    print("Windows: {}, estimated: {} min".format(*n.select(F.coalesce("n", F.lit(0)), minutes).first()))
    if not args.yes and input("Proceed? [y/N]: ").strip().lower() != "y":
        print("Cancelled.")
        return
    texts = B.read_books(spark, args.folder).join(chosen.select("name"), "name", "left_semi").select(F.col("name").alias("book"), "text")
    if args.hierarchical:
        found = runs.process_hierarchical(texts, args.question, out, resume=bool(args.resume), **({"workers": args.workers} if args.workers else {}))
        print(found["answer"])
    else:
        guide = B.triples_guide(sys.stdin if args.guide == "-" else open(args.guide, encoding="utf-8")) if args.guide else ""
        named = chosen.join(titles, "name").select("ord", F.col("name").alias("file"), "title")
        windows = None
        if args.long:
            keep = lambda df, name: kept(df, f"{out}/long", name)
            pieces = LB.read_pieces(spark, args.folder, B.SUFFIX, keep).join(chosen.select(F.col("name").alias("book")), "book", "left_semi")
            windows = LB.tasks(keep(pieces, "pieces"), keep)
        found = runs.process(texts, out, args.question, titles=named, guide=guide, triples_on=not args.no_triples, evidence_on=not args.no_evidence, question_type=args.type,
                             resume=bool(args.resume), windows=windows, **({"workers": args.workers} if args.workers else {}))
        for r in spark.read.option("lineSep", "\n").text(found["answer_with_evidence"]).toLocalIterator():
            print(r.value)
    print(f"Time: {found['total_time']:.0f}s | Windows: {found['total_windows']} | Triples: {found['triples_count']}")


if __name__ == "__main__":
    main()

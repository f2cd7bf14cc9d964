"""Whole runs: automatic and manual questions over books, the hierarchical answer, and batches over question types.

Each model stage is a table under the run's folder, keyed by window or question and by a mark, a hash of all that the call
depends on (texts, prompts, model).  Replies are committed slice by slice, COMMIT rows a task, so a run that is killed or whose
calls fail for good loses no more than that.  A rerun in the same folder sends only what has no row with its key and mark yet,
so it doubles nothing, and other books, prompts or models never meet foreign replies.
"""

from __future__ import annotations

import time
import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.functions.replies import triples_of_lines
from textgraph.functions.text import let, strip_code_fence
from textgraph.functions.vocabulary import QUESTION_TYPES
from textgraph.operators import evidence as E
from textgraph.operators import longtext as L
from textgraph.operators import names as N
from textgraph.operators import sections as S
from textgraph.operators import triples as T
from textgraph.operators.models import (
    HIER_WORKERS, MAX_ANSWER, MAX_SUMMARY, NO_ANSWER, NO_TRIPLES, WORKERS, Model, OfflineModel, StageFunction, call_or_empty, call_or_raise, dealt, identity, mapped, messages, staged, summarize_windows,
    tasks_of, type_prompts,
)
from textgraph.sources import books as B
from textgraph.sources import sinks as K
from textgraph.sources.workspace import kept, release

SUMMARY = "global_idx long, mark long, summary string, triples array<struct<subject:string,predicate:string,object:string>>"
#: Names of one canonicalization call.
NAMES = 2000
#: Rows that a task of a model stage commits at a time.
COMMIT = 10


def registered(tasks: DataFrame, folder: str) -> DataFrame:
    """The windows of a run, written once: all later stages look their texts up there."""
    return kept(tasks, folder, "registry")


def resumed(asked: DataFrame, folder: str, stage: str, keys: list[str], schema: str, call: Callable[[DataFrame], DataFrame], workers: int = WORKERS, commit: int = COMMIT) -> DataFrame:
    """A stage's rows for what is asked: those that an earlier run wrote for the same keys and mark, and the others by call,
    committed slice by slice before use.  One row for each key, whatever was written twice.  asked is a stored table; call gets
    rows that are dealt to the workers' tasks."""
    spark, both, waiting = asked.sparkSession, [*keys, "mark"], f"{folder}/waiting={stage}"
    done = B.read_done(spark, folder, stage, schema).select(*both)
    fresh = not done.limit(1).count()
    open_ = asked if fresh else asked.join(done.distinct(), both, "left_anti")
    n, lanes = open_.count(), tasks_of(spark, workers)
    if fresh and n <= lanes * commit:  # a single slice, read where it lies
        if n:
            K.append_done(call(dealt(open_, n, workers)), folder, stage)
    elif n:
        for paths in K.write_slices(open_, waiting, commit, lanes * commit):
            rows = spark.read.schema(open_.schema).parquet(*paths)
            K.append_done(call(dealt(rows, min(n, lanes * commit), workers)), folder, stage)
        K.drop(spark, waiting)
    release(spark)
    found = B.read_done(spark, folder, stage, schema)
    if fresh and found.select(*both).distinct().count() == n == found.count():
        return found  # all rows are this call's, once each: none has to be looked up or moved
    return found.join(asked.select(*both).distinct(), both, "left_semi").dropDuplicates(both)


def marked(*parts: Column | str) -> Column:
    return F.xxhash64(*[F.col(p) if isinstance(p, str) else p for p in parts])


def summaries(tasks: DataFrame, model: Callable[[], Model], folder: str, triples_on: bool = True, prompt: str | None = None,
              workers: int = WORKERS, commit: int = COMMIT) -> DataFrame:
    """Summaries and triples of all windows."""
    asked = tasks.withColumn("mark", marked("book", "section_idx", "section_total", "text", F.lit(triples_on), F.lit(prompt or ""), F.lit(identity(model))))
    return resumed(asked, folder, "summary", ["global_idx"], SUMMARY, lambda rows: summarize_windows(rows, model, triples_on, prompt, workers, ready=True), workers, commit)


def raw_triples(found: DataFrame, tasks: DataFrame) -> DataFrame:
    """Triples with book, window and an order that follows windows and places in a reply."""
    each = found.select("global_idx", F.posexplode("triples").alias("k", "t"))
    each = each.join(tasks.select("global_idx", "book", F.col("section_idx").alias("win")), "global_idx")
    return each.select((F.col("global_idx") * 1048576 + F.col("k")).alias("ord"), "t.subject", "t.predicate", "t.object", "book", "win")


def entity_mapping(raw: DataFrame, model: Callable[[], Model], folder: str, most: int = NAMES, workers: int = WORKERS, commit: int = COMMIT) -> DataFrame:
    """One call over all names, none where there is no more than one.  More than ``most`` names are asked in overlapping calls,
    in which all names that may be one meet, and the replies are merged."""
    keep = lambda df, name: kept(df, f"{folder}/names", name)
    names = keep(T.entity_candidates(raw), "names")
    n = names.count()
    asked = N.calls(names, most, keep) if n > most else names.select(F.lit(0).cast("long").alias("call"), "entity")
    listed = asked.groupBy("call").agg(F.count("*").alias("n"), F.concat_ws("\n", F.array_sort(F.collect_list(F.concat(F.lit("- "), "entity")))).alias("text")).where("n > 1")
    listed = keep(listed.select("call", "text", marked("text", F.lit(identity(model))).alias("mark")), "calls")
    schema = "call long, mark long, reply string"
    ask = lambda r, own: {"call": r["call"], "mark": r["mark"], "reply": call_or_empty(own, messages("canonicalize", f"TEXT:\n{r['text']}"), 4096, 1)}
    replies = resumed(listed, folder, "names", ["call"], schema, lambda rows: mapped(rows, ask, schema, model, workers, ready=True), workers, commit)
    lines = T.group_lines(replies, order="call")
    return N.merged(lines.withColumnRenamed("r", "call"), keep) if n > most else keep(T.last_lines(lines), "mapping")


def _guided(guide: str) -> str:
    return f"\n\nReference triples:\n{guide}" if guide else ""


def named(books: DataFrame, titles: DataFrame | None) -> DataFrame:
    """The selection's (ord, file, title); a book without a title goes by its name."""
    if titles is None:
        return books.select(F.col("book").alias("ord"), F.col("book").alias("file"), F.col("book").alias("title"))
    return titles


def checked(items: DataFrame, tasks: DataFrame, folder: str, model: Callable[[], Model], audit: bool = True, workers: int = WORKERS, commit: int = COMMIT) -> dict[str, DataFrame]:
    """Evidence of the items that cite sections: lines, their confidence, the low ones, and counts; nothing is dropped."""
    members = kept(E.by_sections(E.cited(items), tasks), folder, "evidence_members")
    references = E.first_members(members)
    # a text is moved once for all items that cite the same sections; their rows then lie beside each other and compress to one
    alike = items.select("qa_idx", "item").join(members.select("qa_idx", "cited", "part"), "qa_idx").groupBy("cited", "part").agg(F.collect_list(F.struct("qa_idx", "item")).alias("_items"))
    texts = alike.join(E.cited_text(references, tasks).withColumnRenamed("qa_idx", "cited"), "cited").select("n_cited", "text", F.inline("_items"))
    texts = kept(texts.withColumn("mark", marked("text", "item", F.lit(identity(model)))), folder, "evidence_asked")
    release(items.sparkSession)
    quote = lambda r, own: {"qa_idx": r["qa_idx"], "mark": r["mark"], "reply": call_or_empty(own, messages("evidence", f"CITED SECTIONS:\n{r['text']}\n\nQA:\n{r['item']}"), MAX_ANSWER)}
    schema = "qa_idx long, mark long, reply string"
    lines = E.evidence_lines(resumed(texts, folder, "evidence", ["qa_idx"], schema, lambda rows: mapped(rows, quote, schema, model, workers, ready=True), workers, commit))
    scored = kept(E.scored(lines, E.cited_text(references, tasks, headed=False), members), folder, "scored")
    K.drop(items.sparkSession, f"{folder}/evidence_asked")
    release(items.sparkSession)
    low = E.low_confidence(scored)
    if audit:
        K.write_audit(low, f"{folder}/evidence_audit")
    return {"evidence": scored.select("qa_idx", "ev_idx", "evidence"), "low": low, "counts": E.evidence_counts(scored)}


def _prompts(spark: SparkSession, question_type: str, override: dict | None) -> tuple[dict[str, str], str]:
    """The prompts and the label of a type; an override goes before both."""
    known = {t[0]: t for t in QUESTION_TYPES}
    if question_type not in known:
        warnings.warn(f"unknown question type {question_type!r}; the default's prompts are used", stacklevel=3)
    own = known.get(question_type, known["default"])
    return type_prompts(own[0], own[4], override), (override or {}).get("label", "custom") if override else own[1]


def automatic(books: DataFrame, folder: str, model: Callable[[], Model] = OfflineModel, titles: DataFrame | None = None, triples_on: bool = True, evidence_on: bool = True,
              question_type: str = "default", guide: str = "", override: dict | None = None, workers: int = WORKERS, commit: int = COMMIT, windows: DataFrame | None = None) -> dict[str, DataFrame]:
    """Questions for each book: windows, summaries, one QA call a book, evidence, final items, and the books' triples.
    books: (book, text); titles: (ord, file, title).  The question type's prompts and number, or the override's, and the
    guide of triples go into the calls."""
    spark = books.sparkSession
    prompts, _ = _prompts(spark, question_type, override)
    titles = named(books, titles)
    tasks = registered(S.tasks(books, folder=folder) if windows is None else windows, folder)
    found = summaries(tasks, model, folder, triples_on, prompts["summarize"], workers, commit)
    said = found.join(tasks.select("global_idx", "book"), "global_idx")
    per_book = S.ordered_concat(said, ["book"], "global_idx", S.labelled("global_idx", "summary"), "\n\n")
    per_book = per_book.join(titles.select(F.col("file").alias("book"), "title").dropDuplicates(["book"]), "book", "left")
    asked = per_book.select(F.col("book").alias("reply_id"), F.concat(F.coalesce("title", "book"), F.lit("\nTEXT:\n"), "text", F.lit(_guided(guide))).alias("text"))
    asked = kept(asked.withColumn("mark", marked("text", F.lit(prompts["qa"]), F.lit(identity(model)))), folder, "qa_asked")
    ask = lambda r, own: {"reply_id": r["reply_id"], "mark": r["mark"], "reply": call_or_raise(own, messages("qa", r["text"], prompts["qa"]), MAX_ANSWER)}
    schema = "reply_id string, mark long, reply string"
    items = E.qa_items(resumed(asked, folder, "qa", ["reply_id"], schema, lambda rows: mapped(rows, ask, schema, model, workers, ready=True), workers, commit))
    totals = items.groupBy("reply_id").agg(F.count("*").alias("n"))
    items = S.numbered(items.withColumn("section_idx", F.col("qa_idx") + 1), totals, "reply_id").withColumn("qa_idx", F.col("global_idx") - 1)
    items = kept(items.drop("global_idx", "section_idx", "reply_id"), folder, "qa_items")
    out = {"tasks": tasks, "summaries": found, "evidence": spark.createDataFrame([], "qa_idx long, ev_idx int, evidence string")}
    if evidence_on:
        out |= checked(items, tasks, folder, model, workers=workers, commit=commit)
    out["items"] = E.assembled(items, out["evidence"], tasks, titles)
    if triples_on:
        raw = raw_triples(found, tasks)
        out["triples"] = T.post_process_main(raw, entity_mapping(raw, model, folder, workers=workers, commit=commit))
    return out


def manual(books: DataFrame, question: str, folder: str, model: Callable[[], Model] = OfflineModel, guide: str = "", titles: DataFrame | None = None, triples_on: bool = True,
           evidence_on: bool = True, question_type: str = "default", override: dict | None = None, workers: int = WORKERS, commit: int = COMMIT, windows: DataFrame | None = None) -> dict[str, DataFrame]:
    """One answer over all books' summaries: answer (one row, fences off), items (what of it is JSON, with evidence) and triples.
    The prompt names the books by their titles, in selection order.  Items get no context, since only lists do."""
    spark = books.sparkSession
    prompts, _ = _prompts(spark, question_type, override)
    titles = named(books, titles)
    tasks = registered(S.tasks(books, folder=folder) if windows is None else windows, folder)
    found = summaries(tasks, model, folder, triples_on, prompts["summarize"], workers, commit)
    whole = S.ordered_concat(found.withColumn("run", F.lit(0)), ["run"], "global_idx", S.labelled("global_idx", "summary"), "\n\n")
    listed = titles.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "title"))), lambda t: t["title"]), ", ").alias("titles"))
    asked = whole.join(listed).select(F.concat(F.lit("Books: "), "titles", F.lit("\nTEXT:\n"), "text", F.lit(f"\n\nQUESTION:\n{question}{_guided(guide)}")).alias("text"))
    asked = kept(asked.select(F.lit(0).cast("long").alias("reply_id"), "text", marked("text", F.lit(identity(model))).alias("mark")), folder, "answer_asked")
    ask = lambda r, own: {"reply_id": r["reply_id"], "mark": r["mark"], "reply": call_or_raise(own, messages("answer", r["text"]), MAX_ANSWER)}
    schema = "reply_id long, mark long, reply string"
    replies = resumed(asked, folder, "answer", ["reply_id"], schema, lambda rows: mapped(rows, ask, schema, model, workers, ready=True), workers, commit)
    items = E.qa_items(replies).drop("reply_id").withColumn("qa_idx", F.col("qa_idx").cast("long"))
    out = {"tasks": tasks, "summaries": found, "answer": replies.select(strip_code_fence(F.col("reply")).alias("answer")), "evidence": spark.createDataFrame([], "qa_idx long, ev_idx int, evidence string")}
    if evidence_on:
        out |= checked(items, tasks, folder, model, workers=workers, commit=commit)
    out["items"] = E.assembled(items, out["evidence"], tasks, titles)
    if triples_on:
        raw = raw_triples(found, tasks)
        out["triples"] = T.post_process_main(raw, entity_mapping(raw, model, folder, workers=workers, commit=commit))
    return out


def process(books: DataFrame, folder: str, question: str | None = None, model: Callable[[], Model] = OfflineModel, titles: DataFrame | None = None, guide: str = "", triples_on: bool = True,
            evidence_on: bool = True, question_type: str = "default", override: dict | None = None, resume: bool = False, workers: int = WORKERS, commit: int = COMMIT, windows: DataFrame | None = None) -> dict:
    """A whole run with its files: result, triples CSV, registry, audit, report.  windows, where given, are the books' windows,
    made elsewhere (of books that are read by ranges), and books needs their names alone.  Gives what the run is reported by; what grows
    with the books is a table.  The stages' tables are deleted after success, unless the folder is to be resumed from."""
    began = time.time()
    more = dict(model=model, titles=titles, guide=guide, triples_on=triples_on, evidence_on=evidence_on, question_type=question_type, override=override, workers=workers, commit=commit, windows=windows)
    out = manual(books, question, folder, **more) if question else automatic(books, folder, **more)
    answered = time.time() - began
    spark = books.sparkSession
    _, label = _prompts(spark, question_type, override)
    K.write_registry(out["tasks"], f"{folder}/chunk_registry")
    K.write_items(out["items"], f"{folder}/items")
    result = K.write_result(out["items"], folder, label)
    if question and not out["items"].limit(1).count():
        with K.opened(spark, result) as f:  # an answer that is no JSON goes out as it is
            f.write("".join(r.answer for r in out["answer"].collect()).strip() + "\n")
    csv = K.write_triples_file(out["triples"], f"{folder}/triples.csv") if triples_on else None
    windows = out["tasks"].count()
    found = {
        "answer": out.get("answer", out["items"]), "answer_with_evidence": result, "evidence_text": out.get("low"), "per_q_evidence": out["evidence"], "total_windows": windows,
        "total_time": time.time() - began, "answer_time": answered, "triples_count": out["triples"].count() if triples_on else 0, "triples_csv": csv,
        "registry_path": f"{folder}/chunk_registry", "run_dir": folder,
    }
    found["answer"] = found["answer"].sparkSession.createDataFrame(found["answer"].collect(), found["answer"].schema) if question else kept(found["answer"], folder, "final_items")
    found["per_q_evidence"] = kept(found["per_q_evidence"], folder, "final_evidence")
    if found["evidence_text"] is not None:
        found["evidence_text"] = kept(found["evidence_text"], folder, "final_low")
    said = {"Question type": label, "Windows": windows, "Total time": f"{found['total_time']:.0f}s", "Triples": found["triples_count"]}
    if "counts" in out:
        said["Evidence"] = "{good} of {total} good, {low} low".format(**out["counts"].first().asDict())
    K.write_report(spark, said | ({"Triples CSV": csv} if csv else {}) | {"Chunk registry": found["registry_path"]}, f"{folder}/result.log")
    if not resume:
        for stage in ("summary", "qa", "evidence", "answer", "names"):
            K.drop_done(spark, folder, stage)
    return found


def compress(pieces: DataFrame, folder: str, model: Callable[[], Model] = OfflineModel, separator: str = "\n\n", target: int = 4000, chunk: int = 800, rounds: int = 10,
             workers: int = HIER_WORKERS, commit: int = COMMIT) -> DataFrame:
    """(text_id, text) of texts that lie in pieces (text_id, k, text): sentences are grouped and shortened, round by round, until a
    text is within the target.  Texts stay in pieces until then; each round is resumed like any stage.  A sentence of more than
    L.LONG characters is too long for a request: it keeps its text as after a call that fails, or what the model's compressed()
    says, and stays in pieces too."""
    spark, finished, at = pieces.sparkSession, [], []
    schema = "text_id string, pos long, mark long, text string"

    def ask(r: dict, own: Model) -> dict:
        reply = call_or_empty(own, messages("compress", f"Section {r['pos'] + 1}\nTEXT:\n{r['text']}"), MAX_SUMMARY)
        return {"text_id": r["text_id"], "pos": r["pos"], "mark": r["mark"], "text": reply.strip() or r["text"]}

    for number in range(rounds):
        at.append(f"{folder}/compressing/{number}")
        keep = lambda df, name, at=at[-1]: kept(df, at, name)
        long = keep(L.sizes(pieces, separator).where(F.col("size") > target), "long")
        if not long.limit(1).count():
            break
        groups, apart = L.groups_apart(pieces.join(long, "text_id", "left_semi"), separator, keep, chunk)
        groups = keep(groups, "groups")
        open_ = groups.groupBy("text_id").agg(F.count("*").alias("n")).join(long, "text_id").where((F.col("n") > 1) | (F.col("size") > 1.5 * target))
        open_ = keep(open_.select("text_id"), "open")
        if not open_.limit(1).count():
            break
        finished.append(keep(L.joined(pieces.join(open_, "text_id", "left_anti"), separator), "finished"))
        asked = groups.where("text is not null").join(open_, "text_id", "left_semi").withColumn("mark", marked("text", F.lit(identity(model))))
        done = resumed(asked, folder, f"compress{number}", ["text_id", "pos"], schema, lambda rows: mapped(rows, ask, schema, model, workers, ready=True), workers, commit)
        if apart is None:
            pieces = done.select("text_id", F.col("pos").alias("k"), "text")
        else:
            beyond = L.leading(apart.join(F.broadcast(open_), "text_id", "left_semi"), separator, keep, getattr(model(), "compressed", lambda size: size))
            pieces = L.in_order(done.select("text_id", "pos", "text"), keep(beyond, "beyond"))
        pieces, separator = keep(pieces, "pieces"), " "
    out = L.joined(pieces, separator)
    for more in finished:
        out = out.union(more)
    out = kept(out, folder, "compressed")
    K.drop(spark, f"{folder}/compressing")
    return out


def hierarchical(books: DataFrame, question: str, folder: str, model: Callable[[], Model] = OfflineModel, preprocess: str | StageFunction = "preprocess",
                 summarize: str | StageFunction = "summarize", resume: bool = False, workers: int = HIER_WORKERS, commit: int = COMMIT) -> dict[str, DataFrame]:
    """Clean, summarize, compress, extract triples, polish, answer; two written stages, by prompts or by functions of one's own,
    before the run's text, which stays in pieces until it is short.  Books without a window give an answer from nothing."""
    spark = books.sparkSession
    schema, carried = "global_idx long, mark long, text string", ("book", "section_idx", "section_total")
    tasks = registered(S.tasks(books, aligned=False, folder=folder), folder)
    whole = ", ".join([schema, *(f"{c} {tasks.schema[c].dataType.simpleString()}" for c in carried)])
    own = lambda stage: F.lit(stage if isinstance(stage, str) else getattr(stage, "__qualname__", "stage"))
    # what the next stage needs of a window goes with its text, which is then joined with nothing
    asked = tasks.withColumn("mark", marked("book", "section_idx", "text", own(preprocess), F.lit(identity(model)), F.lit("carried")))
    cleaned = resumed(asked, folder, "preprocess", ["global_idx"], whole, lambda rows: staged(rows, preprocess, model, workers=workers, ready=True, carried=carried), workers, commit)
    tasks = tasks.drop("text", *carried).join(cleaned.drop("mark"), "global_idx").select(*tasks.columns)
    asked = cleaned.drop("mark").withColumn("mark", marked("book", "section_idx", "text", own(summarize), F.lit(identity(model))))
    missing = lambda r: f"[Section {r['section_idx']} summary unavailable]"
    found = resumed(asked, folder, "hier_summary", ["global_idx"], schema, lambda rows: staged(rows, summarize, model, missing, workers=workers, ready=True), workers, commit)
    pieces = found.select(F.lit("run").alias("text_id"), (F.col("global_idx") - 1).alias("k"), S.labelled("global_idx", "text", line_feed=False).alias("text"))
    short = compress(pieces, folder, model, workers=workers, commit=commit).select("text")
    short = short if short.limit(1).count() else spark.createDataFrame([("",)], "text string")
    one = lambda stage, tokens: lambda r, own: {"text": call_or_empty(own, messages(stage, f"TEXT:\n{r['text']}"), tokens)}
    listed = mapped(short, one("extract", MAX_SUMMARY), "text string", model).select(F.posexplode(triples_of_lines(F.col("text"))).alias("ord", "t")).select("ord", "t.*")
    final = kept(T.post_process_hier(listed), folder, "triples")
    polish = mapped(short, one("polish", MAX_SUMMARY), "text string", model).join(short.select(F.col("text").alias("before"))).select(F.coalesce(F.nullif("text", F.lit("")), "before").alias("text"))
    polished = kept(polish, folder, "polished")
    facts = final.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first_ord", F.concat(F.lit("- "), F.concat_ws(" || ", "subject", "predicate", "object")).alias("x")))), lambda t: t["x"]), "\n").alias("facts"))
    ready = polished.join(facts).select(let(F.col("facts"), lambda f: F.when(f == "", NO_TRIPLES).otherwise(f)).alias("facts"), "text")
    ask = lambda r, own: {"answer": call_or_empty(own, messages("answer", f"QUESTION:\n{question}\nTRIPLES:\n{r['facts']}\nTEXT:\n{r['text']}"), MAX_ANSWER) or NO_ANSWER}
    answer = kept(mapped(ready, ask, "answer string", model), folder, "answer")
    if not resume:
        K.drop_done(spark, folder, "preprocess")
        K.drop_done(spark, folder, "hier_summary")
        for number in range(10):
            K.drop_done(spark, folder, f"compress{number}")
    return {"tasks": tasks, "compressed": short, "triples": final, "polished": polished, "answer": answer}


def process_hierarchical(books: DataFrame, question: str, folder: str, model: Callable[[], Model] = OfflineModel, resume: bool = False, workers: int = HIER_WORKERS) -> dict:
    """A hierarchical run with its files, and what it is reported by."""
    began = time.time()
    out = hierarchical(books, question, folder, model, resume=resume, workers=workers)
    windows = books.sparkSession.read.parquet(f"{folder}/registry").count()
    answer, short, polished = (out[k].first()[0] for k in ("answer", "compressed", "polished"))
    csv = K.write_triples_file(out["triples"].orderBy("first_ord"), f"{folder}/triples.csv", T.KEY)
    spent = time.time() - began
    found = {
        "answer": answer, "compressed_summary": short, "polished_summary": polished, "total_windows": windows, "total_time": spent, "answer_time": spent,
        "triples_count": out["triples"].count(), "triples_csv": csv, "compressed_chars": len(short), "polished_chars": len(polished),
    }
    K.write_report(books.sparkSession, {"Question": question, "Answer": answer, **{k.replace("_", " ").capitalize(): v for k, v in found.items() if k not in ("answer", "compressed_summary", "polished_summary")}}, f"{folder}/result.log")
    return found


def batch(spark: SparkSession, books: DataFrame, folder: str, model: Callable[[], Model] = OfflineModel, types: list[str] | None = None, titles: DataFrame | None = None) -> list[tuple[str, str, str]]:
    """(type, book, state) of each type's books, each asked by its type's prompts; a book that fails is reported and the
    others go on."""
    wanted = S.question_types(spark)
    wanted = wanted.where(F.col("type").isin(*types)) if types else wanted
    out = []
    for r in S.type_books(wanted, books.select(F.col("book").alias("name"))).orderBy("type", "k").collect():
        try:
            own = titles.where(F.col("file") == r.book) if titles is not None else None
            found = process(books.where(F.col("book") == r.book), f"{folder}/{r.type}/{r.book}", None, model, own, question_type=r.type)
            K.write_by_type(found["answer"].withColumns({"type": F.lit(r.type), "source": F.lit(r.book)}), f"{folder}/by_type")
            out.append((r.type, r.book, "done"))
        except Exception as e:
            out.append((r.type, r.book, f"failed: {e}"))
    return out

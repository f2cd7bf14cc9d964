"""Language-model stages: one interface, an offline and an HTTP model, and the loops around calls.

Stages run in mapInPandas, over no more tasks than there are workers; each task has its own model and its share of them as
threads, so calls in flight never exceed the workers, however many cores there are.  Calls are costly and not deterministic,
so callers write a stage's output before they use it twice.
"""

from __future__ import annotations

import itertools
import json
import re
import time
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

Messages = list[dict[str, str]]
NO_SUMMARY, NO_ANSWER, NO_TRIPLES = "[summary unavailable]", "Unable to generate answer.", "(no triples extracted)"
MAX_SUMMARY, MAX_ANSWER, MAX_ITERATIONS, OUTER_ATTEMPTS = 2048, 8192, 3, 3
#: Calls in flight: of automatic and manual runs, and of hierarchical ones.
WORKERS, HIER_WORKERS = 8, 2

#: Our own instructions; each begins with the name of its stage.
PROMPTS = {
    "summarize": "SUMMARIZE. Sum up this section of a book in plain sentences.",
    "extract": "EXTRACT. List facts of the section as subject||PREDICATE||object lines in a [TRIPLES]...[/TRIPLES] block.",
    "validate": "VALIDATE. Check the triples against the section. Reply [VERDICT]PASS[/VERDICT] or FAIL, and [FEEDBACK]...[/FEEDBACK].",
    "revise": "REVISE. Correct the triples by the feedback and list all of them in a [TRIPLES] block.",
    "canonicalize": "CANONICALIZE. Group names of one entity: a [GROUP] block each, the canonical name first, one name a line.",
    "qa": "QA. Write 3-5 questions with answers as a JSON array of book, question, answer; cite sections as [N].",
    "evidence": "EVIDENCE. Quote the sentences of the cited sections that support the answer, one a line.",
    "preprocess": "PREPROCESS. Clean this text of page furniture and keep its wording.",
    "compress": "COMPRESS. Shorten this text and keep its facts.",
    "polish": "POLISH. Smooth this summary.",
    "answer": "ANSWER. Answer the question from the summary and the triples.",
}


#: What each question type has sections summed up for, and what it asks; types without a focus of the first kind take the plain summary.
TYPE_FOCUS = {
    "default": (None, "on any part of the book"),
    "relationship": ("Keep to the people: who meets whom, what they are to each other, what they feel, and what changes between them.", "on how two or more named people stand to each other"),
    "timeline": ("Keep to the course of events: what happens in which order, when, and what follows from what.", "on the order of events, and on what comes before, after or because of what"),
    "detail": ("Keep the particulars: names, numbers, places, things, and words that are said.", "on one particular that a single section gives"),
    "global": (None, "that only several sections together can answer"),
}


def type_prompts(question_type: str = "default", number: str = "3-5", override: dict | None = None) -> dict[str, str]:
    """The prompts of a question type (the default's for an unknown one) with its number of questions; override may hold
    summary_prompt, qa_prompt and num_questions, which go before the type's own."""
    override = override or {}
    focus, asked = TYPE_FOCUS.get(question_type, TYPE_FOCUS["default"])
    summary = PROMPTS["summarize"] + (f" {focus}" if focus else "")
    qa = f"QA. Write 3-5 questions {asked}, with answers, as a JSON array of book, question, answer; cite sections as [N] in answers, never in questions."
    qa = override.get("qa_prompt", qa).replace("3-5", override.get("num_questions", "3-5" if override else number), 1)
    return {"summarize": override.get("summary_prompt", summary), "qa": qa}


class Model(Protocol):
    def call(self, messages: Messages, max_tokens: int) -> str: ...


def messages(stage: str, user: str, system: str | None = None) -> Messages:
    return [{"role": "system", "content": system or PROMPTS[stage]}, {"role": "user", "content": user}]


@dataclass
class OfflineModel:
    """Deterministic replies from the request's own text, for tests and dry runs."""

    passes: bool = True

    def call(self, messages: Messages, max_tokens: int) -> str:
        stage, text = messages[0]["content"].split(".")[0], messages[1]["content"]
        if stage in ("EXTRACT", "REVISE"):
            words = [x[0] for x in itertools.islice(re.finditer(r"\w+", text.split("TEXT:\n")[-1]), 4)]
            return "[TRIPLES]\n" + "\n".join(f"- {a}||KNOWS||{b}" for a, b in zip(words[:4:2], words[1:4:2])) + "\n[/TRIPLES]"
        if stage == "VALIDATE":
            return "[VERDICT]PASS[/VERDICT]" if self.passes else "[VERDICT]FAIL[/VERDICT][FEEDBACK]again[/FEEDBACK]"
        if stage == "CANONICALIZE":
            return ""
        if stage == "QA":
            number, section = (re.search(p, t) for p, t in ((r"\d+", messages[0]["content"]), (r"\[Section (\d+)\]", text)))
            cited = f"A [{section[1] if section else 1}]"
            return json.dumps([{"book": text.split("\n")[0], "question": f"Q {k}?", "answer": cited} for k in range(1, int(number[0] if number else 1) + 1)])
        if stage == "EVIDENCE":
            return text.split("\n")[2][:80] if text.count("\n") > 1 else ""
        if stage == "COMPRESS":
            return text.split("TEXT:\n")[-1][: self.compressed(len(text.split("TEXT:\n")[-1]))]
        if stage in ("PREPROCESS", "POLISH"):
            return text.split("TEXT:\n")[-1]
        return re.split(r"(?<=[.!?])\s", text.split("TEXT:\n")[-1].strip(), maxsplit=1)[0]

    def compressed(self, size: int) -> int:
        """How many of a text's first characters COMPRESS keeps, for texts that are too long for a request."""
        return max(1, size // 2)


@dataclass
class HttpModel:
    """A chat-completions endpoint."""

    url: str
    model: str
    key: str = ""
    timeout: float = 600.0

    def call(self, messages: Messages, max_tokens: int) -> str:
        body = json.dumps({"model": self.model, "messages": messages, "max_tokens": max_tokens, "temperature": 0.3}).encode()
        request = urllib.request.Request(f"{self.url}/chat/completions", body, {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        with urllib.request.urlopen(request, timeout=self.timeout) as reply:
            return json.load(reply)["choices"][0]["message"]["content"].strip()


def call_or_raise(model: Model, sent: Messages, max_tokens: int, attempts: int = 6, wait: float = 2.0) -> str:
    """Attempts with a wait that grows by the same amount; the last error is raised."""
    for attempt in range(attempts):
        try:
            return model.call(sent, max_tokens)
        except Exception as e:
            if attempt == attempts - 1:
                raise RuntimeError(f"model call failed after {attempts} attempts: {e}") from e
            time.sleep(wait * (attempt + 1))
    raise AssertionError


def call_or_empty(model: Model, sent: Messages, max_tokens: int, attempts: int = 3, wait: float = 2.0, validate: Callable[[str], bool] | None = None) -> str:
    """Errors wait; empty replies, and those that validate refuses, don't; "" after the last attempt."""
    for attempt in range(attempts):
        try:
            if (reply := model.call(sent, max_tokens)) and (validate is None or validate(reply)):
                return reply
        except Exception:
            if attempt < attempts - 1:
                time.sleep(wait * (attempt + 1))
    return ""


def parse_block(reply: str) -> list[tuple[str, str, str]]:
    """The row functions' own parse of a triples block; functions.replies has the column form."""
    found = re.search(r"(?is)\[TRIPLES\](.*?)\[/TRIPLES\]", reply)
    parts = [[p.strip() for p in re.sub(r"^[- ]+", "", x.strip()).split("||") if p.strip()] for x in (found[1].split("\n") if found else [])]
    return [tuple(p[:3]) for p in parts if len(p) >= 3]


def passed(reply: str) -> tuple[bool, str]:
    said, told = re.search(r"(?is)\[VERDICT\](.*?)\[/VERDICT\]", reply), re.search(r"(?is)\[FEEDBACK\](.*?)\[/FEEDBACK\]", reply)
    word = said[1].upper() if said else ""
    return "PASS" in word and "FAIL" not in word, told[1].strip() if told else ""


def summarized(model: Model, text: str, where: str, triples_on: bool = True, wait: float = 2.0, prompt: str | None = None) -> tuple[str, list[tuple[str, str, str]]]:
    """Summary and triples of a window: extract, then validate up to three times with a revision after the first two
    failures.  Triples stay if the last validation fails too; a revision without triples keeps the ones before."""
    lines = lambda ts: "\n".join("||".join(t) for t in ts)
    for attempt in range(OUTER_ATTEMPTS):
        try:
            summary = call_or_raise(model, messages("summarize", f"{where}\nTEXT:\n{text}", prompt), MAX_SUMMARY, wait=wait) or NO_SUMMARY
            triples = parse_block(call_or_raise(model, messages("extract", f"SUMMARY:\n{summary}\nTEXT:\n{text}"), MAX_SUMMARY, wait=wait)) if triples_on else []
            for k in range(MAX_ITERATIONS if triples else 0):
                good, feedback = passed(call_or_raise(model, messages("validate", f"TRIPLES:\n{lines(triples)}\nTEXT:\n{text}"), max(512, MAX_SUMMARY // 2), wait=wait))
                if good:
                    break
                if k < MAX_ITERATIONS - 1:
                    triples = parse_block(call_or_raise(model, messages("revise", f"FEEDBACK:\n{feedback}\nTRIPLES:\n{lines(triples)}\nTEXT:\n{text}"), MAX_SUMMARY, wait=wait)) or triples
            return summary, triples
        except Exception:
            if attempt < OUTER_ATTEMPTS - 1:
                time.sleep(wait * (attempt + 1))
    return NO_SUMMARY, []


def identity(model: Callable[[], Model]) -> str:
    """What tells a model's replies from another's."""
    made = model()
    return ":".join([type(made).__qualname__, *(str(v) for k in ("url", "model") if (v := getattr(made, k, None)))])


def tasks_of(spark: SparkSession, workers: int) -> int:
    """Tasks that share the workers: no more than these, and than the cores."""
    return max(1, min(workers, spark.sparkContext.defaultParallelism))


#: Rows and bytes of an Arrow batch: what a worker holds of texts is a few times these bytes.
BATCH = {"maxRecordsPerBatch": 1000, "maxBytesPerBatch": 2 << 20}
#: Rows a task beyond which rows are read where they lie; fewer are dealt evenly.
DEALT = 2000


def bounded_batches(spark: SparkSession) -> None:
    """Keep this session's Arrow batches within BATCH (a single row may be longer)."""
    for key, value in BATCH.items():
        key = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(key, None) != str(value):
            spark.conf.set(key, str(value))


def dealt(rows: DataFrame, n: int, workers: int = WORKERS) -> DataFrame:
    """n rows of a stored table over no more tasks than the workers have.  Few rows are dealt evenly; many are read from where
    they lie, in as many parts as there are cores, and no text is shuffled."""
    tasks = tasks_of(rows.sparkSession, workers)
    return rows.repartition(tasks) if n <= DEALT * tasks else rows.coalesce(tasks)


def mapped(df: DataFrame, row: Callable[[dict, Model], dict], schema: str, model: Callable[[], Model], workers: int = WORKERS, ready: bool = False) -> DataFrame:
    """row(values, model) for each row, by so many workers over all tasks; schema lists what it returns.  ready: the rows come
    from dealt()."""
    tasks = tasks_of(df.sparkSession, workers)
    threads = max(1, workers // tasks)
    bounded_batches(df.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = model()
        names = [x.split()[0] for x in re.split(r",\s*(?![^<]*>)", schema)]
        with ThreadPoolExecutor(threads) as pool:
            for frame in frames:
                each = frame.to_dict("records")
                rows = list(pool.map(lambda r: row(r, own), each)) if threads > 1 else [row(r, own) for r in each]
                yield pd.DataFrame(rows, columns=names)

    return (df if ready else df.repartition(tasks)).mapInPandas(run, schema)


def summarize_windows(tasks: DataFrame, model: Callable[[], Model] = OfflineModel, triples_on: bool = True, prompt: str | None = None, workers: int = WORKERS, ready: bool = False) -> DataFrame:
    """(global_idx, mark, summary, triples) over (global_idx, mark, book, section_idx, section_total, text)."""

    def row(r: dict, own: Model) -> dict:
        summary, triples = summarized(own, r["text"], f"Book {r['book']}, section {r['section_idx']} of {r['section_total']}", triples_on, prompt=prompt)
        return {"global_idx": r["global_idx"], "mark": r["mark"], "summary": summary, "triples": [dict(zip(("subject", "predicate", "object"), t)) for t in triples]}

    schema = "global_idx long, mark long, summary string, triples array<struct<subject:string,predicate:string,object:string>>"
    return mapped(tasks.select("global_idx", "mark", "book", "section_idx", "section_total", "text"), row, schema, model, workers, ready)


#: A stage of one's own: (text, book, section, sections, model) -> text.
StageFunction = Callable[[str, str, int, int, Model], str]


def staged(tasks: DataFrame, stage: str | StageFunction, model: Callable[[], Model] = OfflineModel, fallback: Callable[[dict], str] | None = None,
           validate: Callable[[str], bool] | None = None, workers: int = WORKERS, ready: bool = False, carried: tuple[str, ...] = ()) -> DataFrame:
    """(global_idx, mark, text) and the columns carried (book, section_idx, section_total): one call a row, by the name of a
    prompt or by a function; what fails keeps the fallback, or its text."""

    def row(r: dict, own: Model) -> dict:
        if callable(stage):
            reply = stage(r["text"], r["book"], r["section_idx"], r["section_total"], own)
        else:
            where = f"Book {r['book']}, section {r['section_idx']} of {r['section_total']}"
            reply = call_or_empty(own, messages(stage, f"{where}\nTEXT:\n{r['text']}"), MAX_SUMMARY, validate=validate)
        return {"global_idx": r["global_idx"], "mark": r["mark"], "text": reply or (fallback(r) if fallback else r["text"])} | {c: r[c] for c in carried}

    schema = ", ".join(["global_idx long, mark long, text string", *(f"{c} {tasks.schema[c].dataType.simpleString()}" for c in carried)])
    return mapped(tasks.select("global_idx", "mark", "book", "section_idx", "section_total", "text"), row, schema, model, workers, ready)

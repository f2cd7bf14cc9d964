"""Relational operators, sources, sinks, models and runs on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from textgraph.operators import evidence as E
from textgraph.operators import models as M
from textgraph.operators import sections as S
from textgraph.operators import triples as T
from textgraph.plans import runs
from textgraph.sources import books as B
from textgraph.sources import sinks as K
from textgraph.streaming.windows import stream_windows

TRIPLE = "ord long, subject string, predicate string, object string, book string, win int"


def triples(spark, rows):
    return spark.createDataFrame([(k, *r, "x", 1) if len(r) == 3 else (k, *r) for k, r in enumerate(rows)], TRIPLE)


def test_evidence_is_sorted_by_number(spark):
    rows = [("a", "KNOWS", "b", "x", 10), ("a", "KNOWS", "b", "x", 2), ("a", "KNOWS", "b", "a", 3), ("a", "KNOWS", "b", "x", 2)]
    got = T.dedup_evidence(triples(spark, rows)).collect()
    assert [(r.evidence, r.evidence_count) for r in got] == [("a:3; x:2; x:10", 3)]


def test_last_group_wins(spark):
    group = lambda *x: "[GROUP]\n" + "\n".join(x) + "\n[/GROUP]"
    of = lambda reply: {r.variant: r.canonical for r in T.mapping_of(spark.createDataFrame([(0, reply)], "reply_id long, reply string")).collect()}
    assert of(group("A", "B") + group("C", "B")) == {"A": "A", "B": "C", "C": "C"}
    assert of(group("A", "B") + group("B")) == {"A": "A", "B": "B"}
    assert of("") == {}


def test_canonical_names_and_aliases(spark):
    mapping = spark.createDataFrame([("Boldwood", "William Boldwood"), ("Jem", "James Ryder")], "variant string, canonical string")
    got = T.canonicalize(triples(spark, [("Boldwood", "KNOWS", "Jem"), ("Boldwood", "KNOWS", "Boldwood")]), mapping).orderBy("part", "ord", "object").collect()
    assert [(r.subject, r.predicate, r.object) for r in got] == [
        ("William Boldwood", "KNOWS", "James Ryder"), ("William Boldwood", "KNOWS", "William Boldwood"),
        ("William Boldwood", "ALIAS", "Boldwood"), ("James Ryder", "ALIAS", "Jem"),
    ]


def test_rules_partition_rows(spark):
    rows = [("a", "ALIAS", "a"), ("b", "ALIAS", "c"), ("x", "HAS_ATTRIBUTE", "b"), ("p", "PARTICIPATES_IN", "a"), ("p", "LOVES", "Nobody"), ("p", "KNOWS", "q")]
    got = {r.rule: r.n for r in T.rule_counts(triples(spark, rows)).collect()}
    assert sum(got.values()) == len(rows) and got["self_ref"] == got["alias_attr_subj"] == got["participates_entity"] == got["relation_vague_obj"] == 1
    scoped = triples(spark, rows).withColumn("run", F.col("ord") % 2)
    assert T.ruled(scoped, scope=["run"]).where("rule = 'alias_attr_subj'").count() == 0
    assert T.quality_filter(triples(spark, [])).count() == 0


def test_cited_sections_are_capped(spark):
    registry = spark.createDataFrame([(k, "b", 0, 1, f"t{k}") for k in range(1, 41)], "global_idx long, book string, start int, end int, text string")
    refs = spark.createDataFrame([(0, k) for k in range(1, 50)] + [(1, 7)], "qa_idx long, section int")
    got = {r.qa_idx: r for r in E.cited_text(refs, registry).collect()}
    assert got[0].text.count(E.SEPARATOR) == 30 and got[0].text.endswith(E.OMITTED) and got[0].n_cited == 40
    assert got[1].text == "[7] (b, chars 0-1)\nt7"


def test_items_and_assembly(spark):
    replies = spark.createDataFrame([("r", '[{"book":"","question":"q","answer":"A [1][9]","extra":5},{"question":"r","response":"s [1]"}]')], "reply_id string, reply string")
    items = E.qa_items(replies)
    assert json.loads(items.where("qa_idx = 0").first()["item"])["extra"] == 5
    registry = spark.createDataFrame([(1, "b", 0, 1, "t1")], "global_idx long, book string, start int, end int, text string")
    titles = spark.createDataFrame([(0, "f.cleaned.txt", "First"), (1, "g.cleaned.txt", "Second")], "ord int, file string, title string")
    evidence = spark.createDataFrame([(1, 0, "e")], "qa_idx int, ev_idx int, evidence string")
    got = {r.qa_idx: r for r in E.assembled(items, evidence, registry, titles).collect()}
    assert got[0].book == "First" and got[0].answer == "A" and got[0].context == ["t1"] and got[0].evidence == []
    assert got[1].response == "s [1]" and got[1].context is None and got[1].evidence == ["e"]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "b").mkdir()
    for name, text in {"One a+b.cleaned.txt": "\n Title\nText here. ", "Dracula.cleaned.txt": "no title", "c.cleaned.txt": " \n", "d.txt": "x"}.items():
        (tmp_path / "b" / name).write_text(text)
    folder = f"file://{tmp_path}/b"
    assert [r.name for r in B.book_catalog(spark, folder).collect()] == ["Dracula.cleaned.txt", "One a+b.cleaned.txt"]
    assert {r.name: r.title for r in B.book_titles(spark, folder).collect()} == {"Dracula.cleaned.txt": "Dracula", "One a+b.cleaned.txt": ""}
    assert B.read_book(spark, folder, "Dracula.cleaned.txt").first().text == "no title"
    df = triples(spark, [('Zed "q"', "KNOWS", "b\nc"), ("it", "KNOWS", "d,e")])
    path = K.write_triples_file(T.dedup_evidence(df), f"{tmp_path}/t/t.csv")
    assert open(path, "rb").read(3) == b"\xef\xbb\xbf"
    back = B.read_triples(spark, f"file://{path}")
    assert back.columns == K.TRIPLE_COLUMNS and {r.object for r in back.collect()} == {"b\nc", "d,e"}
    kept = T.clean_filter(back.withColumn("ord", F.monotonically_increasing_id()))
    K.write_cleaned(kept, K.cleaned_path(path))
    assert open(f"{tmp_path}/t/t_cleaned.csv").read().startswith("subject,predicate") and kept.count() == 1
    assert K.write_triples_file(T.dedup_evidence(df.limit(0)), f"{tmp_path}/t/none.csv") is None
    assert B.triples_guide(["a||b||c\n", "d\n", "\n", "e"]) == "a||b||c\nd"
    assert K.report({"a": 1}) == "a: 1\n"


class Counting:
    def __init__(self, replies):
        self.replies, self.stages = replies, []

    def call(self, messages, max_tokens):
        stage = messages[0]["content"].split(".")[0]
        self.stages.append(stage)
        reply = self.replies[stage]
        if isinstance(reply, Exception):
            raise reply
        return reply


def test_adversarial_loop():
    block = "[TRIPLES]\na||KNOWS||b\n[/TRIPLES]"
    m = Counting({"SUMMARIZE": "s", "EXTRACT": block, "VALIDATE": "[VERDICT]FAIL[/VERDICT]", "REVISE": "none"})
    assert M.summarized(m, "t", "w", wait=0) == ("s", [("a", "KNOWS", "b")])
    assert (m.stages.count("VALIDATE"), m.stages.count("REVISE")) == (3, 2)
    m = Counting({"SUMMARIZE": "s"})
    assert M.summarized(m, "t", "w", triples_on=False, wait=0) == ("s", [])
    m = Counting({"SUMMARIZE": ValueError()})
    assert M.summarized(m, "t", "w", wait=0) == (M.NO_SUMMARY, []) and len(m.stages) == 18


def test_retries():
    m = Counting({"QA": ValueError()})
    assert M.call_or_empty(m, M.messages("qa", ""), 1, wait=0) == "" and len(m.stages) == 3
    with pytest.raises(RuntimeError):
        M.call_or_raise(m, M.messages("qa", ""), 1, wait=0)


def test_runs(spark, tmp_path):
    text = "Anna met Ben. Ben met Carl. " * 300
    books = spark.createDataFrame([("b1", text), ("b2", "Short text here. It ends.")], "book string, text string")
    out = runs.automatic(books, f"file://{tmp_path}/a")
    assert {r.book for r in out["items"].collect()} == {"b1", "b2"}
    assert out["tasks"].count() == out["summaries"].count() and out["triples"].count() > 0
    assert out["counts"].first().asDict() == {"total": 6, "low": 0, "good": 6}
    asked = runs.manual(books, "Who?", f"file://{tmp_path}/m")
    assert asked["answer"].count() == 1 and asked["items"].count() == 0 and asked["triples"].count() > 0
    assert runs.hierarchical(books, "Who?", f"file://{tmp_path}/h")["answer"].first().answer
    done = runs.batch(spark, spark.createDataFrame([("Dracula.cleaned.txt", "A b. C d.")], "book string, text string"), f"file://{tmp_path}/t", types=["relationship", "default"])
    assert done == [("relationship", "Dracula.cleaned.txt", "done")]


class Counted(M.OfflineModel):
    """Leaves a file for each call, by its stage."""

    folder = ""

    def call(self, messages, max_tokens):
        import uuid

        stage = messages[0]["content"].split(".")[0]
        open(f"{self.folder}/{stage}-{uuid.uuid4().hex}", "w").close()
        return super().call(messages, max_tokens)


def counting(folder):
    folder.mkdir(parents=True)

    def model():
        own = Counted()
        own.folder = str(folder)
        return own

    return model, lambda: len(list(folder.iterdir()))


def test_reruns_call_and_double_nothing(spark, tmp_path):
    books = spark.createDataFrame([("b1", "Anna met Ben. Ben met Carl. " * 200), ("b2", "Short text here. It ends.")], "book string, text string")
    model, calls = counting(tmp_path / "calls")
    first = runs.automatic(books, f"file://{tmp_path}/a", model, triples_on=False)
    rows, lines, n = first["items"].collect(), first["evidence"].count(), calls()
    again = runs.automatic(books, f"file://{tmp_path}/a", model, triples_on=False)
    assert sorted(again["items"].collect()) == sorted(rows) and again["evidence"].count() == lines and calls() == n
    # other texts under the same numbers are not taken for those of the first run
    other = spark.createDataFrame([("b1", "Dora left. " * 300), ("b2", "Short text here. It ends.")], "book string, text string")
    changed = runs.automatic(other, f"file://{tmp_path}/a", model, triples_on=False)
    assert {r.summary for r in changed["summaries"].collect()} == {"Dora left.", "Short text here."} and calls() > n


def test_a_run_that_breaks_loses_no_more_than_a_slice(spark, tmp_path):
    """The model fails for good at the 61st summary; the rerun asks for at most ten windows a task again."""
    books = spark.createDataFrame([("b1", "Anna met Ben. Ben met Carl. " * 15000)], "book string, text string")
    model, calls = counting(tmp_path / "calls")
    folder = f"file://{tmp_path}/a"
    tasks = runs.registered(S.tasks(books), folder)
    windows, workers = tasks.count(), 3
    assert windows > 130

    class Dying(Counted):
        def call(self, messages, max_tokens):
            import os

            if len(os.listdir(self.folder)) >= 61:
                os._exit(1)  # the worker itself is gone, again and again
            return super().call(messages, max_tokens)

    def dying():
        own = Dying()
        own.folder = str(tmp_path / "calls")
        return own

    dying.__qualname__ = "counting"
    asked = lambda m: runs.resumed(
        tasks.withColumn("mark", runs.marked("text")), folder, "summary", ["global_idx"], runs.SUMMARY, lambda rows: M.summarize_windows(rows, m, False, None, workers), workers
    )
    with pytest.raises(Exception, match="(?i)worker|job aborted|crashed"):
        asked(dying)
    kept = runs.B.read_done(spark, folder, "summary", runs.SUMMARY).count()
    before = calls()
    assert kept == 60 and before - kept <= 10 * workers
    assert asked(model).select("global_idx").distinct().count() == windows
    assert calls() - before == windows - kept  # nothing that was committed is asked again
    assert not (tmp_path / "a/waiting=summary").exists()


@pytest.mark.parametrize(("workers", "tasks"), [(1, 1), (2, 2), (8, 4), (6, 4)])
def test_calls_in_flight(spark, tmp_path, workers, tasks):
    """A model that notes how many calls are open at once, over all tasks."""
    folder = str(tmp_path)

    class Open(M.OfflineModel):
        def call(self, messages, max_tokens):
            import os
            import time
            import uuid

            name = f"{folder}/open-{uuid.uuid4().hex}"
            open(name, "w").close()
            time.sleep(0.02)
            seen = sum(n.startswith("open-") for n in os.listdir(folder))
            os.remove(name)
            return str(seen)

    assert M.tasks_of(spark, workers) == tasks
    rows = spark.range(160).selectExpr("id as global_idx", "id as mark", "'b' as book", "1 as section_idx", "1 as section_total", "'x' as text").repartition(9)
    seen = [int(r.text) for r in M.staged(rows, "polish", Open, workers=workers).collect()]
    assert len(seen) == 160 and max(seen) <= workers and (workers < 2 or max(seen) > 1)


def test_replies_of_another_model_are_not_taken(spark, tmp_path):
    books = spark.createDataFrame([("b1", "Anna met Ben. Ben met Carl.")], "book string, text string")

    class Other(M.OfflineModel):
        def call(self, messages, max_tokens):
            return "other"

    tasks = runs.registered(S.tasks(books), f"file://{tmp_path}")
    assert runs.summaries(tasks, M.OfflineModel, f"file://{tmp_path}", False).first().summary != "other"
    assert runs.summaries(tasks, Other, f"file://{tmp_path}", False).first().summary == "other"
    named = M.identity(lambda: M.HttpModel("http://h", "m1"))
    assert named != M.identity(lambda: M.HttpModel("http://h", "m2")) and "http://h" in named


def test_question_types_guide_and_override(spark, tmp_path):
    said = M.type_prompts("timeline", "4")
    assert "Write 4 questions" in said["qa"] and said["summarize"] != M.PROMPTS["summarize"] and M.type_prompts("nope") == M.type_prompts("default")
    assert M.type_prompts("timeline", "4", {"qa_prompt": "QA. 3-5 or 3-5", "num_questions": "7"})["qa"] == "QA. 7 or 3-5"
    books = spark.createDataFrame([("x.cleaned.txt", "Anna met Ben. Ben met Carl.")], "book string, text string")
    titles = spark.createDataFrame([(0, "x.cleaned.txt", "The Meeting")], "ord int, file string, title string")
    seen = tmp_path / "seen"
    seen.mkdir()

    class Kept(M.OfflineModel):
        def call(self, messages, max_tokens):
            import uuid

            (seen / uuid.uuid4().hex).write_text(messages[0]["content"] + "|" + messages[1]["content"])
            return super().call(messages, max_tokens)

    out = runs.automatic(books, f"file://{tmp_path}/t", Kept, titles, False, question_type="relationship", guide="a||KNOWS||b")
    assert out["items"].count() == 4 and {r.book for r in out["items"].collect()} == {"The Meeting"}
    sent = [p.read_text() for p in seen.iterdir()]
    assert any(x.startswith("QA.") and "The Meeting\nTEXT:" in x and "a||KNOWS||b" in x for x in sent)
    own = runs.automatic(books, f"file://{tmp_path}/o", titles=titles, triples_on=False, override={"num_questions": "2", "qa_prompt": "QA. Write 3-5 questions."})
    assert own["items"].count() == 2
    runs.manual(books, "Who?", f"file://{tmp_path}/m", Kept, titles=titles, triples_on=False)
    assert any("Books: The Meeting" in p.read_text() for p in seen.iterdir())


def test_whole_runs_and_their_files(spark, tmp_path):
    books = spark.createDataFrame([("b1", "Anna met Ben. Ben met Carl. " * 200), ("b2", "Short text here. It ends.")], "book string, text string")
    out = runs.process(books, f"file://{tmp_path}/p")
    assert set(out) == {"answer", "answer_with_evidence", "evidence_text", "per_q_evidence", "total_windows", "total_time", "answer_time", "triples_count", "triples_csv", "registry_path", "run_dir"}
    items = json.load(open(out["answer_with_evidence"]))
    assert len(items) == out["answer"].count() == out["per_q_evidence"].count() == 6 and items[0]["evidence"] and items[0]["answer"] == "A"
    assert open(out["triples_csv"], encoding="utf-8-sig").read().count("KNOWS") == out["triples_count"] > 0
    assert spark.read.json(out["registry_path"]).count() == out["total_windows"]
    assert "Evidence: 6 of 6 good" in (tmp_path / "p/result.log").read_text() and not list((tmp_path / "p").glob("stage=*"))
    asked = runs.process(books, f"file://{tmp_path}/q", "Who?")
    assert open(asked["answer_with_evidence"]).read().strip() == asked["answer"].first().answer
    found = runs.process_hierarchical(books, "Who?", f"file://{tmp_path}/h")
    assert len(found) == 10 and found["answer"] and found["total_windows"] == 3 and (tmp_path / "h/result.log").exists()


def test_runs_of_no_books(spark, tmp_path):
    none = spark.createDataFrame([], "book string, text string")
    assert runs.automatic(none, f"file://{tmp_path}/a")["items"].count() == 0
    assert runs.process(none, f"file://{tmp_path}/p")["triples_csv"] is None
    assert runs.manual(none, "Who?", f"file://{tmp_path}/m")["answer"].count() == 0
    assert runs.hierarchical(none, "Who?", f"file://{tmp_path}/h")["answer"].count() == 1


def test_stages_of_ones_own(spark):
    tasks = spark.createDataFrame([(1, 0, "b", 1, 2, "ab"), (2, 0, "b", 2, 2, "")], "global_idx long, mark long, book string, section_idx int, section_total int, text string")
    done = M.staged(tasks, lambda text, book, k, total, model: f"{book}{k}/{total}:{text.upper()}" if text else "").collect()
    assert {r.global_idx: r.text for r in done} == {1: "b1/2:AB", 2: ""}
    tries = []
    assert M.call_or_empty(Counting({"QA": "no"}), M.messages("qa", ""), 1, wait=0, validate=lambda r: tries.append(r)) == "" and tries == ["no"] * 3


class Grouping:
    """Groups names by their last word; the canonical name is the longest, then the first."""

    def call(self, messages, max_tokens):
        last = {}
        for n in (x[2:] for x in messages[1]["content"].split("\n")[1:]):
            last.setdefault(n.split()[-1], []).append(n)
        return "".join("[GROUP]\n" + "\n".join(sorted(g, key=lambda n: (-len(n), n))) + "\n[/GROUP]" for g in last.values())


@pytest.mark.parametrize("most", [2000, 40, 7])
def test_names_in_several_calls(spark, tmp_path, most):
    """Several calls give the mapping of one, with a first name that most names have."""
    rows = [(k, f"Mr. Nob{k}" if k % 3 else f"Anna Nob{k}", "KNOWS", f"Anna Maria Nob{k}", "x", 1) for k in range(60)]
    rows += [(99, "Bathsheba", "KNOWS", "It", "x", 1), (100, "Boldwood", "KNOWS", "William Boldwood", "x", 1)]
    got = {r.variant: r.canonical for r in runs.entity_mapping(spark.createDataFrame(rows, TRIPLE), Grouping, f"file://{tmp_path}", most).collect()}
    want = {x: f"Anna Maria Nob{k}" for k in range(60) for x in (f"Mr. Nob{k}" if k % 3 else f"Anna Nob{k}", f"Anna Maria Nob{k}")} | {n: "William Boldwood" for n in ("Boldwood", "William Boldwood")}
    alone = {n: c for n, c in got.items() if n in ("Bathsheba", "It")}
    assert {n: c for n, c in got.items() if n not in alone} == want and all(n == c for n, c in alone.items())


def test_calls_hold_no_more_names_than_they_may(spark, tmp_path):
    """Every two names that share a beginning meet in a call."""
    from textgraph.operators import names as N

    own = [f"Anna N{k}" for k in range(50)] + [f"Mr. {w} Lee" for w in ("Ben", "Benno", "Carl")] + ["Mr.", "the", "?!", "Carla", "Élise", "Elis"]
    keep = lambda df, name: runs.kept(df, f"file://{tmp_path}", name)
    df = spark.createDataFrame([(x,) for x in own], "entity string")
    begins = {r.entity: set(r.b) for r in df.select("entity", N.beginnings(F.col("entity")).alias("b")).collect()}
    assert begins["Mr. Benno Lee"] == {"ben", "lee"} and begins["Mr."] == {"mr"} and begins["?!"] == {"?!"} and begins["Élise"] == {"éli"}
    for most in (4, 10, 64):
        calls = {}
        for r in N.calls(df, most, keep).collect():
            calls.setdefault(r.call, set()).add(r.entity)
        slack = 2 if most < 20 else 1  # names are dealt to parts by hash, so tiny parts vary
        assert max(map(len, calls.values())) <= slack * most
        together = {frozenset((a, b)) for c in calls.values() for a in c for b in c}
        assert all(frozenset((a, b)) in together for a in own for b in own if a != b and begins[a] & begins[b])


def test_moves_of_starts_equal_the_pattern():
    """Every place of odd texts against the pattern of the column function."""
    import random
    import re

    from textgraph.functions import chunking as C
    from textgraph.operators import longbooks as LB

    space = C.WS.replace("\\p", "p")
    r = random.Random(6)
    for look in (5, 12, 200):
        for _ in range(60):
            text = "".join(r.choice("ab.!?…\"'」 \n\u3000é。") for _ in range(r.randint(1, 60)))
            want = []
            for k in range(len(text)):
                part = text[k : k + look]
                m = re.match(rf"(?s)^.*?[.!?。！？…][\"'」』]?{space}+", part) or re.match(rf"(?s)^.*?{space}", part)
                want.append(m.end() if m else 0)
            assert LB.moves(text, look).tolist() == want


@pytest.mark.parametrize("size", [700, 100_000])
def test_windows_of_long_books(spark, tmp_path, size):
    """Files read by ranges give the windows of whole files; white space at the ends, long lines, letters of several bytes."""
    import random

    from textgraph.operators import longbooks as LB

    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdeé日😀") for _ in range(r.randint(1, 9)))
    prose = lambda n: "".join(word() + r.choice([" ", " ", " ", ". ", "! ", ".\n", "\n", '." ', ".\r\n"]) for _ in range(n))
    (tmp_path / "b").mkdir()
    books = {"a b+c": " \n\n" * 900 + prose(9000) + "\n \n" * 2000, "é": prose(40), "blank": " \n" * 3000, "one": "x" * 30_000 + ". " + "y" * 9000, "lines": "\n" * 50 + prose(3000).replace(" ", "\n"), "empty": ""}
    for name, text in books.items():
        (tmp_path / f"b/{name}.cleaned.txt").write_text(text, encoding="utf-8", newline="")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        keep = lambda df, name: runs.kept(df, f"file://{tmp_path}/w", name)
        pieces = LB.read_pieces(spark, f"file://{tmp_path}/b", ".cleaned.txt", keep, size)
        pieces = keep(pieces, "pieces")
        if size < 20_000:
            assert pieces.where("book = 'a b+c.cleaned.txt'").count() > 8
        joined = {x.book: x.t for x in pieces.groupBy("book").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda p: p["text"]), "").alias("t")).collect()}
        assert {n: t.strip("\n") for n, t in joined.items()} == {f"{n}.cleaned.txt": t.strip("\n") for n, t in books.items() if t}
        got = LB.aligned(pieces, keep).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    own = spark.createDataFrame([(f"{n}.cleaned.txt", t) for n, t in books.items()], "book string, text string")
    want = S.windows(own).select("book", "start", "end", "text").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 15


def test_linked_names_follow_to_the_last(spark, tmp_path):
    from textgraph.operators import names as N

    keep = lambda df, name: runs.kept(df, f"file://{tmp_path}", name)
    lines = [(2, 0, 1, "A", "B"), (1, 0, 1, "B", "C"), (1, 0, 0, "C", "C"), (3, 0, 0, "Z", "Z"), (5, 0, 1, "P", "Q"), (6, 0, 1, "Q", "P"), (7, 1, 1, "K", "L"), (7, 0, 1, "K", "M")]
    lines += [(8, k, 1, f"chain{k:02}", f"chain{k + 1:02}") for k in range(30)]
    df = spark.createDataFrame(lines, "call long, g int, k int, variant string, canonical string")
    got = {r.variant: r.canonical for r in N.merged(df, keep).collect()}
    want = {"A": "C", "B": "C", "C": "C", "Z": "Z", "P": "P", "Q": "P", "K": "L", "L": "L"} | {f"chain{k:02}": "chain30" for k in range(31)}
    assert got == want


def test_titles_by_parts(spark):
    files = [(k, f"{n}.cleaned.txt", f"T{n}") for k, n in enumerate(["abba", "ab", "é1", "xx", "abbab"])]
    raws = ["", "a", "é", "ab", "bba", "abbab", "Tab", "ned", "none", "Txx", "xx.c", "zzzz", None]
    titles = spark.createDataFrame(files, "ord int, file string, title string")
    got = {r.raw: r.book for r in E.repaired_titles(spark.createDataFrame([(x,) for x in raws], "raw string"), titles).collect()}
    assert got == {x: next((t for _, f, t in files if x is not None and (x == t or x in f)), x) for x in raws}
    assert E.repaired_titles(spark.createDataFrame([("",)], "raw string"), titles.limit(0)).first().book == ""


def test_command_line(spark, tmp_path, capsys):
    from textgraph import __main__ as C

    (tmp_path / "b").mkdir()
    (tmp_path / "b/a.cleaned.txt").write_text("One\nAnna met Ben. Ben met Carl.")
    (tmp_path / "b/c.cleaned.txt").write_text("Two\nDora left.")
    C.main([f"file://{tmp_path}/b", "--books", "1", "--out", f"file://{tmp_path}/o", "--yes"])
    said = capsys.readouterr().out
    assert "a.cleaned.txt" in said and "Windows: 1" in said and '"book": "Two"' in said and '"book": "One"' not in said
    (tmp_path / "t.csv").write_text("subject,predicate,object\nIt,KNOWS,b\nAnna,KNOWS,Ben\n")
    C.main(["--clean", f"{tmp_path}/t.csv"])
    assert "kept: 1" in capsys.readouterr().out and (tmp_path / "t_cleaned.csv").read_text().count("\n") == 2


def test_command_line_switches(spark, tmp_path, capsys):
    """Books read by ranges give the same run; no triples and no evidence are asked for where they are switched off."""
    from textgraph import __main__ as C

    (tmp_path / "b").mkdir()
    for name in ("a", "c d"):
        (tmp_path / f"b/{name}.cleaned.txt").write_text(f"Title {name}\n" + "Anna met Ben. Ben met Carl.\n" * 400)
    said = []
    for k, more in enumerate((["--long"], [])):
        C.main([f"file://{tmp_path}/b", "--out", f"file://{tmp_path}/o{k}", "--yes", "--books", "all", "--no-triples", "--no-evidence", "--workers", "3", *more])
        said.append([x for x in capsys.readouterr().out.split("\n") if not x.startswith("Time")])
        assert not list((tmp_path / f"o{k}").glob("*/triples.csv"))
    assert said[0] == said[1] and any('"Title c d"' in x for x in said[0]) and any("Windows: 8" in x for x in said[0])


@pytest.mark.parametrize("seed", [1, 2])
def test_quoted_csv_by_ranges(spark, tmp_path, seed):
    """Random files with line feeds, doubled and stray quotes, cut anywhere, against the csv module."""
    import csv
    import io
    import random

    from textgraph.sources import quoted as Q

    r = random.Random(seed)
    some = lambda n: "".join(r.choice('ab",\n é') for _ in range(r.randint(0, n)))
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\r\n" if seed == 2 else "\n")
    writer.writerow(["subject", 'pre"dicate', "line\nfeed"])
    for k in range(1500):
        if k % 9 == 4:
            out.write(r.choice(['x"y,"q"z,"a""b"c"d', 'a"b', '"open\nclosed" tail"s,2', ",,"]) + "\n")
        elif k % 50 == 7:
            out.write("\n")
        writer.writerow([some(9), some(300 if k % 40 == 0 else 5), r.choice(["", "x", '"', "\n\n"])])
    path = tmp_path / "f.csv"
    path.write_text(out.getvalue(), encoding="utf-8-sig", newline="")
    want = [x for x in csv.reader(io.StringIO(out.getvalue(), newline="")) if x]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = B.read_triples(spark, f"file://{path}", ordered=True)
        rows = sorted(got.collect(), key=lambda x: x.ord)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got.columns == [*want[0], "ord"]
    assert [list(x[:3]) for x in rows] == [[*x[:3], *[None] * (3 - len(x))] for x in want[1:]]
    for _ in range(2000):
        line, inside = some(12).replace("\n", ""), r.random() < 0.5
        whole = ('"' if inside else "") + line + "\nEND"  # a field that goes on holds the line feed
        rows_ = list(csv.reader(io.StringIO(whole, newline="")))
        assert Q.ends_inside(line, inside) == (len(rows_) == 1), (line, inside)


def test_unknown_types_are_told(spark):
    with pytest.warns(UserWarning, match="nope"):
        assert runs._prompts(spark, "nope", None)[1] == runs._prompts(spark, "default", None)[1]


def test_files_go_to_the_file_system_of_their_path(spark, tmp_path):
    """Beside Spark's own tables, wherever these are: here through a file system that only Spark knows."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.out.link./o", f"file://{tmp_path}")
    spark.conf.set("fs.viewfs.mounttable.out.link./o", f"file://{tmp_path}")
    items = spark.createDataFrame([(0, "b", "q", "é")], "qa_idx long, book string, question string, answer string")
    path = K.write_result(items, "viewfs://out/o/deep/er", "My label")
    assert path == "viewfs://out/o/deep/er/result_My_label.json"
    assert "é" in (tmp_path / "deep/er/result_My_label.json").read_text(encoding="utf-8")
    K.write_report(spark, {"a": 1}, "viewfs://out/o/r.log")
    assert (tmp_path / "r.log").read_text() == "a: 1\n"


def test_compression_stops(spark, tmp_path):
    text = lambda *pieces: spark.createDataFrame([("a", k, x) for k, x in enumerate(pieces)], "text_id string, k long, text string")
    assert runs.compress(text("x" * 5000), f"file://{tmp_path}/1").first().text == "x" * 5000
    assert len(runs.compress(text("Some words. " * 1000), f"file://{tmp_path}/2").first().text) <= 4000
    several = text("Short.", "Text.").union(spark.createDataFrame([("b", k, "Some words here. " * 90) for k in range(40)], "text_id string, k long, text string"))
    got = {r.text_id: r.text for r in runs.compress(several, f"file://{tmp_path}/3").collect()}
    assert got["a"] == "Short.\n\nText." and 0 < len(got["b"]) <= 4000
    assert runs.compress(spark.createDataFrame([], "text_id string, k long, text string"), f"file://{tmp_path}/4").count() == 0


@pytest.mark.parametrize(("block", "chunk"), [(4096, 800), (3, 40), (1, 12)])
def test_texts_in_pieces(spark, tmp_path, monkeypatch, block, chunk):
    """Groups over seams of pieces and blocks equal those of the whole text in one row."""
    import random

    from textgraph.functions.sentences import group_sentences, split_sentences
    from textgraph.operators import longtext as L

    monkeypatch.setattr(L, "BLOCK", block)
    r = random.Random(block)
    words = ["Mr..", "Mr.", "one", "Two", "x.", "Y!", "é", "e.\n", "\n\nNew", "  gap", "A", "St.. ", "[S]", "W" * 30 + "."]
    rows = [(f"t{n}", k, f"{r.choice(['Go', 'x', '.', 'É', '[1]'])}{' '.join(r.choice(words) for _ in range(r.randint(0, 40)))}") for n in range(5) for k in range((1, 2, 9, 30, 40)[n])]
    pieces = spark.createDataFrame(rows, "text_id string, k long, text string").repartition(3)
    for number, separator in enumerate((" ", "\n\n")):
        keep = lambda df, name, number=number: runs.kept(df, f"file://{tmp_path}/{number}", name)
        whole = [(n, separator.join(x for t, _, x in rows if t == n)) for n in sorted({t for t, _, _ in rows})]
        want = spark.createDataFrame(whole, "text_id string, text string").select("text_id", F.posexplode(group_sentences(split_sentences(F.col("text"), chunk), chunk)))
        assert sorted(map(tuple, L.groups(pieces, separator, keep, chunk).collect())) == sorted(map(tuple, want.collect()))
        assert {r.text_id: r.size for r in L.sizes(pieces, separator).collect()} == {n: len(x) for n, x in whole}


def test_stream_of_windows(spark, tmp_path):
    (tmp_path / "a b+é.cleaned.txt").write_text("Ab cd. " * 500)
    q = stream_windows(spark, f"file://{tmp_path}").writeStream.format("memory").queryName("windows").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r.section_idx, r.start) for r in spark.sql("select * from windows order by start").collect()] == [(1, 0), (2, 3003)]
    assert {r.book for r in spark.sql("select book from windows").collect()} == {"a b+é.cleaned.txt"}


def test_types(spark):
    wanted = spark.createDataFrame([("timeline",), ("nope",)], "type string")
    assert {r.wanted: r.type for r in S.type_config(spark, wanted).collect()} == {"timeline": "timeline", "nope": "default"}


def test_questions_that_cite_the_same_share_a_text(spark):
    from textgraph.operators import evidence as E

    references = spark.createDataFrame([(0, 1), (0, 2), (1, 2), (1, 1), (2, 2), (3, 2), (3, 9), (4, 9)], "qa_idx long, section int")
    members = E.by_sections(references, spark.createDataFrame([(1,), (2,)], "global_idx long"))
    assert sorted((r.qa_idx, r.cited, r.sections) for r in members.collect()) == [(0, 0, [1, 2]), (1, 0, [1, 2]), (2, 2, [2]), (3, 2, [2])]
    assert sorted((r.qa_idx, r.section) for r in E.first_members(members).collect()) == [(0, 1), (0, 2), (2, 2)]


def test_stages_move_no_texts(spark, tmp_path):
    """Rows wait in chunks where they lie; many are read by a stage's tasks without a shuffle, few are dealt evenly."""
    rows = spark.range(250, numPartitions=3)
    chunks = K.write_chunks(rows, f"file://{tmp_path}/waiting", 40)
    sizes = [spark.read.parquet(c).count() for c in chunks]
    assert max(sizes) == 40 and sum(sizes) == 250 and len(sizes) == 9
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(M.dealt(rows, 10**6)) and "Exchange" in plan(M.dealt(rows, 250))


def test_last_pieces_get_no_tables(spark, tmp_path):
    from textgraph.operators import longbooks as LB
    from textgraph.sources.workspace import kept

    text = "Anna met Ben. " * 600
    pieces = spark.createDataFrame([("a", 0, text), ("b", 0, text), ("b", 1, text)], "book string, k long, text string")
    keep = lambda df, name: kept(df, f"file://{tmp_path}", name)
    assert LB.aligned(pieces, keep).where("book = 'b'").count() == 6
    assert [(r.book, r.k) for r in spark.read.parquet(f"file://{tmp_path}/tables0").collect()] == [("b", 0)]
    assert spark.read.parquet(f"file://{tmp_path}/heads").where("head <> ''").count() == 1


def test_small_parts_fill_slices(spark, tmp_path):
    """Rows in many parts of few rows are asked in as many slices as their number needs, not in one for each few parts."""
    path = f"file://{tmp_path}/waiting"
    slices = K.write_slices(spark.range(0, 100, 1, 20), path, 40, 40)  # 20 parts of 5 rows
    sizes = [spark.read.parquet(*s).count() for s in slices]
    assert max(sizes) <= 40 and sum(sizes) == 100 and len(sizes) == 3
    asked = spark.range(0, 100, 1, 20).select(F.col("id").alias("qa_idx"), F.lit(0).cast("long").alias("mark"))
    calls = []
    found = runs.resumed(asked, f"file://{tmp_path}/run", "s", ["qa_idx"], "qa_idx long, mark long", lambda rows: calls.append(1) or rows, workers=2, commit=20)
    assert len(calls) == 3 and sorted(r.qa_idx for r in found.collect()) == list(range(100))


def test_long_sentences_stay_in_pieces(spark, tmp_path, monkeypatch):
    """Sentences over many pieces give the same groups and the same compressed text, though no row holds one."""
    import random

    from textgraph.functions.sentences import group_sentences, split_sentences
    from textgraph.operators import longtext as L

    r, chunk = random.Random(1), 30
    words = ["one", "Two", "e.\n", "\n\n\nnew", " \n\n ", "  gap ", "[S]", "Z. ", "x" * 9]
    rows = [(f"t{n}", k, f"[{k}] {' '.join(r.choice(words[: 9 - n % 2 * 2]) for _ in range(r.randint(0, 9)))}") for n in range(4) for k in range((1, 9, 30, 30)[n])]
    rows += [("u", k, f"[{k}] a" + " b" * (k % 7)) for k in range(50)]  # one sentence
    pieces = spark.createDataFrame(rows, "text_id string, k long, text string").repartition(3)
    monkeypatch.setattr(L, "BLOCK", 16)
    for number, separator in enumerate((" ", "\n\n")):
        keep = lambda df, name, number=number: runs.kept(df, f"file://{tmp_path}/{number}", name)
        whole = [(n, separator.join(x for t, _, x in rows if t == n)) for n in sorted({t for t, _, _ in rows})]
        want = spark.createDataFrame(whole, "text_id string, text string").select("text_id", F.posexplode(group_sentences(split_sentences(F.col("text"), chunk), chunk)))
        want = sorted(map(tuple, want.collect()))
        monkeypatch.setattr(L, "LONG", 0)  # 2 * chunk holds
        assert sorted(map(tuple, L.groups(pieces, separator, keep, chunk).collect())) == want
        longest = spark.read.parquet(f"file://{tmp_path}/{number}/sentences").agg(F.max(F.length("sentence"))).first()[0]
        assert longest <= max([4 * chunk, *(len(x) for _, _, x in rows)]) < max(len(x) for _, _, x in want) or separator == "\n\n"
    compressed = {}
    for long in (0, 1 << 22):
        monkeypatch.setattr(L, "LONG", long)
        compressed[long] = sorted(map(tuple, runs.compress(pieces, f"file://{tmp_path}/c{long}", target=50, chunk=chunk, rounds=2).collect()))
    assert compressed[0] == compressed[1 << 22] and len(compressed[0]) == 5
